import pytest

from stellate.sources import files, versions


def rows(spark, root):
    return sorted(tuple(r) for r in versions.read_current(spark, root).collect())


def test_replace_reads_the_version_before(spark, tmp_path):
    root = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        versions.read_current(spark, root)
    versions.replace_table(spark.createDataFrame([(1, None), (2, "x")], "k long, v string"), root)
    versions.replace_table(versions.read_current(spark, root).selectExpr("k + 10 AS k", "v"), root)
    assert rows(spark, root) == [(11, None), (12, "x")]
    assert sorted(tuple(r) for r in files.backfill_table(spark, root, ["v"]).collect()) == [(11, "Unknown"), (12, "x")]
    assert versions.current_version(spark, root)[0] == 3
    versions.drop_old_versions(spark, root)
    assert rows(spark, root) == [(11, "Unknown"), (12, "x")] and len(list((tmp_path / "t").glob("v-*"))) == 1


def dies(*_a, **_k):
    raise RuntimeError("lost")


@pytest.mark.parametrize("step", ["rows", "manifest", "half a manifest", "after"])
def test_a_crash_at_any_step_leaves_a_whole_version(spark, tmp_path, monkeypatch, step):
    root = str(tmp_path / "t")
    versions.replace_table(spark.createDataFrame([(1,)], "k long"), root)
    new = spark.createDataFrame([(2,), (3,)], "k long")
    if step == "rows":
        with pytest.raises(Exception):  # noqa: B017
            versions.replace_table(new.selectExpr("k", "raise_error('lost') AS x"), root)
    elif step == "manifest":
        monkeypatch.setattr(versions, "publish", dies)
        with pytest.raises(RuntimeError):
            versions.replace_table(new, root)
        monkeypatch.undo()
    elif step == "half a manifest":
        versions.replace_table(new, root)
        last = sorted((tmp_path / "t" / "_manifest").glob("0*"))[-1]
        (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
        last.write_text(last.read_text()[:10])
    else:
        versions.replace_table(new, root)
    assert rows(spark, root) == ([(2,), (3,)] if step == "after" else [(1,)])
    versions.replace_table(spark.createDataFrame([(9,)], "k long"), root)  # the next run is not hindered
    assert rows(spark, root) == [(9,)]
    versions.drop_old_versions(spark, root)
    assert rows(spark, root) == [(9,)]


def test_of_two_writers_from_one_version_one_fails(spark, tmp_path):
    root = str(tmp_path / "t")
    versions.replace_table(spark.createDataFrame([(1,)], "k long"), root)
    versions.publish(spark, root, 2, "v-other")
    with pytest.raises(Exception):  # noqa: B017
        versions.publish(spark, root, 2, "v-mine")
