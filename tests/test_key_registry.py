import os

import pytest

from stellate.operators import key_registry as R
from stellate.sources import versions


def load(spark, root, name, rows):
    df = spark.createDataFrame(rows, "k string, extra int")
    return sorted(tuple(r) for r in R.register_load(root, name, df, "k", "key").collect())


def checks(spark, root):
    return {r["check"]: r["found"] for r in R.verify_registry(spark, root, "k", "key").collect()}


def test_keys_stay_and_new_ones_follow(spark, tmp_path):
    root = str(tmp_path / "reg")
    assert R.committed_keys(spark, root) is None
    first = [("b", 1, "one"), ("c", 2, "one")]
    assert load(spark, root, "one", [("c", 1), ("b", 1), (None, 3), ("c", 2)]) == first
    assert load(spark, root, "one", [("z", 1)]) == first  # a load that is committed
    assert load(spark, root, "two", [("a", 1), ("c", 1)]) == [("a", 3, "two"), *first]
    assert load(spark, root, "none", []) == [("a", 3, "two"), *first]
    assert load(spark, root, "three", [("d", 1)])[-1] == ("d", 4, "three")
    assert checks(spark, root) == {"keys": 4, "blocks": 3, "repeated_naturals": 0, "repeated_keys": 0, "outside": 0}


def test_empty_first_load_and_several_key_columns(spark, tmp_path):
    root = str(tmp_path / "reg")
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", None)], "k string, j int")
    assert R.register_load(root, "none", df.limit(0), ["k", "j"], "key").count() == 0
    got = R.register_load(root, "one", df, ["k", "j"], "key")
    assert sorted(tuple(r) for r in got.collect()) == [("a", 1, 1, "one"), ("a", 2, 2, "one")]


def dies(*_a, **_k):
    raise RuntimeError("lost")


@pytest.mark.parametrize("step", ["rows", "manifest", "half a manifest"])
def test_a_failed_load_run_again_gives_the_same_keys(spark, tmp_path, monkeypatch, step):
    root, plain = str(tmp_path / "reg"), str(tmp_path / "plain")
    for r in (root, plain):
        load(spark, r, "one", [("b", 1)])
    if step == "half a manifest":
        load(spark, root, "two", [("c", 1), ("a", 1)])
        torn = sorted((tmp_path / "reg" / "_manifest").glob("0*"))[-1]
        (torn.parent / f".{torn.name}.crc").unlink(missing_ok=True)
        torn.write_text(torn.read_text()[:10])
        with pytest.raises(R.ConcurrentLoad):  # its writer may still be at work
            load(spark, root, "two", [("c", 1), ("a", 1)])
        os.utime(torn, (1, 1))
    else:
        monkeypatch.setattr(*((R, "surrogate_key") if step == "rows" else (versions, "publish")), dies)
        with pytest.raises(RuntimeError):
            load(spark, root, "two", [("c", 1), ("a", 1)])
        monkeypatch.undo()
    assert R.committed_keys(spark, root).count() == 1
    assert load(spark, root, "two", [("c", 1), ("a", 1)]) == load(spark, plain, "two", [("c", 1), ("a", 1)])


def test_of_two_loads_from_one_block_one_fails(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "reg")
    load(spark, root, "one", [("b", 1)])
    before = R.blocks(spark, root)
    load(spark, root, "two", [("c", 1)])
    monkeypatch.setattr(R, "blocks", lambda *_: before)
    with pytest.raises(R.ConcurrentLoad):
        load(spark, root, "three", [("d", 1)])
    monkeypatch.undo()
    assert checks(spark, root)["keys"] == 2
