import datetime as dt

import pytest
from pyspark.sql import functions as F

from stellate.operators import sketches as K
from stellate.operators.levels import distinct_over_levels


def test_merged_loads_give_the_profile_of_all_rows(spark, tmp_path):
    root = str(tmp_path / "s")
    df = spark.range(60000).select(F.col("id"), (F.col("id") % 5000).cast("double").alias("x"),
                                   F.when(F.col("id") % 3 > 0, (F.col("id") % 700).cast("string")).alias("t"))
    K.store_load(root, "base / 1", df.where("id < 50000"))
    K.store_load(root, "new", df.where("id >= 10000"))
    K.store_load(root, "new", df.where("id >= 50000"))  # run again: replaces its own rows only
    got = {r["column_name"]: r for r in K.profile_from_sketches(K.merge_sketches(K.stored_sketches(spark, root))).collect()}
    whole = {r["column_name"]: r for r in K.profile_from_sketches(K.merge_sketches(K.sketch_columns(df))).collect()}
    for c, values in (("id", 60000), ("x", 5000), ("t", 700)):
        g, w = got[c], whole[c]
        assert [g[k] for k in ("total_rows", "non_null_count", "null_count", "min_val", "max_val")] == [
            w[k] for k in ("total_rows", "non_null_count", "null_count", "min_val", "max_val")]
        assert abs(g["distinct_count"] - values) <= 0.08 * values and abs(g["distinct_count"] - w["distinct_count"]) <= 0.02 * values
    for name, p in (("p25", 0.25), ("median", 0.5), ("p75", 0.75)):
        assert abs(got["id"][name] / 60000 - p) < 0.01 and abs(got["x"][name] / 5000 - p) < 0.01
    assert got["t"]["median"] is None and got["t"]["null_count"] == 20000


def test_sketches_of_empty_null_and_odd_columns(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        K.stored_sketches(spark, str(tmp_path / "none"))
    df = spark.createDataFrame([(None, float("nan"), "", dt.date(2020, 1, 1)), (None, 1.0, None, None)],
                               "n int, `a.b` double, s string, d date")
    for rows, x in ((df, df), (0, df.limit(0))):
        got = {r["column_name"]: r for r in K.profile_from_sketches(K.sketch_columns(x)).collect()}
        assert set(got) == {"n", "a.b", "s", "d"} and got["n"]["median"] is None and got["n"]["distinct_count"] == 0
        assert got["n"]["total_rows"] == (2 if rows else 0)
        assert (got["a.b"]["min_val"], got["a.b"]["median"]) == ((1.0, 1.0) if rows else (None, None))


def test_distinct_over_levels_equals_rollup(spark):
    rows = [(None if i % 11 == 0 else i % 3, "abc"[i % 2], None if i % 7 == 0 else (i * 40503) % 99991 - 40000, i) for i in range(500)]
    df = spark.createDataFrame(rows + rows[:50], "g int, `h.x` string, k long, v int")
    got = {(r["depth"], r["g"], r["h.x"]): (r["row_count"], r["distinct_k"], int(r["total_v"]))
           for r in distinct_over_levels(df, ["g", "h.x"], "k", ["v"]).collect()}
    want = {}
    for g, h, k, v in rows + rows[:50]:
        for key in ((2, g, h), (1, g, None), (0, None, None)):
            n, ks, s = want.get(key, (0, set(), 0))
            want[key] = (n + 1, ks | ({k} - {None}), s + v)
    assert got == {key: (n, len(ks), s) for key, (n, ks, s) in want.items()}


def test_distinct_over_levels_edges(spark):
    df = spark.createDataFrame([], "g int, k long, v int")
    assert [tuple(r) for r in distinct_over_levels(df, ["g"], "k", ["v"]).collect()] == [(None, 0, 0, 0, None)]
    nulls = spark.createDataFrame([(1, None, 2)], "g int, k long, v int")
    assert sorted((r["depth"], r["row_count"], r["distinct_k"]) for r in distinct_over_levels(nulls, ["g"], "k").collect()) == [(0, 1, 0), (1, 1, 0)]
    with pytest.raises(TypeError):
        distinct_over_levels(spark.createDataFrame([("a",)], "k string"), [], "k")
