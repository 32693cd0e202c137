import math

from pyspark.sql import functions as F

from stellate.operators import profile as P


def _prof(spark, rows, schema, name="t"):
    df = spark.createDataFrame(rows, schema)
    prof, top = P.profile_columns(df, name)
    return {r["column_name"]: r for r in prof.collect()}, top


def test_nan_and_inf_reported_as_null(spark):
    prof, _ = _prof(spark, [(float("nan"),), (float("inf"),), (1.0,)], "x double")
    r = prof["x"]
    # max is +Inf and mean NaN -> reported null; min is finite
    assert r["min_val"] == 1.0
    assert r["max_val"] is None
    assert r["mean_val"] is None
    assert r["non_null_count"] == 3


def test_boolean_top_values_exclude_null(spark):
    _, top = _prof(spark, [(True,), (True,), (False,), (None,)], "b boolean")
    got = [(r["value"], r["frequency"]) for r in top.orderBy("rank").collect()]
    assert got == [("true", 2), ("false", 1)]


def test_tied_top_values_ordered_by_value(spark):
    _, top = _prof(spark, [("b",), ("a",)], "s string")
    assert [r["value"] for r in top.orderBy("rank").collect()] == ["a", "b"]


def test_top_values_limit_and_threshold(spark):
    rows = [(i % 15,) for i in range(300)]
    _, top = _prof(spark, rows, "k int")
    assert top.count() == 10
    df = spark.range(0, 1500).select(F.col("id").alias("k"))
    _, top2 = P.profile_columns(df, "t")
    assert top2.count() == 0  # more than 1000 distinct values -> no top values


def test_counts_nulls_and_pct(spark):
    prof, _ = _prof(spark, [(1, None), (2, "x"), (2, None), (None, "y")], "a int, s string")
    a, s = prof["a"], prof["s"]
    assert (a["total_rows"], a["non_null_count"], a["null_count"], a["distinct_count"]) == (4, 3, 1, 2)
    assert a["null_pct"] == 25.0 and s["null_pct"] == 50.0
    assert s["min_length"] == 1 and s["max_length"] == 1


def test_exact_percentiles_match_interpolation(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 10.0, 10.0]
    prof, _ = _prof(spark, [(v,) for v in vals], "x double")
    import numpy as np
    r = prof["x"]
    assert math.isclose(r["p25"], float(np.percentile(vals, 25)))
    assert math.isclose(r["median"], float(np.percentile(vals, 50)))
    assert math.isclose(r["p75"], float(np.percentile(vals, 75)))


def test_empty_table_divides_by_one(spark):
    prof, top = _prof(spark, [], "a int, s string")
    assert prof["a"]["total_rows"] == 0 and prof["a"]["null_pct"] == 0.0
    assert top.count() == 0


def test_measure_or_dimension_rule(spark):
    df = spark.createDataFrame([(1.0, 1, 1, 1, "x")], "amount double, id int, unit_no int, customer_key int, label string")
    prof, _ = P.profile_columns(df, "t")
    roles = {r["column_name"]: r["column_role"] for r in prof.collect()}
    assert roles == {"amount": "measure", "id": "dimension", "unit_no": "dimension",
                     "customer_key": "measure", "label": "dimension"}


def test_readiness_edges(spark):
    df = spark.createDataFrame([(9.99, True), (10.0, True), (29.99, True), (30.0, True), (0.0, False)],
                               "a double, pk boolean")
    got = [r[0] for r in df.select(P.modeling_readiness(F.col("pk"), F.col("a"))).collect()]
    assert got == ["high", "medium", "medium", "low", "low"]


def test_high_null_edge(spark):
    prof = spark.createDataFrame([("t", "a", 50.0, 1, "measure"), ("t", "b", 50.01, 2, "measure")],
                                 "table_name string, column_name string, null_pct double, ordinal int, column_role string"
                                 ).withColumn("total_rows", F.lit(10))
    q = P.table_quality(prof).first()
    assert q["high_null_columns"] == ["b"]


def test_frequency_sum_equals_non_null(spark, tmp_path):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    freqs = P.value_frequencies(df)
    tot = {r[0]: r[1] for r in freqs.groupBy("column_name").agg(F.sum("frequency")).collect()}
    n = df.count()
    assert all(v == n for v in tot.values())


def test_profile_many_unions_tables(spark):
    a = spark.createDataFrame([(1,)], "a int")
    b = spark.createDataFrame([("x", 2.0)], "s string, d double")
    prof, _, errors = P.profile_many({"a": a, "b": b})
    assert prof.count() == 3 and errors.count() == 0


def test_rank_statistics_match_numpy(spark):
    import numpy as np
    rng = np.random.default_rng(7)
    a = rng.integers(0, 50, 3000).astype(float)          # many ties
    b = rng.normal(0, 1e3, 2500)                          # all distinct
    c = np.array([5.0])                                   # a single value
    rows = [("a", float(v)) for v in a] + [("b", float(v)) for v in b] + [("c", float(v)) for v in c]
    df = spark.createDataFrame(rows, "col string, x double")
    freqs = (df.groupBy(F.col("col").alias("column_name"), F.col("x").alias("num"))
             .agg(F.count(F.lit(1)).alias("frequency")))
    got = {r.column_name: r for r in P.rank_statistics(freqs, partitions=5).collect()}
    for name, vals in (("a", a), ("b", b), ("c", c)):
        want = np.percentile(vals, [25, 50, 75])
        r = got[name]
        assert np.allclose([r.p25, r.median, r.p75], want, rtol=1e-12, atol=1e-9), (name, r, want)
        assert r.distinct_count == len(set(vals.tolist()))


def test_profile_percentiles_match_numpy(spark):
    import numpy as np
    vals = [float(i % 97) * 1.5 for i in range(1000)]
    df = spark.createDataFrame([(v, i % 3) for i, v in enumerate(vals)], "x double, k int")
    prof, _ = P.profile_columns(df, "t")
    r = {row.column_name: row for row in prof.collect()}
    assert np.allclose([r["x"].p25, r["x"].median, r["x"].p75], np.percentile(vals, [25, 50, 75]))
    assert np.allclose([r["k"].p25, r["k"].median, r["k"].p75], np.percentile([i % 3 for i in range(1000)],
                                                                               [25, 50, 75]))


def test_approx_profile_close_to_exact(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    exact = {r.column_name: r for r in P.profile_columns(df, "l")[0].collect()}
    approx = {r.column_name: r for r in P.profile_columns(df, "l", percentiles="approx",
                                                          distinct="approx")[0].collect()}
    for c, e in exact.items():
        a = approx[c]
        assert a.non_null_count == e.non_null_count and a.min_val == e.min_val and a.max_val == e.max_val
        assert abs(a.distinct_count - e.distinct_count) <= max(2, 0.1 * e.distinct_count), c
        if e.median is not None:
            # percentile_approx returns a data value (nearest rank), the exact profile
            # interpolates: allow 5 % of the range plus one step between distinct values
            span = (e.max_val - e.min_val) or 1.0
            step = span / max(e.distinct_count - 1, 1)
            assert abs(a.median - e.median) <= 0.05 * span + step, c


def test_approx_profile_keeps_top_values_of_columns_at_the_limit(spark):
    cols = [F.concat(F.lit(f"c{i}-"), (F.col("id") % 1000).cast("string")).alias(f"c{i}") for i in range(60)]
    df = spark.range(2000).select(*cols)
    _, top = P.profile_columns(df, "t", percentiles="approx", distinct="approx")
    assert {r.column_name: r.n for r in top.groupBy("column_name").agg(F.count(F.lit(1)).alias("n")).collect()} == {
        f"c{i}": 10 for i in range(60)}


def test_profile_many_isolates_a_table_whose_rows_raise(spark):
    good = spark.createDataFrame([(1,), (2,)], "a int")
    bad = spark.createDataFrame([("x",)], "s string").select(F.col("s").cast("int").alias("n"))
    prof, top, errors = P.profile_many({"good": good, "bad": bad})
    assert {r.table_name for r in prof.collect()} == {"good"} == {r.table_name for r in top.collect()}
    assert [r.table_name for r in errors.collect()] == ["bad"]


def test_long_texts_are_counted_by_digest(spark):
    df = spark.createDataFrame([("x" * 5000,), ("x" * 5000,), ("x" * 5000 + "y",), (None,)], "t string")
    assert P.distinct_by_digest(df).first().distinct_count == 2
