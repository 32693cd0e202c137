import datetime as dt

from pyspark.sql import functions as F

from stellate.operators import metrics as A
from stellate.operators import model as V
from stellate.operators import quality as Q


def test_quarantine_partitions_input(spark):
    df = spark.range(0, 100).withColumn("x", F.col("id") % 7)
    clean, bad = Q.quarantine(df, {"seven": F.col("x") == 0, "big": F.col("id") > 90})
    assert clean.count() + bad.count() == 100
    assert clean.join(bad, "id").count() == 0
    r = bad.where(F.col("id") == 91).first()
    assert r.quarantine_reasons == ["seven", "big"]


def test_ratio_zero_denominator_is_null(spark):
    df = spark.createDataFrame([("a",)], "t string")
    r = A.ratio_kpi(df, F.col("t") == "a", F.col("t") == "b", "r").first()
    assert (r.r_num, r.r_den, r.r) == (1, 0, None)


def test_prior_period_with_gap(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 5), 10.0), (dt.date(2024, 3, 7), 20.0)], "d date, v double")
    p = {r.period: r for r in A.prior_period(A.period_totals(df, "d", "v", "month")).collect()}
    mar = p[dt.date(2024, 3, 1)]
    assert mar.prior_amount is None and mar.growth_pct is None
    assert p[dt.date(2024, 2, 1)].amount is None


def test_to_date_totals_restart(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 30), 1.0), (dt.date(2024, 1, 31), 2.0),
                                (dt.date(2024, 2, 1), 4.0)], "d date, v double")
    t = {r.day: r for r in A.to_date_totals(A.daily(df, "d", "v")).collect()}
    assert float(t[dt.date(2024, 1, 31)].mtd) == 3.0 and float(t[dt.date(2024, 2, 1)].mtd) == 4.0
    assert float(t[dt.date(2024, 2, 1)].ytd) == 7.0


def test_layered_metrics_skip_missing(spark):
    base = spark.createDataFrame([(10.0, 2)], "revenue double, orders bigint")
    out, skipped = A.layered_metrics(base, [A.Metric("aov", "revenue / orders", ("revenue", "orders")),
                                            A.Metric("x", "returns / orders", ("returns",))])
    assert out.first().aov == 5.0 and skipped[0][0] == "x"


def _rel(spark, pairs):
    return spark.createDataFrame([(a, "", b, "") for a, b in pairs],
                                 "from_table string, from_column string, to_table string, to_column string")


def test_ambiguous_path_and_no_cycle(spark):
    rel = _rel(spark, [("A", "B"), ("A", "C"), ("C", "B")])
    amb = {(r.src, r.dst) for r in V.ambiguous_paths(rel).collect()}
    assert amb == {("A", "B")}
    assert V.cycles(rel).count() == 0


def test_cycle(spark):
    rel = _rel(spark, [("A", "B"), ("B", "A")])
    assert [r.cycle for r in V.cycles(rel).collect()] == ["A>B>A"]


def test_naming_rules(spark):
    cols = spark.createDataFrame([("f", "order_date", "date"), ("f", "date_order", "date"),
                                  ("f", "order_date_key", "int"), ("f", "order_date_id", "int")],
                                 "table_name string, column_name string, data_type string")
    rel = spark.createDataFrame([("f", "order_date_id", "dim_date", "date_order_key")],
                                "from_table string, from_column string, to_table string, to_column string")
    pk = spark.createDataFrame([("dim_date", "date_order_key")], "table_name string, column_name string")
    got = {(r.column_name, r.suggestion) for r in V.naming_check(cols, rel, pk).collect()}
    assert got == {("order_date", "date_order"), ("order_date_key", "date_order_key"),
                   ("order_date_id", "date_order_key")}


def test_relations_match_and_coverage(spark):
    a = _rel(spark, [("f", "d1"), ("f", "d2")])
    b = _rel(spark, [("f", "d1")])
    assert V.relations_match(a, b).count() == 1
    d = spark.createDataFrame([("t", "a"), ("t", "b")], "table_name string, column_name string")
    bt = spark.createDataFrame([("t", "a"), ("t", "c")], "table_name string, column_name string")
    assert {r.issue for r in V.schema_coverage(d, bt).collect()} == {"declared, not built", "built, not declared"}


def test_clique_of_tables(spark):
    import itertools
    names = [f"t{i:02d}" for i in range(30)]
    rel = spark.createDataFrame([(a, "k", b, "k") for a, b in itertools.permutations(names, 2)],
                                "from_table string, from_column string, to_table string, to_column string")
    assert V.ambiguous_paths(rel).count() == 30 * 29
    assert [(r.start, r.cycle) for r in V.cycles(rel).collect()] == [("t00", "t00>t01>t00")]


def test_gates_fail_on_an_empty_load(spark):
    e = spark.createDataFrame([], "k int, s string")
    for gate in (Q.null_rate(e, "e", ["k"]), Q.format_gate(e, "e", "s", "x"), Q.fk_coverage(e, "e", ["k"])):
        row = gate.first()
        assert row.observed is None and row.passed is False
