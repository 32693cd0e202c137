import pytest
from pyspark.sql import functions as F

from stellate.operators import loading as L
from stellate.operators import quality as Q

ROWS = [(1, 10, 100, "a1", "ok"), (2, None, 100, "b2", "ok"), (3, 12, 101, "x", "too long"), (4, 13, None, None, None), (5, 14, 102, "c3", "ok")]
SCHEMA = "id long, key long, natural long, code string, note string"
CHECKS = dict(required={"code": 0.1}, looked_up={"key": "natural"}, formats={"code": (r"^[a-z]\d$", 1.0)}, lengths={"note": 5}, coverage={"key": 0.9}, keys=("key",))


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def gates(loaded):
    return {(r.gate, r.column_name): (r.observed, r.passed) for r in loaded.gates().collect()}


def test_gates_and_audit_come_from_the_write(spark, tmp_path):
    """The same rows as the gates that scan the written table, with no further look at it."""
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    done = L.load(df, str(tmp_path / "t"), "t", L.Checks(**CHECKS), ["id", "key", "code", "note"])
    assert gates(done) == {("null_rate", "code"): (0.2, False), ("orphan_rate", "key"): (0.25, False), ("format_rate", "code"): (0.75, False),
                           ("too_long", "note"): (1.0, False), ("fk_coverage", "key"): (0.8, False)}
    t = done.target()
    assert t.columns == ["id", "key", "code", "note"] and t.count() == 5
    scanned = Q.gate_report(Q.null_rate(t, "t", ["code"], 0.1), Q.format_gate(t, "t", "code", r"^[a-z]\d$"), Q.length_gate(t, "t", {"note": 5}),
                            Q.fk_coverage(t, "t", ["key"], 0.9))
    assert set(rows_of(scanned)) < set(rows_of(done.gates()))
    assert rows_of(done.audit(3)) == rows_of(Q.audit_rows(spark, [(3, "t", t, ["key"])]))
    plan = Q.gate_report(done.gates())._jdf.queryExecution().toString() + done.audit(1)._jdf.queryExecution().toString()
    assert str(tmp_path) not in plan and "FileScan" not in plan


def test_two_sinks_of_one_job(spark, tmp_path):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(2)
    rules = {"no key": F.col("key").isNull(), "long": F.length("note") > 5, "high": F.col("natural") > 100}
    done = L.load(df, str(tmp_path / "t"), "t", L.Checks(rules=rules, **CHECKS), ["id", "note"])
    assert rows_of(done.target()) == [(1, "ok"), (4, None)]
    assert sorted((r.id, r.quarantine_reasons) for r in done.bad().collect()) == [(2, ["no key"]), (3, ["long", "high"]), (5, ["high"])]
    assert done.counts["all_rows"] == 5 and done.counts["good"] == 2
    assert gates(done)[("null_rate", "code")] == (0.5, False) and gates(done)[("too_long", "note")] == (0.0, True)
    with pytest.raises(ValueError):
        L.load(df, str(tmp_path / "u"), "u").bad()


@pytest.mark.parametrize("split", [False, True])
def test_empty_loads_pass_nothing(spark, tmp_path, split):
    """Empty by its data and by its plan."""
    df = spark.createDataFrame(ROWS, SCHEMA)
    checks = L.Checks(rules={"low": F.col("id") < 0} if split else {}, **CHECKS)
    for i, empty in enumerate((df.where("id > 99"), df.where("1 = 0"), df.limit(0), spark.createDataFrame([], SCHEMA))):
        done = L.load(empty, str(tmp_path / f"t{i}"), "t", checks)
        assert all(v == (None, False) for v in gates(done).values()) and len(gates(done)) == 5
        assert [tuple(r) for r in done.audit(1).collect()] == [(1, "t", 0, None, "empty load")]
        assert done.target().count() == 0


def test_all_rows_bad_or_good(spark, tmp_path):
    df = spark.createDataFrame(ROWS, SCHEMA)
    for name, cond, n in (("all", F.col("id") > 0, 0), ("none", F.col("id") < 0, 5)):
        done = L.load(df, str(tmp_path / name), name, L.Checks(rules={"r": cond}))
        assert (done.target().count(), done.bad().count()) == (n, 5 - n)


def test_a_repeated_load_replaces_both_sinks(spark, tmp_path):
    df = spark.createDataFrame(ROWS, SCHEMA)
    checks = L.Checks(rules={"r": F.col("id") > 3})
    L.load(df, str(tmp_path / "t"), "t", checks)
    done = L.load(df.where("id <= 3"), str(tmp_path / "t"), "t", checks)
    assert (done.target().count(), done.bad().count()) == (3, 0)


def test_gates_that_scan_fail_on_an_empty_load(spark):
    df = spark.createDataFrame([], SCHEMA)
    dim = spark.createDataFrame([(100,)], "k long")
    found = Q.gate_report(Q.orphan_gate(df, dim, "natural", "k", "t"), Q.length_gate(df, "t", {"note": 5})).collect()
    assert [(r.observed, r.passed) for r in found] == [(None, False)] * 2
