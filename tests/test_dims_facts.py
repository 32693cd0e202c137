import pandas as pd
from pyspark.sql import functions as F

from stellate.functions import clean as C
from stellate.operators import dims as Dm
from stellate.operators import facts as Fa

SF = "/root/testdata/sf0.001"


def test_surrogate_key_dense_unique_and_ordered(spark):
    df = spark.range(0, 5000).select(((F.col("id") * 7919) % 100003).alias("k"))
    for parts in (1, 7):
        got = Dm.surrogate_key(df, "k", "sk", partitions=parts).orderBy("k").select("sk").collect()
        assert [r[0] for r in got] == list(range(1, 5001))


def test_surrogate_key_with_offset_and_composite(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("a", 1)], "x string, y int")
    keyed = {(r.x, r.y): r.sk for r in Dm.surrogate_key(df, ["x", "y"], "sk", offset=10).collect()}
    assert keyed == {("a", 1): 11, ("a", 2): 12, ("b", 1): 13}


def test_stable_surrogate_key_keeps_old_keys(spark):
    old = spark.createDataFrame([(5, 1), (9, 2)], "k int, sk bigint")
    new = spark.createDataFrame([(1,), (5,), (9,), (7,), (7,), (None,)], "k int")
    got = {r.k: r.sk for r in Dm.stable_surrogate_key(old, new, "k", "sk").collect()}
    assert got == {5: 1, 9: 2, 1: 3, 7: 4}


def test_dedupe_latest_carries_maps(spark):
    rows = [(1, 1, {"a": 1}), (1, 2, {"b": 2, "a": 3}), (2, 1, None), (3, 1, {}), (3, 1, {"x": None})]
    df = spark.createDataFrame(rows, "k int, modified int, v map<string,int>")
    got = {r.k: r.v for r in Dm.dedupe_latest(df, "k", "modified").collect()}
    assert got == {1: {"a": 3, "b": 2}, 2: None, 3: {"x": None}}


def test_dedupe_latest_nulls_last_and_hot_key(spark):
    rows = [(1, None, "n"), (1, 5, "a"), (1, 7, "b"), (2, None, "z")] + [(3, i, f"v{i}") for i in range(2000)]
    df = spark.createDataFrame(rows, "k int, modified int, v string")
    got = {r.k: r.v for r in Dm.dedupe_latest(df, "k", "modified").collect()}
    assert got == {1: "b", 2: "z", 3: "v1999"}


def test_lookup_keeps_fact_rows_and_guard(spark):
    fact = spark.createDataFrame([(1,), (2,), (3,), (3,)], "fk int")
    dim = spark.createDataFrame([(1, 10), (3, 30), (3, 31)], "nk int, sk int")
    left = Fa.lookup_key(fact, dim.dropDuplicates(["nk"]), "fk", "nk", "sk")
    assert left.count() == 4 and left.where(F.col("sk").isNull()).count() == 1
    inner = Fa.lookup_key(fact, dim.dropDuplicates(["nk"]), "fk", "nk", "sk", required=True)
    assert inner.count() == 3
    g = Fa.fan_out_guard(fact, dim, "fk", "nk").first()
    assert (g.rows_before, g.rows_after, g.duplicate_keys, g.ok) == (4, 6, 1, False)


def test_guarded_date_no_fall_through(spark):
    df = spark.createDataFrame([(" 2020-01-02 10:00:00", "2021-01-01"), ("2024-13-45 00:00:00", "2021-01-01"),
                                ("n/a", "2021-05-06 00:00:00"), (None, None)], "a string, b string")
    got = [r[0] for r in df.select(C.guarded_date("a", "b")).collect()]
    import datetime as dt
    assert got == [dt.date(2020, 1, 2), None, dt.date(2021, 5, 6), None]


def test_flags_and_casts(spark):
    df = spark.createDataFrame([("Y",), ("yes",), ("YES",), (None,), ("x",)], "f string")
    assert [r[0] for r in df.select(C.flag_to_bool("f")).collect()] == [True, True, False, False, False]
    assert [r[0] for r in df.select(C.to_int("f")).collect()] == [None] * 5


def _brute_sessions(pdf, gap=1800):
    pdf = pdf.sort_values(["user_id", "ts", "event_id"]).copy()
    prev = pdf.groupby("user_id")["ts"].shift(1)
    new = prev.isna() | ((pdf["ts"] - prev).dt.total_seconds() > gap)
    pdf["session_no"] = new.astype(int).groupby(pdf["user_id"]).cumsum()
    pdf["seq"] = pdf.groupby(["user_id", "session_no"]).cumcount() + 1
    return pdf


def test_sessionize_matches_brute_force_across_buckets(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet").select("event_id", "user_id", "ts", "event_type")
    # one-hour buckets force sessions to continue across bucket edges
    s = Fa.sessionize(ev, bucket=F.date_trunc("hour", F.col("ts")))
    got = s.select("event_id", "session_no").toPandas().set_index("event_id")["session_no"]
    want = _brute_sessions(ev.toPandas()).set_index("event_id")["session_no"]
    assert got.sort_index().tolist() == want.sort_index().tolist()
    pv = Fa.page_views(ev, bucket=F.date_trunc("hour", F.col("ts"))).toPandas().set_index("event_id")
    bw = _brute_sessions(ev.toPandas()).set_index("event_id")
    assert pv["sequence_in_session"].sort_index().tolist() == bw["seq"].sort_index().tolist()


def test_first_flag(spark):
    df = spark.createDataFrame([(1, 5, 1), (1, 3, 2), (1, 3, 3), (2, 9, 4)], "u int, t int, id int")
    got = {r.id: r.is_first for r in Dm.first_flag(df, "u", "t", "id").collect()}
    assert got == {1: False, 2: True, 3: False, 4: True}


def test_calendar_and_time_dims(spark):
    d = Dm.dim_date(spark, "2024-02-27", "2024-03-01")
    assert [r.date_key for r in d.orderBy("full_date").collect()] == [20240227, 20240228, 20240229, 20240301]
    assert Dm.dim_time(spark).count() == 86400


def test_unknown_member(spark):
    dim = spark.createDataFrame([(1, "a")], "sk bigint, name string")
    out = {r.sk: r.name for r in Dm.unknown_member(dim, "sk").collect()}
    assert out == {1: "a", -1: "Unknown"}


def test_star_build_appends_audit(spark, tmp_path):
    from stellate.plans.star import build_star
    audit_path = str(tmp_path / "audit")
    for run in range(2):
        build_star(spark, SF, out_dir=str(tmp_path / f"run{run}"), audit_path=audit_path)
    log = spark.read.parquet(audit_path)
    assert log.count() == 18 and log.select("run_dir").distinct().count() == 2


def test_empty_source_gives_an_empty_calendar(spark):
    o = spark.createDataFrame([], "d date")
    assert Dm.dim_date_for(o, "d").count() == 0


def test_missing_foreign_key_stays_null(spark):
    src = spark.createDataFrame([(1, "a", None), (2, None, 7)], "id int, name string, nation int")
    spec = Dm.DimensionSpec("d", ("id",), "sk", {"name": "name", "nation": "nation"}, foreign_keys=("nation",))
    got = {r.id: (r.name, r.nation) for r in Dm.build_dimension(src, spec).collect()}
    assert got == {1: ("a", None), 2: ("Unknown", 7)}


def test_unknown_member_has_no_natural_key(spark):
    dim = spark.createDataFrame([(1, 0, "x")], "sk long, k int, name string")
    got = {r.sk: (r.k, r.name) for r in Dm.unknown_member(dim, "sk", natural_key="k").collect()}
    assert got == {1: (0, "x"), -1: (None, "Unknown")}


def test_lookups_start_no_size_check(spark):
    fact = spark.range(10).withColumnRenamed("id", "k")
    dim = spark.range(5).selectExpr("id AS k", "id + 100 AS sk")
    plan = Fa.lookup_key(fact, dim, "k", "k", "sk")._jdf.queryExecution().toString()
    assert "Limit" not in plan


def test_checkpoint_dir_is_set_once(spark):
    from stellate.session import checkpoint_dir
    first = checkpoint_dir(spark), spark.sparkContext.getCheckpointDir()
    for _ in range(500):
        assert (checkpoint_dir(spark), spark.sparkContext.getCheckpointDir()) == first


def test_a_session_that_never_pauses_spans_many_buckets(spark):
    """Positions run on over time buckets, with a second session and another user between."""
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i, 1, t0 + dt.timedelta(minutes=20 * i), "view") for i in range(100)]
    rows += [(500 + i, 1, t0 + dt.timedelta(minutes=20 * 99 + 31 + 10 * i), "view") for i in range(9)]
    rows += [(900, 2, t0 + dt.timedelta(minutes=7), "view")]
    e = spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp, event_type string").repartition(3)
    got = {r.event_id: (r.session_no, r.sequence_in_session) for r in Fa.page_views(e).collect()}
    assert all(got[i] == (1, i + 1) for i in range(100)) and all(got[500 + i] == (2, i + 1) for i in range(9)) and got[900] == (1, 1)
