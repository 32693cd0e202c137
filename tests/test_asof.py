import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from stellate.operators import facts
from stellate.operators.asof import as_of_join, hourly

T0 = dt.datetime(2024, 1, 1)


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def brute(left, right):
    out = []
    for n, user, ts in left:
        met = [(t, k) for u, t, k in right if u is not None and u == user and t is not None and ts is not None and t <= ts]
        out.append((n, *(max(met) if met else (None, None))))
    return sorted(out, key=str)


def joined(spark, left, right, bucket=hourly):
    l = spark.createDataFrame(left, "n int, user_id long, ts timestamp").repartition(3)
    r = spark.createDataFrame(right, "who long, made timestamp, k long").repartition(2)
    return as_of_join(l, r, "user_id", "ts", "made", ["made", "k"], "k", bucket, "who")


CASES = {
    "hand": ([(1, 7, at(0)), (2, 7, at(59)), (3, 7, at(60)), (4, 7, at(5000)), (5, 8, at(1)), (6, None, at(1)), (7, 7, None), (8, 7, at(-1))],
             [(7, at(0), 1), (7, at(0), 3), (7, at(0), 2), (7, at(61), 9), (None, at(0), 5), (7, None, 6), (8, at(2), 4)]),
    "no right rows": ([(1, 7, at(0))], []),
    "no left rows": ([], [(7, at(0), 1)]),
}


@pytest.mark.parametrize("case", CASES)
def test_against_brute_force(spark, case):
    left, right = CASES[case]
    assert sorted((tuple(r[c] for c in ("n", "made", "k")) for r in joined(spark, left, right).collect()), key=str) == brute(left, right)


@pytest.mark.parametrize("bucket", [hourly, lambda c: F.date_trunc("day", c), lambda c: F.lit(0)])
def test_any_bucket(spark, bucket):
    """Cutting time changes nothing; equal times, rows on bucket edges and repeated rows included."""
    r = random.Random(4)
    left = [(i, r.choice([1, 1, 1, 2, 3]), at(r.choice([0, 60, 120, r.randrange(6000)]))) for i in range(400)] + [(9, 1, at(60))] * 2
    right = [(r.choice([1, 1, 2, 4]), at(r.choice([0, 60, r.randrange(6000)])), r.randrange(50)) for _ in range(150)]
    got = joined(spark, left, right, bucket).collect()
    assert sorted(((x.n, x.made, x.k) for x in got), key=str) == brute(left, right)


def test_an_entity_with_a_third_of_the_rows_is_spread(spark):
    """The hot entity's rows are sorted in many tasks, none of which holds much of them."""
    rows = spark.range(30_000).select("id", F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("user_id"),
                                      F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 60).alias("ts"))
    right = rows.where("id % 700 = 0").select("user_id", F.col("ts").alias("made"), F.col("id").alias("k"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = as_of_join(rows, right, "user_id", "ts", "made", ["made", "k"], "k")
        sizes = [r["n"] for r in got.where("user_id = 1").groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
        assert sum(sizes) == 10_001 and len(sizes) == int(spark.conf.get("spark.sql.shuffle.partitions")) and max(sizes) < 4 * 10_000 / len(sizes)
        assert got.where("user_id = 1 AND made IS NULL").count() == 0 and got.where("made > ts").count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_event_sessions(spark):
    """A session under an earlier registration, one with its own, one opened by it, one before any; an event without a user is in no session."""
    rows = [(1, 5, at(0), "view", 1.5), (2, 5, at(10), "signup", 2.0), (3, 5, at(20), "click", None), (4, 5, at(100), "view", 4.0),
            (5, 5, at(200), "signup", 1.0), (6, 5, at(210), "signup", 1.0), (7, 5, at(500), "view", 0.0), (8, None, at(3), "view", 9.0)]
    e = spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp, event_type string, value double")
    got = {r.opening_event: r for r in facts.event_sessions(e, "signup").collect()}
    assert {k: (r.registration_event, r.session_registration, r.session_end) for k, r in got.items()} == {
        1: (None, at(10), at(20)), 4: (2, None, at(100)), 5: (5, at(200), at(210)), 7: (6, None, at(500))}
    assert float(got[1].session_amount) == 3.5 and got[5].opening_kind == "signup"


def test_payload_must_not_clash(spark):
    df = spark.createDataFrame([(1, at(0), 2)], "user_id long, ts timestamp, k long")
    with pytest.raises(ValueError):
        as_of_join(df, df, "user_id", "ts", "ts", ["k"], "k")
