"""Property tests: invariants that must hold for any input."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from stellate.operators import dims as Dm
from stellate.operators import facts as Fa
from stellate.operators import quality as Q

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(keys=st.sets(st.integers(-10**12, 10**12), min_size=1, max_size=300), parts=st.integers(1, 9))
def test_surrogate_key_is_row_number(spark, keys, parts):
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    got = [r.sk for r in Dm.surrogate_key(df, "k", "sk", partitions=parts).orderBy("k").collect()]
    assert got == list(range(1, len(keys) + 1))


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(0, 5), st.one_of(st.none(), st.integers(0, 50)), st.integers(0, 10**6)),
                     min_size=1, max_size=200, unique_by=lambda r: r[2]))
def test_dedupe_latest_matches_window(spark, rows):
    df = spark.createDataFrame(rows, "k int, modified int, id int")
    got = {r.k: r.id for r in Dm.dedupe_latest(df, "k", "modified", "id").collect()}
    w = Window.partitionBy("k").orderBy(F.col("modified").desc_nulls_last(), F.col("id").desc())
    want = {r.k: r.id for r in df.withColumn("rn", F.row_number().over(w)).where("rn = 1").collect()}
    assert got == want


@SETTINGS
@given(vals=st.lists(st.one_of(st.none(), st.integers(-100, 100)), min_size=0, max_size=200))
def test_quarantine_splits_every_row_once(spark, vals):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id int, v int")
    clean, bad = Q.quarantine(df, {"negative": F.col("v") < 0, "missing": F.col("v").isNull()})
    c, b = {r.id for r in clean.collect()}, {r.id for r in bad.collect()}
    assert c | b == set(range(len(vals))) and not (c & b)


@SETTINGS
@given(fact=st.lists(st.one_of(st.none(), st.integers(0, 20)), min_size=0, max_size=200),
       dim=st.sets(st.integers(0, 30), max_size=25))
def test_lookup_keeps_fact_rows(spark, fact, dim):
    f = spark.createDataFrame([(i, k) for i, k in enumerate(fact)], "id int, fk int")
    d = spark.createDataFrame([(k, k * 10) for k in dim], "nk int, sk int")
    out = Fa.lookup_key(f, d, "fk", "nk", "sk")
    rows = out.collect()
    assert len(rows) == len(fact)
    assert all((r.sk is None) == (r.fk is None or r.fk not in dim) for r in rows)
