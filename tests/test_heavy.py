from collections import Counter

from pyspark.sql import functions as F

from stellate.operators import heavy
from stellate.operators import profile as P


def got(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["column_name"], r["rank"])):
        out.setdefault(r["column_name"], []).append((r["value"], r["frequency"]))
    return out


def want(values, limit=10):
    return sorted(Counter(str(v) for v in values if v is not None).items(), key=lambda x: (-x[1], x[0]))[:limit]


def test_lists_are_exact_for_skewed_flat_and_small_columns(spark):
    skewed = [i % 20 if i % 3 else i for i in range(30000)]  # 20 frequent values, 10,000 others
    flat = [i // 2 for i in range(30000)]
    small = [None if i % 5 == 0 else "xyz"[i % 3] for i in range(30000)]
    df = spark.createDataFrame(list(zip(skewed, flat, small)), "skewed int, flat int, small string").repartition(7)
    found = heavy.summaries(df, df.columns, 64)
    assert found["small"].whole and not found["flat"].whole and 0 < found["skewed"].bound < 1000
    top = got(P.heavy_hitters(df, "t", listed=64, slices=5))
    assert top == {"skewed": want(skewed), "flat": want(flat), "small": want(small)}


def test_summaries_of_parts_are_never_too_low(spark):
    df = spark.range(20000).select((F.col("id") % 3000).alias("v")).union(spark.range(400).select(F.lit(7).alias("v"))).repartition(9)
    for fan in (1, 3, 256):
        s = heavy.summaries(df, ["v"], 32, tracked=64, fan=fan)["v"]
        assert s.non_null == 20400 and s.bound >= 7  # the most that a value outside the list occurs
        assert got(P.heavy_hitters(df, "t", limit=1, listed=32))["v"] == [("7", 407)]


def test_threshold_applies_to_the_values_counted(spark):
    df = spark.range(3000).select((F.col("id") % 1000).alias("at"), (F.col("id") % 1001).alias("above"), (F.col("id") % 2 / 2).alias("h"))
    top = got(P.table_top_values(df, "t"))
    assert set(top) == {"at", "h"} and top["at"][0] == ("0", 3) and len(top["at"]) == 10
    assert top["h"] == [("0.0", 1500), ("0.5", 1500)]


def test_empty_null_and_odd_names(spark):
    df = spark.createDataFrame([(None, None, None), (None, -0.0, "q"), (None, 0.0, "")], "n int, `a.b` double, `c``d` string")
    assert P.heavy_hitters(df.limit(0), "t").count() == P.table_top_values(df.limit(0), "t").count() == 0
    want_ = {"a.b": [("0.0", 2)], "c`d": [("", 1), ("q", 1)]}
    assert got(P.heavy_hitters(df, "t")) == want_ == got(P.table_top_values(df, "t"))
