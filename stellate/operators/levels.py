"""Exact distinct counts over the levels of a rollup (A2, A9), from bitmaps that are combined upwards.

Raw rows are read once and never expanded to the levels: the finest level makes, per group and bucket of 32,768 neighbouring
keys, one bitmap of the keys that occur; each level above is the bitwise or of the one below. Distinct counts are then
sums of set bits over the buckets, sums and row counts add up beside them.

A bitmap takes 4 KB, so keys should be dense (surrogate keys, D2): a group then takes about as many bitmaps as its keys
span buckets. Any whole number is counted right. A hot group is spread over its buckets, and partial bitmaps are
combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.session import checkpoint_dir


def distinct_over_levels(df: DataFrame, levels, key: str, measures=()) -> DataFrame:
    """A row for each group of each prefix of ``levels`` (``ROLLUP``): the level columns (null above their level), depth (how
    many are set), row_count, distinct_<key> and total_<measure>. Null keys count as rows only. Without rows: the total
    alone, with zero counts and null totals."""
    levels, measures = list(levels), list(measures)
    if df.schema[key].dataType.typeName() not in ("byte", "short", "integer", "long"):
        raise TypeError(f"{key}: bitmaps need whole numbers; give the column a surrogate key first")
    names = [f"_g{i}" for i in range(len(levels))]
    k = F.col(f"`{key}`").cast("long")
    base = df.select(*[F.col(f"`{c}`").alias(g) for c, g in zip(levels, names)], F.bitmap_bucket_number(k).alias("_bucket"),
                     F.bitmap_bit_position(k).alias("_bit"),
                     *[F.col(f"`{m}`").cast("decimal(38,4)").alias(f"_m{i}") for i, m in enumerate(measures)])
    sums = [F.sum(f"_m{i}").alias(f"_m{i}") for i in range(len(measures))]
    checkpoint_dir(df.sparkSession)
    level = base.groupBy(*names, "_bucket").agg(F.bitmap_construct_agg("_bit").alias("_bits"), F.count(F.lit(1)).alias("_n"), *sums)
    out = None
    for depth in range(len(levels), -1, -1):
        if depth < len(levels):
            level = level.groupBy(*names[:depth], "_bucket").agg(F.bitmap_or_agg("_bits").alias("_bits"), F.sum("_n").alias("_n"), *sums)
        level = level.checkpoint(eager=True)  # read by its own counts and by the level above
        counts = level.groupBy(*names[:depth]).agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"),
            F.coalesce(F.sum(F.bitmap_count("_bits")), F.lit(0)).alias(f"distinct_{key}"),
            *[F.sum(f"_m{i}").alias(f"total_{m}") for i, m in enumerate(measures)])
        counts = counts.select(*[(F.col(g) if i < depth else F.lit(None).cast(df.schema[c].dataType)).alias(c)
                                 for i, (c, g) in enumerate(zip(levels, names))], F.lit(depth).alias("depth"),
                               "row_count", f"distinct_{key}", *[f"total_{m}" for m in measures])
        out = counts if out is None else out.unionByName(counts)
    return out
