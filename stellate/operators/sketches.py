"""Stored, mergeable column sketches (P6, P7): a new load's profile merges with those before instead of rescanning them.

A sketch table has one row a column: row counts, minimum and maximum, a HyperLogLog sketch of the different values and,
for numbers, a KLL sketch of their quantiles, both as bytes of Spark's own sketch functions. Sketches are made in two
levels, ``fan`` partial results first, so that no task merges the sketches of all tasks. Each load keeps its sketch table
as a versioned table; a load that is run again replaces its own.
"""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stellate.functions.types import NUMERIC, type_family
from stellate.operators.heavy import digest
from stellate.operators.profile import finite
from stellate.sources import versions

# 2^12 registers: 1.6 % standard error. 800 items: 0.35 % rank error with 99 % confidence.
LG_REGISTERS, QUANTILE_ITEMS, FAN = 12, 800, 256


def sketch_columns(df: DataFrame, columns=None, registers: int = LG_REGISTERS, items: int = QUANTILE_ITEMS, fan: int = FAN) -> DataFrame:
    """One row a column: column_name, total_rows, non_null_count, min_val, max_val (numbers only), distinct and quantiles
    (sketches). NaN and infinite numbers take part in the distinct sketch alone."""
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    first, second, out = [F.count(F.lit(1)).alias("n")], [F.sum("n").alias("n")], []
    for i, f in enumerate(fields):
        first += [F.count(F.col(f"`{f.name}`")).alias(f"c{i}"), F.hll_sketch_agg(digest(f.name), registers).alias(f"h{i}")]
        second += [F.sum(f"c{i}").alias(f"c{i}"), F.hll_union_agg(f"h{i}").alias(f"h{i}")]
        bounds = [F.lit(None).cast("double")] * 2
        quantiles = F.lit(None).cast("binary")
        if type_family(f.dataType) == NUMERIC:
            v = finite(F.col(f"`{f.name}`").cast("double")) + F.lit(0.0)  # one zero
            first += [F.min(v).alias(f"l{i}"), F.max(v).alias(f"m{i}"), F.kll_sketch_agg_double(v, items).alias(f"q{i}")]
            second += [F.min(f"l{i}").alias(f"l{i}"), F.max(f"m{i}").alias(f"m{i}"), F.kll_merge_agg_double(f"q{i}", items).alias(f"q{i}")]
            bounds, quantiles = [F.col(f"l{i}"), F.col(f"m{i}")], F.col(f"q{i}")
        out.append(F.struct(F.lit(f.name).alias("column_name"), F.coalesce("n", F.lit(0)).cast("long").alias("total_rows"),
                            F.coalesce(f"c{i}", F.lit(0)).cast("long").alias("non_null_count"),
                            bounds[0].alias("min_val"), bounds[1].alias("max_val"),
                            F.col(f"h{i}").alias("distinct"), quantiles.alias("quantiles")))
    part = df.groupBy((F.spark_partition_id() % fan).alias("part")).agg(*first)
    return part.agg(*second).select(F.inline(F.array(*out)))


def merge_sketches(sketches: DataFrame, items: int = QUANTILE_ITEMS) -> DataFrame:
    """One row a column over all rows of ``sketches``: the sketch table of the loads together."""
    return sketches.groupBy("column_name").agg(
        F.sum("total_rows").alias("total_rows"), F.sum("non_null_count").alias("non_null_count"),
        F.min("min_val").alias("min_val"), F.max("max_val").alias("max_val"),
        F.hll_union_agg("distinct").alias("distinct"), F.kll_merge_agg_double("quantiles", items).alias("quantiles"))


def profile_from_sketches(sketches: DataFrame, probs: dict | None = None) -> DataFrame:
    """column_name, total_rows, non_null_count, null_count, distinct_count (estimate), min_val, max_val and a quantile for
    each of ``probs`` (name -> probability; quartiles if not given), from a merged sketch table."""
    some = F.coalesce(F.kll_sketch_get_n_double("quantiles"), F.lit(0)) > 0
    return sketches.select(
        "column_name", "total_rows", "non_null_count", (F.col("total_rows") - F.col("non_null_count")).alias("null_count"),
        F.coalesce(F.hll_sketch_estimate("distinct"), F.lit(0)).alias("distinct_count"), "min_val", "max_val",
        *[F.when(some, F.kll_sketch_get_quantile_double("quantiles", F.lit(float(p)))).alias(name)
          for name, p in (probs or {"p25": 0.25, "median": 0.5, "p75": 0.75}).items()])


def store_load(root: str, load: str, df: DataFrame, **options) -> None:
    """Sketch the rows of one load and keep them under its name; replaces what an earlier run of the load left."""
    versions.replace_table(sketch_columns(df, **options), f"{root}/load-{quote(load, safe='')}")


def stored_sketches(spark: SparkSession, root: str) -> DataFrame:
    """The current sketch rows of all loads."""
    fs, folder = versions.file_system(spark, root)
    if not fs.exists(folder):
        raise FileNotFoundError(f"no sketches in {root}")
    names = sorted(s.getPath().getName() for s in fs.listStatus(folder))
    found = [versions.current_version(spark, f"{root}/{n}") for n in names if n.startswith("load-")]
    current = [v[1] for v in found if v]
    if not current:
        raise FileNotFoundError(f"no sketches in {root}")
    return spark.read.parquet(*current)  # one scan
