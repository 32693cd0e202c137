"""Dimensions, surrogate keys and bridges."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stellate.functions import clean as C
from stellate.functions.clean import date_key
from stellate.session import checkpoint_dir


# ------------------------------------------------------------------ D1
def dedupe_latest(df: DataFrame, key, order, tiebreak=()) -> DataFrame:
    """One row per natural key, the one with the greatest ``order`` (NULLs last),
    then the greatest ``tiebreak`` columns.

    A grouped ``max(struct(order..., row))`` instead of ``row_number`` over a window:
    the aggregate is combined map-side, so a key holding a third of all rows never
    has to be sorted inside one task. Maps have no order, so a map column goes through as its sorted entries.
    """
    key = [key] if isinstance(key, str) else list(key)
    order = [order] if isinstance(order, str) else list(order)
    tiebreak = [tiebreak] if isinstance(tiebreak, str) else list(tiebreak)
    rest = [c for c in df.columns if c not in key]
    maps = {f.name for f in df.schema if isinstance(f.dataType, T.MapType)}
    # NULL orders sort below any value inside a struct, so max() puts them last.
    ranked = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order + tiebreak)],
                      F.struct(*[(F.sort_array(F.map_entries(f"`{c}`")) if c in maps else F.col(f"`{c}`")).alias(c) for c in rest])
                      .alias("_row"))
    best = df.groupBy(*key).agg(F.max(ranked).alias("_best"))
    row = {c: F.col(f"_best._row.`{c}`") for c in rest}
    return best.select(*key, *[(F.map_from_entries(v) if c in maps else v).alias(c) for c, v in row.items()]).select(*df.columns)


# ------------------------------------------------------------------ D2, D3
def surrogate_key(df: DataFrame, natural_key, key_name: str, offset=0, partitions: int | None = None) -> DataFrame:
    """Dense keys 1..n (+ offset) in natural-key order; equals
    ``ROW_NUMBER() OVER (ORDER BY natural_key)`` for a unique, non-null key.

    Rows never go through a single partition, whatever the size: they are
    range-partitioned on the key and sorted within partitions; each row gets its
    partition id and position, the result is checkpointed (range bounds come from
    sampling, so a re-evaluation could cut differently; the input is evaluated once),
    and the per-partition counts (one row per partition) become cumulative offsets
    that are broadcast back.
    """
    spark = df.sparkSession
    keys = [natural_key] if isinstance(natural_key, str) else list(natural_key)
    off = offset if not isinstance(offset, (int, float)) else F.lit(int(offset))
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    checkpoint_dir(spark)
    ranged = (df.repartitionByRange(n, *[F.col(k).asc_nulls_last() for k in keys])
              .sortWithinPartitions(*[F.col(k).asc_nulls_last() for k in keys])
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id())
              .checkpoint(eager=True))
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_base"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", "_base",
                            F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_before"))
    return (ranged.join(F.broadcast(offsets), "_pid")
            .withColumn(key_name, (off + F.col("_before") + (F.col("_mid") - F.col("_base")) + 1).cast("bigint"))
            .drop("_pid", "_mid", "_base", "_before"))


def stable_surrogate_key(existing: DataFrame, incoming: DataFrame, natural_key, key_name: str) -> DataFrame:
    """D3: identity semantics across loads: existing rows keep their keys, new natural
    keys get max(key) + 1, + 2, ... in natural-key order. Repeated incoming keys get one
    row, rows without a natural key none."""
    keys = [natural_key] if isinstance(natural_key, str) else list(natural_key)
    new = C.require_key(incoming, keys).dropDuplicates(keys).join(existing.select(*keys), keys, "left_anti")
    top = existing.agg(F.max(key_name)).first()[0] or 0  # one scalar
    fresh = surrogate_key(new, keys, key_name, offset=int(top))
    return existing.unionByName(fresh.select(*existing.columns))


def reuse_surrogate(df: DataFrame, column: str, key_name: str) -> DataFrame:
    """A source ``*_key_sk`` column is the surrogate key, cast to BIGINT."""
    return df.withColumn(key_name, F.col(column).cast("bigint"))


# ------------------------------------------------------------------ D5
@dataclass(frozen=True)
class DimensionSpec:
    name: str
    natural_key: tuple
    key_name: str
    attributes: dict                       # target column -> source column / Column
    order_by: tuple = ()                   # newest-first dedup order (D1)
    tiebreak: tuple = ()
    soft_delete: str | None = None         # F3 column
    status: str | None = None              # F4 column
    keep_null_status: bool = True
    schema: T.StructType | None = None     # C16 target types
    defaults: bool = True                  # C8
    foreign_keys: tuple = ()               # attributes that are never defaulted: an unresolved key stays NULL


def build_dimension(df: DataFrame, spec: DimensionSpec) -> DataFrame:
    """F3/F4/F5 -> D1 -> projection -> C8 -> D2 -> C16."""
    x = df
    if spec.soft_delete:
        x = C.soft_delete_filter(x, spec.soft_delete)
    if spec.status:
        x = C.active_filter(x, spec.status, keep_null=spec.keep_null_status)
    x = C.require_key(x, list(spec.natural_key))
    if spec.order_by:
        x = dedupe_latest(x, list(spec.natural_key), list(spec.order_by), list(spec.tiebreak))
    else:
        x = x.dropDuplicates(list(spec.natural_key))
    x = x.select(*[F.col(k) for k in spec.natural_key],
                 *[C.col(v).alias(k) for k, v in spec.attributes.items() if k not in spec.natural_key])
    if spec.defaults:
        x = C.fill_defaults(x, [k for k in spec.attributes if k not in (*spec.natural_key, *spec.foreign_keys)])
    x = surrogate_key(x, list(spec.natural_key), spec.key_name)
    cols = [spec.key_name, *spec.natural_key, *[k for k in spec.attributes if k not in spec.natural_key]]
    x = x.select(*cols)
    if spec.schema is not None:
        x = C.cast_to_schema(x, spec.schema)
    return x


# ------------------------------------------------------------------ D6
def unknown_member(dim: DataFrame, key_name: str, key_value: int = -1, natural_key=()) -> DataFrame:
    """Add one 'Unknown' member for consumers; facts map NULL keys to it with
    ``coalesce(fk, -1)``. Columns named in ``natural_key`` stay NULL, as any default could be
    a real key."""
    natural = [natural_key] if isinstance(natural_key, str) else list(natural_key)
    row = []
    for f in dim.schema.fields:
        if f.name == key_name:
            row.append(F.lit(key_value).cast(f.dataType).alias(f.name))
        elif f.name in natural:
            row.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            d = C.default_for(f.dataType)
            row.append((d if d is not None else F.lit(None)).cast(f.dataType).alias(f.name))
    one = dim.sparkSession.range(1).select(*row)
    return dim.unionByName(one)


# ------------------------------------------------------------------ D7-D9 calendars
def dim_date(spark: SparkSession, start, end) -> DataFrame:
    """One row per day in [start, end], generated in parallel with ``range``; no row if a
    bound is missing (a source without dates)."""
    start_d = F.to_date(F.lit(None if start is None else str(start)))
    n = -1
    if start is not None and end is not None:
        n = spark.sql(f"SELECT datediff(DATE'{end}', DATE'{start}') AS n").first()[0]
    d = spark.range(0, int(n) + 1).select(F.date_add(start_d, F.col("id").cast("int")).alias("full_date"))
    return d.select(
        date_key("full_date").alias("date_key"), "full_date",
        F.year("full_date").alias("year"), F.quarter("full_date").alias("quarter"),
        F.month("full_date").alias("month"), F.date_format("full_date", "MMMM").alias("month_name"),
        F.dayofmonth("full_date").alias("day_of_month"), F.dayofweek("full_date").alias("day_of_week"),
        F.date_format("full_date", "EEEE").alias("day_name"), F.weekofyear("full_date").alias("week_of_year"),
        (F.dayofweek("full_date").isin(1, 7)).alias("is_weekend"),
        (F.year("full_date") * 100 + F.month("full_date")).alias("month_key"))


def dim_date_for(df: DataFrame, column: str) -> DataFrame:
    """D7 over the range of a date column of the data (two scalars come back)."""
    r = df.agg(F.min(F.to_date(column)).alias("a"), F.max(F.to_date(column)).alias("b")).first()
    return dim_date(df.sparkSession, r["a"], r["b"])


def dim_month(dates: DataFrame) -> DataFrame:
    """Month roll-up of the calendar."""
    return (dates.groupBy("month_key", "year", "quarter", "month", "month_name")
            .agg(F.min("full_date").alias("first_day"), F.max("full_date").alias("last_day"),
                 F.count(F.lit(1)).alias("days")))


def dim_year(dates: DataFrame) -> DataFrame:
    """Year roll-up of the calendar."""
    return (dates.groupBy("year").agg(F.min("full_date").alias("first_day"), F.max("full_date").alias("last_day"),
                                      F.count(F.lit(1)).alias("days")))


def dim_time(spark: SparkSession, grain_seconds: int = 1) -> DataFrame:
    """One row per second (or per ``grain_seconds``) of the day."""
    s = spark.range(0, 86400, grain_seconds).select(F.col("id").cast("int").alias("sec"))
    h, m, sec = (F.col("sec") / 3600).cast("int"), ((F.col("sec") % 3600) / 60).cast("int"), F.col("sec") % 60
    return s.select(F.col("sec").alias("time_key"), h.alias("hour"), m.alias("minute"), sec.alias("second"),
                    F.format_string("%02d:%02d:%02d", h, m, sec).alias("time_text"))


# ------------------------------------------------------------------ D10-D16
def dim_geography(nation: DataFrame, region: DataFrame) -> DataFrame:
    """Conformed geography = nation joined with its region, surrogate-keyed."""
    g = nation.join(region, nation.n_regionkey == region.r_regionkey, "left").select(
        "n_nationkey", F.col("n_name").alias("country"), F.col("r_name").alias("region"))
    return surrogate_key(g, "n_nationkey", "geography_key").select(
        "geography_key", "n_nationkey", "country", "region")


def status_dimension(df: DataFrame, cols, key_name: str) -> DataFrame:
    """junk/status dimension: distinct combinations, surrogate-keyed."""
    cols = list(cols)
    combos = df.select(*cols).distinct()
    return surrogate_key(combos, cols, key_name).select(key_name, *cols)


def first_flag(df: DataFrame, entity, order, tiebreak, flag_name: str = "is_first") -> DataFrame:
    """Flag the first row per entity by time.

    The first (order, tiebreak) per entity comes from a grouped ``min`` (map-side
    combined) and is joined back, instead of a row_number window per entity.
    """
    entity = [entity] if isinstance(entity, str) else list(entity)
    first = df.groupBy(*entity).agg(F.min(F.struct(F.col(order).alias("_o"), F.col(tiebreak).alias("_t")))
                                    .alias("_first"))
    j = df.join(first, entity, "left")
    is_first = (F.col(order) == F.col("_first._o")) & (F.col(tiebreak) == F.col("_first._t"))
    return j.withColumn(flag_name, F.coalesce(is_first, F.lit(False))).drop("_first")


def activity_levels(df: DataFrame, levels, key_name: str = "activity_key") -> DataFrame:
    """Distinct level combinations of a three-level hierarchy, surrogate-keyed."""
    return status_dimension(df, levels, key_name)


def build_bridge(pairs: DataFrame, left: DataFrame, left_on: str, left_key: str,
                 right: DataFrame, right_on: str, right_key: str) -> DataFrame:
    """Many-to-many pairs as surrogate-key pairs (distinct natural pairs, two lookups)."""
    from stellate.operators.facts import lookup_key
    p = pairs.select(left_on, right_on).distinct()
    p = lookup_key(p, left, left_on, left_on, left_key)
    p = lookup_key(p, right, right_on, right_on, right_key)
    return p.select(left_key, right_key)
