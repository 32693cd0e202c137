"""As-of join: each row meets the latest row of another table at or before its time.

The order of an entity is cut into time buckets, and rows are sorted per (entity, bucket), so an entity that holds
a third of all rows is spread over as many tasks as it has buckets. What a bucket needs from before its start
is one row: the latest one of the earlier buckets, found on a summary of one row per (entity, bucket) and put
in front of the bucket's own rows. No row is joined to another by the entity alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hourly(ts: Column) -> Column:
    return F.date_trunc("hour", ts)


def as_of_join(left: DataFrame, right: DataFrame, by: str, left_ts: str, right_ts: str, payload: list[str],
               tiebreak: str, bucket: Callable[[Column], Column] = hourly, right_by: str | None = None) -> DataFrame:
    """``left`` with the ``payload`` columns of the latest ``right`` row of the same ``by`` whose time is not after
    the left row's; of equal times the highest ``tiebreak`` counts.

    Every left row comes back once. The payload is NULL where no such row exists and where the left row's entity
    or time is NULL; right rows with a NULL entity or time meet nothing. ``bucket`` maps a time to a value that
    does not fall as time grows.
    """
    right_by = right_by or by
    if set(payload) & set(left.columns):
        raise ValueError("payload columns must not have names of left columns")
    entity, at = left.schema[by].dataType, left.schema[left_ts].dataType
    rows = left.select(F.struct("*").alias("_row"), F.col(by).alias("_by"), F.col(left_ts).alias("_ts"))
    row_type = rows.schema["_row"].dataType
    met = right.where(F.col(right_by).isNotNull() & F.col(right_ts).isNotNull()).select(
        F.col(right_by).cast(entity).alias("_by"), F.col(right_ts).cast(at).alias("_ts"), F.col(tiebreak).alias("_tie"),
        F.struct(*payload).alias("_found"))
    tie, found = met.schema["_tie"].dataType, met.schema["_found"].dataType
    rows = rows.withColumn("_b", bucket(F.col("_ts")))
    met = met.withColumn("_b", bucket(F.col("_ts")))

    # the latest right row of each bucket, carried over the entity's later buckets that have left rows
    last = F.max(F.struct("_ts", "_tie", "_found"))
    ends = met.groupBy("_by", "_b").agg(last.alias("_last"), F.lit(False).alias("_asks"))
    asks = rows.groupBy("_by", "_b").agg(F.lit(True).alias("_asks")).select(
        "_by", "_b", F.lit(None).cast(ends.schema["_last"].dataType).alias("_last"), "_asks")
    summary = ends.unionByName(asks).groupBy("_by", "_b").agg(F.max("_last").alias("_last"), F.max("_asks").alias("_asks"))
    before = Window.partitionBy("_by").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carried = (summary.withColumn("_last", F.last("_last", ignorenulls=True).over(before))
               .where(F.col("_asks") & F.col("_last").isNotNull()))

    no_row, no_tie = F.lit(None).cast(row_type).alias("_row"), F.lit(None).cast(tie).alias("_tie")
    parts = [rows.select("_by", "_b", "_ts", F.lit(2).alias("_kind"), no_tie, "_row", F.lit(None).cast(found).alias("_found")),
             met.select("_by", "_b", "_ts", F.lit(1).alias("_kind"), "_tie", no_row, "_found"),
             carried.select("_by", "_b", F.lit(None).cast(at).alias("_ts"), F.lit(0).alias("_kind"), no_tie, no_row,
                            F.col("_last._found").alias("_found"))]
    all_rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    # the carried row first, then by time, right rows before left rows of the same time
    order = Window.partitionBy("_by", "_b").orderBy(F.col("_kind") > 0, F.col("_ts").asc_nulls_first(), "_kind", "_tie")
    so_far = F.last("_found", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return (all_rows.withColumn("_found", so_far).where(F.col("_kind") == 2)
            .select("_row.*", *[F.col(f"_found.{c}").alias(c) for c in payload]))
