"""Frequent-item summaries of all columns of a table in one scan (P9, P10), without a shuffle of values.

Each column is summarised by Spark's frequent-items sketch over 64-bit digests of its values. Summaries are made in two
levels, ``FAN`` partial results first. A summary's counts are never too low, and a value that is not listed occurs at most
as often as the lowest count listed says, which tells when a recount of the listed values is the exact answer.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FAN = 256


@dataclass(frozen=True)
class Summary:
    """What one scan knows of a column: its non-null values, the digests listed and the most that any other value may
    occur (0 if the list holds all values)."""
    non_null: int
    digests: tuple
    bound: int

    @property
    def whole(self) -> bool:
        return self.bound == 0


def digest(name: str) -> Column:
    """A 64-bit digest of a value of any type but maps (null of null): fixed width, whole texts are never kept."""
    c = F.col("`" + name.replace("`", "``") + "`")
    return F.when(c.isNotNull(), F.xxhash64(c))


def summaries(df: DataFrame, columns, listed: int, tracked: int | None = None, fan: int = FAN) -> dict[str, Summary]:
    """A ``Summary`` of each column from one scan, with up to ``listed`` digests of the most frequent values. ``tracked``
    counters are kept a column (4 * listed if not given); up to so many different values are counted without error."""
    columns, tracked = list(columns), tracked or 4 * listed
    if not columns:
        return {}
    named = df.select(*[digest(c).alias(f"d{i}") for i, c in enumerate(columns)], (F.spark_partition_id() % fan).alias("part"))
    first, second, out = [], [], []
    for i in range(len(columns)):
        first += [F.count(f"d{i}").alias(f"n{i}"), F.expr(f"approx_top_k_accumulate(d{i}, {tracked})").alias(f"s{i}")]
        second += [F.sum(f"n{i}").alias(f"n{i}"), F.expr(f"approx_top_k_combine(s{i}, {tracked})").alias(f"s{i}")]
        out += [F.col(f"n{i}"), F.when(F.col(f"n{i}") > 0, F.expr(f"approx_top_k_estimate(s{i}, {listed})")).alias(f"s{i}")]
    # grouped by a constant: the combining function takes no empty input; ``listed`` numbers a column
    row = named.groupBy("part").agg(*first).groupBy(F.lit(0).alias("all")).agg(*second).select(*out).first()
    if row is None:
        return {c: Summary(0, (), 0) for c in columns}
    found = {}
    for i, c in enumerate(columns):
        items = [x for x in row[f"s{i}"] or [] if x["item"] is not None]
        complete = len(items) < listed and sum(x["count"] for x in items) == row[f"n{i}"]
        least = min((x["count"] for x in items), default=row[f"n{i}"])
        # a list that was not cut at ``listed`` leaves out only values below its last count
        bound = 0 if complete else least - (0 < len(items) < listed)
        found[c] = Summary(row[f"n{i}"], tuple(x["item"] for x in items), bound)
    return found
