"""Checked loads: the job that writes a target also observes its gates (Q1-Q3, Q7, Q8), splits off the rows that
break a rule (Q4) and counts what the audit records (S11).

The observed aggregates travel with the write (``DataFrame.observe``), so no written table is scanned again for its
gates. With rules, one job writes both sinks: the folder ``sink=clean`` is the target, ``sink=bad`` holds the broken
rows with their reasons; every row lands in one of them. The aggregates stand right before the writer, behind the last
shuffle, so a task that runs again is counted once.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stellate.operators import quality as Q

SINK, REASONS = "sink", "quarantine_reasons"


@dataclass(frozen=True)
class Checks:
    """What one load has to keep. Conditions may read columns that are not written."""

    required: dict = field(default_factory=dict)   # Q1: column -> highest share of NULLs
    looked_up: dict = field(default_factory=dict)  # Q2: key column -> the natural key it was looked up by
    orphan_rate: float = 0.0                       # Q2: highest share of natural keys without a key
    formats: dict = field(default_factory=dict)    # Q3: column -> (pattern, lowest share of values that match)
    rules: dict = field(default_factory=dict)      # Q4: reason -> condition, TRUE for a row to set aside
    lengths: dict = field(default_factory=dict)    # Q7: column -> most characters
    coverage: dict = field(default_factory=dict)   # Q8: key column -> lowest share of rows that have it
    keys: tuple = ()                               # S11: keys whose NULLs the audit reports


@dataclass
class Loaded:
    """A written target and what its load observed."""

    spark: SparkSession
    table: str
    path: str
    schema: object
    checks: Checks
    counts: dict

    @cached_property
    def _all(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    def target(self) -> DataFrame:
        """The written rows."""
        return self._all.where(F.col(SINK) == "clean").drop(SINK, REASONS) if self.checks.rules else self._all

    def bad(self) -> DataFrame:
        """The rows set aside, with their reasons."""
        if not self.checks.rules:
            raise ValueError("this load has no rules")
        return self._all.where(F.col(SINK) == "bad").drop(SINK)

    def _observed(self) -> DataFrame:
        return self.spark.createDataFrame([tuple(self.counts.values())], ", ".join(f"{k} long" for k in self.counts))

    def gates(self) -> DataFrame:
        """The gate rows of the load, from what it observed; nothing observed does not pass."""
        c, one, found = self.checks, self._observed(), []

        def share(part, whole):
            return F.round(F.try_divide(F.col(part), F.col(whole)), 6)

        def add(gate, observed, thresholds, higher_is_bad=True):
            if observed:
                found.append(Q._gate_rows(one, gate, self.table, observed, thresholds, higher_is_bad))

        add("null_rate", {x: share(f"q1_{i}", "good") for i, x in enumerate(c.required)}, c.required)
        add("orphan_rate", {x: share(f"q2_{i}", f"q2_of_{i}") for i, x in enumerate(c.looked_up)}, dict.fromkeys(c.looked_up, c.orphan_rate))
        add("format_rate", {x: share(f"q3_{i}", f"q3_of_{i}") for i, x in enumerate(c.formats)}, {x: v[1] for x, v in c.formats.items()}, False)
        add("too_long", {x: F.when(F.col("good") > 0, F.col(f"q7_{i}")) for i, x in enumerate(c.lengths)}, dict.fromkeys(c.lengths, 0))
        add("fk_coverage", {x: share(f"q8_{i}", "good") for i, x in enumerate(c.coverage)}, c.coverage, False)
        return Q.gate_report(*found) if found else self.spark.createDataFrame([], Q.GATE_SCHEMA)

    def audit(self, step: int) -> DataFrame:
        """The audit row of the load."""
        rate = F.round(F.try_divide(F.col("s11"), F.col("good")), 6) if self.checks.keys else F.lit(None).cast("double")
        row = self._observed().select(F.col("good").alias("row_count"), rate.alias("null_fk_rate"))
        return row.select(F.lit(int(step)).alias("step"), F.lit(self.table).alias("target"), "row_count", "null_fk_rate", Q.load_warning())


def _aggregates(checks: Checks) -> dict:
    """Counts over the rows that reach the target; ``all_rows`` over every row."""
    good = F.size(REASONS) == 0 if checks.rules else F.lit(True)

    def count(cond):
        return F.count_if(good & cond)

    out = {"all_rows": F.count(F.lit(1)), "good": F.count_if(good)}
    for i, c in enumerate(checks.required):
        out[f"q1_{i}"] = count(F.col(c).isNull())
    for i, (key, natural) in enumerate(checks.looked_up.items()):
        out[f"q2_{i}"] = count(F.col(natural).isNotNull() & F.col(key).isNull())
        out[f"q2_of_{i}"] = count(F.col(natural).isNotNull())
    for i, (c, (pattern, _)) in enumerate(checks.formats.items()):
        out[f"q3_{i}"] = count(F.col(c).rlike(pattern))
        out[f"q3_of_{i}"] = count(F.col(c).isNotNull())
    for i, (c, n) in enumerate(checks.lengths.items()):
        out[f"q7_{i}"] = count(F.length(c) > n)
    for i, c in enumerate(checks.coverage):
        out[f"q8_{i}"] = count(F.col(c).isNotNull())
    if checks.keys:
        null_any = F.lit(False)
        for c in checks.keys:
            null_any = null_any | F.col(c).isNull()
        out["s11"] = count(null_any)
    return out


def load(df: DataFrame, path: str, table: str, checks: Checks | None = None, columns=None) -> Loaded:
    """Write ``columns`` of ``df`` (all by default) to ``path`` in one job that also observes the checks."""
    checks = checks or Checks()
    columns = list(columns or df.columns)
    rows, kept = df, [F.col(c) for c in columns]
    if checks.rules:
        rows = Q.with_reasons(rows, checks.rules, REASONS)
        kept += [F.col(REASONS), F.when(F.size(REASONS) == 0, F.lit("clean")).otherwise(F.lit("bad")).alias(SINK)]
    aggregates = _aggregates(checks)
    seen = Observation(f"load-{table}-{uuid.uuid4().hex}")
    out = rows.observe(seen, *[v.alias(k) for k, v in aggregates.items()]).select(*kept)
    writer = out.write.mode("overwrite")
    (writer.partitionBy(SINK) if checks.rules else writer).parquet(path)
    found = seen.get
    # a plan that is empty by its shape observes nothing
    return Loaded(df.sparkSession, table, path, out.schema, checks, {k: int(found.get(k) or 0) for k in aggregates})
