"""Quality gates and the load audit.

Every gate returns rows of one shape so the report (Q9) is a plain union:
(gate, table_name, column_name, observed, threshold, passed).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GATE_SCHEMA = "gate string, table_name string, column_name string, observed double, threshold double, passed boolean"


def _gate_rows(df: DataFrame, gate: str, table: str, observed: dict, thresholds: dict, higher_is_bad: bool = True):
    """One aggregate row of observed values -> one gate row per column (inline, no shuffle).

    Nothing observed (an empty load) is NULL and does not pass."""
    entries = []
    for c, obs in observed.items():
        thr = float(thresholds[c])
        passed = (obs <= F.lit(thr)) if higher_is_bad else (obs >= F.lit(thr))
        entries.append(F.struct(F.lit(gate).alias("gate"), F.lit(table).alias("table_name"),
                                F.lit(c).alias("column_name"), obs.cast("double").alias("observed"),
                                F.lit(thr).alias("threshold"), F.coalesce(passed, F.lit(False)).alias("passed")))
    return df.select(F.inline(F.array(*entries)))


def null_rate(df: DataFrame, table: str, cols, max_rate: float = 0.0) -> DataFrame:
    """Q1: share of NULLs per required column against a maximum (one scan)."""
    cols = list(cols)
    agg = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in cols])
    return _gate_rows(agg, "null_rate", table, {c: F.round(F.col(c), 6) for c in cols}, {c: max_rate for c in cols})


def orphans(fact: DataFrame, dim: DataFrame, fk: str, dim_key: str):
    """Q2: fact rows whose non-null key has no dimension row.

    Returns (summary, orphan_rows). The summary is one row: checked, orphan_rows, orphan_rate.
    ``left_anti`` keeps the fact side whole; AQE broadcasts a small dimension.
    """
    keys = dim.select(F.col(dim_key).alias("_k")).distinct()
    nonnull = fact.where(F.col(fk).isNotNull())
    bad = nonnull.join(keys, nonnull[fk] == keys["_k"], "left_anti")
    found = nonnull.join(keys, nonnull[fk] == keys["_k"], "left").select(F.col("_k").isNull().alias("_orphan"))
    summary = found.agg(F.count(F.lit(1)).alias("checked"), F.count_if("_orphan").alias("orphan_rows"),
                        F.round(F.try_divide(F.count_if("_orphan"), F.count(F.lit(1))), 6).alias("orphan_rate"))
    return summary, bad


def orphan_gate(fact: DataFrame, dim: DataFrame, fk: str, dim_key: str, table: str, max_rate: float = 0.0):
    summary, _ = orphans(fact, dim, fk, dim_key)
    return _gate_rows(summary, "orphan_rate", table, {fk: F.col("orphan_rate")}, {fk: max_rate})


def format_gate(df: DataFrame, table: str, column: str, pattern: str, min_rate: float = 1.0) -> DataFrame:
    """Q3: share of non-null values matching the expected format, against a minimum."""
    c = F.col(column)
    agg = df.where(c.isNotNull()).agg(F.round(F.try_divide(F.count_if(c.rlike(pattern)), F.count(F.lit(1))), 6)
                                      .alias("r"))
    return _gate_rows(agg, "format_rate", table, {column: F.col("r")}, {column: min_rate},
                      higher_is_bad=False)


def with_reasons(df: DataFrame, rules: dict[str, Column], name: str = "quarantine_reasons") -> DataFrame:
    """``df`` with the names of the rules that each row breaks."""
    return df.withColumn(name, F.array_compact(F.array(*[F.when(cond, F.lit(reason)) for reason, cond in rules.items()])))


def quarantine(df: DataFrame, rules: dict[str, Column]):
    """Q4: split rows into clean and bad; bad rows carry the names of the rules they break.

    ``rules`` maps a reason to a condition that is TRUE for a bad row. Each input row
    lands in exactly one of the two outputs (a NULL condition counts as not broken).
    """
    tagged = with_reasons(df, rules)
    clean = tagged.where(F.size("quarantine_reasons") == 0).drop("quarantine_reasons")
    bad = tagged.where(F.size("quarantine_reasons") > 0)
    return clean, bad


def duplicate_keys(df: DataFrame, key) -> DataFrame:
    """Q5: natural keys with more than one row (map-side combined count)."""
    key = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("row_count")).where(F.col("row_count") > 1)


def empty_or_low_flags(summary: DataFrame) -> DataFrame:
    """Q6: warning rows for empty sources and low modelling readiness."""
    return summary.select(
        "table_name",
        F.when(F.col("row_count") == 0, F.lit("source empty: load guarded with WHERE 1 = 0"))
        .when(F.col("modeling_readiness") == "low", F.lit("readiness low: review keys and nulls"))
        .alias("warning")).where(F.col("warning").isNotNull())


def length_gate(df: DataFrame, table: str, lengths: dict) -> DataFrame:
    """Q7: values longer than the declared VARCHAR(n), counted per column (max 0)."""
    rows = F.count(F.lit(1))
    agg = df.agg(*[F.when(rows > 0, F.count_if(F.length(F.col(c)) > n)).alias(c) for c, n in lengths.items()])
    return _gate_rows(agg, "too_long", table, {c: F.col(c) for c in lengths}, {c: 0 for c in lengths})


def fk_coverage(fact: DataFrame, table: str, fks, min_rate: float = 0.95) -> DataFrame:
    """Q8: share of non-null foreign keys per key column, against a minimum."""
    fks = list(fks)
    agg = fact.agg(*[F.avg(F.col(c).isNotNull().cast("double")).alias(c) for c in fks])
    return _gate_rows(agg, "fk_coverage", table, {c: F.round(F.col(c), 6) for c in fks},
                      {c: min_rate for c in fks}, higher_is_bad=False)


def gate_report(*gates: DataFrame) -> DataFrame:
    """Q9: all gate rows in one table."""
    out = gates[0]
    for g in gates[1:]:
        out = out.unionByName(g)
    return out


def load_warning() -> Column:
    return (F.when(F.col("row_count") == 0, F.lit("empty load"))
            .when(F.col("null_fk_rate") > 0, F.lit("unresolved foreign keys")).alias("warning"))


def audit_rows(spark, steps) -> DataFrame:
    """Ordered audit of loads. ``steps``: iterable of (step_no, target, df, fk_columns).

    Each step contributes one aggregate row (row count, NULL-FK rate, warning), so the
    audit is one small job per target; the caller appends it to the audit table.
    """
    parts = []
    for step, target, df, fks in steps:
        fks = list(fks)
        if fks:
            null_any = F.lit(False)
            for c in fks:
                null_any = null_any | F.col(c).isNull()
            rate = F.round(F.avg(null_any.cast("double")), 6)
        else:
            rate = F.lit(None).cast("double")
        row = df.agg(F.count(F.lit(1)).alias("row_count"), rate.alias("null_fk_rate"))
        parts.append(row.select(
            F.lit(int(step)).alias("step"), F.lit(target).alias("target"), "row_count",
            "null_fk_rate", load_warning()))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def write_audit(audit: DataFrame, path: str) -> None:
    """S11 sink: append-only."""
    audit.write.mode("append").parquet(path)
