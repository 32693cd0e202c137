"""Projection, filter and scalar cleaning expressions.

All are built-in Spark expressions, so they stay inside whole-stage codegen and
filters on raw columns push into the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stellate.functions.types import BOOLEAN, DATE, NUMERIC, STRING, type_family

# Text flags read as TRUE (case-sensitive); anything else, NULL included, is FALSE.
TRUE_FLAGS = ("Y", "true", "1", "yes")
# Null defaults by type family.
DEFAULT_TEXT = "Unknown"
DEFAULT_NUMBER = 0
DEFAULT_DATE = "1900-01-01"
DEFAULT_BOOL = False
DATE_FMT = "yyyy-MM-dd"
TIMESTAMP_FMT = "yyyy-MM-dd HH:mm:ss"
MONEY = T.DecimalType(18, 4)


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ------------------------------------------------------------------ F: projections / filters
def typed_null(type_: str | T.DataType) -> Column:
    """NULL of a type."""
    return F.lit(None).cast(type_)


def typed_const(value, type_: str | T.DataType) -> Column:
    """constant of a type, e.g. ``1::NUMERIC(18,4)``."""
    return F.lit(value).cast(type_)


def soft_delete_filter(df: DataFrame, column: str = "isdeleted") -> DataFrame:
    """keep rows not flagged deleted (NULL counts as not deleted), if the column exists."""
    if column not in df.columns:
        return df
    return df.where(~F.coalesce(F.col(column), F.lit(False)))


def active_filter(df: DataFrame, column: str = "meta_record_status", active: str = "A",
                  keep_null: bool = True) -> DataFrame:
    """status = active; NULL status kept when ``keep_null`` (the loader SQL does so)."""
    if column not in df.columns:
        return df
    c = F.col(column)
    return df.where((c.isNull() | (c == active)) if keep_null else (c == active))


def require_key(df: DataFrame, cols) -> DataFrame:
    """drop rows whose natural key is NULL."""
    return df.dropna(subset=[cols] if isinstance(cols, str) else list(cols))


def filter_in(df: DataFrame, column: str, values) -> DataFrame:
    """IN-list filter. A Python list becomes ``isin`` (pushed to the scan); a
    DataFrame of values becomes a left-semi join (Catalyst broadcasts it when small)."""
    if isinstance(values, DataFrame):
        v = values.select(F.col(values.columns[0]).alias(column)).distinct()
        return df.join(v, column, "left_semi")
    return df.where(F.col(column).isin(list(values)))


def false_guard(df: DataFrame) -> DataFrame:
    """``WHERE 1 = 0``: Catalyst prunes the plan to an empty relation."""
    return df.where(F.lit(False))


def rename_hide(df: DataFrame, renames: dict, hide=()) -> DataFrame:
    """business-friendly names; technical columns dropped for consumers."""
    return df.withColumnsRenamed(renames).drop(*hide)


# ------------------------------------------------------------------ C: casts and defaults
def to_date(c, fmt: str | None = DATE_FMT) -> Column:
    """Text -> DATE; malformed -> NULL (never an error)."""
    c = col(c)
    return F.try_to_date(c, fmt) if fmt else c.try_cast("date")


def to_timestamp(c, fmt: str | None = TIMESTAMP_FMT) -> Column:
    """Text -> TIMESTAMP; malformed -> NULL."""
    c = col(c)
    return F.try_to_timestamp(c, F.lit(fmt)) if fmt else c.try_cast("timestamp")


def to_money(c) -> Column:
    """Text -> NUMERIC(18,4); malformed -> NULL."""
    return col(c).try_cast(MONEY)


def to_int(c) -> Column:
    """C4: text -> INTEGER; malformed -> NULL."""
    return col(c).try_cast("int")


def flag_to_bool(c) -> Column:
    """C5: 'Y','true','1','yes' -> TRUE, everything else (NULL too) -> FALSE."""
    return F.coalesce(col(c).isin(*TRUE_FLAGS), F.lit(False))


def id_to_text(c, max_len: int = 50) -> Column:
    """Identifier as text (VARCHAR(50)); longer values are caught by the length gate Q7."""
    return col(c).cast("string")


def guarded_date(*cols) -> Column:
    """First column whose trimmed text has at least 10 chars gives the date (its first
    10 chars); a malformed first candidate gives NULL (no fall-through), as in the loader."""
    out = None
    for c in cols:
        t = F.trim(col(c))
        cond = F.length(t) >= 10
        val = F.substring(t, 1, 10).try_cast("date")
        out = F.when(cond, val) if out is None else out.when(cond, val)
    return out.otherwise(F.lit(None).cast("date"))


def default_for(dt: T.DataType) -> Column | None:
    """The rules' default for a NULL of a type family."""
    fam = type_family(dt)
    if fam == STRING:
        return F.lit(DEFAULT_TEXT)
    if fam == NUMERIC:
        return F.lit(DEFAULT_NUMBER).cast(dt)
    if fam == DATE:
        return F.lit(DEFAULT_DATE).cast(dt)
    if fam == BOOLEAN:
        return F.lit(DEFAULT_BOOL)
    return None


def fill_defaults(df: DataFrame, columns=None) -> DataFrame:
    """Replace NULLs by the type default (all columns or the given ones)."""
    cols = set(columns or df.columns)
    out = []
    for f in df.schema.fields:
        d = default_for(f.dataType) if f.name in cols else None
        out.append(F.coalesce(F.col(f"`{f.name}`"), d).alias(f.name) if d is not None else F.col(f"`{f.name}`"))
    return df.select(*out)


def defaults_by_null_band(df: DataFrame, null_pcts: dict) -> tuple[DataFrame, list]:
    """100 % null -> constant default; > 0 % -> default; > 50 % also a warning.

    ``null_pcts`` maps column -> null % (from the profile, catalog-sized).
    Returns the DataFrame and the list of (column, warning) pairs.
    """
    warnings, out = [], []
    for f in df.schema.fields:
        p = null_pcts.get(f.name, 0.0) or 0.0
        d = default_for(f.dataType)
        c = F.col(f"`{f.name}`")
        if d is not None and p >= 100:
            out.append(d.alias(f.name))
            warnings.append((f.name, "all null: constant default"))
        elif d is not None and p > 0:
            out.append(F.coalesce(c, d).alias(f.name))
            if p > 50:
                warnings.append((f.name, "more than half null: default applied"))
        else:
            out.append(c)
    return df.select(*out), warnings


def map_codes(c, mapping: dict, default=None) -> Column:
    """C11: CASE over raw codes (short lists; long lists belong in a broadcast map join)."""
    c = col(c)
    out = None
    for k, v in mapping.items():
        out = F.when(c == k, F.lit(v)) if out is None else out.when(c == k, F.lit(v))
    return out.otherwise(F.lit(default)) if out is not None else F.lit(default)


def cast_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select + cast to a declared schema; missing columns become typed NULLs;
    a value that does not fit its type becomes NULL (``try_cast``)."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields])


def url_host(c) -> Column:
    """Host part of a URL."""
    return F.try_parse_url(col(c), F.lit("HOST"))


def url_path_levels(c, levels: int = 5) -> list[Column]:
    """C17: path segments 1..levels of a URL (NULL when absent)."""
    parts = F.split(F.regexp_replace(F.try_parse_url(col(c), F.lit("PATH")), "^/", ""), "/")
    return [F.nullif(F.get(parts, i), F.lit("")).alias(f"page_location_{i + 1}") for i in range(levels)]


def split_datetime(c, prefix: str) -> list[Column]:
    """Datetime -> date, time text HH:mm:ss, datetime."""
    c = col(c)
    return [F.to_date(c).alias(f"{prefix}_date"), F.date_format(c, "HH:mm:ss").alias(f"{prefix}_time"),
            c.alias(f"{prefix}_datetime")]


def date_key(c) -> Column:
    """Calendar key yyyyMMdd as INTEGER."""
    c = F.to_date(col(c))
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def seconds_between(start, end) -> Column:
    """Seconds from ``start`` to ``end`` (fractional), independent of the session time zone."""
    return F.timestamp_diff("MICROSECOND", col(start), col(end)) / F.lit(1_000_000.0)
