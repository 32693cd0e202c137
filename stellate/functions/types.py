"""Type families used by profiling and casting."""

from __future__ import annotations

from pyspark.sql import types as T

NUMERIC = "numeric"
DATE = "date"
STRING = "string"
BOOLEAN = "boolean"
OTHER = "other"

_NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                  T.DoubleType, T.DecimalType)
_DATE_TYPES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def type_family(dt: T.DataType) -> str:
    if isinstance(dt, _NUMERIC_TYPES):
        return NUMERIC
    if isinstance(dt, _DATE_TYPES):
        return DATE
    if isinstance(dt, (T.StringType, T.VarcharType, T.CharType)):
        return STRING
    if isinstance(dt, T.BooleanType):
        return BOOLEAN
    return OTHER


def family_of_name(type_name: str) -> str:
    """Family from a catalog type name (warehouse or Spark spelling)."""
    t = type_name.strip().lower()
    base = t.split("(")[0].strip()
    if base in ("integer", "int", "bigint", "smallint", "tinyint", "decimal", "numeric", "real",
                "double precision", "double", "float", "float4", "float8", "long", "short", "byte"):
        return NUMERIC
    if base.startswith("timestamp") or base in ("date", "timestamptz"):
        return DATE
    if base in ("varchar", "char", "text", "bpchar", "character varying", "character", "string"):
        return STRING
    if base in ("boolean", "bool"):
        return BOOLEAN
    return OTHER
