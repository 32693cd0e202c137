"""Metadata tables.

Every operator here takes and returns catalog DataFrames (one row per table or per
column of a whole lake); nothing iterates over Python lists of tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CATALOG_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("data_type", T.StringType()),
    T.StructField("character_maximum_length", T.IntegerType()),
    T.StructField("numeric_precision", T.IntegerType()),
    T.StructField("numeric_scale", T.IntegerType()),
    T.StructField("is_nullable", T.StringType()),
    T.StructField("ordinal_position", T.IntegerType()),
])

# Name patterns of versioned / backup copies of a table.
VERSIONED_TABLE_PATTERNS = (
    r"_\d+$",
    r"_v\d+$",
    r"_(old|bak|backup|copy|temp|tmp|archive|test|dev|staging)$",
    r"_\d{6,8}$",
    r"_deleted$",
)


def catalog_columns(spark: SparkSession, tables: dict) -> DataFrame:
    """M1: one row per column of each table, in table-name then ordinal order.

    Built from each DataFrame's schema (the lake's catalog); for a warehouse source
    read ``information_schema.columns`` over JDBC into the same shape instead.
    """
    rows = []
    for name in sorted(tables):
        for i, f in enumerate(tables[name].schema.fields, start=1):
            dt = f.dataType
            prec = dt.precision if isinstance(dt, T.DecimalType) else None
            scale = dt.scale if isinstance(dt, T.DecimalType) else None
            clen = dt.length if isinstance(dt, (T.VarcharType, T.CharType)) else None
            rows.append((name, f.name, dt.simpleString(), clen, prec, scale,
                         "YES" if f.nullable else "NO", i))
    return spark.createDataFrame(rows, CATALOG_SCHEMA)


def catalog_from_metastore(spark: SparkSession, database: str | None = None, pattern: str | None = None) -> DataFrame:
    """M1 for a lake registered in the Spark catalog: base tables (views and temporary
    tables skipped, as the reference keeps ``BASE TABLE`` only) in name order and their
    columns, read from the catalog API - no table data is touched."""
    tables = sorted((t.name for t in spark.catalog.listTables(database, pattern)
                     if not t.isTemporary and (t.tableType or "").upper() != "VIEW"))
    prefix = f"{database}." if database else ""
    return catalog_columns(spark, {t: spark.table(prefix + t) for t in tables})


def table_list(columns: DataFrame) -> DataFrame:
    return columns.select("table_name").distinct()


def is_versioned(name_col) -> F.Column:
    low = F.lower(name_col)
    out = F.lit(False)
    for p in VERSIONED_TABLE_PATTERNS:
        out = out | low.rlike(p)
    return out


def drop_versioned_tables(tables: DataFrame, col: str = "table_name") -> DataFrame:
    """M2: drop names that look like versioned or backup copies."""
    return tables.where(~is_versioned(F.col(col)))


def dedupe_table_names(tables: DataFrame, col: str = "table_name") -> DataFrame:
    """M3: keep the first table (name order) per canonical name (lower case, numeric tail cut).

    ``min`` per canonical name is the first in name order; a grouped aggregate instead
    of a window so one large group never lands in one task.
    """
    canon = F.regexp_replace(F.lower(F.col(col)), r"_\d+$", "")
    return (tables.select(F.col(col), canon.alias("_canon")).groupBy("_canon")
            .agg(F.min(col).alias(col)).select(col))


def clean_table_list(tables: DataFrame, col: str = "table_name") -> DataFrame:
    """M2 then M3, as the reference applies them."""
    return dedupe_table_names(drop_versioned_tables(tables, col), col)


def declared_keys(pk_constraints: DataFrame, fk_constraints: DataFrame):
    """M4: PK rows and FK rows with composite keys paired by position.

    ``pk_constraints``: (table_name, constraint_name, column_name, position)
    ``fk_constraints``: (table_name, constraint_name, column_name, position,
                         referenced_table, referenced_column, referenced_position)
    """
    pk = pk_constraints.select("table_name", "column_name").distinct()
    fk = (fk_constraints.where(F.col("position") == F.col("referenced_position"))
          .select("table_name", "column_name", "referenced_table", "referenced_column").distinct())
    return pk, fk


def build_erd(columns: DataFrame, pk: DataFrame, fk: DataFrame, tables: DataFrame | None = None) -> DataFrame:
    """M5: columns with PK flag and FK target; relationships per table; every table kept.

    Output: one row per table with ``columns`` and ``relationships`` arrays.
    """
    cols = (columns.join(pk.select("table_name", "column_name", F.lit(True).alias("primary_key")),
                         ["table_name", "column_name"], "left")
            .join(fk.select("table_name", "column_name",
                            F.concat_ws(".", "referenced_table", "referenced_column").alias("foreign_key")),
                  ["table_name", "column_name"], "left"))
    col_struct = F.struct(
        F.col("ordinal_position"), F.col("column_name").alias("name"), F.col("data_type").alias("type"),
        (F.col("is_nullable") == "YES").alias("nullable"), F.col("character_maximum_length").alias("max_length"),
        F.col("numeric_precision").alias("precision"), F.col("numeric_scale").alias("scale"),
        F.coalesce(F.col("primary_key"), F.lit(False)).alias("primary_key"), F.col("foreign_key"))
    per_table = (cols.groupBy("table_name")
                 .agg(F.array_sort(F.collect_list(col_struct)).alias("_cols"))
                 .select("table_name", F.transform("_cols", lambda s: s.dropFields("ordinal_position"))
                         .alias("columns")))
    rels = (fk.select("table_name", F.lit("many-to-one").alias("type"),
                      F.col("referenced_table").alias("to_table"), F.col("column_name").alias("on_column"),
                      F.col("referenced_column").alias("references")).distinct()
            .groupBy("table_name")
            .agg(F.array_sort(F.collect_list(F.struct("type", "to_table", "on_column", "references")))
                 .alias("relationships")))
    all_tables = tables if tables is not None else table_list(columns)
    return (all_tables.join(per_table, "table_name", "left").join(rels, "table_name", "left")
            .select("table_name",
                    F.coalesce("columns", F.array().cast(per_table.schema["columns"].dataType)).alias("columns"),
                    F.coalesce("relationships", F.array().cast(rels.schema["relationships"].dataType))
                    .alias("relationships")))


def name_stem(table_col, column_col) -> F.Column:
    """Column name without a short table alias prefix (``o_custkey`` -> ``custkey``)."""
    return F.regexp_replace(F.lower(column_col), r"^[a-z]{1,2}_", "")


def singular(name_col) -> F.Column:
    return F.regexp_replace(F.lower(name_col), r"s$", "")


def pk_fk_candidates(columns: DataFrame) -> DataFrame:
    """M6: isPkCandidate / isFkCandidate from names.

    PK: ``id``, ``<table>_id``, ``<table>_key`` (table also in singular form).
    FK: ``<other>_id`` / ``<other>_key`` for another table of the catalog; the
    other-table test is an equi-join on the name with its suffix cut off.
    """
    c = columns.withColumn("_low", F.lower("column_name"))
    t = F.lower("table_name")
    own = (c["_low"] == "id") | F.col("_low").isin(
        F.concat(t, F.lit("_id")), F.concat(t, F.lit("_key")),
        F.concat(singular(F.col("table_name")), F.lit("_id")),
        F.concat(singular(F.col("table_name")), F.lit("_key")))
    c = c.withColumn("is_pk_candidate", own)
    c = c.withColumn("_base", F.regexp_extract("_low", r"^(.*)_(id|key)$", 1))
    tables = table_list(columns)
    names = (tables.select(F.lower("table_name").alias("_base"), F.col("table_name").alias("_other"))
             .unionByName(tables.select(singular(F.col("table_name")).alias("_base"),
                                        F.col("table_name").alias("_other")))
             .distinct())
    hits = (c.where(F.col("_base") != "").select("table_name", "column_name", "_base")
            .join(names, "_base")
            .where(F.col("_other") != F.col("table_name"))
            .groupBy("table_name", "column_name")
            .agg(F.array_sort(F.collect_set("_other")).alias("fk_targets")))
    return (c.join(hits, ["table_name", "column_name"], "left")
            .select(*columns.columns, "is_pk_candidate",
                    F.coalesce(F.size("fk_targets") > 0, F.lit(False)).alias("is_fk_candidate"),
                    F.coalesce("fk_targets", F.array().cast("array<string>")).alias("fk_targets")))


def name_prefix_groups(tables: DataFrame, col: str = "table_name") -> DataFrame:
    """M7: longest common '_'-segment prefix of all names; group by the next segment.

    Output: (table_name, prefix, domain, suffix). ``suffix`` is the lower-cased
    name after the common prefix, used by suffix joins (K6).
    """
    seg = tables.select(F.col(col).alias("table_name"), F.split(F.col(col), "_").alias("parts"))
    # Per segment position: how many different segments. The prefix ends at the first
    # position that differs, capped by the shortest name. One scalar comes back.
    per_pos = (seg.select(F.posexplode("parts").alias("pos", "part"))
               .groupBy("pos").agg(F.count_distinct("part").alias("nd")))
    min_len = seg.agg(F.min(F.size("parts"))).first()[0] or 0
    first_diff = per_pos.where(F.col("nd") > 1).agg(F.min("pos")).first()[0]
    prefix_len = min(min_len, first_diff) if first_diff is not None else min_len
    plen = F.lit(prefix_len)
    return seg.select("table_name",
                      F.array_join(F.slice("parts", 1, plen), "_").alias("prefix"),
                      F.lower(F.get("parts", plen)).alias("domain"),
                      F.lower(F.array_join(F.slice("parts", plen + 1, F.size("parts")), "_")).alias("suffix"))
