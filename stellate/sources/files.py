"""CSV / JSON / table sources and sinks of the modelling flow.

Catalog-sized outputs (column lists, relation matrices) are written as one CSV file
each (``coalesce(1)`` on a few hundred rows); data-sized outputs are written with
Spark's commit protocol, never through the driver.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stellate.functions.clean import fill_defaults
from stellate.session import checkpoint_dir
from stellate.sources.versions import read_current, replace_table


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory (never machine-local on a cluster)."""
    return os.path.join(checkpoint_dir(spark), "stellate-out", f"{name}-{uuid.uuid4().hex[:12]}")


def table_kind(name_col) -> F.Column:
    low = F.lower(name_col)
    return (F.when(low.startswith("fact"), F.lit("fact")).when(low.startswith("dim"), F.lit("dim"))
            .when(low.startswith("bridge"), F.lit("bridge")).otherwise(F.lit("other")))


def read_target_schema(spark: SparkSession, path: str) -> DataFrame:
    """``Table,Column`` CSV -> (table_name, column_name, column_position, kind).

    Extra (blank) CSV columns are ignored; positions follow the file order.
    """
    raw = spark.read.option("header", True).csv(path)
    cols = {c.lower(): c for c in raw.columns}
    t, c = cols["table"], cols["column"]
    x = (raw.select(F.trim(F.col(t)).alias("table_name"), F.trim(F.col(c)).alias("column_name"))
         .where(F.col("table_name").isNotNull() & (F.col("table_name") != ""))
         .withColumn("_pos", F.monotonically_increasing_id()))
    # position within the table in file order: small per-table window on a catalog-sized file
    from pyspark.sql import Window
    w = Window.partitionBy("table_name").orderBy("_pos")
    return x.select("table_name", "column_name", F.row_number().over(w).alias("column_position"),
                    table_kind(F.col("table_name")).alias("kind"))


def target_schema_lists(target: DataFrame) -> DataFrame:
    """S4 (grouped form): one row per target table with its kind and ordered column list."""
    return (target.groupBy("table_name", "kind")
            .agg(F.array_sort(F.collect_list(F.struct("column_position", "column_name"))).alias("_c"))
            .select("table_name", "kind", F.transform("_c", lambda c: c["column_name"]).alias("columns")))


def read_matrix(spark: SparkSession, path: str) -> DataFrame:
    """Wide relation matrix -> long (fact, dim); any non-blank cell other than '0' is a relation."""
    raw = spark.read.option("header", True).csv(path)
    key = [c for c in raw.columns if c.lower() == "table"][0]
    dims = [c for c in raw.columns if c != key and not c.startswith("_c")]
    long = raw.unpivot(key, dims, "dim", "cell")
    cell = F.trim(F.col("cell"))
    return (long.where(cell.isNotNull() & (cell != "") & (cell != "0"))
            .select(F.col(key).alias("fact"), "dim"))


def write_columns(columns: DataFrame, path: str) -> None:
    """``Table,Column`` CSV in table then ordinal order."""
    (columns.orderBy("table_name", "ordinal_position")
     .select(F.col("table_name").alias("Table"), F.col("column_name").alias("Column"))
     .coalesce(1).write.mode("overwrite").option("header", True).csv(path))


def write_matrix(long: DataFrame, rows: list, cols: list, path: str) -> None:
    """Wide CSV, ``1`` or empty, rows and columns in the given order."""
    spark = long.sparkSession
    r = spark.createDataFrame([(x, i) for i, x in enumerate(rows)], "Table string, _i int")
    wide = long.groupBy(F.col("row_table").alias("Table")).pivot("col_table", list(cols)).agg(F.max(F.lit("1")))
    out = r.join(wide, "Table", "left").orderBy("_i").select("Table", *[F.coalesce(F.col(c).cast("string"), F.lit(""))
                                                                      .alias(c) for c in cols])
    out.coalesce(1).write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)


def profile_document(profile: DataFrame, top: DataFrame, summary: DataFrame, schema_name: str) -> DataFrame:
    """S8 body: one nested record per table: metadata, quality, keys, grain, measures,
    dimensions, readiness and columns[] each with its top values."""
    tv = (top.groupBy("table_name", "column_name")
          .agg(F.array_sort(F.collect_list(F.struct("rank", "value", "frequency"))).alias("_tv"))
          .select("table_name", "column_name",
                  F.transform("_tv", lambda s: F.struct(s["value"].alias("value"), s["frequency"].alias("frequency")))
                  .alias("top_values")))
    cols = profile.join(tv, ["table_name", "column_name"], "left")
    col_struct = F.struct(*[F.col(c) for c in profile.columns if c != "table_name"],
                          F.coalesce("top_values", F.array().cast(tv.schema["top_values"].dataType))
                          .alias("top_values"))
    per = (cols.groupBy("table_name")
           .agg(F.array_sort(F.collect_list(F.struct(F.col("ordinal").alias("_o"), col_struct.alias("c"))))
                .alias("_cols"))
           .select("table_name", F.transform("_cols", lambda s: s["c"]).alias("columns")))
    return summary.join(per, "table_name", "left").select(
        F.col("table_name").alias("name"), F.lit(schema_name).alias("schema"), "row_count",
        F.struct(F.col("column_count")).alias("structure"),
        F.struct("avg_null_pct", "max_null_pct", "high_null_columns").alias("quality"),
        F.struct(F.col("primary_keys")).alias("keys"), "grain", "measures", "dimensions",
        F.lit(None).cast("string").alias("business_meaning"), "modeling_readiness", "columns")


def write_profile_json(doc: DataFrame, path: str) -> None:
    """JSON lines, one table per line (written by the executors)."""
    doc.write.mode("overwrite").json(path)


def backfill_table(spark: SparkSession, root: str, columns) -> DataFrame:
    """Replace NULLs in the given columns of an existing versioned table (``sources.versions``) by their type
    defaults. The filled rows become a new version, so a run that fails leaves the table as it was."""
    replace_table(fill_defaults(read_current(spark, root), columns), root)
    return read_current(spark, root)


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Typed target write. ``overwrite`` makes a re-run idempotent (an append
    re-run would duplicate facts)."""
    df.write.mode(mode).parquet(path)
