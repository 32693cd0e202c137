"""Intermediate tables in the folder that all executors share.

``stage`` writes a DataFrame as Parquet under ``spark.checkpoint.dir`` and reads it back, which
cuts the lineage: a lost executor costs a re-read, not a re-run. The folder is read from the
session; a scratch folder is made only where the setting is absent and the master is local.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_ROOT = "stellate-staged"


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables (no trailing slash)."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="stellate-staged-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new staged table and return the table."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{_ROOT}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    staged.__dict__["staged_path"] = path
    return staged


def drop_staged(*tables: DataFrame) -> None:
    """Delete staged tables whose readers have all been staged themselves."""
    for table in tables:
        _delete(table.sparkSession, table.__dict__["staged_path"])


def _delete(spark: SparkSession, name: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def clear_staged(spark: SparkSession) -> None:
    """Delete this application's staged tables (call once their results are written)."""
    _delete(spark, f"{shared_dir(spark)}/{_ROOT}/{spark.sparkContext.applicationId}")
