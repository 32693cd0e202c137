"""Session helpers.

Library code never creates its own session: every operator takes DataFrames and
uses ``df.sparkSession``. ``get_spark`` is for tests, the bench and scripts.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that the plans in this package are written for. AQE re-plans joins at
# runtime (broadcast conversion, skew-join splitting, partition coalescing).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files (surrogate keys, rank selection) are removed once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int = 8,
              app_name: str = "stellate", extra: dict | None = None) -> SparkSession:
    master = master or os.environ.get("STELLATE_MASTER", "local[8]")
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("STELLATE_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names a shared file system folder. Only where it is unset and
    the master is local (tests) a scratch folder is made, once per session; otherwise an
    error asks for the setting. The folder that Spark makes below it is set once.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return d or current
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="stellate-ckpt-")
    spark.sparkContext.setCheckpointDir(d)
    return d
