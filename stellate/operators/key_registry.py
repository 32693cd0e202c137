"""Append-only registry of surrogate keys (D3): each load commits the keys it adds as one block with its range.

A registry is a folder of blocks (``keys-<id>``: parquet of natural key and surrogate key) and of numbered manifests, made
by exclusive create as in ``sources.versions``. Manifest n names block n, the load that made it and the last key given out,
so the next load starts there: no scan for ``max(key)``. Only blocks with a whole manifest are read.

* A repeated load (its name is committed) changes nothing.
* A load that failed before its manifest left nothing that readers see; run again on the same rows it gives the same keys,
  because keys follow the order of the natural key from the same start.
* Of two loads that start from the same block, one fails with ``ConcurrentLoad`` and has to be run again.
* A manifest that its writer did not finish blocks its number until ``TORN_AFTER`` seconds have passed, then the next load
  removes it.

Natural keys are compared whole; rows where any of their columns is null get no key, repeated ones get one.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stellate.functions.clean import require_key
from stellate.operators.dims import surrogate_key
from stellate.sources import versions

TORN_AFTER = 60


class ConcurrentLoad(RuntimeError):
    """Another load committed the same block number first."""


@dataclass(frozen=True)
class Block:
    number: int
    folder: str
    load: str
    last: int  # the highest key given out up to this block
    rows: int


def blocks(spark: SparkSession, root: str) -> list[Block]:
    """The committed blocks in order, one a load that brought new keys or none."""
    return [Block(number, **json.loads(line)) for number, line in versions.manifests(spark, root)]


def committed_keys(spark: SparkSession, root: str) -> DataFrame | None:
    """(natural key columns, key, load) of all committed blocks; None before the first load."""
    found = blocks(spark, root)
    filled = [b for b in found if b.rows] or found[:1]
    if not filled:
        return None
    # one scan of all blocks: the load is a column of the block's rows
    return spark.read.parquet(*[f"{root}/{b.folder}" for b in filled])


def register_load(root: str, load: str, incoming: DataFrame, natural_key, key_name: str) -> DataFrame:
    """Give keys to the natural keys of ``incoming`` that the registry does not know, commit them as ``load`` and return
    all committed keys: (natural key columns, ``key_name``, ``load``)."""
    spark = incoming.sparkSession
    keys = [natural_key] if isinstance(natural_key, str) else list(natural_key)
    _drop_torn(spark, root)
    found = blocks(spark, root)
    if load in (b.load for b in found):
        return committed_keys(spark, root)
    known = committed_keys(spark, root)
    new = require_key(incoming, keys).select(*keys).dropDuplicates()
    if known is not None:
        new = new.join(known.select(*keys), keys, "left_anti")
    last = found[-1].last if found else 0
    folder = f"keys-{uuid.uuid4().hex}"
    numbered = surrogate_key(new, keys, key_name, offset=last)
    numbered.select(*keys, key_name, F.lit(load).alias("load")).write.parquet(f"{root}/{folder}")
    rows = spark.read.parquet(f"{root}/{folder}").count()  # from the files' footers
    entry = {"folder": folder, "load": load, "last": last + rows, "rows": rows}
    try:
        versions.publish(spark, root, (found[-1].number if found else 0) + 1, json.dumps(entry))
    except Py4JJavaError as e:
        if "FileAlreadyExists" in str(e.java_exception.getClass().getName()):
            raise ConcurrentLoad(f"{load}: another load came first; run it again") from e
        raise
    return committed_keys(spark, root)


def _drop_torn(spark: SparkSession, root: str) -> None:
    whole = {number for number, _ in versions.manifests(spark, root)}
    for number in set(versions.numbers(spark, root)) - whole:
        fs, path = versions.file_system(spark, versions.manifest_name(root, number))
        if time.time() - fs.getFileStatus(path).getModificationTime() / 1000 >= TORN_AFTER:
            fs.delete(path, False)


def verify_registry(spark: SparkSession, root: str, natural_key, key_name: str) -> DataFrame:
    """(check, found): keys, blocks (committed loads with keys), repeated_naturals, repeated_keys, outside (keys that lie
    outside the range of their load); the last three are 0 in a sound registry."""
    keys = [natural_key] if isinstance(natural_key, str) else list(natural_key)
    all_keys = committed_keys(spark, root)
    if all_keys is None:
        raise FileNotFoundError(f"no registry in {root}")
    ranges = [(b.load, b.last - b.rows + 1, b.last) for b in blocks(spark, root) if b.rows]
    bounds = spark.createDataFrame(ranges, "load string, lo long, hi long")

    def row(name, df, value):
        return df.agg(value.cast("long").alias("found")).select(F.lit(name).alias("check"), "found")
    again = F.count_if(F.col("n") > 1)
    inside = F.coalesce(F.col(key_name).between(F.col("lo"), F.col("hi")), F.lit(False))
    return (row("keys", all_keys, F.count(F.lit(1)))
            .unionByName(row("blocks", bounds, F.count(F.lit(1))))
            .unionByName(row("repeated_naturals", all_keys.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), again))
            .unionByName(row("repeated_keys", all_keys.groupBy(key_name).agg(F.count(F.lit(1)).alias("n")), again))
            .unionByName(row("outside", all_keys.join(F.broadcast(bounds), "load", "left"), F.count_if(~inside))))
