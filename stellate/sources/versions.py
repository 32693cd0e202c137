"""Tables that are replaced safely (S9, C10): a new version is written beside the current one, then switched to.

A table is a folder of versions (``v-<id>``, plain parquet) and of numbered manifests (``_manifest/<number>``), each
naming one version. A manifest is made under a name of its own with an exclusive create, so of two writers that
start from the same version one fails, and no rename or overwrite has to be atomic. Readers take the highest manifest
that is whole. A run that dies at any step leaves the version before it, or the new one, whole and current.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_END = "end"


def file_system(spark: SparkSession, name: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def manifests(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    """(number, version) of the whole manifests, lowest first."""
    fs, folder = file_system(spark, f"{root}/_manifest")
    if not fs.exists(folder):
        return []
    found = []
    for status in fs.listStatus(folder):
        number = status.getPath().getName()
        if number.isdigit():
            lines = _read(spark, f"{root}/_manifest/{number}").split("\n")
            if len(lines) >= 2 and lines[1] == _END:  # else its writer died
                found.append((int(number), lines[0]))
    return sorted(found)


def _read(spark: SparkSession, name: str) -> str:
    fs, path = file_system(spark, name)
    stream = fs.open(path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def manifest_name(root: str, number: int) -> str:
    return f"{root}/_manifest/{number:010d}"


def publish(spark: SparkSession, root: str, number: int, version: str) -> None:
    """Make the manifest; fails if another writer made this number first."""
    fs, path = file_system(spark, manifest_name(root, number))
    stream = fs.create(path, False)
    try:
        stream.write(bytearray(f"{version}\n{_END}\n".encode()))
    finally:
        stream.close()


def current_version(spark: SparkSession, root: str) -> tuple[int, str] | None:
    """(number, folder) of the version that readers see; None if there is none."""
    found = manifests(spark, root)
    return (found[-1][0], f"{root}/{found[-1][1]}") if found else None


def read_current(spark: SparkSession, root: str) -> DataFrame:
    found = current_version(spark, root)
    if found is None:
        raise FileNotFoundError(f"no version of {root}")
    return spark.read.parquet(found[1])


def replace_table(df: DataFrame, root: str) -> None:
    """Write ``df``, which may read the current version, as the new version and switch to it."""
    spark = df.sparkSession
    found = current_version(spark, root)
    taken = numbers(spark, root)
    number = max([found[0] if found else 0, *taken]) + 1
    version = f"v-{uuid.uuid4().hex}"
    df.write.parquet(f"{root}/{version}")
    publish(spark, root, number, version)


def numbers(spark: SparkSession, root: str) -> list[int]:
    fs, folder = file_system(spark, f"{root}/_manifest")
    if not fs.exists(folder):
        return []
    return [int(n) for s in fs.listStatus(folder) if (n := s.getPath().getName()).isdigit()]


def drop_old_versions(spark: SparkSession, root: str, keep: int = 1) -> None:
    """Delete every version but the last ``keep`` ones, with what failed writers left. Not while readers of older versions or
    writers are at work."""
    kept = {v for _, v in manifests(spark, root)[-keep:]}
    fs, folder = file_system(spark, root)
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        if name.startswith("v-") and name not in kept:
            fs.delete(status.getPath(), True)
