"""Tables of whole versions behind a pointer that is swapped in one step.

A version is a folder of its own; the file ``_current`` names the one that counts.
Readers that have opened a version keep it while others write, and a table may be
made from itself. The swap is a rename that replaces, which file systems do in one
step (object stores may not).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from timbre.sources.tables import read_stage

POINTER = "_current"


def _store(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def current_version(spark: SparkSession, path: str) -> str | None:
    """The name of the version that counts; None before the first one."""
    place, store = _store(spark, f"{path.rstrip('/')}/{POINTER}")
    if not store.exists(place):
        return None
    stream = store.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def read_current(spark: SparkSession, path: str) -> DataFrame | None:
    """The version that counts now, whatever is written later; None before the first one."""
    name = current_version(spark, path)
    return None if name is None else spark.read.parquet(f"{path.rstrip('/')}/{name}")


def replace(df: DataFrame, path: str) -> str:
    """Writes ``df`` as a new version (it may read the present one) and swaps the pointer; returns its name."""
    spark, root = df.sparkSession, path.rstrip("/")
    name = f"version-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(f"{root}/{name}")
    swap(spark, root, name)
    return name


def swap(spark: SparkSession, root: str, name: str) -> None:
    """Makes the pointer name a version that is written."""
    jvm, sc = spark._jvm, spark.sparkContext
    fresh, store = _store(spark, f"{root}/{POINTER}.{uuid.uuid4().hex}")
    out = store.create(fresh)
    out.write(bytearray(name.encode()))
    out.close()
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = sc._gateway.new_array(kind, 1)
    how[0] = kind.OVERWRITE
    final, _ = _store(spark, f"{root}/{POINTER}")
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fresh.toUri(), spark._jsc.hadoopConfiguration()).rename(fresh, final, how)


def drop_old_versions(spark: SparkSession, path: str) -> int:
    """Deletes all versions but the one that counts, once nobody reads them; returns how many."""
    name, count = current_version(spark, path), 0
    place, store = _store(spark, path)
    for status in store.listStatus(place):
        other = status.getPath().getName()
        if other.startswith("version-") and other != name:
            store.delete(status.getPath(), True)
            count += 1
    return count


def merge_labels(spark: SparkSession, source: str, target: str, version: str) -> str:
    """All label parts of ``source`` with the schema's version, as the new version of ``target``; returns its name.

    ``source`` may be a folder of parts or a table of versions, ``target`` itself included.
    """
    rows = read_current(spark, source)
    rows = read_stage(spark, source) if rows is None else rows
    return replace(rows.withColumn("schema_version", F.lit(version)), target)
