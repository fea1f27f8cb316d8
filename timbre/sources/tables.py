"""Stage tables: directories of ``part-*.parquet`` with a fixed schema, and the log of finished tasks."""

from __future__ import annotations

import json
import os
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from timbre.functions.text import utc_now
from timbre.schemas import TASK_LOG


def read_stage(spark: SparkSession, path: str, schema: T.StructType | None = None, view: str | None = None) -> DataFrame:
    """The part files under ``path``, columns merged by name; files of unfinished writes aren't read."""
    reader = spark.read.option("pathGlobFilter", "part-*.parquet").option("recursiveFileLookup", "false")
    reader = reader.schema(schema) if schema is not None else reader.option("mergeSchema", "true")
    df = reader.parquet(path)
    if view:
        df.createOrReplaceTempView(view)
    return df


def conformed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of ``schema``, cast; missing ones are null, others raise ``ValueError``."""
    if unknown := sorted(set(df.columns) - set(schema.names)):
        raise ValueError(f"columns that the table doesn't have: {', '.join(unknown)}")
    return df.select(*((F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields))


def write_stage(df: DataFrame, path: str, schema: T.StructType, partition_by: str | None = None) -> None:
    """Writes typed parts with zstd; an empty frame still leaves a typed file.

    With ``partition_by`` only the partitions in ``df`` are replaced, so running a
    task again has the same result as running it once.
    """
    writer = conformed(df, schema).write.mode("overwrite").option("compression", "zstd")
    if partition_by:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(partition_by)
    writer.parquet(path)


def log_tasks(tasks: DataFrame, path: str, stage: str, status: str = "done") -> None:
    """Appends a row for each ``task_id`` of ``tasks``; written after a stage's tables."""
    error = F.col("error") if "error" in tasks.columns else F.lit(None).cast("string")
    rows = tasks.select(F.lit(stage).alias("stage"), "task_id", F.lit(status).alias("status"), F.left(error, F.lit(500)).alias("error"), utc_now().alias("ts_iso"))
    conformed(rows, TASK_LOG).write.mode("append").parquet(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The task log; empty where nothing has been logged yet."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], TASK_LOG)
    return spark.read.schema(TASK_LOG).parquet(path)


def write_stages(tables: dict[str, tuple[DataFrame, T.StructType]], root: str, tasks: DataFrame, stage: str, partition_by: str = "shard") -> None:
    """All tables of a fused stage, then its log."""
    for name, (df, schema) in tables.items():
        write_stage(df, f"{root}/{name}", schema, partition_by)
    log_tasks(tasks, f"{root}/task_log", stage)


def atomic_bytes(path: str, data: bytes) -> None:
    """A driver-side file that is whole or absent: written beside, flushed, renamed."""
    folder = os.path.dirname(os.path.abspath(path))
    os.makedirs(folder, exist_ok=True)
    fd, temporary = tempfile.mkstemp(dir=folder, suffix=".tmp")
    try:
        with os.fdopen(fd, "wb") as f:
            f.write(data)
            f.flush()
            os.fsync(f.fileno())
        os.replace(temporary, path)
    except BaseException:
        os.unlink(temporary)
        raise


def atomic_json(path: str, value: object) -> None:
    atomic_bytes(path, json.dumps(value, ensure_ascii=False, indent=2).encode())


def snapshot(path: str, value: dict, stamp: str) -> None:
    """A monitor snapshot under its stamp, and as ``latest.json``."""
    atomic_json(f"{path}/snapshot-{stamp.translate({ord(c): None for c in ':-'})}.json", value)
    atomic_json(f"{path}/latest.json", value)


def write_tiers(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").partitionBy("tier").parquet(path)


def write_documents(df: DataFrame, path: str, tiered_only: bool = True) -> None:
    """One JSON document per clip and line; only clips with a tier unless asked otherwise."""
    rows = df.where("selection.tier IS NOT NULL") if tiered_only else df
    rows.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
