"""Incremental arrival: parts of a stage table as a file stream; the checkpoint is the marker."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def arriving(spark: SparkSession, path: str, schema: T.StructType, files: int = 100) -> DataFrame:
    """New part files of a stage table, ``files`` of them in a batch."""
    return spark.readStream.schema(schema).option("pathGlobFilter", "part-*.parquet").option("maxFilesPerTrigger", files).parquet(path)


def run_incrementally(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], target: str, checkpoint: str) -> StreamingQuery:
    """Applies a batch operator to what has arrived and appends, each batch once.

    A batch that is run again after a failure writes the same partition again.
    """

    def put(batch: DataFrame, number: int) -> None:
        transform(batch).withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(target)

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def reject_rates(stream: DataFrame, ts: str, window: str = "10 minutes", late: str = "30 minutes") -> DataFrame:
    """(window, reject_reason, n) over event time; rows later than ``late`` don't count."""
    return stream.withWatermark(ts, late).groupBy(F.window(ts, window), "reject_reason").agg(F.count("*").alias("n"))
