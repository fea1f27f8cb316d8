"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from timbre.store import checkpointed, delete_path, fresh_path, shared_dir

__all__ = ["checkpointed", "delete_path", "fresh_path", "free_shuffles", "narrow", "read_table", "shared_dir", "spread_join", "SPACE_CHARS", "SPACE_CLASS"]

#: ASCII white space of the contracts: space and 0x09 to 0x0D.
SPACE_CLASS = "[ \\x09-\\x0D]"
SPACE_CHARS = " \t\n\x0b\x0c\r"
#: Rows of a key that always go to one task, and a bound on the keys that are dealt to several.
LEAST_HOT, MOST_HOT = 256, 4096


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder; the path may be in any store that Spark reads."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_shuffles(spark: SparkSession) -> None:
    """Frees shuffle files of plans that a checkpoint has cut off; the driver's collector alone does that."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def narrow(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns under internal names, so that others can't clash."""
    return df.select(*(F.col(f"`{source}`").alias(name) for name, source in columns.items()))


def spread_join(rows: DataFrame, table: DataFrame, left: str, right: str, count: str, total: int, salt: Column, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``table`` (a row for each key, with the ``count`` of rows that have it), hot keys dealt to several tasks.

    Keys of more than ``total / MOST_HOT`` of the ``total`` rows are hot; there are
    ``MOST_HOT`` of them at most, so their list is broadcast. Their rows are dealt
    by ``salt``, and the table's row goes to each of their tasks.
    """
    limit = max(LEAST_HOT, total // MOST_HOT)
    lots = F.ceil(F.col(count) / limit).cast("int")
    hot = F.broadcast(table.where(F.col(count) > limit).select(F.col(right).alias("__hot"), lots.alias("__lots")))
    dealt = rows.join(hot, F.col(left) == F.col("__hot"), "left").withColumn("__lot", F.coalesce(F.pmod(salt, F.col("__lots")), F.lit(0)).cast("int")).drop("__hot", "__lots")
    copies = F.explode(F.when(F.col(count) > limit, F.sequence(F.lit(0), lots - 1)).otherwise(F.array(F.lit(0))))
    table = table.withColumn("__copy", copies)
    return dealt.join(table, (F.col(left) == F.col(right)) & (F.col("__lot") == F.col("__copy")), how).drop("__lot", "__copy")
