"""The corpus pipeline: five training-data operators over the documents.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's ``docs``. All stages but the last
return the columns of ``docs``.

Edge cases are those of the operators: null or empty texts fail the quality
rules and go; rows without an id lose no lines, aren't near copies of anything
and go on; rows that repeat an id are one document to line dedup and one row
after near-dedup; an empty table stays empty through all stages.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from timbre.llm.common import fresh_path, read_table
from timbre.llm.line_dedup import drop_repeated_lines
from timbre.llm.order_minhash import keep_one
from timbre.llm.quality_rules import keep_good
from timbre.llm.retrieval_pack import packed_pieces
from timbre.llm.source_mix import mix_sources


#: Files whose places in the order (a row of some 100 bytes each) are broadcast.
MOST_FILES = 100_000


def in_written_order(docs: DataFrame, name: str) -> DataFrame:
    """Adds the number of each row in the order of the table's files and of the rows in them.

    The mixing stage writes its order as ranges, one file after the other. Rows
    that don't come from files keep the order of their partitions.
    """
    try:
        placed = docs.select("*", F.col("_metadata.file_name").alias("__file"), F.col("_metadata.row_index").alias("__row"))
    except AnalysisException:
        return docs.withColumn(name, F.monotonically_increasing_id())
    files = placed.groupBy("__file").agg(F.count("*").alias("n"))  # a row for each file
    before = F.sum("n").over(Window.orderBy("__file").rowsBetween(Window.unboundedPreceding, -1))
    files = files.select(F.col("__file").alias("__f"), F.coalesce(before, F.lit(0)).alias("__before"))
    if len(docs.inputFiles()) <= MOST_FILES:
        files = F.broadcast(files)  # else the join exchanges the texts by file
    return placed.join(files, F.col("__file") == F.col("__f")).withColumn(name, F.col("__before") + F.col("__row")).drop("__file", "__row", "__f", "__before")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return keep_good(docs, read_table(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that another document of a smaller id has."""
    return drop_repeated_lines(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return keep_one(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mix."""
    return mix_sources(docs)


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences, which follow the mix's order."""
    return packed_pieces(in_written_order(docs, "__place"), place="__place")


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("near_dedup", near_stage),
    ("source_mix", mix_stage),
    ("retrieval_pack", pack_stage),
]

#: SQL can't express the hashed ratio, the alignment or the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what lies between two of them is a table in the shared folder."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = fresh_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
