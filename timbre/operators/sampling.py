"""Worklists, capped sampling, deterministic shuffles and reading orders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from timbre.operators.scoring import minmax, ranked, top_fraction, zscore_sum


def slice_width(rows: int, size: int) -> int:
    """Digits of a slice number: five, or as many as the last one needs."""
    return max(5, len(str(max(0, (rows - 1) // size))))


def slices(df: DataFrame, size: int, rank: str = "priority_rank") -> DataFrame:
    """Adds slice_id, the zero-padded number of the rank's slice; its width comes from a one-row aggregate."""
    last = F.broadcast(df.agg(F.coalesce(F.max(rank), F.lit(0)).alias("__last")))
    number = F.floor(F.col(rank) / size).cast("string")
    width = F.greatest(F.lit(5), F.length(F.floor(F.col("__last") / size).cast("string")))
    out = df.crossJoin(last)
    return out.withColumn("slice_id", F.concat(F.repeat(F.lit("0"), width - F.length(number)), number)).drop("__last")


def checked_priority(joined: DataFrame, priority: str) -> None:
    """Raises ``ValueError`` if the expression names other columns than a worklist has, or isn't a number."""
    columns = [*joined.schema.fields, *(T.StructField(c, T.DoubleType()) for c in ("prosody_dsp_score", "norm_aesthetics_pq") if c not in joined.columns)]
    try:
        kind = joined.sparkSession.createDataFrame([], T.StructType(columns)).select(F.expr(priority).alias("p")).schema["p"].dataType
    except AnalysisException as e:
        raise ValueError(f"priority {priority!r}: {e.getCondition()}") from e
    if not isinstance(kind, T.NumericType):
        raise ValueError(f"priority {priority!r} isn't a number")


def worklist(joined: DataFrame, weights: Sequence[tuple[str, float]], keep: float | None, priority: str, size: int) -> DataFrame:
    """Survivors in priority order with rank and slice.

    Score over all given rows, the top fraction by quantile, quality scaled over
    the kept ones, priority by an expression over their columns, which is checked
    before any job starts.
    """
    checked_priority(joined, priority)
    out = zscore_sum(joined, weights)
    if keep is not None:
        out = top_fraction(out, "prosody_dsp_score", keep)
    out = minmax(out, {"norm_aesthetics_pq": "aes_pq"}, constant=1.0)
    out = out.withColumn("priority", F.expr(priority))
    return slices(ranked(out, [F.desc("priority"), F.asc("clip_id")]), size)


def capped_round_robin(df: DataFrame, cap: int | None, speaker: str, bucket: str, score: str, key: str) -> DataFrame:
    """Adds kept: at most ``cap`` rows of a speaker, dealt in turn over its buckets.

    The n-th best rows of all buckets come before the (n+1)-th best; among them
    the bucket of the better best row, then of the greater name. ``key`` is unique.

    Only narrow rows are ranked. Each task first keeps its own best ``cap`` rows of
    a (speaker, bucket), then of a speaker (Spark does so before the exchange of a
    rank that is cut), so a speaker who has most of the rows, or rows without one,
    are spread over all tasks.
    """
    if cap is None:
        return df.withColumn("kept", F.lit(True))
    rows = df.select(F.col(key).alias("__key"), F.col(score).alias("__score"), F.coalesce(speaker, F.lit("")).alias("__who"), F.coalesce(bucket, F.lit("")).alias("__what"))
    inner = Window.partitionBy("__who", "__what").orderBy(F.desc("__score"), F.asc("__key"))
    near = rows.withColumn("__rk", F.row_number().over(inner)).where(F.col("__rk") <= cap)
    near = near.withColumn("__best", F.max("__score").over(Window.partitionBy("__who", "__what")))
    turn = Window.partitionBy("__who").orderBy("__rk", F.desc("__best"), F.desc("__what"))
    picked = near.withColumn("__turn", F.row_number().over(turn)).where(F.col("__turn") <= cap).select("__key", F.lit(True).alias("__kept"))
    return df.join(picked, F.col(key) == F.col("__key"), "left").withColumn("kept", F.coalesce("__kept", F.lit(False))).drop("__key", "__kept")


def shuffle_order(key: str, seed: int = 1234) -> list[Column]:
    """An order that depends on the key and the seed alone."""
    return [F.asc(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))), F.asc(key)]


def shuffled(df: DataFrame, key: str, seed: int = 1234) -> DataFrame:
    """Rows in an order that depends on their key and the seed alone."""
    return df.orderBy(*shuffle_order(key, seed))


def first_seen_order(df: DataFrame, group: str, position: str) -> DataFrame:
    """Adds regroup_rank: groups by their first position, rows by position inside."""
    first = F.min(position).over(Window.partitionBy(group))
    return ranked(df.withColumn("__first", first), [F.asc("__first"), F.asc(position)], "regroup_rank").drop("__first")


def repack_offsets(df: DataFrame, missing: Column) -> DataFrame:
    """Rows whose audio exists, with their offset in their slice in priority order."""
    w = Window.partitionBy("slice_id").orderBy("priority_rank")
    return df.where(~missing).withColumn("offset", (F.row_number().over(w) - 1).cast("long"))


def slice_rows(df: DataFrame, slice_id: str) -> DataFrame:
    """A slice in reading order: shard, then offset, where a missing one counts as 0."""
    return df.where(F.col("slice_id") == slice_id).orderBy("shard", F.greatest(F.coalesce("offset", F.lit(0)), F.lit(0)), "clip_id")
