"""The task log: pending tasks, progress, failures, and the plain joins and sets of the reports."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def pending(tasks: DataFrame, done: DataFrame, key: str = "task_id", limit: int | None = None) -> DataFrame:
    """Tasks that aren't done, in order; the first ``limit`` of them."""
    out = tasks.select(key).distinct().join(done.select(key).distinct(), key, "left_anti").orderBy(key)
    return out if limit is None else out.limit(limit)


def stage_progress(tasks: DataFrame, log: DataFrame) -> DataFrame:
    """(stage, total, done, failed, pending); a stage without a task list has as many as are done."""
    totals = tasks.groupBy("stage").agg(F.count_distinct("task_id").alias("listed"))
    states = log.groupBy("stage").agg(F.count_distinct(F.when(F.col("status") == "done", F.col("task_id"))).alias("done"), F.count_distinct(F.when(F.col("status") == "failed", F.col("task_id"))).alias("failed"))
    both = totals.join(states, "stage", "full")
    out = both.select("stage", F.coalesce("listed", "done").alias("total"), F.coalesce("done", F.lit(0)).alias("done"), F.coalesce("failed", F.lit(0)).alias("failed"))
    return out.withColumn("pending", F.greatest(F.col("total") - F.col("done"), F.lit(0)))


def quarantined(failures: DataFrame, attempts: int) -> DataFrame:
    """(task_id, n) of the tasks that failed ``attempts`` times or more."""
    return failures.groupBy("task_id").agg(F.count("*").alias("n")).where(F.col("n") >= attempts)


def throughput(log: DataFrame, ts: str, now: Column, total: int) -> DataFrame:
    """(done, last_hour, remaining, eta_hours); no estimate without progress in the last hour."""
    recent = (F.col(ts) > now - F.expr("interval 1 hour")) & (F.col(ts) <= now)
    out = log.agg(F.count("*").alias("done"), F.count_if(recent).alias("last_hour"))
    out = out.withColumn("remaining", F.greatest(F.lit(total) - F.col("done"), F.lit(0)))
    return out.withColumn("eta_hours", F.when(F.col("last_hour") > 0, F.col("remaining") / F.col("last_hour")))


def expanded_shards(spark: SparkSession, spec: str) -> DataFrame:
    """(shard): the names of ``A000..A019,B7``; both ends share prefix and width."""
    parts = []
    for item in (x.strip() for x in spec.split(",") if x.strip()):
        low, dots, high = item.partition("..")
        if not dots:
            parts.append(spark.range(1).select(F.lit(item).alias("shard")))
            continue
        a, b = (re.fullmatch(r"(.*?)(\d+)", x.strip()) for x in (low, high))
        if not a or not b or a[1] != b[1] or int(a[2]) > int(b[2]):
            raise ValueError(f"this isn't a range of shards: {item!r}")
        number = F.col("id").cast("string")
        width = len(a[2])
        parts.append(spark.range(int(a[2]), int(b[2]) + 1).select(F.concat(F.lit(a[1]), F.when(F.length(number) >= width, number).otherwise(F.lpad(number, width, "0"))).alias("shard")))
    out = parts[0] if parts else spark.createDataFrame([], "shard string")
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def stale(remote: DataFrame, local: DataFrame, prefixes: tuple[str, ...], key: str = "path") -> DataFrame:
    """Remote files under the managed prefixes that aren't there locally."""
    managed = F.lit(False)
    for p in prefixes:
        managed = managed | F.col(key).startswith(p)
    return remote.where(managed).join(local, key, "left_anti")


def union_parts(*parts: DataFrame) -> DataFrame:
    """Rows of all parts, columns merged by name."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out
