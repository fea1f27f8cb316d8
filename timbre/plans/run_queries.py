"""Driver queries on how work is run: batches across rows, tasks done once, tables replaced from themselves."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from timbre.operators import batching
from timbre.plans.catalog import query
from timbre.plans.standins import table
from timbre.sources import attempts, versions
from timbre.store import fresh_path

WIDTH, HOP = 16, 8


@query("window_quality", f"""WITH w AS (SELECT vec_id, unnest(range(0, len(embedding), {HOP})) AS s, embedding AS e FROM embeddings), k AS (SELECT vec_id, e[s + 1:s + {WIDTH}] AS x FROM w WHERE s = 0 OR len(e) - s >= {WIDTH} / 2),
    q AS (SELECT vec_id, 1 + 10 * sqrt(list_sum(list_transform(x, lambda v: cast(v AS double) * cast(v AS double))) / len(x)) AS score FROM k)
    SELECT vec_id, count(*) AS n_windows, round(greatest(1, least(5, avg(score))), 6) AS quality FROM q GROUP BY vec_id""")
def window_quality(spark, sf_dir):
    """Sliding windows of each vector, scored in batches of 512 across vectors."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return batching.window_quality(rows, "embedding", "loudness", WIDTH, HOP).select("vec_id", "n_windows", F.round("quality", 6).alias("quality"))


RESULT = T.StructType([T.StructField("tokens", T.LongType())])


def counted(first: bool):
    """Work that fails for good on some tasks, and on others only at first."""

    def make():
        def work(row: dict) -> dict:
            if row["doc_id"] % 29 == 0 or first and row["doc_id"] % 7 == 0:
                raise ValueError(f"no text for {row['doc_id']}")
            return {"tokens": len((row["text"] or "").split(" "))}

        return work

    return make


@query("tasks_done_once", """SELECT concat('d', doc_id) AS task_id, CASE WHEN doc_id % 29 = 0 THEN 'failed' ELSE 'done' END AS outcome, CASE WHEN doc_id % 29 <> 0 THEN len(string_split(coalesce(text, ''), ' ')) END AS tokens,
    cast(CASE WHEN doc_id % 29 = 0 THEN 2 WHEN doc_id % 7 = 0 THEN 1 ELSE 0 END AS bigint) AS n_failed, CASE WHEN doc_id % 29 = 0 THEN concat('ValueError: no text for ', doc_id) END AS error FROM documents""")
def tasks_done_once(spark, sf_dir):
    """Documents as tasks in two runs: what the first one has done isn't done again, what it failed is tried again."""
    root = fresh_path(spark, "runs")
    tasks = table(spark, sf_dir, "documents").select(F.concat(F.lit("d"), "doc_id").alias("task_id"), "doc_id", "text")
    for first in (True, False):
        attempts.run_once(tasks, root, "count", RESULT, counted(first))
    rows = attempts.outcomes(spark, root, RESULT)
    last = F.max_by(F.struct("outcome", "tokens", "error"), "attempt").alias("last")
    out = rows.groupBy("task_id").agg(last, F.count_if(F.col("outcome") == "failed").alias("n_failed"))
    return out.select("task_id", "last.outcome", "last.tokens", "n_failed", "last.error")


@query("merged_labels", "SELECT doc_id, quality, toxic, 'v2' AS schema_version, doc_id % 2 = 0 AS early FROM labels")
def merged_labels(spark, sf_dir):
    """Labels that arrive in two parts; the merged table is replaced by a version made from itself."""
    rows, target = table(spark, sf_dir, "labels").withColumn("early", F.col("doc_id") % 2 == 0), fresh_path(spark, "labels")
    versions.replace(rows.where("early"), target)
    versions.replace(versions.read_current(spark, target).unionByName(rows.where("NOT early")), target)
    versions.merge_labels(spark, target, target, "v2")
    return versions.read_current(spark, target)
