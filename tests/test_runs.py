"""Batches across rows, versions of tables, work that is done once."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from timbre.operators import batching
from timbre.sources import attempts, tables, versions


def noted():
    """A model that says how large its batches were."""
    sizes: list[int] = []

    def run(items):
        sizes.append(len(items))
        return [(float(sum(x)), len(items)) for x in items]

    return run


@pytest.mark.parametrize("size", (1, 2, 3, 7, 64, 10_000))
def test_batches_equal_runs_by_row(spark, size):
    rng = random.Random(size)
    rows = [(i, None if i % 23 == 0 else [[float(rng.randint(0, 9)) for _ in range(3)] for _ in range(rng.randint(0, 9))]) for i in range(200)]
    df = spark.createDataFrame(rows, "i long, items array<array<double>>").coalesce(2)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "17")
    try:
        kind = T.StructType([T.StructField("total", T.DoubleType()), T.StructField("batch", T.LongType())])
        made = lambda: (lambda items: [{"total": t, "batch": n} for t, n in noted()(items)])
        out = batching.batched(df, "items", "found", kind, made, size).withColumn("part", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [r.i for r in out] == [r.i for r in df.collect()]  # the order of the input
    want = dict(rows)
    for r in out:
        assert (None if want[r.i] is None else [sum(x) for x in want[r.i]]) == (None if r.found is None else [x.total for x in r.found])
    for part in {r.part for r in out}:
        used = [x.batch for r in out if r.part == part for x in r.found or ()]
        full = len(used) // size * size
        assert used == [size] * full + [len(used) - full] * (len(used) - full)


def test_a_model_must_answer_every_item(spark):
    with pytest.raises(Exception, match="returned 0 results"):
        batching.batched(spark.createDataFrame([([1.0],)], "x array<double>"), "x", "y", T.DoubleType(), lambda: lambda items: []).collect()


def test_window_quality(spark):
    rows = [(1, [0.1] * 10), (2, [0.9] * 3), (3, []), (4, None), (5, [0.0] * 8)]
    out = {r.i: (r.n_windows, r.quality) for r in batching.window_quality(spark.createDataFrame(rows, "i long, v array<float>"), "v", "loudness", 4, 2, size=3).collect()}
    assert out[1][0] == 5 and abs(out[1][1] - 2) < 1e-6 and out[2] == (1, 5.0) and out[3] == (0, None) and out[4][1] is None and out[5] == (4, 1.0)


def test_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    assert versions.read_current(spark, path) is None
    versions.replace(spark.range(5), path)
    old = versions.read_current(spark, path)
    versions.replace(old.union(spark.range(5, 8)), path)  # made from itself
    assert old.count() == 5 and versions.read_current(spark, path).count() == 8
    # a version that was never swapped in doesn't count
    spark.range(99).write.parquet(f"{path}/version-lost")
    assert versions.read_current(spark, path).count() == 8
    assert versions.drop_old_versions(spark, path) == 2 and versions.read_current(spark, path).count() == 8
    assert len([x for x in os.listdir(path) if x.startswith("_current")]) == 1


def test_label_merge_replaces_what_it_reads(spark, tmp_path):
    parts, target = str(tmp_path / "parts"), str(tmp_path / "merged")
    for n in range(2):
        spark.range(n * 3, n * 3 + 3).select(F.concat(F.lit("c"), "id").alias("clip_id")).coalesce(1).write.mode("append").parquet(parts)
        versions.merge_labels(spark, parts, target, f"v{n}")
        assert versions.read_current(spark, target).count() == 3 * n + 3
    versions.merge_labels(spark, target, target, "v9")
    assert {r.schema_version for r in versions.read_current(spark, target).collect()} == {"v9"}


RESULT = T.StructType([T.StructField("double", T.LongType()), T.StructField("note", T.StringType())])


def worker(fails):
    def make():
        def work(row):
            if row["task_id"] in fails:
                raise RuntimeError("no " + "x" * 600)
            if row["task_id"] == "t9":
                return {"double": "not a number"}
            return {"double": row["n"] * 2}

        return work

    return make


def test_tasks_are_done_once(spark, tmp_path):
    root = str(tmp_path)
    work = spark.createDataFrame([(f"t{k}", k) for k in range(10)] + [("t3", 3)], "task_id string, n long")
    first = attempts.run_once(work, root, "s", RESULT, worker({"t1", "t2"}))
    assert first.count() == 10 and {r.task_id for r in first.where("outcome = 'failed'").collect()} == {"t1", "t2", "t9"}
    assert max(len(r.error) for r in attempts.failures(spark, root).collect()) == attempts.ERROR_SIZE
    # cut before its table was whole: it doesn't count
    run = attempts.run_paths(spark, root)[0].removeprefix("file:")
    os.makedirs(f"{root}/run-cut/outcome=done")
    # cut between table and log: the second look finds it
    os.rename(f"{root}/task_log", f"{root}/lost_log")
    second = attempts.run_once(work, root, "s", RESULT, worker({"t2"}))
    assert {(r.task_id, r.outcome, r.attempt) for r in second.collect()} == {("t1", "done", 2), ("t2", "failed", 2), ("t9", "failed", 2)}
    log = tables.read_log(spark, f"{root}/task_log")
    assert log.where("status = 'done'").count() == 8 and log.where("status = 'done'").select("task_id").distinct().count() == 8
    third = attempts.run_once(work, root, "s", RESULT, worker({"t2"}))
    assert {r.task_id for r in third.collect()} == {"t2", "t9"}
    assert attempts.run_once(work, root, "s", RESULT, worker(set())).count() == 0  # given up after three
    assert {r.task_id: r.double for r in attempts.results(spark, root, RESULT).collect()} == {f"t{k}": 2 * k for k in range(9) if k != 2}
    assert sorted((r.task_id, r.attempt) for r in attempts.failures(spark, root).collect()) == [("t1", 1)] + [(t, k) for t in ("t2", "t9") for k in (1, 2, 3)]
    assert os.path.isdir(run)
