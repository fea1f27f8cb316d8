"""Work that is done once: results and failures from one pass, and a second look before work.

A run reads the tasks that no earlier run has finished (or given up on), works on
them, and writes what comes of it in one pass: rows of results and rows of
failures lie in two folders of the run's own table, which counts once it is whole.
The log is written after it. So a run that is cut before its table is whole leaves
nothing, one that is cut between table and log is looked up in the table, and a
task is handled once by each run that counts.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from timbre.functions.text import utc_now
from timbre.sources.tables import log_tasks, read_log

ERROR_SIZE = 500


def run_paths(spark: SparkSession, root: str) -> list[str]:
    """The runs whose tables are whole."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/run-*/_SUCCESS")
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place) or []
    return sorted(str(s.getPath().getParent()) for s in found)


def outcomes(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """All rows of all runs: task_id, the result's columns, outcome, error, attempt, ts_iso."""
    kind = T.StructType([T.StructField("task_id", T.StringType()), *schema.fields, T.StructField("error", T.StringType()), T.StructField("attempt", T.LongType()), T.StructField("ts_iso", T.StringType()), T.StructField("outcome", T.StringType())])
    parts = [spark.read.schema(kind).parquet(p) for p in run_paths(spark, root)]
    out = spark.createDataFrame([], kind)
    for part in parts:
        out = out.unionByName(part)
    return out


def results(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    return outcomes(spark, root, schema).where("outcome = 'done'").select("task_id", *schema.names)


def failures(spark: SparkSession, root: str) -> DataFrame:
    """(task_id, attempt, error, ts_iso) of every attempt that has failed."""
    return outcomes(spark, root, T.StructType()).where("outcome = 'failed'").select("task_id", "attempt", "error", "ts_iso")


def worked(tasks: DataFrame, schema: T.StructType, make: Callable[[], Callable[[dict], dict]]) -> DataFrame:
    """``tasks`` with the columns of what the work returns, outcome and error; an error of the work is a row."""
    names = tasks.columns
    kinds = pa.schema([*((f.name, to_arrow_type(f.dataType)) for f in (*tasks.schema.fields, *schema.fields)), ("outcome", pa.string()), ("error", pa.string())])
    blank = dict.fromkeys(schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                try:
                    found = blank | work(row)
                    pa.RecordBatch.from_pylist([{k: found[k] for k in blank}], pa.schema([kinds.field(k) for k in blank]))  # of the types said
                    rows.append({**{k: row[k] for k in names}, **found, "outcome": "done", "error": None})
                except Exception as e:  # noqa: BLE001  work may fail in any way; the row keeps the error
                    rows.append({**{k: row[k] for k in names}, **blank, "outcome": "failed", "error": f"{type(e).__name__}: {e}"[:ERROR_SIZE]})
            yield pa.RecordBatch.from_pylist(rows, kinds)

    return tasks.mapInArrow(run, T.StructType([*tasks.schema.fields, *schema.fields, T.StructField("outcome", T.StringType()), T.StructField("error", T.StringType())]))


def run_once(tasks: DataFrame, root: str, stage: str, schema: T.StructType, make: Callable[[], Callable[[dict], dict]], attempts: int = 3) -> DataFrame:
    """Works on the tasks (task_id and what the work needs) that aren't done and have failed less than ``attempts`` times; returns this run's outcomes.

    ``make`` gives a task's work: a function of a row as a dict that returns the
    columns of ``schema`` or raises. Rows of one task_id are one task.
    """
    spark, log = tasks.sparkSession, f"{root}/task_log"
    before = outcomes(spark, root, schema).groupBy("task_id").agg(F.count_if(F.col("outcome") == "done").alias("__done"), F.count_if(F.col("outcome") == "failed").alias("__failed"))
    logged = read_log(spark, log).where((F.col("stage") == stage) & (F.col("status") == "done")).select("task_id").distinct()
    # a run that was cut between its table and the log
    log_tasks(before.where("__done > 0").join(logged, "task_id", "left_anti"), log, stage)
    todo = tasks.dropDuplicates(["task_id"]).join(before, "task_id", "left").where((F.coalesce("__done", F.lit(0)) == 0) & (F.coalesce("__failed", F.lit(0)) < attempts))
    todo = todo.withColumn("attempt", (F.coalesce("__failed", F.lit(0)) + 1).cast("long")).drop("__done", "__failed")
    path = f"{root}/run-{uuid.uuid4().hex}"
    rows = worked(todo, schema, make).withColumn("ts_iso", utc_now()).select("task_id", *schema.names, "error", "attempt", "ts_iso", "outcome")
    rows.write.partitionBy("outcome").parquet(path)
    found = spark.read.schema(rows.schema).parquet(path)  # the log says what is in the table
    log_tasks(found.where("outcome = 'done'").select("task_id"), log, stage)
    log_tasks(found.where("outcome = 'failed'").select("task_id", "error"), log, stage, status="failed")
    return found
