"""Tables in the folder that driver and executors share: checkpoints and written intermediates."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    The session's checkpoint folder wins, then ``spark.checkpoint.dir``. Only a
    session in one JVM may name neither (unit tests): it gets a temporary folder.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None:
            if not sc.master.startswith("local[") and sc.master != "local":
                raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
            named = tempfile.mkdtemp(prefix="timbre-checkpoint-")
            atexit.register(shutil.rmtree, named, ignore_errors=True)
        sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def fresh_path(spark: SparkSession, kind: str) -> str:
    """A new path in the shared folder, for a written table."""
    return f"{shared_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def delete_path(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` with its lineage cut by a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
