"""Files: stage tables, shards of clips, signals, streams."""

from __future__ import annotations

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from timbre import schemas
from timbre.functions import signal
from timbre.operators import tasks
from timbre.sources import tables
from timbre.streaming import incremental


def test_stage_table_typed_and_idempotent(spark, tmp_path):
    path = str(tmp_path / "s0")
    tables.write_stage(spark.createDataFrame([], "clip_id string"), path, schemas.S0)
    empty = tables.read_stage(spark, path)
    assert empty.count() == 0 and empty.dtypes == [(f.name, f.dataType.simpleString()) for f in schemas.S0.fields]
    rows = spark.createDataFrame([("a", "P0", True), ("b", "P1", False)], "clip_id string, shard string, passed boolean")
    for _ in range(2):
        tables.write_stage(rows, str(tmp_path / "by"), schemas.S0, "shard")
    assert spark.read.parquet(str(tmp_path / "by")).count() == 2
    with pytest.raises(ValueError):
        tables.conformed(rows.withColumn("more", F.lit(1)), schemas.S0)


def test_unfinished_parts_are_not_read(spark, tmp_path):
    path = tmp_path / "t"
    spark.range(3).coalesce(1).write.parquet(str(path))
    part = next(p for p in os.listdir(path) if p.startswith("part-"))
    (path / "part-x.parquet.tmp").write_bytes((path / part).read_bytes())
    assert tables.read_stage(spark, str(path)).count() == 3


def test_task_log(spark, tmp_path):
    path = str(tmp_path / "log")
    assert tables.read_log(spark, path).count() == 0
    tables.log_tasks(spark.createDataFrame([("P0",)], "task_id string"), path, "scan")
    todo = tasks.pending(spark.createDataFrame([("P0",), ("P1",)], "task_id string"), tables.read_log(spark, path).where("stage = 'scan'"))
    assert [r.task_id for r in todo.collect()] == ["P1"]


def test_atomic_files(tmp_path):
    tables.snapshot(str(tmp_path), {"a": "é"}, "2025-01-02T03:04:05Z")
    assert sorted(os.listdir(tmp_path)) == ["latest.json", "snapshot-20250102T030405Z.json"]


def test_signal_kernels():
    rate = 16000
    tone = (0.5 * np.sin(2 * np.pi * 1000 * np.arange(rate) / rate)).astype(np.float32)
    assert abs(signal.roll_off(tone, rate) - 1000) < 64 and signal.roll_off(np.zeros(rate, np.float32), rate) == 0.0
    back, r = signal.decode_wav(signal.encode_wav(tone, rate))
    assert r == rate and np.abs(back - tone).max() < 1e-3
    assert signal.header_rate(b"no") is None and signal.header_rate(signal.encode_wav(tone, 8000)) == 8000
    half = signal.resample(tone, rate, 8000)
    assert len(half) == 8000 and abs(np.abs(half[100:-100]).max() - 0.5) < 0.02 and signal.resample(tone, rate, rate) is tone
    # a 1 kHz sine of amplitude 0.5 is about -9 LUFS in one channel
    assert abs(signal.loudness(tone, rate) + 9.03) < 0.3 and signal.loudness(tone[:0], rate) == float("-inf")
    f0 = signal.track_pitch(signal.synthetic_voice(1.0, seed=1), rate)
    assert 80 < np.median(f0[f0 > 0]) < 260
    spans = signal.speech_spans(signal.synthetic_voice(2.0, seed=2, pauses=((0.8, 1.2),)), rate)
    assert len(spans) == 2
    assert signal.pitch_metrics(np.zeros(5))["f0_mean_hz"] == 0.0
    assert len(signal.trimmed_wav(signal.encode_wav(tone, rate), 0.25, 0.5)) == 44 + 2 * 4000
    assert (signal.seeded_numbers("a", 1, n=3) == signal.seeded_numbers("a", 1, n=3)).all()


def test_stream_appends_once(spark, tmp_path):
    source, target, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    spark.range(5).write.parquet(source)
    schema = spark.read.parquet(source).schema
    for n in (5, 8):
        incremental.run_incrementally(incremental.arriving(spark, source, schema), lambda b: b.where("id < 100"), target, mark).awaitTermination()
        assert spark.read.parquet(target).count() == n
        spark.range(10, 13).write.mode("append").parquet(source)


def test_reject_rates_of_arriving_parts(spark, tmp_path):
    source = str(tmp_path / "in")
    moment = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 60)
    spark.range(60).select(moment.alias("ts"), (F.col("id") % 3 != 0).alias("passed"), F.when(F.col("id") % 3 == 0, "short").alias("reject_reason")).write.parquet(source)
    stream = incremental.arriving(spark, source, spark.read.parquet(source).schema)
    rates = incremental.reject_rates(stream, "ts")
    assert rates.isStreaming
    query = rates.writeStream.format("memory").queryName("rates").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    rows = spark.table("rates").collect()
    assert sum(r.n for r in rows if r.reject_reason == "short") == 20 and sum(r.n for r in rows) == 60
    assert len({r.window.start for r in rows}) == 7  # an hour that begins inside a window of ten minutes
