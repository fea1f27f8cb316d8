"""States of parts: merged in any order they are the statistics of all rows."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from timbre.functions import clip_audio, signal
from timbre.operators import part_state, sampling, scoring

LIMITS = [("a", "<", 0.5)]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    found = [(f"p{k % 5}", k, None if k % 11 == 0 else 1e6 + rng.gauss(0, 1), float(rng.randint(0, 3)), 7.0) for k in range(4000)]
    return found + [("empty", 9000, None, None, None), ("one", 9001, 1e6, 2.0, 7.0)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "part string, id long, a double, b double, c double").repartition(4)


def values(rows, i):
    return np.array([r[i] for r in rows if r[i] is not None])


def test_merged_in_any_order(spark, rows, tmp_path):
    df, path = frame(spark, rows), str(tmp_path / "states")
    names = sorted({r[0] for r in rows})
    for order in (names, names[::-1]):
        for n in order:
            part_state.add_parts(part_state.part_states(df.where(F.col("part") == n), "part", ["a", "b", "c"], LIMITS), path)
    states = part_state.read_states(spark, path)
    assert states.count() == 3 * len(names)  # a part that came twice has one state
    pairs = part_state.merged(part_state.merged(states.withColumn("half", F.hash("part") % 2), ["metric", "half"]))  # merged states merge
    for whole in (part_state.merged(states), pairs):
        got = {r.metric: r for r in part_state.summary(whole, (0.1, 0.5, 0.99)).collect()}
        for i, m in ((2, "a"), (3, "b"), (4, "c")):
            v = values(rows, i)
            assert (got[m].n, got[m].low, got[m].high) == (len(v), v.min(), v.max())
            assert abs(got[m].mean - v.mean()) < 1e-6 and abs(got[m].std - v.std()) < 1e-6
            for q, x in zip((0.1, 0.5, 0.99), got[m].quantiles):
                assert (v < x).mean() - part_state.RANK_ERROR <= q <= (v <= x).mean() + part_state.RANK_ERROR
        assert got["a"].killed == sum(r[2] is None or r[2] < 0.5 for r in rows) and got["b"].killed == 0


def test_prefixes_and_named_parts(spark, rows, tmp_path):
    df, path = frame(spark, rows), str(tmp_path / "states")
    part_state.add_parts(part_state.part_states(df, "part", ["a", "b"], LIMITS), path)
    got = {(r.upto, r.metric): r for r in part_state.prefixes(part_state.read_states(spark, path)).collect()}
    for upto in sorted({r[0] for r in rows}):
        mine = [r for r in rows if r[0] <= upto]
        v, r = values(mine, 2), got[upto, "a"]
        assert r.n == len(v) and r.killed == sum(x[2] is None for x in mine)
        assert (r.mean is None and r.std is None) if not len(v) else abs(r.mean - v.mean()) < 1e-6 and abs(r.std - v.std()) < 1e-5
    some = {r.metric: r for r in part_state.merged(part_state.read_states(spark, path, ["p1", "p2"])).collect()}
    assert some["a"].n == len(values([r for r in rows if r[0] in ("p1", "p2")], 2))
    source = str(tmp_path / "stage")
    df.write.parquet(source)
    frame(spark, [("new", 1, 1.0, 1.0, 1.0)]).write.mode("append").parquet(source)
    assert [r.part for r in part_state.pending_parts(spark, source, path, "part").collect()] == ["new"]


def test_scores_by_state_equal_scores_by_rows(spark, rows):
    df = frame(spark, rows)
    weights = [("a", 0.5), ("b", 0.3), ("c", 0.2)]
    got = {r.id: r.score for r in part_state.scored(df, part_state.merged(part_state.part_states(df, "part", ["a", "b", "c"])), weights).collect()}
    want = {r.id: r.prosody_dsp_score for r in scoring.zscore_sum(df, weights).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 for k in got)


def test_priority_is_checked_before_any_job(spark):
    df = spark.createDataFrame([("c", 1.0)], "clip_id string, aes_pq double")
    sampling.checked_priority(df, "prosody_dsp_score * norm_aesthetics_pq + aes_pq")
    for bad in ("no_such_column + 1", "aes_pq +", "concat(clip_id, 'x')"):
        with pytest.raises(ValueError, match="priority"):
            sampling.checked_priority(df, bad)


def test_clip_columns(spark):
    x = np.sin(np.arange(8000) / 20).astype(np.float32) * 0.5
    wav = signal.encode_wav(x, 8000)
    df = spark.createDataFrame([(1, wav, 0.25, 0.5), (2, wav, None, 0.5), (3, wav, 0.75, None), (4, None, 0.1, 0.2), (5, b"junk", None, None), (6, wav[:30], None, None)], "i int, audio binary, a double, b double")
    rows = {r.i: r for r in df.select("i", clip_audio.decoded(clip_audio.cut("audio", "a", "b")).alias("d")).select("i", "d.*").collect()}
    assert [len(rows[k].samples) for k in (1, 2, 3)] == [2000, 8000, 2000] and rows[1].rate == 8000
    assert np.abs(np.array(rows[1].samples) - x[2000:4000]).max() < 1e-3
    assert rows[4].samples is None and rows[4].error is None and rows[5].error and rows[6].error and math.isclose(rows[3].rate, 8000)
