"""Operators against literal loops and the edge cases of the stage rules."""

from __future__ import annotations

import math
import random
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from timbre import config, schemas
from timbre.config import AcousticGate, Config, MetadataGate, PurityRule, SelectionRule, overlay
from timbre.functions import text
from timbre.operators import gates, labels, meta, reports, sampling, scoring, sequences, tasks


def test_config_overlay_and_unknown_keys(tmp_path):
    path = tmp_path / "c.yaml"
    path.write_text("metadata:\n  duration_max: 20\nselection:\n  verdicts: [single]\n")
    c = config.load_config(str(path))
    assert c.metadata.duration_max == 20 and c.selection.verdicts == ("single",)
    with pytest.raises(ValueError):
        overlay(Config(), {"metadata": {"durations": 1}})
    assert math.isclose(sum(w for _, w in Config().prosody.items()), 1.0)


def test_metadata_gates(spark):
    rows = [("a", 2.0, "zh", 4.0, "你好世界"), ("b", 31.0, "en", None, "x"), ("c", None, " ZH ", 3.0, "ab　cd"), ("d", 3.0, "zh", 3.2, "abcd"), ("e", 30.0, None, 5.0, None)]
    df = spark.createDataFrame(rows, "clip_id string, duration_s double, original_language string, original_dnsmos double, original_text string")
    out = {r.clip_id: r for r in gates.metadata_gates(df, MetadataGate()).collect()}
    assert out["a"].reject_reason == "duration_short"
    assert out["b"].reject_reason == "duration_long;language_not_target;dnsmos_missing;text_short"
    assert out["c"].reject_reason == "duration_missing;dnsmos_low" and out["c"].duration_s == 0.0
    assert out["d"].passed and out["d"].reject_reason is None
    assert out["e"].reject_reason == "language_not_target;text_short"


def test_acoustic_gates(spark):
    df = spark.createDataFrame([(8.0, 1.5, 6.0, 30.0, 0.0, 11000.0), (5.0, 1.5, 6.0, 3.0, 0.0, 11000.0), (None, 1.5, 6.0, 30.0, 0.002, 11000.0)], "aes_pq double, aes_pc double, aes_ce double, snr_db double, clipping_ratio double, bandwidth_hz double")
    out = [r.reject_reason for r in gates.acoustic_gates(df, AcousticGate()).collect()]
    assert out == [None, "aes_pq<7.0;snr_db<20.0", "aes_pq<7.0;clipping_ratio>0.001"]
    kills = {r.gate: r.killed for r in gates.kill_counts(df, gates.acoustic_limits(AcousticGate())).collect()}
    assert kills["aes_pq<7.0"] == 2 and kills["aes_ce<5.0"] == 0


def test_scope_and_unknown(spark):
    with pytest.raises(ValueError):
        gates.scope_filter("all")


def test_zscore_matches_numpy(spark):
    rng = np.random.default_rng(3)
    rows = [(i, float(a), 5.0, int(i % 3)) for i, a in enumerate(rng.normal(size=50))]
    df = spark.createDataFrame(rows, "i long, a double, flat double, g int")
    out = {r.i: r.score for r in scoring.zscore_sum(df, [("a", 0.7), ("flat", 0.3)], "score").collect()}
    a = np.array([r[1] for r in rows])
    assert np.allclose([out[i] for i in range(50)], 0.7 * (a - a.mean()) / a.std())
    one = scoring.zscore_sum(df.where("i = 0"), [("a", 1.0)], "score").first()
    assert one.score == 0.0


def test_ranked_is_total_and_gapless(spark):
    rng = random.Random(1)
    rows = [(rng.randint(0, 20), i) for i in range(500)]
    out = scoring.ranked(spark.createDataFrame(rows, "p int, k int").repartition(7), [F.desc("p"), F.asc("k")]).collect()
    want = {k: i for i, (p, k) in enumerate(sorted(rows, key=lambda r: (-r[0], r[1])))}
    assert {r.k: r.priority_rank for r in out} == want
    assert not scoring.ranked(spark.createDataFrame([], "p int, k int"), [F.asc("k")]).collect()


def test_slices_widen(spark):
    df = spark.range(0, 12).select(F.col("id").alias("priority_rank"))
    assert sorted({r.slice_id for r in sampling.slices(df, 5).collect()}) == ["00000", "00001", "00002"]
    wide = spark.createDataFrame([(0,), (1_234_567,)], "priority_rank long")
    assert [r.slice_id for r in sampling.slices(wide, 1).orderBy("priority_rank").collect()] == ["0000000", "1234567"]
    assert sampling.slice_width(1_234_568, 1) == 7


def literal_round_robin(rows, cap):
    """rows: (speaker, emotion, score, key). Keys kept, by the loop the closed form stands for."""
    kept = set()
    speakers = defaultdict(lambda: defaultdict(list))
    for r in rows:
        speakers[r[0]][r[1]].append(r)
    for buckets in speakers.values():
        for b in buckets.values():
            b.sort(key=lambda r: (-r[2], r[3]))
        order = sorted(buckets, key=lambda e: (buckets[e][0][2], e), reverse=True)
        turn, picked = 0, []
        while len(picked) < cap and any(turn < len(b) for b in buckets.values()):
            picked += [buckets[e][turn] for e in order if turn < len(buckets[e])]
            turn += 1
        kept |= {r[3] for r in picked[:cap]}
    return kept


def test_capped_round_robin_equals_loop(spark):
    rng = random.Random(5)
    for _ in range(3):
        rows = [(rng.choice("ab"), rng.choice("xyz"), float(rng.randint(0, 5)), i) for i in range(40)]
        out = sampling.capped_round_robin(spark.createDataFrame(rows, "s string, e string, score double, k long"), 7, "s", "e", "score", "k")
        assert {r.k for r in out.where("kept").collect()} == literal_round_robin(rows, 7)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.floats(0, 1, width=16), min_size=1, max_size=25))
def test_runs_against_loop(values):
    spark = test_runs_against_loop.spark
    df = spark.createDataFrame([("c", i, float(v)) for i, v in enumerate(values)], "c string, i long, v double")
    want, start = [], None
    for i, v in enumerate([*values, 1.0]):
        if v < 0.5 and i < len(values):
            start = i if start is None else start
        elif start is not None:
            want.append((start, i - 1))
            start = None
    got = sorted((r.run_start, r.run_end) for r in sequences.runs(df, ["c"], "i", F.col("v") < 0.5).collect())
    assert got == want
    if want:
        best = max(want, key=lambda r: (r[1] - r[0], -r[0]))
        r = sequences.longest_run(df, ["c"], "i", F.col("v") < 0.5).first()
        assert (r.run_start, r.run_end) == best


@pytest.fixture(autouse=True)
def _hand_over(spark):
    test_runs_against_loop.spark = spark
    yield


def test_greedy_peaks_against_loop(spark):
    rng = random.Random(2)
    for _ in range(4):
        v = [rng.random() for _ in range(30)]
        want = []
        beyond = [float("-inf"), *v, float("-inf")]
        for i in range(30):
            if v[i] >= beyond[i] and v[i] >= beyond[i + 2] and v[i] >= 0.4 and (not want or i - want[-1] >= 3):
                want.append(i)
        df = spark.createDataFrame([(v,)], "v array<double>")
        assert df.select(sequences.greedy_peaks(F.col("v"), 0.4, 3).alias("p")).first().p == want
    assert spark.createDataFrame([([1.0],)], "v array<double>").select(sequences.greedy_peaks(F.col("v"), 0.4, 3).alias("p")).first().p == [0]
    assert spark.createDataFrame([([],)], "v array<double>").select(sequences.greedy_peaks(F.col("v"), 0.4, 3).alias("p")).first().p == []


def test_greedy_peaks_of_long_arrays(spark):
    """A million values, and arrays about as long as a block."""
    rng = np.random.default_rng(3)
    for n, apart in ((1_000_000, 5), (sequences.BLOCK, 2), (sequences.BLOCK + 1, 700), (3 * sequences.BLOCK - 1, 3000), (2500, 1)):
        v = np.round(rng.random(n), 2)
        beyond = np.concatenate([[-np.inf], v, [-np.inf]])
        want, last = [], -apart
        for i in np.flatnonzero((v >= beyond[:-2]) & (v >= beyond[2:]) & (v >= 0.3)).tolist():
            if i - last >= apart:
                want.append(i)
                last = i
        df = spark.createDataFrame([(v.tolist(),)], "v array<double>")
        assert df.select(sequences.greedy_peaks(F.col("v"), 0.3, apart).alias("p")).first().p == want


def test_variation_of_short_groups(spark):
    rows = [("long", i, float(i % 5)) for i in range(32)] + [("short", i, 1.0) for i in range(7)] + [("one", i, 1.0) for i in range(9)]
    df = spark.createDataFrame(rows, "g string, i long, v double")
    for out in (sequences.rate_variation(df, ["g"], "i", "v", 8), sequences.peak_rate_variation(df, ["g"], "i", "v", 8, 2)):
        got = {r.g: (r.n_windows, r.rate_var_cv) for r in out.collect()}
        assert got["short"] == (0, 0.0) and got["one"] == (1, 0.0) and got["long"][0] == 4


def test_purity_table(spark):
    cases = [  # n, mean, min, confidence, duration, first, last, start, end -> verdict
        ((1, 0.1, 0.1, 0.1, 2.0, None, None, None, None), "single"),
        ((5, 0.9, 0.8, 0.9, 4.5, None, None, None, None), "single"),
        ((6, 0.9, 0.5, 0.9, 6.0, 0, 1, 0.0, 2.25), "intruded_trimmed"),
        ((6, 0.9, 0.5, 0.9, 5.24, 0, 1, 0.0, 2.25), "intruded_rejected"),
        ((6, 0.9, 0.5, 0.9, 5.25, 0, 1, 0.0, 2.25), "intruded_trimmed"),
        ((6, 0.9, 0.5, 0.9, 5.25, 4, 5, 3.0, 5.25), "intruded_trimmed"),
        ((6, 0.9, 0.5, 0.9, 5.25, 2, 3, 1.5, 3.75), "intruded_rejected"),
        ((4, 0.6, 0.5, 0.9, 3.75, 0, 3, 0.0, 3.75), "degraded_pass"),
        ((4, 0.6, 0.5, 0.2, 3.75, 0, 3, 0.0, 3.75), "overlap_rejected"),
        ((4, 0.75, 0.72, 0.44, 3.75, None, None, None, None), "overlap_rejected"),
        ((4, 0.9, 0.6, 0.9, 3.75, None, None, None, None), "degraded_pass"),
    ]
    df = spark.createDataFrame([(i, *c) for i, (c, _) in enumerate(cases)], "i int, n_windows long, mean_win_cos double, min_win_cos double, f0_tracker_confidence double, duration_s double, run_first long, run_last long, run_start_s double, run_end_s double")
    out = sequences.purity(df, PurityRule()).orderBy("i").collect()
    assert [r.verdict for r in out] == [v for _, v in cases]
    assert out[2].trim_start_s == 2.25 and out[2].trim_end_s == 6.0 and out[5].trim_end_s == 3.0 and out[6].trimmed_duration_s is None


def test_sliding_windows_keep_half(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 4.0), ("c", None)], "c string, d double")
    out = defaultdict(list)
    for r in sequences.sliding_windows(df, "d", 1.5, 0.0).orderBy("window_no").collect():
        out[r.c].append((r.start_s, r.end_s))
    assert out["a"] == [(0.0, 1.0)] and out["b"] == [(0.0, 1.5), (1.5, 3.0), (3.0, 4.0)] and out["c"] == [(0.0, 0.0)]


def test_fitted_spans(spark):
    df = spark.createDataFrame([([1, 2, 3], 2), ([1, 2], 4), ([], 2)], "s array<int>, n int")
    assert [r.x for r in df.select(sequences.fitted_spans(F.col("s"), F.col("n")).alias("x")).collect()] == [[1, 2], [1, 2, 2, 2], []]


def test_hard_constraints_first_wins(spark):
    df = spark.createDataFrame([(None, ["truncated_head"], "single"), ("broken", ["truncated_head"], "single"), ("match", ["truncated_head"], "x"), ("match", None, None), ("fixable", [], "single")], "text_verdict string, defects array<string>, verdict string")
    out = [r.r for r in df.select(gates.hard_constraint(SelectionRule()).alias("r")).collect()]
    assert out == ["missing_omni_labels", "text_broken", "truncated_defect", "verdict_rejected", None]


def test_char_error_rate(spark):
    df = spark.createDataFrame([("你好世界", "你好x界"), ("", ""), ("", "a"), ("é", "eee"), (None, None)], "r string, h string")
    assert [x.c for x in df.select(text.char_error_rate(F.col("r"), F.col("h")).alias("c")).collect()] == [0.25, 0.0, 1.0, 3.0, 0.0]


def test_text_functions(spark):
    row = spark.createDataFrame([("　 Ab ", "a/b.c.TAR", "x", 1536, "HTTP 429")], "t string, p string, n string, b long, e string").select(
        text.lowered(F.col("t")).alias("t"), text.stem(F.col("p")).alias("stem"), text.suffix(F.col("p")).alias("suffix"), text.to_number(F.col("n")).alias("n"),
        text.human_bytes(F.col("b")).alias("b"), text.is_rate_limit(F.col("e")).alias("e"), text.padded(F.lit(123456), 3).alias("wide"), text.hash_slot(F.lit("ZH-B000000"), 8).alias("slot"),
    ).first()
    assert tuple(row) == ("ab", "b.c", ".tar", None, "1.5 KB", True, "123456", 2)


def test_flatten_roundtrip(spark):
    df = spark.sql("SELECT 1 AS clip_id, named_struct('aesthetics', named_struct('pq', 2.0D), 'snr_db', 3.0D) AS acoustics, cast(NULL AS struct<purity_check: struct<verdict: string>>) AS speaker, array('a') AS tags")
    flat = meta.flatten(df)
    assert flat.columns == ["clip_id", "acoustics_aesthetics_pq", "acoustics_snr_db", "speaker_purity_check_verdict", "tags"]
    assert flat.first().speaker_purity_check_verdict is None
    assert meta.flatten(meta.unflatten(flat)).collect() == flat.collect()
    assert meta.split_name("prosody_dsp_rate_var_cv") == ("prosody_dsp", "rate_var_cv")


def test_label_documents(spark):
    import json

    good = json.loads(labels.seeded_document("c", "text"))
    bad = {**good, "emotion": {**good["emotion"], "primary": "bored"}}
    more = {**good, "mood": 1}
    rows = [(1, json.dumps(good)), (2, "```json\n" + json.dumps(good) + "\n```"), (3, json.dumps(bad)), (4, json.dumps(more)), (5, "{"), (6, None)]
    out = {r.i: r for r in labels.parse_labels(spark.createDataFrame(rows, "i int, response string"), "response").collect()}
    assert [out[i].s4_status for i in range(1, 7)] == ["ok", "ok", "failed", "failed", "failed", "failed"]
    assert out[3].schema_errors == ["emotion.primary"] and out[4].schema_errors == ["unknown:mood"] and out[5].schema_errors == ["malformed"]
    assert out[1].labels.emotion.primary in schemas.EMOTIONS and out[3].labels is None


def test_label_calls_retry(spark):
    import asyncio

    calls = []

    async def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise labels.LabelError("slow down", 429)
        return "done"

    async def still(_):
        return None

    assert asyncio.run(labels.with_retry(flaky, config.LabelRule(), random.Random(0), sleep=still)) == "done"
    assert labels.retryable(500, "") and not labels.retryable(400, "") and labels.retryable(None, "Connection reset")
    out = labels.label_calls(spark.createDataFrame([("a", "x"), ("b", None)], "clip_id string, text string")).collect()
    assert {r.clip_id for r in out} == {"a", "b"} and all(r.error is None for r in out)


def test_tasks(spark):
    assert [r.shard for r in tasks.expanded_shards(spark, "P008..P011,x").collect()] == ["P008", "P009", "P010", "P011", "x"]
    with pytest.raises(ValueError):
        tasks.expanded_shards(spark, "P1..Q2")
    all_ = spark.createDataFrame([("b",), ("a",), ("c",)], "task_id string")
    assert [r.task_id for r in tasks.pending(all_, spark.createDataFrame([("b",)], "task_id string")).collect()] == ["a", "c"]


def test_suggested_thresholds_clamp(spark):
    df = spark.range(0, 101).select(F.col("id").cast("double").alias("m"))
    out = lambda s: reports.suggested_thresholds(df, [("m", "min")], s).first().suggested
    assert out(1.0) == 1.0 and math.isclose(out(0.6), 40.0)


def test_nearest_rank(spark):
    df = spark.createDataFrame([(float(i),) for i in range(10)], "s double")
    assert reports.nearest_rank(df, "s", 0.6).first().cut == 6.0 and reports.nearest_rank(df, "s", 1.0).first().cut == 9.0


def test_markdown(spark):
    assert reports.markdown_table(spark.createDataFrame([("a", 1.5)], "k string, v double")) == "| k | v |\n| --- | --- |\n| a | 1.5 |\n"


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_ranks_of_wide_rows(spark, adaptive):
    """More rows than a sample of the range bounds holds, with columns beside the order's."""
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        rows = spark.range(0, 60_000, numPartitions=7).select("id", (F.col("id") * 7919 % 60_000).alias("v"), F.repeat(F.lit("wide"), 20).alias("w"), (F.col("id") % 3).alias("g"))
        out = scoring.ranked(rows, [F.desc("v")], "r")
        assert out.where("r = 59999 - v").count() == 60_000
        groups = scoring.numbered(rows, [F.col("g"), F.col("v")], "r", by=["g"]).groupBy("g").agg(F.count_distinct("r").alias("n"), F.max("r").alias("m"))
        assert {(r.n, r.m) for r in groups.collect()} == {(20_000, 19_999)}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_quantiles_against_percentile(spark):
    rows = spark.range(1000).select(F.when(F.col("id") % 5 > 0, F.col("id") * 37 % 101 / 7).alias("a"), F.lit(None).cast("double").alias("b"))
    want = rows.agg(F.percentile("a", F.array(F.lit(0.0), F.lit(0.33), F.lit(1.0)))).first()[0]
    got = {(r.metric, r.q): (r.n, r.value) for r in scoring.quantiles(rows, ["a", "b"], [0.0, 0.33, 1.0]).collect()}
    assert all(got["a", q][0] == 800 and abs(got["a", q][1] - x) < 1e-9 for q, x in zip((0.0, 0.33, 1.0), want))
    assert got["b", 0.33] == (0, None)


def test_silence_has_no_ratio(spark):
    powers = spark.createDataFrame([(1, 0.0)] * 5, "k int, power double")
    assert sequences.blind_snr(powers, ["k"]).first().snr_db == 0.0


def test_label_schema_lists_what_is_checked():
    schema = labels.label_schema()
    assert schema["additionalProperties"] is False and schema["properties"]["emotion"]["required"] == ["primary", "intensity", "confidence"]
    assert schema["properties"]["prosody"]["properties"]["expressiveness"] == {"type": "integer", "minimum": 1, "maximum": 5}
    assert "paralinguistic" not in schema["required"] and "usable" in schema["required"]


def test_any_failure_of_a_provider_is_kept(spark):
    async def broken(clip_id, text):
        raise KeyError("no such field")

    rows = labels.label_calls(spark.createDataFrame([("a", "x")], "clip_id string, text string"), provider=broken).collect()
    assert rows[0].response is None and "no such field" in rows[0].error


def test_malformed_answers_are_asked_for_again(spark):
    """The first answers of a clip are broken in several ways; a clip whose answers all are keeps its row."""

    def maker():
        seen = {}

        async def provider(clip_id, text):
            n = seen[clip_id] = seen.get(clip_id, 0) + 1
            good = labels.seeded_document(clip_id, text)
            if clip_id == "never":
                return "{"
            bad = ["{", "null", "[]", good.replace('"usable": true', '"usable": 1'), good.replace('"emotion"', '"mood"')]
            return bad[n - 1] if n <= int(clip_id) else "```json\n" + good + "\n```"

        return provider

    rule = config.LabelRule(max_attempts=6, backoff_cap_s=0.0)
    clips = spark.createDataFrame([(str(k), "t") for k in range(6)] + [("never", None)], "clip_id string, text string").coalesce(1)
    rows = {r.clip_id: r for r in labels.label_rows(labels.label_calls(clips, rule, maker())).collect()}
    assert [rows[str(k)].s4_status for k in range(6)] == ["ok"] * 6 and rows["3"].labels.text_fixed == "t"
    assert rows["never"].s4_status == "failed" and rows["never"].error.startswith("malformed answer") and rows["never"].labels is None


def test_validation_in_and_after_the_call_agree(spark):
    import json

    good = json.loads(labels.seeded_document("c", "text"))
    changes = [{}, {"mood": 1}, {"usable": None}, {"emotion": {**good["emotion"], "primary": "bored"}}, {"emotion": {**good["emotion"], "secondary": "sad"}}, {"emotion": {**good["emotion"], "intensity": 9}}, {"defects": ["rust"]}, {"prosody": {k: v for k, v in good["prosody"].items() if k != "rhythm"}}, {"context": {**good["context"], "x": 1}}, {"language": None}, {"text_verdict": None}]
    texts = [json.dumps({**good, **c}) for c in changes]
    after = {r.i: r.s4_status for r in labels.parse_labels(spark.createDataFrame(list(enumerate(texts)), "i int, response string"), "response").collect()}
    for i, t in enumerate(texts):
        assert (after[i] == "ok") == (not labels.problems(json.loads(t), labels.label_schema())), t
    assert [after[i] for i in range(5)] == ["ok", "failed", "failed", "failed", "ok"]


def test_triaged_clips_have_no_labels(spark):
    async def triage(clip_id, text):
        return labels.seeded_document(clip_id, text).replace('"usable": true', '"usable": false') if clip_id == "b" else labels.seeded_document(clip_id, text)

    clips = spark.createDataFrame([("a", "x"), ("b", "y")], "clip_id string, text string")
    poor = spark.createDataFrame([("ok", True), ("ok", False), ("failed", None)], "s4_status string, usable boolean")
    rows = {r.clip_id: r for r in labels.label_pass(clips, poor, triage=triage).collect()}
    assert rows["b"].s4_status == "ok" and rows["b"].labels is None and rows["b"].triaged and rows["a"].labels is not None
    fine = labels.label_pass(clips, poor.where("usable"), triage=triage).collect()
    assert not any(r.triaged for r in fine) and all(r.labels is not None for r in fine)


def test_rows_tied_at_the_cut_are_kept(spark):
    """Interpolation between equal scores gives that score, not one beside it."""
    for score in (0.10802409014926796, 0.7, -1 / 3):
        for n in (24, 30, 37, 43, 58):
            rows = spark.range(n).select(F.lit(score).alias("s"))
            assert scoring.top_fraction(rows, "s", 0.4).count() == n


def test_statistics_are_worked_out_once(spark):
    """A score that is made anew for another job is the same to the last bit."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = spark.range(50).select("id", (F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 3).alias("g"))
    for by, least in (((), 50), (("g",), 50)):
        for out in (scoring.zscore_sum(rows.mapInArrow(count, rows.schema), [("a", 1.0)], by=by), scoring.minmax(rows.mapInArrow(count, rows.schema), {"b": "a"}, 0.0, by=by)):
            before = seen.value
            assert out.count() == 50 and out.select("id").distinct().count() == 50
            assert seen.value - before <= 2 * least  # the rows of each job, none for the statistics


def test_bytes_round_as_they_are_printed(spark):
    sizes = [0, 1023, 1024, 1280, 1792, 2304, 2816, 3328, 3329, 3840, 1048524, 1048525, 1048575, 1 << 20, 5 << 18, 7 << 18, (9 << 38) - 1, 9 << 38, (9 << 38) + 1, 11 << 38, 5000 << 40]
    got = {r.n: r.h for r in spark.createDataFrame([(n,) for n in sizes], "n long").select("n", text.human_bytes(F.col("n")).alias("h")).collect()}

    def printed(n):
        for power, unit in ((10, "KB"), (20, "MB"), (30, "GB"), (40, "TB")):
            if n < 1024:
                return f"{n} B"
            if n < 1 << power + 10 or unit == "TB":
                return f"{n / (1 << power):.1f} {unit}"

    assert got == {n: printed(n) for n in sizes}
