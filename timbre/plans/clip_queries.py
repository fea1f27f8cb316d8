"""Driver queries over the stand-in stage tables."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from timbre.config import AcousticGate, MetadataGate, ProsodyWeights, PurityRule, SelectionRule
from timbre.operators import gates, meta, reports, sampling, scoring, sequences, tasks
from timbre.plans.catalog import query
from timbre.plans.standins import standin, table, with_standins
from timbre.schemas import RELEASE_TIERS, TIERS

METADATA = MetadataGate(language=("en", "fr"), quality_min=2.6)
WEIGHTS = ProsodyWeights().items()
ELIGIBLE = ("single", "intruded_trimmed", "degraded_pass")
SLICE, CAP = 25, 12
RULE = SelectionRule(speaker_cap=CAP)
PURITY = PurityRule()


def r6(*names: str) -> list[Column]:
    return [F.round(n, 6).alias(n) for n in names]


def kept(df: DataFrame) -> DataFrame:
    """What several passes read (statistics, cuts, ranks) is worked out once and kept on disk where memory is short."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clips that pass both gates with all measures and the verdict: inner joins on the clip."""
    s0, s1, s2, s3 = (standin(spark, sf_dir, n) for n in ("s0", "s1", "s2", "s3"))
    out = s0.where("passed").select("clip_id", "doc_id", "shard", "original_speaker", "duration_s")
    out = out.join(s1.where("passed").select("clip_id", "aes_pq", "aes_pc", "aes_ce"), "clip_id")
    out = out.join(s2.drop("doc_id"), "clip_id")
    return kept(out.join(s3.select("clip_id", "verdict", "trimmed", "trimmed_duration_s"), "clip_id"))


JOINED = """joined AS (SELECT s0.clip_id, s0.doc_id, s0.shard, s0.original_speaker, s0.duration_s, s1.aes_pq, s1.aes_pc, s1.aes_ce,
    s2.f0_std_st, s2.f0_range_st, s2.energy_std_db, s2.speech_rate_cps, s2.rate_var_cv, s2.pause_count, s2.f0_tracker_confidence, s3.verdict, s3.trimmed, s3.trimmed_duration_s
    FROM s0 JOIN s1 USING (clip_id) JOIN s2 USING (clip_id) JOIN s3 USING (clip_id) WHERE s0.passed AND s1.passed)"""


def zsum(over: str = "") -> str:
    return " + ".join(f"cast({w} AS double) * coalesce(({m} - avg({m}) OVER ({over})) / nullif(stddev_pop({m}) OVER ({over}), 0), 0)" for m, w in WEIGHTS)


SCORED = f"scored AS (SELECT *, {zsum()} AS prosody_dsp_score, verdict IN ('single', 'intruded_trimmed', 'degraded_pass') AS s3_eligible FROM joined)"
TIERED = """cut AS (SELECT quantile_cont(prosody_dsp_score, 0.6) AS c FROM scored WHERE s3_eligible),
    tiered AS (SELECT scored.*, CASE WHEN NOT s3_eligible THEN 's3rejected' WHEN prosody_dsp_score >= c THEN 'prime' ELSE 'extended' END AS tier FROM scored, cut)"""
STAGES = "s0 s1 s2 s3"


def tiered(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scoring.zscore_sum(joined(spark, sf_dir), WEIGHTS).withColumn("s3_eligible", F.col("verdict").isin(*ELIGIBLE))
    out = scoring.quantile_cut(out, "prosody_dsp_score", 0.4, F.col("s3_eligible"))
    return out.withColumn("tier", gates.release_tier(F.col("s3_eligible"), F.col("prosody_dsp_score"), F.col("score_cut")))


@query("release_tiers", with_standins(STAGES, f"""WITH {JOINED}, {SCORED}, {TIERED}
    SELECT t.tier, count(tiered.clip_id) AS n, round(coalesce(sum(prosody_dsp_score), 0), 6) AS score_sum, round(coalesce(avg(aes_pq), 0), 6) AS pq_mean
    FROM (VALUES ('prime'), ('extended'), ('s3rejected')) AS t(tier) LEFT JOIN tiered USING (tier) GROUP BY t.tier"""))
def release_tiers(spark, sf_dir):
    rows = tiered(spark, sf_dir).groupBy("tier").agg(F.count("*").alias("n"), F.sum("prosody_dsp_score").alias("s"), F.avg("aes_pq").alias("m"))
    wanted = spark.range(1).select(F.explode(F.array(*map(F.lit, RELEASE_TIERS))).alias("tier"))
    return wanted.join(rows, "tier", "left").select("tier", F.coalesce("n", F.lit(0)).alias("n"), F.round(F.coalesce("s", F.lit(0.0)), 6).alias("score_sum"), F.round(F.coalesce("m", F.lit(0.0)), 6).alias("pq_mean"))


S0_REASON = """nullif(concat_ws(';',
    CASE WHEN duration_s IS NULL THEN 'duration_missing' WHEN duration_s < 3.0 THEN 'duration_short' WHEN duration_s > 30.0 THEN 'duration_long' END,
    CASE WHEN lower(trim(original_language)) NOT IN ('en', 'fr') THEN 'language_not_target' END,
    CASE WHEN original_dnsmos IS NULL THEN 'dnsmos_missing' WHEN original_dnsmos < 2.6 THEN 'dnsmos_low' END,
    CASE WHEN length(regexp_replace(original_text, '\\s', '', 'g')) < 4 THEN 'text_short' END), '')"""


@query("s0_gates", with_standins("raw_meta", f"""SELECT clip_id, coalesce(duration_s, 0) AS duration_s, coalesce(duration_s BETWEEN 3.0 AND 30.0, false) AS dur_ok, original_language IN ('en', 'fr') AS lang_ok,
    coalesce(original_dnsmos >= 2.6, false) AS dnsmos_ok, length(regexp_replace(original_text, '\\s', '', 'g')) >= 4 AS text_ok, {S0_REASON} IS NULL AS passed, {S0_REASON} AS reject_reason FROM raw_meta"""))
def s0_gates(spark, sf_dir):
    return gates.metadata_gates(standin(spark, sf_dir, "raw_meta"), METADATA).select("clip_id", "duration_s", "dur_ok", "lang_ok", "dnsmos_ok", "text_ok", "passed", "reject_reason")


@query("s0_reject_histogram", with_standins("raw_meta", f"SELECT {S0_REASON} AS value, count(*) AS n FROM raw_meta WHERE {S0_REASON} IS NOT NULL GROUP BY 1"))
def s0_reject_histogram(spark, sf_dir):
    return reports.histogram(gates.metadata_gates(standin(spark, sf_dir, "raw_meta"), METADATA), F.col("reject_reason"), ~F.col("passed"))


@query("s1_gates", with_standins("measures", """SELECT clip_id, reject_reason IS NULL AS passed, reject_reason FROM (SELECT clip_id, nullif(concat_ws(';',
    CASE WHEN aes_pq < 7.0 THEN 'aes_pq<7.0' END, CASE WHEN aes_pc > 2.5 THEN 'aes_pc>2.5' END, CASE WHEN aes_ce < 5.0 THEN 'aes_ce<5.0' END,
    CASE WHEN snr_db < 20.0 THEN 'snr_db<20.0' END, CASE WHEN clipping_ratio > 0.001 THEN 'clipping_ratio>0.001' END, CASE WHEN bandwidth_hz < 4000.0 THEN 'bandwidth_hz<4000.0' END), '') AS reject_reason FROM measures)"""))
def s1_gates(spark, sf_dir):
    return gates.acoustic_gates(standin(spark, sf_dir, "measures"), AcousticGate()).select("clip_id", "passed", "reject_reason")


KILLS = (("aes_pq<7.0", "aes_pq < 7.0"), ("aes_pc>2.5", "aes_pc > 2.5"), ("aes_ce<5.0", "aes_ce < 5.0"), ("snr_db<20.0", "snr_db < 20.0"), ("clipping_ratio>0.001", "clipping_ratio > 0.001"), ("bandwidth_hz<4000.0", "bandwidth_hz < 4000.0"))


@query("s1_kill_rates", with_standins("measures", " UNION ALL ".join(f"SELECT '{n}' AS gate, count(*) FILTER ({c}) AS killed, count(*) AS total, round(count(*) FILTER ({c}) / greatest(1, count(*)), 6) AS kill_rate FROM measures" for n, c in KILLS)))
def s1_kill_rates(spark, sf_dir):
    out = gates.kill_counts(standin(spark, sf_dir, "measures"), gates.acoustic_limits(AcousticGate()))
    return out.select("gate", "killed", "total", *r6("kill_rate"))


@query("joint_survival", with_standins("s1", "SELECT count(*) AS total, count(*) FILTER (passed) AS survived, round(count(*) FILTER (passed) / greatest(1, count(*)), 6) AS ratio FROM s1"))
def joint_survival(spark, sf_dir):
    out = reports.survival(standin(spark, sf_dir, "measures"), gates.joint_gate(gates.acoustic_limits(AcousticGate())))
    return out.select("total", "survived", *r6("ratio"))


@query("nearest_rank_cut", with_standins(STAGES, f"""WITH {JOINED}, {SCORED}, o AS (SELECT prosody_dsp_score AS v, row_number() OVER (ORDER BY prosody_dsp_score) - 1 AS r, count(*) OVER () AS n FROM scored)
    SELECT n, round(v, 6) AS cut FROM o WHERE r = least(n - 1, cast(floor(0.6 * n) AS bigint))"""))
def nearest_rank_cut(spark, sf_dir):
    return reports.nearest_rank(scoring.zscore_sum(joined(spark, sf_dir), WEIGHTS), "prosody_dsp_score", 0.6).select("n", F.round("cut", 6).alias("cut"))


NORMED = """kept AS (SELECT * FROM scored WHERE s3_eligible AND prosody_dsp_score >= (SELECT quantile_cont(prosody_dsp_score, 0.6) FROM scored WHERE s3_eligible)),
    bounds AS (SELECT min(aes_pq) AS a, max(aes_pq) AS b FROM kept),
    normed AS (SELECT kept.*, CASE WHEN b > a THEN (aes_pq - a) / (b - a) ELSE 1.0 END AS norm_aesthetics_pq FROM kept, bounds)"""
# the score's population is the survivors, so they come first
SURVIVORS = JOINED.replace("joined AS", "everyone AS") + ", joined AS (SELECT * FROM everyone WHERE verdict IN ('single', 'intruded_trimmed', 'degraded_pass'))"
ORDERED = "ordered AS (SELECT *, prosody_dsp_score * norm_aesthetics_pq AS priority, row_number() OVER (ORDER BY prosody_dsp_score * norm_aesthetics_pq DESC, clip_id) - 1 AS priority_rank FROM normed)"
WORKLIST = f"{SURVIVORS}, {SCORED}, {NORMED}, {ORDERED}"


def worklist(spark: SparkSession, sf_dir: str, priority: str = "prosody_dsp_score * norm_aesthetics_pq") -> DataFrame:
    return sampling.worklist(joined(spark, sf_dir).where(F.col("verdict").isin(*ELIGIBLE)), WEIGHTS, 0.4, priority, SLICE)


@query("survivors_ranked", with_standins(STAGES, f"WITH {WORKLIST} SELECT clip_id, verdict, round(prosody_dsp_score, 6) AS prosody_dsp_score, round(norm_aesthetics_pq, 6) AS norm_aesthetics_pq, round(priority, 6) AS priority, priority_rank FROM ordered"))
def survivors_ranked(spark, sf_dir):
    return worklist(spark, sf_dir).select("clip_id", "verdict", *r6("prosody_dsp_score", "norm_aesthetics_pq", "priority"), "priority_rank")


@query("worklist_slices", with_standins(STAGES, f"WITH {WORKLIST} SELECT clip_id, priority_rank, lpad(cast(priority_rank // {SLICE} AS varchar), 5, '0') AS slice_id FROM ordered"))
def worklist_slices(spark, sf_dir):
    return worklist(spark, sf_dir).select("clip_id", "priority_rank", "slice_id")


@query("custom_priority", with_standins(STAGES, f"WITH {WORKLIST.replace('prosody_dsp_score * norm_aesthetics_pq', 'aes_pq - 0.1 * pause_count')} SELECT clip_id, round(priority, 6) AS priority, priority_rank FROM ordered"))
def custom_priority(spark, sf_dir):
    return worklist(spark, sf_dir, "aes_pq - 0.1D * pause_count").select("clip_id", *r6("priority"), "priority_rank")


def scope_query(scope: str, condition: str) -> None:
    @query(f"scope_{scope}", with_standins(STAGES, f"WITH {JOINED}, {SCORED}, {TIERED} SELECT clip_id, tier, round(prosody_dsp_score, 6) AS prosody_dsp_score FROM tiered WHERE {condition}"))
    def rows(spark, sf_dir):
        return tiered(spark, sf_dir).where(gates.scope_filter(scope)).select("clip_id", "tier", *r6("prosody_dsp_score"))


scope_query("prime", "tier = 'prime'")
scope_query("s3", "s3_eligible")
scope_query("s1", "true")

SPINE = f"""{JOINED}, {SCORED}, spine AS (SELECT scored.*, s4.s4_status, s4.text_verdict, s4.emotion_primary, s4.emotion_intensity, s4.prosody_expressiveness, s4.defects FROM scored LEFT JOIN s4 USING (clip_id))"""
LABELLED = "s0 s1 s2 s3 s4"


def spine(spark: SparkSession, sf_dir: str, labelled: bool = True) -> DataFrame:
    scored = scoring.zscore_sum(joined(spark, sf_dir), WEIGHTS)
    s4 = standin(spark, sf_dir, "s4").select("clip_id", "s4_status", "text_verdict", "emotion_primary", "emotion_intensity", "prosody_expressiveness", "defects")
    return kept(scoring.with_labels(scored, s4 if labelled else None, s4.schema))


@query("s5_join", with_standins(LABELLED, f"WITH {SPINE} SELECT clip_id, original_speaker, verdict, s4_status, text_verdict, emotion_primary, emotion_intensity, prosody_expressiveness, array_to_string(defects, '|') AS defects, round(prosody_dsp_score, 6) AS prosody_dsp_score FROM spine"))
def s5_join(spark, sf_dir):
    return spine(spark, sf_dir).select("clip_id", "original_speaker", "verdict", "s4_status", "text_verdict", "emotion_primary", "emotion_intensity", "prosody_expressiveness", F.when(F.col("defects").isNotNull(), F.concat_ws("|", "defects")).alias("defects"), *r6("prosody_dsp_score"))


@query("s5_join_unlabelled", with_standins(STAGES, f"WITH {JOINED}, {SCORED} SELECT clip_id, cast(NULL AS varchar) AS text_verdict, cast(NULL AS int) AS emotion_intensity, 'missing_omni_labels' AS reject_reason, round(prosody_dsp_score, 6) AS prosody_dsp_score FROM scored"))
def s5_join_unlabelled(spark, sf_dir):
    """Scoring where there is no table of labels: all label columns are null, and every clip lacks its labels."""
    rows = spine(spark, sf_dir, labelled=False).withColumn("reject_reason", gates.hard_constraint(RULE))
    return rows.select("clip_id", "text_verdict", "emotion_intensity", "reject_reason", *r6("prosody_dsp_score"))


REASON = """CASE WHEN text_verdict IS NULL THEN 'missing_omni_labels' WHEN text_verdict NOT IN ('match', 'fixable') THEN 'text_broken'
    WHEN list_has_any(coalesce(defects, []), ['truncated_head', 'truncated_tail']) THEN 'truncated_defect' WHEN verdict IS NULL OR verdict NOT IN ('single', 'intruded_trimmed') THEN 'verdict_rejected' END"""


def constrained(spark, sf_dir):
    return spine(spark, sf_dir).withColumn("reject_reason", gates.hard_constraint(RULE))


@query("s5_hard_constraints", with_standins(LABELLED, f"WITH {SPINE} SELECT clip_id, {REASON} AS reject_reason FROM spine"))
def s5_hard_constraints(spark, sf_dir):
    return constrained(spark, sf_dir).select("clip_id", "reject_reason")


def unit(c: str) -> str:
    return f"CASE WHEN max({c}) OVER () > min({c}) OVER () THEN ({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()) ELSE 0.0 END"


SELECTED = f"""cand AS (SELECT *, coalesce(cast(prosody_expressiveness * emotion_intensity AS double), 0) AS expr_intensity FROM (SELECT *, {REASON} AS reason FROM spine) WHERE reason IS NULL),
    chosen AS (SELECT *, cast(0.35 AS double) * {unit('aes_pq')} + cast(0.25 AS double) * {unit('prosody_dsp_score')} + cast(0.30 AS double) * {unit('expr_intensity')} + cast(0.10 AS double) * {unit('aes_ce')} AS selection_score FROM cand),
    placed AS (SELECT *, row_number() OVER (ORDER BY selection_score DESC, clip_id) AS place, count(*) OVER () AS n FROM chosen),
    graded AS (SELECT *, CASE WHEN place <= greatest(1, ceil(n * cast(0.2 AS double))) AND coalesce(emotion_primary, '') <> 'neutral' AND coalesce(emotion_intensity, 0) >= 3 THEN 'S'
        WHEN coalesce(prosody_expressiveness, 0) <= 2 THEN 'B' ELSE 'A' END AS tier FROM placed)"""


def selected(spark, sf_dir):
    return kept(scoring.selection_scores(constrained(spark, sf_dir).where("reject_reason IS NULL"), RULE))


@query("s5_scores", with_standins(LABELLED, f"WITH {SPINE}, {SELECTED} SELECT clip_id, round(selection_score, 6) AS selection_score FROM chosen"))
def s5_scores(spark, sf_dir):
    return selected(spark, sf_dir).select("clip_id", *r6("selection_score"))


@query("s5_tiers", with_standins(LABELLED, f"WITH {SPINE}, {SELECTED} SELECT clip_id, tier FROM graded"))
def s5_tiers(spark, sf_dir):
    return scoring.assign_tiers(selected(spark, sf_dir), RULE).select("clip_id", "tier")


@query("s5_tier_counts", with_standins(LABELLED, f"WITH {SPINE}, {SELECTED} SELECT t.tier, count(graded.clip_id) AS n FROM (VALUES ('S'), ('A'), ('B')) AS t(tier) LEFT JOIN graded USING (tier) GROUP BY t.tier"))
def s5_tier_counts(spark, sf_dir):
    return reports.tier_counts(scoring.assign_tiers(selected(spark, sf_dir), RULE), TIERS)


CAPPED = f"""ranks AS (SELECT *, row_number() OVER (PARTITION BY original_speaker, emotion_primary ORDER BY selection_score DESC, clip_id) AS rk, max(selection_score) OVER (PARTITION BY original_speaker, emotion_primary) AS best FROM graded),
    capped AS (SELECT *, row_number() OVER (PARTITION BY original_speaker ORDER BY rk, best DESC, emotion_primary DESC) <= {CAP} AS kept FROM ranks)"""


def capped(spark, sf_dir):
    return sampling.capped_round_robin(scoring.assign_tiers(selected(spark, sf_dir), RULE), CAP, "original_speaker", "emotion_primary", "selection_score", "clip_id")


@query("s5_speaker_cap", with_standins(LABELLED, f"WITH {SPINE}, {SELECTED}, {CAPPED} SELECT clip_id, original_speaker, tier, kept FROM capped"))
def s5_speaker_cap(spark, sf_dir):
    return capped(spark, sf_dir).select("clip_id", "original_speaker", "tier", "kept")


@query("published_entries", with_standins(LABELLED, f"WITH {SPINE}, {SELECTED}, {CAPPED} SELECT clip_id, tier FROM capped WHERE kept AND tier IN ('S', 'A')"))
def published_entries(spark, sf_dir):
    return capped(spark, sf_dir).where(F.col("kept") & F.col("tier").isin("S", "A")).select("clip_id", "tier")


def record(spark, sf_dir) -> DataFrame:
    """The published nested record of the candidates."""
    rows = capped(spark, sf_dir)
    return rows.select(
        "clip_id", meta.published_duration().alias("duration_s"),
        F.struct(F.struct(F.round("aes_pq", 6).alias("pq"), F.round("aes_ce", 6).alias("ce")).alias("aesthetics")).alias("acoustics"),
        F.struct("rate_var_cv", "pause_count").alias("prosody_dsp"), F.struct(F.struct("verdict", "trimmed").alias("purity_check")).alias("speaker"),
        F.struct(F.struct(F.col("emotion_primary").alias("primary"), F.col("emotion_intensity").alias("intensity")).alias("emotion"), "text_verdict").alias("omni_labels"),
        F.struct(F.when(F.col("kept"), F.col("tier")).alias("tier"), F.when(~F.col("kept"), "speaker_quota").alias("reject_reason"), F.round("selection_score", 6).alias("score")).alias("selection"),
        F.struct(meta.stages_passed(F.col("s4_status") == "ok").alias("stages_passed")).alias("pipeline"),
    )


FLAT = f"""WITH {SPINE}, {SELECTED}, {CAPPED} SELECT clip_id, coalesce(CASE WHEN trimmed THEN trimmed_duration_s END, duration_s, 0) AS duration_s, round(aes_pq, 6) AS acoustics_aesthetics_pq, round(aes_ce, 6) AS acoustics_aesthetics_ce,
    rate_var_cv AS prosody_dsp_rate_var_cv, pause_count AS prosody_dsp_pause_count, verdict AS speaker_purity_check_verdict, trimmed AS speaker_purity_check_trimmed, emotion_primary AS omni_labels_emotion_primary,
    emotion_intensity AS omni_labels_emotion_intensity, text_verdict AS omni_labels_text_verdict, CASE WHEN kept THEN tier END AS selection_tier, CASE WHEN NOT kept THEN 'speaker_quota' END AS selection_reject_reason,
    round(selection_score, 6) AS selection_score, 's0,s1,s2,s3,s4,s5' AS pipeline_stages_passed FROM capped"""


@query("meta_flat", with_standins(LABELLED, FLAT))
def meta_flat(spark, sf_dir):
    return meta.flatten(record(spark, sf_dir)).withColumn("pipeline_stages_passed", F.concat_ws(",", "pipeline_stages_passed"))


@query("unflatten_roundtrip", with_standins(LABELLED, FLAT))
def unflatten_roundtrip(spark, sf_dir):
    return meta.flatten(meta.unflatten(meta_flat(spark, sf_dir)))


@query("meta_json")
def meta_json(spark, sf_dir):
    rows = record(spark, sf_dir)
    return rows.where("selection.tier IS NOT NULL").select("clip_id", meta.as_json(*rows.columns).alias("document"))


@query("release_meta_json")
def release_meta_json(spark, sf_dir):
    rows = tiered(spark, sf_dir)
    metrics = F.struct(*(meta.finite(F.col(m).cast("double")).alias(m) for m, _ in WEIGHTS))
    return rows.select("clip_id", "tier", meta.as_json("clip_id", "tier", "verdict", metrics.alias("metrics")).alias("document"))


@query("published_duration", with_standins("s0 s3", "SELECT clip_id, coalesce(CASE WHEN s3.trimmed THEN s3.trimmed_duration_s END, s0.duration_s, 0) AS duration FROM s0 JOIN s3 USING (clip_id)"))
def published_duration(spark, sf_dir):
    s0, s3 = standin(spark, sf_dir, "s0"), standin(spark, sf_dir, "s3")
    return s0.select("clip_id", "duration_s").join(s3.select("clip_id", "trimmed", "trimmed_duration_s"), "clip_id").select("clip_id", meta.published_duration().alias("duration"))


@query("dnsmos_agreement", with_standins("s0 s1", "SELECT count(*) AS n, round(corr(aes_pq, original_dnsmos), 6) AS r, round(avg(aes_pq - original_dnsmos), 6) AS mean_diff FROM s1 JOIN s0 USING (clip_id) WHERE original_dnsmos IS NOT NULL"))
def dnsmos_agreement(spark, sf_dir):
    both = standin(spark, sf_dir, "s1").join(standin(spark, sf_dir, "s0").select("clip_id", "original_dnsmos"), "clip_id")
    return reports.agreement(both, "aes_pq", "original_dnsmos").select("n", *r6("r", "mean_diff"))


@query("verdict_histogram", with_standins("s3", "SELECT verdict AS value, count(*) AS n FROM s3 WHERE verdict IS NOT NULL GROUP BY 1"))
def verdict_histogram(spark, sf_dir):
    return reports.histogram(standin(spark, sf_dir, "s3"), F.col("verdict"))


@query("emotion_histogram", with_standins("s4", "SELECT emotion_primary AS value, count(*) AS n FROM s4 WHERE emotion_primary IS NOT NULL GROUP BY 1"))
def emotion_histogram(spark, sf_dir):
    nested = standin(spark, sf_dir, "s4").select(F.struct(F.struct(F.col("emotion_primary").alias("primary")).alias("emotion")).alias("labels"))
    return reports.histogram(nested, F.col("labels.emotion.primary"))


@query("label_cost", with_standins("s0 s4", """WITH j AS (SELECT s4_status = 'ok' AS ok, regexp_matches(lower(coalesce(error, '')), '429|throttl|rate limit|ratelimit|too many requests') AS lim, coalesce(nullif(duration_s, 0), 8.0) AS d FROM s4 LEFT JOIN s0 USING (clip_id)),
    a AS (SELECT count(*) FILTER (ok) AS k, count(*) FILTER (NOT ok) AS f, count(*) FILTER (NOT ok AND lim) AS l, coalesce(sum(d) FILTER (ok), 0) AS s FROM j)
    SELECT k AS labels_ok, f AS labels_failed, l AS rate_limit_failures, round(CASE WHEN k + f > 0 THEN l / (k + f) ELSE 0 END, 4) AS rate_limit_rate, round(s * 25.0 + k * 900.0, 1) AS est_input_tokens, round(cast(k * 220.0 AS double), 1) AS est_output_tokens,
    round(cast((s * 25.0 + k * 900.0) / 1000.0 * 0.0008 + k * 220.0 / 1000.0 * 0.0020 AS double), 4) AS est_cost_usd FROM a"""))
def label_cost(spark, sf_dir):
    return reports.label_cost(standin(spark, sf_dir, "s4"), standin(spark, sf_dir, "s0"))


@query("pilot_rate", with_standins("s4", "SELECT count(*) FILTER (s4_status = 'ok') AS n_ok, count(*) FILTER (s4_status = 'ok' AND usable) AS n_usable, round(coalesce(count(*) FILTER (s4_status = 'ok' AND usable) / nullif(count(*) FILTER (s4_status = 'ok'), 0), 0), 6) AS pilot_rate FROM s4"))
def pilot_rate(spark, sf_dir):
    from timbre.operators.labels import pilot_rate as rate

    return rate(standin(spark, sf_dir, "s4")).select("n_ok", "n_usable", *r6("pilot_rate"))


# --- purity ---
LOW = f"cosine < {PURITY.min_cosine}"
RUNS = f"""isl AS (SELECT clip_id, n_windows, i, i - row_number() OVER (PARTITION BY clip_id ORDER BY i) AS g FROM win_cos WHERE {LOW}),
    runs AS (SELECT clip_id, min(i) AS run_start, max(i) AS run_end, max(i) - min(i) + 1 AS run_len FROM isl GROUP BY clip_id, g),
    longest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY clip_id ORDER BY run_len DESC, run_start) AS k FROM runs) WHERE k = 1)"""


@query("low_cosine_runs", with_standins("win_cos", f"WITH {RUNS} SELECT clip_id, run_start, run_end, run_len FROM runs"))
def low_cosine_runs(spark, sf_dir):
    return sequences.runs(standin(spark, sf_dir, "win_cos"), ["clip_id"], "i", F.col("cosine") < PURITY.min_cosine)


@query("longest_run", with_standins("win_cos", f"WITH {RUNS} SELECT clip_id, run_start, run_end, run_len FROM longest"))
def longest_run(spark, sf_dir):
    return sequences.longest_run(standin(spark, sf_dir, "win_cos"), ["clip_id"], "i", F.col("cosine") < PURITY.min_cosine)


@query("purity_verdict", with_standins("s0 win_cos", f"""WITH {RUNS}, w AS (SELECT clip_id, doc_id, max(n_windows) AS n, avg(cosine) AS mean_cos, min(cosine) AS min_cos FROM win_cos GROUP BY clip_id, doc_id),
    f AS (SELECT w.*, run_start AS a, run_end AS b, run_start * 0.75 AS rs, run_end * 0.75 + 1.5 AS re, w.n * 0.75 + 0.75 AS total, (doc_id * 53 % 100) / 100.0 AS conf FROM w LEFT JOIN longest USING (clip_id)),
    g AS (SELECT *, min_cos < 0.70 AND a IS NOT NULL AND NOT (a = 0 AND b = n - 1) AS part, a = 0 AS head, b = n - 1 AS tail FROM f),
    h AS (SELECT *, CASE WHEN head THEN re ELSE 0 END AS k0, CASE WHEN head THEN total ELSE rs END AS k1 FROM g),
    v AS (SELECT *, CASE WHEN n <= 1 THEN 'single' WHEN part AND (head OR tail) AND k1 - k0 >= 3.0 THEN 'intruded_trimmed' WHEN part THEN 'intruded_rejected'
        WHEN mean_cos < 0.80 AND conf < 0.45 THEN 'overlap_rejected' WHEN mean_cos < 0.80 OR min_cos < 0.70 THEN 'degraded_pass' ELSE 'single' END AS verdict FROM h)
    SELECT clip_id, verdict, verdict = 'intruded_trimmed' AS trimmed, round(cast(CASE WHEN verdict = 'intruded_trimmed' THEN k1 - k0 END AS double), 6) AS trimmed_duration_s, round(cast(CASE WHEN n > 1 AND part THEN (re - rs) * 1000.0 END AS double), 6) AS intrusion_span_ms FROM v"""))
def purity_verdict(spark, sf_dir):
    win = standin(spark, sf_dir, "win_cos")
    stats = win.groupBy("clip_id", "doc_id").agg(F.max("n_windows").alias("n_windows"), F.avg("cosine").alias("mean_win_cos"), F.min("cosine").alias("min_win_cos"))
    run = sequences.longest_run(win, ["clip_id"], "i", F.col("cosine") < PURITY.min_cosine)
    hop = PURITY.window_s * (1 - PURITY.overlap)
    run = run.select("clip_id", F.col("run_start").alias("run_first"), F.col("run_end").alias("run_last"), (F.col("run_start") * hop).alias("run_start_s"), (F.col("run_end") * hop + PURITY.window_s).alias("run_end_s"))
    rows = stats.join(run, "clip_id", "left").withColumns({"duration_s": F.col("n_windows") * hop + hop, "f0_tracker_confidence": (F.col("doc_id") * 53 % 100) / 100.0})
    return sequences.purity(rows, PURITY).select("clip_id", "verdict", "trimmed", *r6("trimmed_duration_s", "intrusion_span_ms"))


@query("sliding_windows", with_standins("s0", """WITH n AS (SELECT clip_id, duration_s AS d, greatest(0, cast(ceil(duration_s / 0.75) AS bigint) - 1) AS last FROM s0),
    w AS (SELECT clip_id, d, unnest(range(0, last + 1)) AS window_no FROM n)
    SELECT clip_id, window_no, round(cast(window_no * 0.75 AS double), 6) AS start_s, round(cast(least(window_no * 0.75 + 1.5, d) AS double), 6) AS end_s FROM w WHERE window_no = 0 OR least(window_no * 0.75 + 1.5, d) - window_no * 0.75 >= 0.75"""))
def sliding_windows(spark, sf_dir):
    out = sequences.sliding_windows(standin(spark, sf_dir, "s0"), "duration_s", PURITY.window_s, PURITY.overlap)
    return out.select("clip_id", "window_no", *r6("start_s", "end_s"))


@query("speech_rate", with_standins("raw_meta", """SELECT clip_id, round(CASE WHEN s > 0 THEN c / s WHEN d > 0 THEN c / d ELSE 0 END, 6) AS speech_rate_cps FROM
    (SELECT clip_id, length(regexp_replace(original_text, '\\s', '', 'g')) AS c, CASE WHEN doc_id % 9 = 0 THEN 0 ELSE coalesce(duration_s, 0) * 0.8 END AS s, coalesce(duration_s, 0) AS d FROM raw_meta)"""))
def speech_rate(spark, sf_dir):
    from timbre.functions.signal import speech_rate as rate
    from timbre.functions.text import visible_chars

    rows = standin(spark, sf_dir, "raw_meta")
    spoken = F.when(F.col("doc_id") % 9 == 0, 0.0).otherwise(F.coalesce("duration_s", F.lit(0.0)) * 0.8)
    return rows.select("clip_id", F.round(rate(visible_chars(F.col("original_text")), spoken, F.coalesce("duration_s", F.lit(0.0))), 6).alias("speech_rate_cps"))


# --- worklist files ---
MISSING = "doc_id % 6 = 0"
OFFSETS = f"{WORKLIST}, offs AS (SELECT clip_id, shard, priority_rank, lpad(cast(priority_rank // {SLICE} AS varchar), 5, '0') AS slice_id, row_number() OVER (PARTITION BY priority_rank // {SLICE} ORDER BY priority_rank) - 1 AS \"offset\" FROM ordered WHERE NOT ({MISSING}))"


def offsets(spark, sf_dir):
    return sampling.repack_offsets(worklist(spark, sf_dir), F.expr(MISSING))


@query("repack_offsets", with_standins(STAGES, f'WITH {OFFSETS} SELECT clip_id, slice_id, "offset" FROM offs'))
def repack_offsets(spark, sf_dir):
    return offsets(spark, sf_dir).select("clip_id", "slice_id", "offset")


@query("index_lookup", with_standins(STAGES, f'WITH {OFFSETS} SELECT o.clip_id, o.shard, x."offset" FROM ordered o LEFT JOIN offs x USING (clip_id)'))
def index_lookup(spark, sf_dir):
    index = offsets(spark, sf_dir).select("clip_id", "offset")
    return worklist(spark, sf_dir).select("clip_id", "shard").join(index, "clip_id", "left").select("clip_id", "shard", "offset")


@query("slice_scan", with_standins(STAGES, f'WITH {OFFSETS} SELECT clip_id, shard, "offset" FROM offs WHERE slice_id = \'00001\''))
def slice_scan(spark, sf_dir):
    return sampling.slice_rows(offsets(spark, sf_dir), "00001").select("clip_id", "shard", "offset")


@query("slice_tasks", with_standins(STAGES, f"WITH {WORKLIST} SELECT DISTINCT lpad(cast(priority_rank // {SLICE} AS varchar), 5, '0') AS slice_id FROM ordered"))
def slice_tasks(spark, sf_dir):
    return worklist(spark, sf_dir).select("slice_id").distinct().orderBy("slice_id")


@query("manifest_semi_join", with_standins(STAGES, f"WITH {JOINED}, {SCORED}, {TIERED} SELECT clip_id, tier FROM tiered WHERE clip_id IN (SELECT clip_id FROM s3 WHERE verdict = 'single')"))
def manifest_semi_join(spark, sf_dir):
    manifest = standin(spark, sf_dir, "s3").where("verdict = 'single'").select("clip_id")
    return tiered(spark, sf_dir).join(manifest, "clip_id", "left_semi").select("clip_id", "tier")


@query("regrouped_by_shard", with_standins("s2 s0", "WITH f AS (SELECT s2.clip_id, s0.shard, s2.doc_id % 101 * 100000 + s2.doc_id AS p FROM s2 JOIN s0 USING (clip_id)), g AS (SELECT *, min(p) OVER (PARTITION BY shard) AS m FROM f) SELECT clip_id, shard, row_number() OVER (ORDER BY m, p) - 1 AS regroup_rank FROM g"))
def regrouped_by_shard(spark, sf_dir):
    rows = standin(spark, sf_dir, "s2").select("clip_id", "doc_id").join(standin(spark, sf_dir, "s0").select("clip_id", "shard"), "clip_id")
    rows = rows.withColumn("p", F.col("doc_id") % 101 * 100000 + F.col("doc_id"))
    return sampling.first_seen_order(rows, "shard", "p").select("clip_id", "shard", "regroup_rank")


@query("funnel_counts", with_standins("s0 s1 s2 s3", " UNION ALL ".join(f"SELECT '{s}' AS stage, (SELECT count(*) FROM {t}) AS n_in, (SELECT count(*) FROM {t} WHERE {c}) AS n_out" for s, t, c in (("s0", "s0", "passed"), ("s1", "s1", "passed"), ("s3", "s3", "verdict IN ('single', 'intruded_trimmed', 'degraded_pass')")))))
def funnel_counts(spark, sf_dir):
    counts = []
    for stage, name, ok in (("s0", "s0", F.col("passed")), ("s1", "s1", F.col("passed")), ("s3", "s3", F.col("verdict").isin(*ELIGIBLE))):
        counts.append(standin(spark, sf_dir, name).agg(F.count("*").alias("n_in"), F.count_if(ok).alias("n_out")).select(F.lit(stage).alias("stage"), "n_in", "n_out"))
    return tasks.union_parts(*counts)


@query("labels_gate", """SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'missing_omni_labels' WHEN l.toxic = 1 THEN 'text_broken' WHEN l.quality = 0 THEN 'truncated_defect' END AS reject_reason FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def labels_gate(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    verdict = F.when(F.col("quality").isNull(), None).when(F.col("toxic") == 1, "broken").otherwise("match")
    rows = rows.select("doc_id", verdict.alias("text_verdict"), F.when(F.col("quality") == 0, F.array(F.lit("truncated_head"))).alias("defects"), F.lit("single").alias("verdict"))
    return rows.select("doc_id", gates.hard_constraint(RULE).alias("reject_reason"))
