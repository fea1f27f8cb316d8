"""Row types of the stage tables and the closed vocabularies of their enums."""

from __future__ import annotations

from pyspark.sql import types as T

# Vocabularies.
LANGUAGES = ("zh", "en", "other")
STAGES = ("s0", "s1", "s2", "s3", "s4", "s5", "none")
VERDICTS = ("single", "intruded_trimmed", "intruded_rejected", "overlap_rejected", "degraded_pass")
GENDERS = ("female", "male", "unknown")
TEXT_VERDICTS = ("match", "fixable", "broken")
EMOTIONS = ("neutral", "happy", "excited", "sad", "angry", "fearful", "surprised", "disgusted", "affectionate", "serious")
STYLES = ("narration", "conversational", "storytelling", "speech", "broadcast", "acting", "vlog", "interview")
RHYTHMS = ("steady", "varied", "dramatic")
SCENARIOS = ("podcast", "audiobook", "drama", "interview", "lecture", "vlog", "customer_service", "other")
REGISTERS = ("formal", "casual", "intimate")
ACCENTS = ("standard", "accented", "dialect")
EVENTS = ("laughter", "sigh", "crying", "breath_prominent", "filler_heavy", "disfluent")
DEFECTS = ("truncated_head", "truncated_tail", "artifact", "other")
TIERS = ("S", "A", "B")
LABEL_STATUS = ("ok", "failed")
RELEASE_TIERS = ("prime", "extended", "s3rejected")


def table(spec: str) -> T.StructType:
    """A type of comma-separated ``name kind`` pairs, all nullable."""
    kinds = {"string": T.StringType(), "double": T.DoubleType(), "long": T.LongType(), "int": T.IntegerType(), "boolean": T.BooleanType(), "strings": T.ArrayType(T.StringType())}
    return T.StructType([T.StructField(n, kinds[k]) for n, k in (x.split() for x in spec.split(",") if x.strip())])


def nested(blocks: dict) -> T.StructType:
    """A type of named blocks, each a list of fields or blocks again; the fields of unnamed ones ("", " ") stand between them."""
    out = []
    for name, inner in blocks.items():
        kind = nested(inner) if isinstance(inner, dict) else table(inner)
        out += [T.StructField(name, kind)] if name.strip() else kind.fields
    return T.StructType(out)


S0 = table("clip_id string, shard string, original_id string, original_speaker string, original_text string, original_language string, duration_s double, original_dnsmos double, dur_ok boolean, lang_ok boolean, dnsmos_ok boolean, text_ok boolean, passed boolean, reject_reason string")
S1 = table("clip_id string, shard string, aes_pq double, aes_pc double, aes_ce double, aes_cu double, dnsmos_sig double, dnsmos_bak double, dnsmos_ovrl double, snr_db double, clipping_ratio double, bandwidth_hz double, loudness_lufs double, passed boolean, reject_reason string")
S2 = table("clip_id string, shard string, f0_mean_hz double, f0_std_st double, f0_range_st double, energy_std_db double, speech_rate_cps double, rate_var_cv double, pause_count long, pause_total_ms double, f0_tracker_confidence double")
S3 = table("clip_id string, shard string, original_speaker string, emb_file string, emb_row long, gender_pred string, n_windows long, mean_win_cos double, min_win_cos double, f0_stability double, verdict string, intrusion_span_ms string, trimmed boolean, trimmed_duration_s double, trim_start_s double, trim_end_s double")
WORKLIST = table("clip_id string, source_shard string, original_text string, original_speaker string, duration_s double, aes_pq double, prosody_dsp_score double, norm_aesthetics_pq double, priority double, verdict string, trimmed boolean, trim_start_s double, trim_end_s double, priority_rank long, slice_id string")
REPACK_INDEX = table("clip_id string, shard string, offset long")
TASK_LOG = table("stage string, task_id string, status string, error string, ts_iso string")

#: Nested label document.
LABELS = T.StructType([
    T.StructField("text_verdict", T.StringType()),
    T.StructField("text_fixed", T.StringType()),
    T.StructField("text_punctuated", T.StringType()),
    T.StructField("emotion", T.StructType([T.StructField("primary", T.StringType()), T.StructField("secondary", T.StringType()), T.StructField("intensity", T.IntegerType()), T.StructField("confidence", T.DoubleType())])),
    T.StructField("prosody", T.StructType([T.StructField("expressiveness", T.IntegerType()), T.StructField("speaking_style", T.StringType()), T.StructField("rhythm", T.StringType()), T.StructField("prominent_stress", T.BooleanType())])),
    T.StructField("context", T.StructType([T.StructField("scenario", T.StringType()), T.StructField("register", T.StringType()), T.StructField("summary", T.StringType())])),
    T.StructField("language", T.StructType([T.StructField("primary", T.StringType()), T.StructField("code_switch", T.BooleanType()), T.StructField("accent", T.StringType())])),
    T.StructField("paralinguistic", T.ArrayType(T.StringType())),
    T.StructField("defects", T.ArrayType(T.StringType())),
    T.StructField("usable", T.BooleanType()),
])

S4 = T.StructType([*table("clip_id string, slice_id string, model string, prompt_version string, s4_status string, error string, cer_vs_original double").fields, T.StructField("labels", LABELS)])
