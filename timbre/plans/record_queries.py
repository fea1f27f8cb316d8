"""Driver queries on the published record: all joined clips, kept and rejected, with all fields."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from timbre.operators import meta, published
from timbre.plans import clip_queries as clips
from timbre.plans.catalog import query
from timbre.plans.standins import modular, standin, with_standins
from timbre.sources import tables
from timbre.store import fresh_path

RELEASE = published.Release(dataset="stand-in", dataset_version="1", version="timbre-1", processed_at="2025-01-01T00:00:00Z")

#: Columns that the stand-in stages lack, as SQL that both engines read; those of labels are null without them.
MEASURES = {
    "original_id": "concat('o', cast(doc_id AS string))", "aes_cu": modular(3019, 3, 1, 9), "dnsmos_sig": modular(17, 1, 1, 5), "dnsmos_bak": modular(19, 2, 1, 5), "dnsmos_ovrl": f"CASE WHEN doc_id % 3 <> 0 THEN {modular(23, 3, 1, 5)} END",
    "loudness_lufs": f"CASE WHEN doc_id % 5 <> 0 THEN {modular(29, 4, -40, -10)} END", "f0_mean_hz": modular(31, 5, 80, 280), "pause_total_ms": modular(37, 6, 0, 3000), "emb_file": "CASE WHEN doc_id % 43 <> 0 THEN concat('emb-', shard, '.npy') END",
    "emb_row": "CASE WHEN doc_id % 43 <> 0 THEN doc_id % 1000 END", "gender_pred": "CASE WHEN doc_id % 6 = 0 THEN 'female' WHEN doc_id % 6 = 1 THEN 'male' END", "n_windows": "1 + doc_id % 9", "mean_win_cos": modular(41, 7, 0, 1), "min_win_cos": modular(47, 8, 0, 1),
    "f0_stability": modular(53, 9, 0, 1), "intrusion_span_ms": f"CASE WHEN trimmed THEN {modular(59, 1, 0, 4000)} END",
}
LABELS = {
    "s4_model": "'labeller'", "s4_prompt_version": "CASE WHEN doc_id % 2 = 0 THEN 'p1' END", "text_fixed": "original_text", "text_punctuated": "CASE WHEN doc_id % 4 <> 0 THEN concat(original_text, '.') END", "cer_vs_original": f"CASE WHEN doc_id % 9 <> 0 THEN {modular(61, 2, 0, 1)} END",
    "emotion_secondary": "CASE WHEN doc_id % 8 = 0 THEN 'sad' END", "emotion_confidence": modular(67, 3, 0, 1), "prosody_speaking_style": "'narration'", "prosody_rhythm": "CASE WHEN doc_id % 2 = 0 THEN 'steady' ELSE 'varied' END", "prosody_prominent_stress": "doc_id % 2 = 0",
    "context_scenario": "'lecture'", "context_register": "'casual'", "context_summary": "CASE WHEN doc_id % 3 = 0 THEN 'short' END", "language_primary": "CASE WHEN doc_id % 5 <> 0 THEN 'en' END", "language_code_switch": "CASE WHEN doc_id % 5 <> 1 THEN doc_id % 10 = 0 END", "language_accent": "CASE WHEN doc_id % 5 <> 2 THEN 'accented' END",
}
SIGHS = {"paralinguistic": "CASE WHEN doc_id % 6 = 0 THEN {} END"}


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All joined clips with all columns of their stages, and what selection decided."""
    rows = published.selected_rows(clips.constrained(spark, sf_dir), clips.capped(spark, sf_dir))
    s1 = standin(spark, sf_dir, "s1").select("clip_id", "snr_db", "clipping_ratio", "bandwidth_hz")
    raw = standin(spark, sf_dir, "raw_meta").select("clip_id", "original_text", "original_language", "original_dnsmos")
    rows = rows.join(s1, "clip_id").join(raw, "clip_id").join(standin(spark, sf_dir, "s4").select("clip_id", "usable"), "clip_id", "left")
    sigh = {c: F.expr(e.format("array('sigh', 'laughter')")) for c, e in SIGHS.items()}
    labels = {c: F.expr(f"CASE WHEN text_verdict IS NOT NULL THEN {e} END") for c, e in LABELS.items()}
    return rows.withColumns({c: F.expr(e) for c, e in MEASURES.items()} | labels | sigh)


def sql_leaves() -> dict[str, str]:
    """The SQL of each leaf over the wide rows."""
    shared = {"schema_version": RELEASE.schema_version, "source.dataset": RELEASE.dataset, "source.dataset_version": RELEASE.dataset_version, "pipeline.version": RELEASE.version, "pipeline.processed_at": RELEASE.processed_at}
    own = {k: f"'{v}'" for k, v in shared.items()} | {
        "audio.path": "concat(clip_id, '.flac')", "audio.duration_s": "coalesce(CASE WHEN trimmed THEN trimmed_duration_s END, duration_s, 0)", "audio.sample_rate": "cast(24000 AS int)", "audio.channels": "cast(1 AS int)", "audio.loudness_lufs": "coalesce(loudness_lufs, 0)",
        "speaker.embedding_ref.emb_row": "coalesce(emb_row, -1)", "speaker.gender_pred": "coalesce(gender_pred, 'unknown')", "speaker.purity_check.trimmed": "coalesce(trimmed, false)", "omni_labels.language.primary": "coalesce(language_primary, 'zh')",
        "omni_labels.language.code_switch": "coalesce(language_code_switch, false)", "omni_labels.language.accent": "coalesce(language_accent, 'standard')", "omni_labels.paralinguistic": "array_to_string(coalesce(paralinguistic, []), '|')", "omni_labels.defects": "array_to_string(coalesce(defects, []), '|')",
        "omni_labels.usable": "coalesce(usable, false)", "selection.selection_score": "round(coalesce(selection_score, 0), 6)", "pipeline.stages_passed": "CASE WHEN labelled THEN 's0|s1|s2|s3|s4' ELSE 's0|s1|s2|s3' END", "prosody_dsp.prosody_dsp_score": "round(prosody_dsp_score, 6)",
    }
    for place in ("source.original_id", "source.original_text", "source.original_speaker", "source.original_language", "speaker.original_speaker", "speaker.embedding_ref.emb_file", "omni_labels.text_fixed", "omni_labels.text_punctuated"):
        own[place] = f"coalesce({place.rsplit('.', 1)[1]}, '')"
    own |= {"omni_labels.model": "coalesce(s4_model, '')", "omni_labels.prompt_version": "coalesce(s4_prompt_version, '')", "omni_labels.context.summary": "coalesce(context_summary, '')"}
    out = {}
    for path in meta.leaves(published.RECORD):
        place, block = ".".join(path), ".".join(path[:-1])
        sql = own.get(place, published.COLUMNS.get(block, "{}").format(path[-1]))
        if path[0] == "omni_labels":
            sql = f"CASE WHEN labelled THEN {sql} END"
        elif block == "acoustics.dnsmos_p835":
            sql = f"CASE WHEN dnsmos_ovrl IS NOT NULL THEN {sql} END"
        out["_".join(path)] = sql
    return out


def shown(flat: DataFrame) -> DataFrame:
    """Lists as text, scores to six places."""
    out = []
    for f in flat.schema.fields:
        c = F.col(f.name)
        c = F.when(c.isNotNull(), F.concat_ws("|", c)) if isinstance(f.dataType, T.ArrayType) else F.round(c, 6) if f.name.endswith("_score") else c
        out.append(c.alias(f.name))
    return flat.select(*out)


EXTRA = ", ".join(f"{e.replace('AS string', 'AS varchar')} AS {c}" for c, e in MEASURES.items()) + ", " + ", ".join(f"CASE WHEN text_verdict IS NOT NULL THEN {e} END AS {c}" for c, e in LABELS.items()) + ", " + ", ".join(f"{e.format(chr(91) + repr('sigh') + ', ' + repr('laughter') + chr(93))} AS {c}" for c, e in SIGHS.items())
WIDE = f"""{clips.SPINE}, {clips.SELECTED}, {clips.CAPPED}, chosen_rows AS (SELECT spine.*, {clips.REASON} AS reason, c.selection_score, CASE WHEN c.kept THEN c.tier END AS tier, c.kept FROM spine LEFT JOIN (SELECT clip_id, selection_score, tier, kept FROM capped) c USING (clip_id)),
    joined_rows AS (SELECT chosen_rows.*, s1.snr_db, s1.clipping_ratio, s1.bandwidth_hz, raw_meta.original_text, raw_meta.original_language, raw_meta.original_dnsmos, s4.usable, coalesce(reason, CASE WHEN NOT kept THEN 'speaker_quota' END) AS reject_reason,
        text_verdict IS NOT NULL AND emotion_primary IS NOT NULL AS labelled FROM chosen_rows JOIN (SELECT clip_id, snr_db, clipping_ratio, bandwidth_hz FROM s1) s1 USING (clip_id) JOIN raw_meta USING (clip_id) LEFT JOIN (SELECT clip_id, usable FROM s4) s4 USING (clip_id)),
    wide AS (SELECT *, {EXTRA} FROM joined_rows)"""
# the same names come from several stages; DuckDB wants one of each
WIDE = WIDE.replace("JOIN raw_meta USING (clip_id)", "JOIN (SELECT clip_id, original_text, original_language, original_dnsmos FROM raw_meta) raw_meta USING (clip_id)")


@query("published_flat", with_standins("raw_meta s0 s1 s2 s3 s4", f"WITH {WIDE} SELECT {', '.join(f'{e} AS {c}' for c, e in sql_leaves().items())} FROM wide"))
def published_flat(spark, sf_dir):
    """The flat table of all joined clips, written with the declared schema and read back."""
    path = fresh_path(spark, "published")
    meta.flatten(published.published_records(wide(spark, sf_dir), RELEASE)).write.parquet(path)
    return shown(spark.read.schema(published.flat_schema()).parquet(path))


@query("published_counts", with_standins("raw_meta s0 s1 s2 s3 s4", f"WITH {WIDE} SELECT count(*) AS n_rows, count(*) FILTER (reject_reason IS NULL OR reject_reason = 'speaker_quota') AS n_candidates, count(tier) AS n_kept, count(tier) AS n_documents FROM wide"))
def published_counts(spark, sf_dir):
    """All rows, candidates and kept ones; as many documents are written as are kept."""
    path = fresh_path(spark, "documents")
    records = published.published_records(wide(spark, sf_dir), RELEASE)
    tables.write_documents(records, path)
    documents = spark.read.schema(published.RECORD).json(path).agg(F.count("*").alias("n_documents"))
    return published.selection_counts(records).crossJoin(F.broadcast(documents))
