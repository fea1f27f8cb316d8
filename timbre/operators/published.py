"""The published record of a clip: one declared schema, from which the nested form, its flat columns and its JSON come."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from timbre.operators.meta import leaves, published_duration
from timbre.schemas import nested

# The record's fields.
RECORD = nested({
    "": "clip_id string, schema_version string",
    "audio": "path string, duration_s double, sample_rate int, channels int, loudness_lufs double",
    "source": "dataset string, dataset_version string, original_id string, original_text string, original_speaker string, original_dnsmos double, original_language string",
    "acoustics": {"aesthetics": "pq double, pc double, ce double, cu double", "dnsmos_p835": "sig double, bak double, ovrl double", "": "snr_db double, clipping_ratio double, bandwidth_hz double"},
    "prosody_dsp": "f0_mean_hz double, f0_std_st double, f0_range_st double, energy_std_db double, speech_rate_cps double, rate_var_cv double, pause_count long, pause_total_ms double, f0_tracker_confidence double, prosody_dsp_score double",
    "speaker": {
        "": "original_speaker string", "embedding_ref": "emb_file string, emb_row long", " ": "gender_pred string",
        "purity_check": "n_windows long, mean_win_cos double, min_win_cos double, f0_stability double, verdict string, intrusion_span_ms double, trimmed boolean",
    },
    "omni_labels": {
        "": "model string, prompt_version string, text_verdict string, text_fixed string, text_punctuated string, cer_vs_original double",
        "emotion": "primary string, secondary string, intensity int, confidence double", "prosody": "expressiveness int, speaking_style string, rhythm string, prominent_stress boolean",
        "context": "scenario string, register string, summary string", "language": "primary string, code_switch boolean, accent string", " ": "paralinguistic strings, defects strings, usable boolean",
    },
    "selection": "selection_score double, tier string, reject_reason string",
    "pipeline": "version string, stages_passed strings, processed_at string",
})
#: Columns of the joined stages that don't have the name of their leaf: by path.
COLUMNS = {
    "acoustics.aesthetics": "aes_{}", "acoustics.dnsmos_p835": "dnsmos_{}", "omni_labels.emotion": "emotion_{}", "omni_labels.prosody": "prosody_{}", "omni_labels.context": "context_{}", "omni_labels.language": "language_{}",
}
NAMES = {"omni_labels.model": "s4_model", "omni_labels.prompt_version": "s4_prompt_version"}


@dataclass(frozen=True)
class Release:
    """What all records of a release share."""

    dataset: str
    dataset_version: str
    version: str
    processed_at: str
    schema_version: str = "1.3"
    sample_rate: int = 24000
    channels: int = 1
    loudness_lufs: float = 0.0
    audio_ext: str = "flac"


def labelled() -> Column:
    return F.col("text_verdict").isNotNull() & F.col("emotion_primary").isNotNull()


def fixed(release: Release) -> dict[str, Column]:
    """Leaves that aren't columns of the joined stages, and the values of those that may lack one."""
    text = lambda name: F.coalesce(name, F.lit(""))
    none = F.array().cast("array<string>")
    stages = ["s0", "s1", "s2", "s3"]
    return {
        "schema_version": F.lit(release.schema_version), "audio.path": F.concat("clip_id", F.lit(f".{release.audio_ext}")), "audio.duration_s": published_duration(), "audio.sample_rate": F.lit(release.sample_rate), "audio.channels": F.lit(release.channels),
        "audio.loudness_lufs": F.coalesce("loudness_lufs", F.lit(release.loudness_lufs)), "source.dataset": F.lit(release.dataset), "source.dataset_version": F.lit(release.dataset_version),
        **{f"source.{n}": text(n) for n in ("original_id", "original_text", "original_speaker", "original_language")},
        "speaker.original_speaker": text("original_speaker"), "speaker.embedding_ref.emb_file": text("emb_file"), "speaker.embedding_ref.emb_row": F.coalesce("emb_row", F.lit(-1)), "speaker.gender_pred": F.coalesce("gender_pred", F.lit("unknown")),
        "speaker.purity_check.trimmed": F.coalesce("trimmed", F.lit(False)),
        **{f"omni_labels.{n}": text(c) for n, c in (("model", "s4_model"), ("prompt_version", "s4_prompt_version"), ("text_fixed", "text_fixed"), ("text_punctuated", "text_punctuated"), ("context.summary", "context_summary"))},
        "omni_labels.language.primary": F.coalesce("language_primary", F.lit("zh")), "omni_labels.language.code_switch": F.coalesce("language_code_switch", F.lit(False)), "omni_labels.language.accent": F.coalesce("language_accent", F.lit("standard")),
        "omni_labels.paralinguistic": F.coalesce("paralinguistic", none), "omni_labels.defects": F.coalesce("defects", none), "omni_labels.usable": F.coalesce("usable", F.lit(False)),
        "selection.selection_score": F.coalesce("selection_score", F.lit(0.0)), "pipeline.version": F.lit(release.version), "pipeline.processed_at": F.lit(release.processed_at),
        "pipeline.stages_passed": F.when(labelled(), F.array(*map(F.lit, [*stages, "s4"]))).otherwise(F.array(*map(F.lit, stages))),
    }


def absent() -> dict[str, Column]:
    """Blocks that are null as a whole, and when."""
    return {"acoustics.dnsmos_p835": F.col("dnsmos_ovrl").isNull(), "omni_labels": ~labelled()}


def published_records(rows: DataFrame, release: Release) -> DataFrame:
    """Records of all rows, kept and rejected, of the declared schema.

    ``rows`` are joined stages with the columns of their tables, and tier,
    reject_reason and selection_score (null where a clip was no candidate).
    """
    values, missing = fixed(release), absent()

    def build(kind: T.StructType, path: str) -> list[Column]:
        out = []
        for f in kind.fields:
            place = f"{path}.{f.name}".lstrip(".")
            if isinstance(f.dataType, T.StructType):
                block = F.struct(*build(f.dataType, place))
                out.append((F.when(~missing[place], block) if place in missing else block).alias(f.name))
            else:
                value = values.get(place)
                value = F.col(NAMES.get(place, COLUMNS.get(path, "{}").format(f.name))) if value is None else value
                out.append(value.cast(f.dataType).alias(f.name))
        return out

    return rows.select(*build(RECORD, ""))


def flat_schema() -> T.StructType:
    """The declared schema's leaves as columns."""

    def kind(path: tuple[str, ...]) -> T.DataType:
        at: T.DataType = RECORD
        for p in path:
            at = at[p].dataType
        return at

    return T.StructType([T.StructField("_".join(p), kind(p)) for p in leaves(RECORD)])


def selected_rows(spine: DataFrame, candidates: DataFrame, key: str = "clip_id") -> DataFrame:
    """All rows of ``spine`` (with reject_reason of the hard constraints) with selection_score, tier and the final reason.

    ``candidates`` has key, selection_score, tier and kept of the rows that pass
    them; those that aren't kept are beyond their speaker's quota.
    """
    chosen = candidates.select(key, "selection_score", F.when(F.col("kept"), F.col("tier")).alias("tier"), (~F.col("kept")).alias("__over"))
    out = spine.join(chosen, key, "left")
    return out.withColumn("reject_reason", F.coalesce("reject_reason", F.when(F.col("__over"), "speaker_quota"))).drop("__over")


def selection_counts(records: DataFrame) -> DataFrame:
    """(n_rows, n_candidates, n_kept): all, those that passed the hard constraints, those with a tier."""
    reason = F.col("selection.reject_reason")
    return records.agg(F.count("*").alias("n_rows"), F.count_if(reason.isNull() | (reason == "speaker_quota")).alias("n_candidates"), F.count_if(F.col("selection.tier").isNotNull()).alias("n_kept"))
