"""Accept and reject decisions as columns: every number stays, thresholds are replayed."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timbre.config import AcousticGate, MetadataGate, SelectionRule
from timbre.functions.text import lowered, visible_chars


def joined_reasons(*reasons: Column) -> Column:
    """All reasons in order, joined by semicolons; null if there is none."""
    return F.nullif(F.concat_ws(";", *reasons), F.lit(""))


def metadata_gates(df: DataFrame, gate: MetadataGate) -> DataFrame:
    """Adds dur_ok, lang_ok, dnsmos_ok, text_ok, passed and reject_reason; a null duration becomes 0."""
    duration, quality = F.col("duration_s"), F.col("original_dnsmos")
    reasons = [
        F.when(duration.isNull(), "duration_missing").when(duration < gate.duration_min, "duration_short").when(duration > gate.duration_max, "duration_long"),
        F.when(~lowered(F.col("original_language")).isin(*gate.language), "language_not_target"),
        F.when(quality.isNull(), "dnsmos_missing").when(quality < gate.quality_min, "dnsmos_low"),
        F.when(visible_chars(F.col("original_text")) < gate.min_text_chars, "text_short"),
    ]
    flags = ["dur_ok", "lang_ok", "dnsmos_ok", "text_ok"]
    out = df.select("*", *(r.isNull().alias(f) for r, f in zip(reasons, flags)), joined_reasons(*reasons).alias("reject_reason"))
    return out.withColumns({"passed": F.col("reject_reason").isNull(), "duration_s": F.coalesce("duration_s", F.lit(0.0))})


def acoustic_limits(gate: AcousticGate) -> list[tuple[str, str, float]]:
    """(measure, comparison that rejects, threshold) in the order of reasons."""
    return [
        ("aes_pq", "<", gate.aes_pq_min),
        ("aes_pc", ">", gate.aes_pc_max),
        ("aes_ce", "<", gate.aes_ce_min),
        ("snr_db", "<", gate.snr_db_min),
        ("clipping_ratio", ">", gate.clipping_ratio_max),
        ("bandwidth_hz", "<", gate.bandwidth_hz_min),
    ]


def fails(name: str, sign: str, limit: float) -> Column:
    """True where the value is on the rejected side or missing."""
    value = F.col(name)
    return value.isNull() | ((value < limit) if sign == "<" else (value > limit))


def acoustic_gates(df: DataFrame, gate: AcousticGate) -> DataFrame:
    """Adds passed and reject_reason; reasons carry the threshold, as in ``aes_pq<7.0``."""
    reasons = [F.when(fails(*x), f"{x[0]}{x[1]}{x[2]}") for x in acoustic_limits(gate)]
    out = df.withColumn("reject_reason", joined_reasons(*reasons))
    return out.withColumn("passed", F.col("reject_reason").isNull())


def joint_gate(limits: Sequence[tuple[str, str, float]]) -> Column:
    """True where no limit rejects."""
    return reduce(lambda a, b: a & b, (~fails(*x) for x in limits))


def kill_counts(df: DataFrame, limits: Sequence[tuple[str, str, float]]) -> DataFrame:
    """(gate, killed, total, kill_rate) for every limit, counted in one pass."""
    one = df.agg(F.count("*").alias("total"), *(F.count_if(fails(*x)).alias(x[0]) for x in limits))
    rows = F.explode(F.array(*(F.struct(F.lit(f"{n}{s}{v}").alias("gate"), F.col(n).alias("killed")) for n, s, v in limits)))
    return one.select("total", rows.alias("x")).select("x.gate", "x.killed", "total", (F.col("x.killed") / F.greatest("total", F.lit(1))).alias("kill_rate"))


def survivors(df: DataFrame, verdicts: Sequence[str]) -> DataFrame:
    return df.where(F.col("s0_passed") & F.col("s1_passed") & F.col("verdict").isin(*verdicts))


def scope_filter(scope: str | None, top_only: bool = True) -> Column:
    """Rows of a publish scope: ``prime``, ``s3`` or ``s1``; unset falls back to ``top_only``."""
    scope = scope or ("prime" if top_only else "s3")
    known = {"prime": F.col("tier") == "prime", "s3": F.col("s3_eligible"), "s1": F.lit(True)}
    if scope not in known:
        raise ValueError(f"no such scope: {scope!r}; known are {', '.join(known)}")
    return known[scope]


def release_tier(eligible: Column, score: Column, cut: Column) -> Column:
    return F.when(~eligible, "s3rejected").when(score >= cut, "prime").otherwise("extended")


def hard_constraint(rule: SelectionRule) -> Column:
    """The first failing constraint, null if none fails."""
    defects = F.coalesce(F.col("defects"), F.array().cast("array<string>"))
    return (
        F.when(F.col("text_verdict").isNull(), "missing_omni_labels")
        .when(~F.col("text_verdict").isin(*rule.text_verdicts), "text_broken")
        .when(F.arrays_overlap(defects, F.array(*map(F.lit, rule.forbidden_defects))), "truncated_defect")
        .when(F.col("verdict").isNull() | ~F.col("verdict").isin(*rule.verdicts), "verdict_rejected")
    )
