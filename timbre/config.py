"""Typed configuration: frozen sections with defaults, a YAML overlay, unknown keys rejected."""

from __future__ import annotations

from dataclasses import dataclass, field, fields, is_dataclass, replace
from typing import Any


@dataclass(frozen=True)
class MetadataGate:
    duration_min: float = 3.0
    duration_max: float = 30.0
    language: tuple[str, ...] = ("zh",)
    quality_min: float = 3.2
    min_text_chars: int = 4


@dataclass(frozen=True)
class AcousticGate:
    """Least or greatest accepted value of each measure."""

    aes_pq_min: float = 7.0
    aes_pc_max: float = 2.5
    aes_ce_min: float = 5.0
    snr_db_min: float = 20.0
    clipping_ratio_max: float = 0.001
    bandwidth_hz_min: float = 4000.0


@dataclass(frozen=True)
class ProsodyWeights:
    f0_std_st: float = 0.30
    f0_range_st: float = 0.20
    energy_std_db: float = 0.15
    speech_rate_cps: float = 0.10
    rate_var_cv: float = 0.15
    pause_count: float = 0.10

    def items(self) -> list[tuple[str, float]]:
        return [(f.name, getattr(self, f.name)) for f in fields(self)]


@dataclass(frozen=True)
class PurityRule:
    window_s: float = 1.5
    overlap: float = 0.5
    embedding_dim: int = 192
    min_cosine: float = 0.70
    mean_cosine: float = 0.80
    poor_confidence: float = 0.45
    min_residual_s: float = 3.0


@dataclass(frozen=True)
class LabelRule:
    slice_size: int = 5000
    max_attempts: int = 5
    backoff_cap_s: float = 60.0
    concurrency: int = 16
    pilot_rate: float = 0.60
    two_pass: bool = False


@dataclass(frozen=True)
class SelectionRule:
    w_quality: float = 0.35
    w_prosody: float = 0.25
    w_expression: float = 0.30
    w_enjoyment: float = 0.10
    top_fraction: float = 0.20
    min_intensity: int = 3
    max_plain_expressiveness: int = 2
    plain_emotions: tuple[str, ...] = ("neutral",)
    text_verdicts: tuple[str, ...] = ("match", "fixable")
    forbidden_defects: tuple[str, ...] = ("truncated_head", "truncated_tail")
    verdicts: tuple[str, ...] = ("single", "intruded_trimmed")
    speaker_cap: int | None = None


@dataclass(frozen=True)
class ReleaseRule:
    survivor_verdicts: tuple[str, ...] = ("single", "intruded_trimmed", "degraded_pass")
    top_fraction: float = 0.40
    priority: str = "prosody_dsp_score * norm_aesthetics_pq"
    scope: str | None = None
    shard_bytes: int = 1 << 30


@dataclass(frozen=True)
class Config:
    metadata: MetadataGate = field(default_factory=MetadataGate)
    acoustic: AcousticGate = field(default_factory=AcousticGate)
    prosody: ProsodyWeights = field(default_factory=ProsodyWeights)
    purity: PurityRule = field(default_factory=PurityRule)
    label: LabelRule = field(default_factory=LabelRule)
    selection: SelectionRule = field(default_factory=SelectionRule)
    release: ReleaseRule = field(default_factory=ReleaseRule)


def overlay(section: Any, values: dict[str, Any]) -> Any:
    """``section`` with ``values``; a key that it doesn't have raises ``ValueError``."""
    known = {f.name for f in fields(section)}
    if unknown := sorted(set(values) - known):
        raise ValueError(f"unknown configuration keys: {', '.join(unknown)}")
    changed = {}
    for name, value in values.items():
        now = getattr(section, name)
        if is_dataclass(now):
            value = overlay(now, value or {})
        elif isinstance(now, tuple):
            value = tuple(value)
        changed[name] = value
    return replace(section, **changed)


def load_config(path: str) -> Config:
    """The configuration of a YAML file laid over the defaults."""
    import yaml

    with open(path, encoding="utf-8") as f:
        return overlay(Config(), yaml.safe_load(f) or {})
