"""Nested and flat records: flattening by path, rebuilding by prefix, JSON export."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Blocks of the published record; the longest prefix of a flat name wins.
BLOCKS = (
    ("acoustics",), ("acoustics", "aesthetics"), ("acoustics", "dnsmos_p835"), ("audio",), ("source",), ("prosody_dsp",),
    ("speaker",), ("speaker", "embedding_ref"), ("speaker", "purity_check"), ("omni_labels",), ("omni_labels", "emotion"),
    ("omni_labels", "prosody"), ("omni_labels", "context"), ("omni_labels", "language"), ("selection",), ("pipeline",),
)


def leaves(kind: T.StructType, path: tuple[str, ...] = ()) -> list[tuple[str, ...]]:
    """Paths of all leaves; lists are leaves."""
    out = []
    for f in kind.fields:
        out += leaves(f.dataType, (*path, f.name)) if isinstance(f.dataType, T.StructType) else [(*path, f.name)]
    return out


def flatten(df: DataFrame) -> DataFrame:
    """One column per leaf, its path joined by underscores; a null block gives null leaves."""
    return df.select(*(F.col(".".join(f"`{p}`" for p in path)).alias("_".join(path)) for path in leaves(df.schema)))


def split_name(name: str, blocks: Iterable[tuple[str, ...]] = BLOCKS) -> tuple[str, ...]:
    """The nested path of a flat name; what follows the block is one leaf."""
    fitting = [b for b in blocks if name.startswith("_".join(b) + "_")]
    if not fitting:
        return (name,)
    block = max(fitting, key=lambda b: len("_".join(b)))
    return (*block, name[len("_".join(block)) + 1 :])


def nested(columns: dict, prefix: tuple[str, ...] = ()) -> list[Column]:
    return [(F.struct(*nested(v, (*prefix, k))) if isinstance(v, dict) else v).alias(k) for k, v in columns.items()]


def unflatten(df: DataFrame, blocks: Iterable[tuple[str, ...]] = BLOCKS) -> DataFrame:
    """The nested record of flat columns; names outside all blocks stay on top."""
    tree: dict = {}
    for name in df.columns:
        *path, leaf = split_name(name, blocks)
        at = tree
        for p in path:
            at = at.setdefault(p, {})
        at[leaf] = F.col(f"`{name}`")
    return df.select(*nested(tree))


def published_duration() -> Column:
    """The trimmed duration of a trimmed clip, else the source's, else 0."""
    return F.coalesce(F.when(F.col("trimmed"), F.col("trimmed_duration_s")), F.col("duration_s"), F.lit(0.0))


def stages_passed(labelled: Column) -> Column:
    return F.when(labelled, F.array(*map(F.lit, ("s0", "s1", "s2", "s3", "s4", "s5")))).otherwise(F.array(*map(F.lit, ("s0", "s1", "s2", "s3", "s5"))))


def as_json(*columns: Column | str) -> Column:
    """A JSON document with null fields kept and text unescaped."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def finite(c: Column) -> Column:
    """Null for NaN and infinities, which JSON doesn't have."""
    return F.when(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), c)
