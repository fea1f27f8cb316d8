"""Sharding by histogram sort: probe counts refine splitters, then one exchange.

Rows are ordered by (hash of the text, doc_id, a hash of the id's row). For
every splitter each round counts, over all partitions, the exact bytes and rows
below a set of candidate keys, and narrows the splitter's interval to the keys
that the candidates on either side of its target hold, until the bytes below it
meet the tolerance. Counts are summed by candidate, so the driver gets a table
whose size depends on the number of shards alone. Rows are exchanged once.

Equal texts are adjacent in that order and share a shard unless a splitter must
fall among them to keep sizes equal. Law: ``bytes``.

Edge cases: a null text has no bytes and a CRC-32 of 0; a null ``doc_id`` sorts
first among equal texts; rows that are alike in id and text are told apart by
their number within their task's input; with fewer rows than shards some shards
are empty; an empty table gives an empty result. Payload columns may be any.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from timbre.llm.common import checkpointed
from timbre.operators.scoring import numbered

SHARDS = 24
OVERHEAD = 8
KEYS = ("__k1", "__k2", "__k3")
WIDE = 8 * len(KEYS)
TOP = (1 << 8 * WIDE) - 1


@dataclass(frozen=True)
class SplitRule:
    """tolerance: allowed miss of a splitter, as a share of a shard; probes: candidates of a splitter in a round."""

    shards: int = SHARDS
    tolerance: float = 0.002
    probes: int = 48
    max_rounds: int = 40


def key_bytes(batch: pa.RecordBatch) -> np.ndarray:
    """The first three columns as fixed-width bytes that sort as the signed numbers do."""
    parts = []
    for i in range(len(KEYS)):
        n = batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)
        parts.append(n.astype(">u8").view(np.uint8).reshape(-1, 8))
    return np.ascontiguousarray(np.concatenate(parts, axis=1)).view(f"S{WIDE}").reshape(-1)


def as_bytes(keys: list[int]) -> np.ndarray:
    return np.array([k.to_bytes(WIDE, "big") for k in keys], f"S{WIDE}")


def counter(probes: list[int]) -> Callable:
    """Bytes, rows, least and greatest key of the rows between one probe and the next, by task."""
    edges = as_bytes(probes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(edges) + 1
        size, rows = np.zeros(n, np.int64), np.zeros(n, np.int64)
        low: dict[int, bytes] = {}
        high: dict[int, bytes] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = key_bytes(batch)
            at = np.searchsorted(edges, keys, side="right")
            np.add.at(size, at, batch.column(3).to_numpy())
            np.add.at(rows, at, 1)
            order = np.lexsort((keys, at))
            starts = np.flatnonzero(np.r_[True, np.diff(at[order]) > 0])
            for s, e in zip(starts, np.r_[starts[1:], len(order)]):
                cell = int(at[order[s]])
                a, b = (bytes(keys[order[i]]).ljust(WIDE, b"\0") for i in (s, e - 1))
                low[cell], high[cell] = min(low.get(cell, a), a), max(high.get(cell, b), b)
        used = np.flatnonzero(rows)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(size[used]), pa.array(rows[used]), pa.array([low[int(i)] for i in used], pa.binary()), pa.array([high[int(i)] for i in used], pa.binary())], names=["cell", "size", "n", "low", "high"])

    return count


def histogram(keyed: DataFrame, probes: list[int]) -> list[tuple[int, int, int, int]]:
    """(bytes, rows, least key, greatest key) of each cell; a row for each probe at most reaches the driver."""
    cells = keyed.select(*KEYS, "__size").mapInArrow(counter(probes), "cell int, size long, n long, low binary, high binary")
    found = {r.cell: r for r in cells.groupBy("cell").agg(F.sum("size").alias("size"), F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")).collect()}
    return [(r.size, r.n, int.from_bytes(r.low, "big"), int.from_bytes(r.high, "big")) if (r := found.get(i)) else (0, 0, 0, 0) for i in range(len(probes) + 1)]


def between(low: int, high: int, n: int) -> list[int]:
    """At most ``n`` keys spread evenly over (low, high]."""
    return sorted({low + (high - low) * i // n for i in range(1, n + 1)} - {low})


def splitters(keyed: DataFrame, parts: int, rule: SplitRule) -> tuple[list[int], int]:
    """``parts - 1`` keys; a part holds the keys from its splitter up to the next. And the sum of bytes."""
    [(total, rows, low, high)] = histogram(keyed, [])
    if not rows:
        return [TOP] * (parts - 1), 0
    targets = [total * i / parts for i in range(1, parts)]
    slack = rule.tolerance * total / parts
    # interval (low, high] of each open splitter, with the bytes below its ends
    spans = {i: (low, high) for i in range(parts - 1)}
    best = {i: (abs(t), low) for i, t in enumerate(targets)}
    for _ in range(rule.max_rounds):
        if not spans:
            break
        probes = sorted({p for s in set(spans.values()) for p in between(*s, rule.probes if len(set(spans.values())) > 1 else rule.probes * parts)})
        if not probes:
            break
        cells = histogram(keyed, probes)
        below = np.cumsum([c[0] for c in cells])  # bytes below each probe, then the sum
        for i, (lo, hi) in list(spans.items()):
            k = int(np.searchsorted(below[:-1], targets[i], side="left"))  # the first probe with the target or more below it
            for j in (k - 1, k):
                if 0 <= j < len(probes):
                    best[i] = min(best[i], (abs(below[j] - targets[i]), probes[j]))
            size, n, least, most = cells[k]
            if best[i][0] <= slack or least == most or not n:
                del spans[i]  # met, or a single key whose either side has been weighed
                if best[i][0] > slack and n:
                    over = below[k] if k < len(below) else total
                    best[i] = min(best[i], (abs(over - size - targets[i]), least), (abs(over - targets[i]), most + 1))
            else:
                spans[i] = (least, most)
                best[i] = min(best[i], (abs(below[k] - targets[i]), min(most + 1, TOP)))
    return [int(x) for x in np.maximum.accumulate(np.array([best[i][1] for i in range(parts - 1)], object))], int(total)


def placer(edges: list[int]) -> Callable:
    marks = as_bytes(edges)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = np.searchsorted(marks, key_bytes(batch), side="right") if batch.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part, pa.int32())], names=[*batch.schema.names, "__shard"])

    return place


def sharded(rows: DataFrame, size: str, text_hash: str, doc_id: str, rule: SplitRule = SplitRule()) -> DataFrame:
    """``rows`` with ``shard`` and ``slot`` (gapless from 0 in each shard, in key order).

    The keys are written once to the shared folder, so that all rounds and the
    exchange see the same ones. The driver holds a cell for each probe of each
    splitter, whatever the number of rows. One range exchange brings the rows
    into key order, over as many tasks as they need; slots are places in it.
    """
    tie = F.xxhash64(F.monotonically_increasing_id())
    keyed = checkpointed(rows.select(F.col(text_hash).alias("__k1"), F.coalesce(F.col(doc_id), F.lit(-(1 << 63))).alias("__k2"), tie.alias("__k3"), F.col(size).alias("__size"), F.struct(*(F.col(f"`{c}`") for c in rows.columns)).alias("__row")))
    edges, _ = splitters(keyed, rule.shards, rule)
    kind = T.StructType([*(keyed.schema[k] for k in (*KEYS, "__row")), T.StructField("__shard", T.IntegerType())])
    placed = keyed.select(*KEYS, "__row").mapInArrow(placer(edges), kind)
    out = numbered(placed, [F.col(c) for c in ("__shard", *KEYS)], "__slot", by=["__shard"])
    return out.select("__row.*", F.col("__shard").alias("shard"), F.col("__slot").alias("slot"))


def shard_report(docs: DataFrame, rule: SplitRule = SplitRule()) -> DataFrame:
    """One row per document with its size, CRC-32, shard and slot."""
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select("doc_id", (F.octet_length(raw) + OVERHEAD).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"), F.xxhash64(raw).alias("hash"))
    out = sharded(rows, "size", "hash", "doc_id", rule)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
