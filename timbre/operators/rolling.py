"""Size-bounded shards: the sequential roll-over as a composition of block functions.

A shard takes rows in order and is closed by the row that brings it to ``cap``
bytes. What a block of rows does to the bytes held when it begins is a step
function of them: (shards closed, bytes held at its end). Such functions compose,
so blocks of blocks are worked out in parallel, level by level, and what each
block really begins with is handed down again (a parallel prefix). No task sees
more than a block's rows or ``FAN`` functions, however large a group is.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timbre.operators.scoring import numbered
from timbre.store import checkpointed

#: Shards that a block of rows holds, and blocks that a block of the next level holds.
SPAN, FAN = 16, 16
STEPS = "key string, block long, low long, closed long, held long, passes boolean"


@dataclass(frozen=True)
class Steps:
    """A block's function: from ``low[k]`` bytes on, up to the next one, ``closed[k]`` shards are closed and ``held[k]`` bytes are left.

    Where ``passes``, the bytes held at the beginning are added to those left.
    """

    low: np.ndarray
    closed: np.ndarray
    held: np.ndarray
    passes: np.ndarray

    def at(self, carry: np.ndarray | int) -> tuple:
        k = np.searchsorted(self.low, carry, "right") - 1
        return self.closed[k], np.where(self.passes[k], self.held[k] + carry, self.held[k])

    def then(self, other: Steps, cap: int) -> Steps:
        """This block, followed by the other."""
        closed, held = other.at(self.held)
        out = [(self.low[~self.passes], (self.closed + closed)[~self.passes], held[~self.passes], np.zeros((~self.passes).sum(), bool))]
        for k in np.flatnonzero(self.passes).tolist():  # at most one: too few bytes to close a shard
            end = int(self.low[k + 1]) if k + 1 < len(self.low) else cap
            moved, shift = other.low - self.held[k], self.held[k]
            ends = np.append(moved[1:], cap)
            meet = (ends > self.low[k]) & (moved < end)
            added = np.where(other.passes, other.held + shift, other.held)
            out.append((np.maximum(moved, self.low[k])[meet], other.closed[meet] + self.closed[k], added[meet], other.passes[meet]))
        low, closed, held, passes = (np.concatenate(x) for x in zip(*out))
        order = np.argsort(low, kind="stable")
        return Steps(low[order], closed[order], held[order], passes[order]).merged()

    def merged(self) -> Steps:
        """Equal neighbours as one step."""
        same = (self.closed[1:] == self.closed[:-1]) & (self.held[1:] == self.held[:-1]) & (self.passes[1:] == self.passes[:-1])
        keep = np.append(True, ~same)
        return Steps(self.low[keep], self.closed[keep], self.held[keep], self.passes[keep])


def closes(before: np.ndarray, after: np.ndarray, start: np.ndarray, cap: int) -> np.ndarray:
    """Row that closes the shard which begins with nothing at row ``start``; the number of rows if none does."""
    n = len(before)
    return np.where(start < n, np.searchsorted(after, before[np.minimum(start, n - 1)] + cap), n)


def block_steps(sizes: np.ndarray, cap: int) -> Steps:
    """The function of a block of rows."""
    after = np.cumsum(sizes)
    before, n, total = after - sizes, len(sizes), int(after[-1])
    last = int(np.searchsorted(after, cap))  # the row that closes if nothing is held
    first = np.arange(min(last, n - 1), -1, -1)  # rows that close first, for rising bytes held
    low = np.maximum(0, cap - after[first])
    use = low < cap - before[first]  # rows without bytes never close
    first, low = first[use], low[use]
    start, closed, held = first + 1, np.ones(len(first), np.int64), np.zeros(len(first), np.int64)
    while (go := (end := closes(before, after, start, cap)) < n).any():
        closed, start = closed + go, np.where(go, end + 1, start)
    held = np.where(start < n, total - before[np.minimum(start, n - 1)], 0)
    if last == n:
        low, closed, held = np.append(0, low), np.append(0, closed), np.append(total, held)
    passes = np.zeros(len(low), bool)
    passes[:1] = last == n
    return Steps(low, closed, held, passes).merged()


def as_table(key: str, block: int, steps: Steps) -> pa.Table:
    n = len(steps.low)
    return pa.table({"key": pa.array([key] * n, pa.string()), "block": np.full(n, block, np.int64), "low": steps.low.astype(np.int64), "closed": steps.closed.astype(np.int64), "held": steps.held.astype(np.int64), "passes": steps.passes})


def functions_of(table: pa.Table) -> list[tuple[int, Steps]]:
    """(block, function) of the rows of several blocks, by block."""
    table = table.sort_by([("block", "ascending"), ("low", "ascending")])
    block, *columns = (table[c].to_numpy(zero_copy_only=False) for c in ("block", "low", "closed", "held", "passes"))
    cuts = np.flatnonzero(np.diff(block)) + 1
    parts = [np.split(c, cuts) for c in (block, *columns)]
    return [(int(b[0]), Steps(*rest)) for b, *rest in zip(*parts)]


def fold_rows(table: pa.Table, cap: int) -> pa.Table:
    table = table.sort_by("before")
    return as_table(table["key"][0].as_py(), table["block"][0].as_py(), block_steps(table["bytes"].to_numpy(), cap))


def fold_blocks(table: pa.Table, cap: int, fan: int) -> pa.Table:
    (block, whole), *others = functions_of(table)
    for _, steps in others:
        whole = whole.then(steps, cap)
    return as_table(table["key"][0].as_py(), block // fan, whole)


CARRIES = "key string, block long, carry long, base long"


def hand_down(carries: pa.Table, table: pa.Table) -> pa.Table:
    """What each block of a larger one begins with: bytes held, shards closed before."""
    (row,) = carries.to_pylist()
    carry, base, rows = row["carry"], row["base"], []
    for block, steps in functions_of(table):
        rows.append({"key": row["key"], "block": block, "carry": int(carry), "base": int(base)})
        closed, carry = steps.at(int(carry))
        base += int(closed)
    return pa.Table.from_pylist(rows, pa.schema([("key", pa.string()), ("block", pa.int64()), ("carry", pa.int64()), ("base", pa.int64())]))


def block_starts(carries: pa.Table, table: pa.Table, cap: int) -> pa.Table:
    """Places (bytes before them in the group) where shards begin inside a block."""
    (row,) = carries.to_pylist()
    table = table.sort_by("before")
    place, sizes = table["before"].to_numpy(), table["bytes"].to_numpy()
    after = np.cumsum(sizes)
    starts, need = [], cap - row["carry"]
    while (at := int(np.searchsorted(after, need))) < len(after):
        starts.append(int(place[at] + sizes[at]))
        need = int(after[at]) + cap
    return pa.Table.from_pylist([{"key": row["key"], "block": row["block"], "base": row["base"], "starts": starts}], pa.schema([("key", pa.string()), ("block", pa.int64()), ("base", pa.int64()), ("starts", pa.list_(pa.int64()))]))


def rollover(df: DataFrame, group: Sequence[str], order: Sequence[str], size: str, cap: int, span: int = SPAN, fan: int = FAN) -> DataFrame:
    """Adds shard_no, from 0 in each group: a shard is closed by the row that brings it to ``cap``.

    ``order`` must be total inside a group. Null and negative sizes count as 0;
    nulls in a group's columns are values like others; an empty frame stays empty.
    A task holds the sizes of the rows of ``span`` shards.
    """
    if cap < 1:
        raise ValueError("cap must be at least 1")
    own, before, key, block = "__bytes", "__before", "__key", "__block"
    rows = df.withColumn(own, F.greatest(F.coalesce(F.col(size).cast("long"), F.lit(0)), F.lit(0)))
    rows = numbered(rows, [F.asc(c) for c in (*group, *order)], before, weight=F.col(own), by=group)
    rows = rows.withColumns({key: F.to_json(F.struct(*group), {"ignoreNullFields": "false"}), block: F.floor(F.col(before) / (cap * span))})
    # rows without bytes have the place of the row that follows them, so one row stands for each place
    state = rows.groupBy(F.col(key).alias("key"), F.col(block).alias("block"), F.col(before).alias("before")).agg(F.sum(own).alias("bytes"))
    state = checkpointed(state)
    levels = [checkpointed(state.groupBy("key", "block").applyInArrow(lambda t: fold_rows(t, cap), STEPS))]
    while (levels[-1].agg(F.max("block")).first()[0] or 0) > 0:
        upper = levels[-1].groupBy("key", F.floor(F.col("block") / fan)).applyInArrow(lambda t: fold_blocks(t, cap, fan), STEPS)
        levels.append(checkpointed(upper))
    carries = levels[-1].select("key", "block").distinct().withColumns({"carry": F.lit(0).cast("long"), "base": F.lit(0).cast("long")})
    for lower in levels[-2::-1]:
        parts = lower.groupBy("key", F.floor(F.col("block") / fan))
        carries = carries.groupBy("key", "block").cogroup(parts).applyInArrow(lambda c, t: hand_down(c, t), CARRIES)
    starts = carries.groupBy("key", "block").cogroup(state.groupBy("key", "block")).applyInArrow(lambda c, t: block_starts(c, t, cap), "key string, block long, base long, starts array<long>")
    out = rows.join(starts.toDF("__k", "__b", "__base", "__starts"), (F.col(key) == F.col("__k")) & (F.col(block) == F.col("__b")))
    number = F.col("__base") + F.size(F.filter("__starts", lambda s: s <= F.col(before)))
    return out.select(*(f"`{c}`" for c in df.columns), number.cast("long").alias("shard_no"))

