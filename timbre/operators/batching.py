"""Fixed-size batches of items across the rows of a task, with the rows' order kept.

Models want batches of one size; rows (clips) have any number of items (windows).
A task fills batches over the borders of its rows, hands each to the model, and
puts the results back where their items came from. Rows leave in the order in
which they came, without an exchange.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: A model takes a list of items and returns as many results; a factory makes it once for each task.
Model = Callable[[list], Sequence]
MODELS: dict[str, Callable[[], Model]] = {}


def model(name: str) -> Callable:
    """Registers a factory of models under a name."""

    def register(make: Callable[[], Model]) -> Callable[[], Model]:
        MODELS[name] = make
        return make

    return register


class Held:
    """A record batch whose rows wait for their results."""

    def __init__(self, batch: pa.RecordBatch, counts: list[int | None]):
        self.batch, self.results = batch, [None if n is None else [] for n in counts]
        self.left = sum(n or 0 for n in counts)


def in_batches(batches: Iterator[pa.RecordBatch], items: str, run: Model, size: int, kind: pa.DataType, result: str) -> Iterator[pa.RecordBatch]:
    waiting: deque[Held] = deque()
    places: list[list] = []  # the list that each item's result goes to, and the batch that waits for it
    taken: list = []

    def flush(n: int) -> None:
        nonlocal places, taken
        found = run(taken[:n])
        if len(found) != n:
            raise ValueError(f"the model returned {len(found)} results for {n} items")
        for (held, row), value in zip(places[:n], found):
            row.append(value)
            held.left -= 1
        places, taken = places[n:], taken[n:]

    def ready() -> Iterator[pa.RecordBatch]:
        while waiting and not waiting[0].left:
            held = waiting.popleft()
            yield pa.RecordBatch.from_arrays([*held.batch.columns, pa.array(held.results, pa.list_(kind))], names=[*held.batch.schema.names, result])

    for batch in batches:
        rows = batch.column(items)
        held = Held(batch, [len(r) if r.is_valid else None for r in rows])
        waiting.append(held)
        for row, out in zip(rows, held.results):
            for item in row.as_py() or ():
                taken.append(np.asarray(item) if isinstance(item, list) else item)
                places.append([held, out])
                if len(taken) == size:
                    flush(size)
        yield from ready()
    if taken:
        flush(len(taken))
    yield from ready()


def batched(df: DataFrame, items: str, result: str, kind: T.DataType, make: str | Callable[[], Model], size: int = 512) -> DataFrame:
    """Adds ``result``, an array of the model's results for the items of each row's array ``items``.

    ``make`` is a factory or the name of a registered one. A null array stays
    null; a row without items has no results. All batches but a task's last one
    have ``size`` items.
    """
    make = MODELS[make] if isinstance(make, str) else make
    arrow = to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return in_batches(batches, items, make(), size, arrow, result)

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(result, T.ArrayType(kind))]))


def window_slices(values: Column, width: int, hop: int) -> Column:
    """Windows of ``width`` values every ``hop``, the last partial one if it has half a window; a short array is one window, an empty one none."""
    starts = F.filter(F.sequence(F.lit(0), F.size(values) - 1, F.lit(hop)), lambda s: (s == 0) | (F.size(values) - s >= width / 2))
    return F.when(F.size(values) > 0, F.transform(starts, lambda s: F.slice(values, s + 1, F.least(F.lit(width), F.size(values) - s)))).otherwise(F.array().cast("array<array<float>>"))


def window_quality(df: DataFrame, values: str, make: str | Callable[[], Model], width: int, hop: int, low: float = 1.0, high: float = 5.0, size: int = 512) -> DataFrame:
    """Adds n_windows and quality: the mean of the model's scores of all windows, within [low, high]; null without windows."""
    names = [f.name for f in df.schema.fields]
    out = batched(df.withColumn("__windows", window_slices(F.col(values), width, hop)), "__windows", "__scores", T.DoubleType(), make, size)
    mean = F.aggregate("__scores", F.lit(0.0), lambda a, x: a + x) / F.nullif(F.size("__scores"), F.lit(0))
    return out.select(*names, F.size("__windows").cast("long").alias("n_windows"), F.when(mean.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), mean))).alias("quality"))


@model("loudness")
def loudness() -> Model:
    """A stand-in for a learned quality model: 1 and ten times the effective value of a window."""
    return lambda windows: [1.0 + 10.0 * float(np.sqrt(np.mean(np.square(w.astype(np.float64))))) for w in windows]
