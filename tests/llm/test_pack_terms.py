"""Terms of many pieces at once against one piece after the other, and how often they are worked out."""

from __future__ import annotations

from types import SimpleNamespace

import numpy as np
import pyarrow as pa

from timbre.llm import retrieval_pack


def some_pieces(n=1300):
    rng = np.random.default_rng(5)
    return [rng.integers(0, rng.choice([3, 40, 49_000]), rng.choice([0, 1, 2, 5, 400])).astype("<u2") for _ in range(n)]


def test_leading_terms_and_frequencies():
    pieces, size = some_pieces(), 49_000
    idf = np.maximum(np.round(np.random.default_rng(6).normal(1, 2, size)), 0.0)  # many equal and many of no weight
    batch = pa.RecordBatch.from_arrays([*(pa.array(range(len(pieces)), pa.int64()) for _ in range(4)), pa.array([p.tobytes() for p in pieces], pa.binary())], names=["piece", "salt", "doc_id", "doc_tokens", "rest"])
    (got,) = retrieval_pack.leading_terms(SimpleNamespace(value=(idf, 1.0)))(iter([batch]))
    for p, *found in zip(pieces, *(got.column(k).to_pylist() for k in (4, 5, 6))):
        terms, counts = np.unique(p, return_counts=True)
        weight = idf[terms] * np.log1p(counts)
        want = [int(terms[k]) for k in np.argsort(-weight, kind="stable")[:3] if weight[k] > 0]
        assert found == want + [-1] * (3 - len(want))
    wholes = pa.array([[np.unique(p).tobytes()] * (k % 3) if k % 5 else [] for k, p in enumerate(pieces)], pa.list_(pa.binary()))
    (rows,) = retrieval_pack.frequency_counter(size, 2048)(iter([pa.RecordBatch.from_arrays([batch.column(4), wholes], names=["rest", "wholes"])]))
    want = np.zeros(size, np.int64)
    for k, p in enumerate(pieces):
        want[np.unique(p)] += 1 + (k % 3 if k % 5 else 0)
    counts = dict(zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()))
    n = sum(k % 3 for k in range(len(pieces)) if k % 5)
    assert counts.pop(-1) == len(pieces) + n and counts.pop(-2) == sum(map(len, pieces)) + 2048 * n
    assert counts == {int(t): int(want[t]) for t in np.flatnonzero(want)}


def test_leading_terms_are_worked_out_once(spark, monkeypatch):
    seen, real = spark.sparkContext.accumulator(0), retrieval_pack.leading_terms

    def counted(sent):
        inner = real(sent)

        def run(batches):
            for b in inner(batches):
                seen.add(b.num_rows)
                yield b

        return run

    monkeypatch.setattr(retrieval_pack, "leading_terms", counted)
    docs = spark.createDataFrame([(k, f"word{k % 9} and number {k} of a text") for k in range(90)], "doc_id long, text string").repartition(3)
    out = retrieval_pack.packed_pieces(docs)
    assert out.select("doc_id").distinct().count() == 90 and seen.value == 90
