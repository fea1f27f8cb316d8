"""Hard negatives against all scores."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest

from timbre.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, anchor string, rank string, score string"


def mined(rows):
    some = [(i, [math.floor(256 * float(np.float32(x))) for x in v], (y + 1) % 10 if i % 7 == 0 else y) for i, v, y in rows if None not in (i, v, y) and all(x is not None and math.isfinite(x) for x in v)]
    anchors = {(i, tuple(v), y) for i, v, y in some if i % 100 == 0}
    found = Counter()
    for i, v, y in anchors:
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, z) for j, w, z in some)
        for s, j, z in [x for x in scored if x[2] == y and x[1] != i][:5]:
            fits = [(-t, k) for t, k, u in scored if u != y and 30 * -s <= 100 * -t <= 90 * -s][:10]
            found.update((i, j, r + 1, k, -s, t) for r, (t, k) in enumerate(fits))
    return found


def frame(spark, rows):
    return spark.createDataFrame([(i, v, y, "a", "b", "c") for i, v, y in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    unit = lambda: [rng.gauss(0, 0.4) for _ in range(8)]
    same = unit()
    found = [(k, unit(), rng.randrange(10)) for k in range(700)]
    found += [(k, same, k % 3) for k in range(700, 1000)]  # ties
    found += [(1100, None, 3), (1200, unit(), None), (None, unit(), 1), (1300, [*unit()[:7], None], 2), (1400, [*unit()[:7], float("nan")], 2), (1500, [*unit()[:7], float("inf")], 2)]
    found += [(1600, unit()[:5], 4), (1601, [], 4), (1700, [0.0] * 8, 5), (100, *found[100][1:]), (100, *found[100][1:]), (205, *found[205][1:]), (300, unit(), found[300][2])]
    return found


@pytest.mark.parametrize("rule", (hn.MineRule(), hn.MineRule(shard_rows=300, block_anchors=4, leaf_rows=8)))
def test_against_all_scores(spark, rows, rule):
    want = mined(rows)
    assert len(want) > 300 and Counter(map(tuple, hn.hard_negatives(frame(spark, rows), rule).collect())) == want


def test_empty_tables(spark, rows):
    assert hn.hard_negatives(frame(spark, rows).limit(0)).count() == 0
    assert hn.hard_negatives(frame(spark, [(1100, None, 3), (200, [1.0], 1)])).count() == 0


def test_great_vectors_take_no_part(spark):
    found = hn.hard_negatives(frame(spark, [(0, [1.0, 0.0], 1), (2, [1.0, 0.0], 2), (3, [3e38, 0.0], 2), (4, [0.8, 0.1], 3), (5, [0.5, 0.0], 3)])).collect()
    assert [(r.positive_id, r.negative_id) for r in found] == [(2, 4), (2, 5)]


def test_walk_is_in_order_and_lazy():
    rng = np.random.default_rng(1)
    x = np.floor(rng.normal(0, 3, (2000, 2)) * 50)
    tree = hn.VantageTree(np.arange(2000), np.arange(2000) % 10, x, 16)
    opened = []
    for _ in range(20):
        q = np.floor(rng.normal(0, 1, 2) * 50)
        stretch = tree.stretches(q[None])
        walk = hn.Walk(tree, q, stretch[0], tree.gaps(q[None] * stretch[:, None])[0], lambda s: tree.labels[s] != 3)
        opened.append(walk)
        scores = x @ q
        least, most = np.quantile(scores, [0.6, 0.7])
        got = hn.first_of(walk.nearest(least, most), 10)
        want = sorted((-s, i) for i, s in enumerate(scores) if least <= s <= most and i % 10 != 3)[:10]
        assert got == [(i, int(-s)) for s, i in want]
    assert sum(len(w.leaves) for w in opened) < 0.6 * len(opened) * sum(n[5] < 0 for n in tree.nodes)
