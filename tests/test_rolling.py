"""The roll-over by blocks against the fold row by row."""

from __future__ import annotations

import random

import numpy as np
import pytest

from timbre.operators import rolling


def fold(sizes, cap, held=0):
    number, out = 0, []
    for n in sizes:
        out.append(number)
        held += n
        if held >= cap:
            number, held = number + 1, 0
    return out, number, held


def some_sizes(rng, most):
    return np.array([rng.choice([0, 1, 2, 5, rng.randint(0, 40)]) for _ in range(rng.randint(1, most))])


def test_functions_of_blocks():
    rng = random.Random(1)
    for _ in range(400):
        cap, a, b = rng.randint(1, 30), some_sizes(rng, 25), some_sizes(rng, 10)
        one, two = rolling.block_steps(a, cap), rolling.block_steps(a, cap).then(rolling.block_steps(b, cap), cap)
        for carry in range(cap):
            for steps, sizes in ((one, a), (two, [*a, *b])):
                assert tuple(map(int, steps.at(carry))) == fold(sizes, cap, carry)[1:]


def test_rollover_counts_after_adding(spark):
    df = spark.createDataFrame([("t", i, n) for i, n in enumerate([5, 5, 3, 20, 1, 9, 9])], "tier string, i int, size long")
    out = [r.shard_no for r in rolling.rollover(df, ["tier"], ["i"], "size", 10).orderBy("i").collect()]
    assert out == [0, 0, 1, 1, 2, 2, 3]


@pytest.mark.parametrize("cap, span, fan", ((10, 2, 2), (25, 16, 16), (10**6, 4, 4)))
def test_rollover_of_groups(spark, cap, span, fan):
    """Null groups and sizes, rows without bytes, rows larger than a shard, one level and several."""
    rng = random.Random(cap)
    rows = [(g, i, rng.choice([None, -4, 0, 1, 3, 7, 50 if i % 9 == 0 else 2]), "x") for g in ("a", None, "b") for i in range(300)] + [("zeros", i, 0, "x") for i in range(40)]
    df = spark.createDataFrame(rows, "g string, i long, size long, key string").repartition(4)
    out = rolling.rollover(df, ["g"], ["i"], "size", cap, span, fan)
    got = {(r.g, r.i): r.shard_no for r in out.collect()}
    assert out.columns == [*df.columns, "shard_no"] and len(got) == len(rows)
    for g in ("a", None, "b", "zeros"):
        mine = [max(0, s or 0) for h, _, s, _ in rows if h == g]
        assert [got[g, i] for i in range(len(mine))] == fold(mine, cap)[0]
    assert rolling.rollover(df.limit(0), ["g"], ["i"], "size", cap).count() == 0
    with pytest.raises(ValueError):
        rolling.rollover(df, ["g"], ["i"], "size", 0)
