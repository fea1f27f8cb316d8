"""Periodic runs against all periods tried one by one."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import pytest

from timbre.llm import periodic_runs

WORDS = re.compile("[^\x20\x09-\x0d]+")


def all_runs(w, least=12):
    found = []
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i + q - s >= max(least, 2 * q) and not any(all(w[k] == w[k + r] for k in range(s, i + q - r)) for r in range(1, q)):
                found.append((s, i + q - s, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def samples(rng, n):
    for _ in range(n):
        w = [rng.randrange(rng.choice((1, 2, 2, 3, 5))) for _ in range(rng.randint(0, 60))]
        if w and rng.random() < 0.5:
            s, p = rng.randrange(len(w)), rng.randint(1, 12)
            w = [w[i] if i < s else w[s + (i - s) % min(p, len(w) - s)] for i in range(len(w))]
        yield w + w[: rng.randint(0, len(w))] if rng.random() < 0.3 else w


@pytest.mark.parametrize("least", (2, 5, 12))
def test_runs_against_all_periods(least):
    for w in samples(random.Random(least), 500):
        assert periodic_runs.runs_of(w, least) == all_runs(w, least)


def test_runs_with_colliding_hashes(monkeypatch):
    monkeypatch.setattr(periodic_runs, "PRIMES", (7, 11))
    monkeypatch.setattr(periodic_runs, "DIRECT", 1)
    for w in samples(random.Random(3), 300):
        assert periodic_runs.runs_of(w) == all_runs(w)


def test_long_texts():
    assert periodic_runs.runs_of(["a"] * 50_000) == [(0, 50_000, 1)]
    assert periodic_runs.runs_of([k % 9001 for k in range(60_000)]) == [(0, 60_000, 9001)]
    rng = random.Random(1)
    line = [rng.randrange(4000) for _ in range(500)]
    assert periodic_runs.runs_of([w for k in range(60) for w in (*line, f"end {k}")]) == []


def report(doc_id, text):
    w = WORDS.findall(text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and w:
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    runs = all_runs(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    digests = [hashlib.sha256(x.encode()).hexdigest() for x in ("".join(f"{s},{n},{q}\n" for s, n, q in runs), " ".join(x for i, x in enumerate(w) if i not in gone))]
    return (doc_id, len(runs), *(top or (None,) * 3), 1000 * top[1] // top[2] if top else None, *digests)


def test_report(spark):
    rng = random.Random(11)
    texts = [" ".join(f"w{x}" for x in w) for w in samples(rng, 150)]
    rows = list(enumerate(texts)) + [(200, None), (201, ""), (202, " \n\t\x0b\r"), (None, "a b " * 9), (None, None), (5, texts[5]), (5, texts[5])]
    rows += [(300 + k, sep.join(["é", "x\u00a0y", "z\u2028"] * 7)) for k, sep in enumerate((" ", "\n", "\t\t", "\x1c ", "\x0c"))] + [(400, "one two three " * 2000)]
    docs = spark.createDataFrame([(i, t, "s", "r") for i, t in rows], "doc_id long, text string, start string, runs string").repartition(3)
    assert Counter(map(tuple, periodic_runs.run_report(docs).collect())) == Counter(report(*r) for r in rows)
    assert periodic_runs.run_report(docs.limit(0)).count() == 0
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i in range(150)) > 5


def test_word_runs(spark):
    got = periodic_runs.word_runs(spark.createDataFrame([(1, "s  go left go left\ngo left go left go left go left go on")], "doc_id long, text string")).first()
    assert [tuple(r) for r in got.runs] == [(1, 13, 2)] and got.collapsed == "s go left on"
