"""Random strings among ten thousand documents, good documents that the ratio wasn't fitted on, and the ratio against literal counts."""

from __future__ import annotations

import os
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from timbre.llm import quality_rules

SF = "/root/testdata/sf0.1"


def noise(rng, k):
    if k % 2:
        return " ".join("".join(rng.choice("bcdfgxyz0189") for _ in range(7)) for _ in range(100))
    return " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 9))) for _ in range(100))


@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables aren't here")
def test_noise_goes_and_held_out_good_documents_stay(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rng = random.Random(9)
    more = spark.createDataFrame([(10**9 + k, noise(rng, k)) for k in range(40)], "doc_id long, text string")
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    out = quality_rules.quality_report(docs.unionByName(more).repartition(16), labels.where(half)).select("doc_id", "base_failed", "kept").collect()
    held = {r.doc_id for r in labels.where(~half & (F.col("quality") == 1)).collect()}
    assert not any(r.kept for r in out if r.doc_id >= 10**9)
    good = [r.kept for r in out if r.doc_id in held and not r.base_failed]
    assert len(good) > 1000 and sum(good) >= 0.95 * len(good)


def test_ends_of_words_against_counts(spark):
    rule = quality_rules.RatioRule(buckets=(1 << 12, 1 << 12), smoothing=(2.0, 3.0), min_words=2)
    rows = [(1, "running walking of Éan"), (2, "ab ing talking é naïve"), (3, "一二三四 xs x")]
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    orders = (lambda t: [w[-3:] for w in t.split()], lambda t: list(zip(t.split(), t.split()[1:])))
    want = defaultdict(list)
    for bag, s in zip(orders, rule.smoothing):
        raw, good = Counter(g for _, t in rows for g in bag(t)), Counter(bag(rows[0][1]))
        n, m, cells = sum(raw.values()), sum(good.values()), rule.buckets[0]
        for i, t in rows:
            want[i] += [np.log((good[g] + s * m / n) / (m + s * m / n * cells)) - np.log((raw[g] + s) / (n + s * cells)) for g in bag(t)]
    for r in quality_rules.quality_report(docs, labels, rule).collect():
        assert abs(r.mean_ratio - np.mean([np.round(x, 3) for x in want[r.doc_id]])) < 1e-3
