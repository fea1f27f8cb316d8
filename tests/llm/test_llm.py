"""Training-data operators against brute force on small fixtures, with their edge cases."""

from __future__ import annotations

import hashlib
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from timbre.llm import histogram_shard, html_text, line_dedup, media_tiff, order_minhash, quality_rules, queries, retrieval_pack, secret_scan, source_mix, warc_archive

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()
DOCS = "doc_id long, text string, lang string, source string, n_chars long, row string, kept string, drop string"


def document(rng, n, words=WORDS):
    return " ".join(rng.choice(words) + str(rng.randint(0, 60)) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    """Copies, near copies, shared lines, nulls, empties, a long text, repeated rows, clashing columns."""
    rng = random.Random(7)
    texts = [document(rng, rng.randint(60, 140)) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)]
    near = texts[0].split()
    for k in range(12):
        w = list(near)
        w[5 + k] = "changed"
        rows.append((100 + k, " ".join(w)))
    rows += [(200 + k, texts[1]) for k in range(8)]
    rows += [(300 + k, "A shared line of some length\n" + texts[20 + k] + "\n a SHARED line of some length\t") for k in range(10)]
    rows += [(400, None), (401, ""), (402, " \n\t\n"), (403, "short"), (None, texts[2]), (None, None), (5, texts[5]), (5, texts[5]), (404, document(rng, 9000)), (405, "é" * 3), (406, "####&&& " * 80)]
    full = [(i, t, "en", None if n % 17 == 3 else f"s{min(n % 5, 2)}", len(t or ""), "x", "y", "z") for n, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, DOCS).repartition(5).cache()


@pytest.fixture(scope="module")
def labels(spark, docs):
    rows = [(i, int(i != 406), 0) for i in (0, 1, 2, 3, 7, 9, 11, 20, 406)] + [(None, 1, 0), (3, None, None)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def empty(spark, docs):
    return spark.createDataFrame([], docs.schema)


# --- quality rules ---


def word_rules(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    seen, repeats = set(), 0
    for line in text.split("\n"):
        if line.strip(" \t\n\x0b\x0c\r"):
            repeats += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeats, len(covered), failed


def test_quality_rules(spark, docs, labels):
    out = quality_rules.quality_report(docs, labels).collect()
    texts = {(r.doc_id, r.text) for r in docs.collect()}
    assert len(out) == docs.count()
    want = Counter((i, *word_rules(t)) for i, t in texts for _ in range(docs.where(F.col("doc_id").eqNullSafe(i) & F.col("text").eqNullSafe(t)).count()))
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in out) == want
    assert not any(r.kept for r in out if r.base_failed)
    kept = quality_rules.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in out)
    assert quality_rules.quality_report(empty(spark, docs), labels).count() == 0
    none = quality_rules.quality_report(docs, labels.where("false")).collect()
    assert all(r.mean_ratio == 0.0 and r.kept != r.base_failed for r in none)


def test_quality_ratio_against_counts(spark):
    rule = quality_rules.RatioRule(buckets=(1 << 12, 1 << 12), smoothing=(2.0, 3.0), min_words=2)
    rows = [(1, "a b a c"), (2, "a d d e"), (3, "x y x z")]
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    orders = (lambda t: t.split(), lambda t: list(zip(t.split(), t.split()[1:])))
    want = defaultdict(list)
    for bag, s in zip(orders, rule.smoothing):
        raw, good = Counter(g for _, t in rows for g in bag(t)), Counter(bag(rows[0][1]))
        n, m, cells = sum(raw.values()), sum(good.values()), rule.buckets[0]
        for i, t in rows:  # two multinomials, the trusted one smoothed at the corpus rate
            want[i] += [np.log((good[g] + s * m / n) / (m + s * m / n * cells)) - np.log((raw[g] + s) / (n + s * cells)) for g in bag(t)]
    for r in quality_rules.quality_report(docs, labels, rule).collect():
        assert abs(r.mean_ratio - np.mean([np.round(x, 3) for x in want[r.doc_id]])) < 1e-3


def test_quality_drops_random_strings(spark, docs):
    rng = random.Random(9)
    prose = [(1000 + i, document(rng, 90)) for i in range(200)]
    noise = [(5000 + i, " ".join("".join(rng.choice("bcdfgxyz0189") for _ in range(7)) for _ in range(100))) for i in range(5)]
    rows = spark.createDataFrame(prose + noise, "doc_id long, text string")
    good = spark.createDataFrame([(1000 + i, 1, 0) for i in range(0, 200, 2)], "doc_id long, quality int, toxic int")
    kept = {r.doc_id for r in quality_rules.quality_report(rows, good).where("kept").collect()}
    assert not any(i in kept for i, _ in noise) and sum(i in kept for i, _ in prose) > 190


# --- line dedup ---


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))


def test_line_dedup(spark, docs):
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    holders = defaultdict(set)
    for i, t in rows:
        if i is not None:
            for line in t.split("\n"):
                if len(key(line)) >= 10:
                    holders[key(line)].add(i)
    want = Counter()
    for i, t in rows:
        lines = t.split("\n")
        kept = [x for x in lines if i is None or len(key(x)) < 10 or len(holders[key(x)]) < 2 or min(holders[key(x)]) == i]
        want[(i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest())] += 1
    assert Counter(map(tuple, line_dedup.line_report(docs).collect())) == want
    out = line_dedup.drop_repeated_lines(docs)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    assert all(r.n_chars == len(r.text) for r in out.where("text IS NOT NULL").collect())
    assert line_dedup.line_report(empty(spark, docs)).count() == 0


def duck(path, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}/{table}.parquet'")
    return con.execute(queries.ORACLE_SQL[name]).to_arrow_table()


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_against_sql(spark, name):
    path = "/root/testdata/sf0.001"
    out, want = queries.QUERIES[name](spark, path), duck(path, name)
    assert sorted(out.columns) == sorted(want.column_names)
    names = sorted(out.columns)
    assert Counter(tuple(r[c] for c in names) for r in out.collect()) == Counter(tuple(r[c] for c in names) for r in want.to_pylist())


def test_filters_merge_exactly():
    rng = np.random.default_rng(1)
    cells = 1 << 16
    seen = [rng.integers(0, 1 << 62, 300, dtype=np.uint64) for _ in range(3)]
    seen[2][:50] = seen[0][:50]
    once, twice = np.zeros(cells, bool), np.zeros(cells, bool)
    for h in seen:
        a = np.zeros(cells, bool)
        a[np.unique(line_dedup.cells_of(h, cells))] = True
        twice |= once & a
        once |= a
    assert twice[line_dedup.cells_of(seen[0][:50], cells)].all()
    assert twice[line_dedup.cells_of(seen[1], cells)].all(axis=1).mean() < 0.01


# --- near copies ---


def test_near_classes(spark, docs):
    texts = {}
    for r in docs.where("doc_id IS NOT NULL").collect():
        texts[r.doc_id] = [w for w in re.split("[\x20\x09-\x0d]+", r.text or "") if w]
    grams = {i: Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) for i, w in texts.items()}
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in texts:
        for b in texts:
            if a < b:
                both = sum((grams[a] & grams[b]).values())
                if both >= 0.8 * (sum(grams[a].values()) + sum(grams[b].values()) - both):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    out = order_minhash.near_classes(docs).collect()
    assert {r.doc_id: r.class_id for r in out if r.doc_id is not None} == {i: find(i) for i in texts}
    assert sum(r.doc_id is None for r in out) == 2 and all(r.class_id is None for r in out if r.doc_id is None)
    one = order_minhash.keep_one(docs)
    assert one.columns == docs.columns
    assert sorted(r.doc_id for r in one.where("doc_id IS NOT NULL").collect()) == sorted({find(i) for i in texts})
    assert order_minhash.near_classes(empty(spark, docs)).count() == 0


def test_banded_alignment_against_table():
    rng = random.Random(3)
    for _ in range(400):
        a, b = ([rng.randint(0, 6) for _ in range(rng.randint(0, 14))] for _ in range(2))
        band = rng.randint(0, 6)
        best = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1, j + 1] = max(best[i, j + 1], best[i + 1, j], best[i, j] + 1 if x == y and abs(i - j) <= band else 0)
        got = order_minhash.matched_kmers(a, b, band)
        # equal ends are matched before the band is laid
        assert got >= best[-1, -1] and got <= order_minhash.matched_kmers(a, b, 99)
        full = order_minhash.matched_kmers(a, b, 99)
        best = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1, j + 1] = max(best[i, j + 1], best[i + 1, j], best[i, j] + (x == y))
        assert full == best[-1, -1]


def test_order_matters():
    rule = order_minhash.NearRule()
    rng = random.Random(1)
    words = document(rng, 300).split()
    a, b = order_minhash.kmers_of(words, 5), order_minhash.kmers_of(words[150:] + words[:150], 5)
    assert not order_minhash.similar(a, b, 0.8) and order_minhash.similar(a, a, 0.8)
    same = sum(x == y for x, y in zip(order_minhash.buckets_of(a, rule), order_minhash.buckets_of(b, rule)))
    assert same < rule.sketches


def test_near_copies_around_a_shared_passage(spark):
    """Pairs whose shared buckets are all headed by an unlike text of the same passage."""
    rng = random.Random(5)
    passage, texts = document(rng, 50), {}
    for i in range(300):
        own = document(rng, 10, ["w" + str(rng.random())]).split()
        own = [f"{w}x{rng.random()}" for w in own]
        texts[2 * i] = f"{passage} {' '.join(own)}"
        texts[2 * i + 1] = f"{passage} {' '.join([*own[:5], *(f'y{rng.random()}' for _ in range(5))])}"
    order = list(texts)
    rng.shuffle(order)
    ids = {k: n for n, k in enumerate(order)}
    rows = spark.createDataFrame([(ids[k], t) for k, t in texts.items()], "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in order_minhash.near_classes(rows).collect()}
    assert got == {ids[k]: min(ids[k], ids[k ^ 1]) for k in texts}


# --- mixing ---


def scheduled(rows, share, frame, block):
    """The whole schedule by a literal queue: (doc_id, slot, position) with each source's documents in the given order."""
    queues = {s: [ids[i : i + block] for i in range(0, len(ids), block)] for s, ids in rows.items()}
    out, slot, done = [], 0, dict.fromkeys(queues, 0)
    slots = {}
    while len(slots) < frame:
        ready = [s for s in share if done[s] * frame // share[s] <= slot]
        s = min(ready, key=lambda s: (-(-(done[s] + 1) * frame // share[s]), s))
        slots[slot] = (s, done[s])
        done[s] += 1
        slot += 1
    placed = []
    for s, blocks in queues.items():
        turns = {turn: at for at, (name, turn) in slots.items() if name == s}
        placed += [(j // share[s] * frame + turns[j % share[s]], s, b) for j, b in enumerate(blocks)]
    for slot, s, b in sorted(placed):
        out += [(i, slot) for i in b]
    return out


def test_mix(spark, docs):
    rule = source_mix.MixRule(block_rows=3, weights={"s0": 1, "s1": 2, "s2": 5})
    out = sorted(source_mix.mix_report(docs, rule).collect(), key=lambda r: r.position)
    assert [r.position for r in out] == list(range(docs.count()))
    assert Counter(r.doc_id for r in out) == Counter(r.doc_id for r in docs.collect())
    assert all(r.release <= r.slot < r.deadline for r in out)
    blocks = sorted({(r.slot, r.source) for r in out})
    assert len({s for s, _ in blocks}) == len(blocks)
    share, frame = {r.source: r.share for r in out}, out[0].frame
    assert sum(share.values()) == frame
    target = {"": 1 / 9, "s0": 1 / 9, "s1": 2 / 9, "s2": 5 / 9}
    assert all(abs(share[s] / frame - target[s]) < 1 / frame for s in share)
    # the literal schedule over each source's documents in the order that the operator gives them
    order = defaultdict(list)
    for r in out:
        order[r.source].append(r.doc_id)
    assert [(r.doc_id, r.slot) for r in out] == scheduled(order, share, frame, 3)
    # less than one block off the target in every prefix until a source has run out
    on, served = {r.slot for r in out if r.on_target}, Counter()
    for slot, source in blocks:
        if slot not in on:
            break
        served[source] += 1
        assert all(abs(served[s] - (slot + 1) * share[s] / frame) < 1 for s in share)
    mixed = source_mix.mix_sources(docs, rule)
    assert mixed.columns == docs.columns and mixed.count() == docs.count()
    assert source_mix.mix_report(empty(spark, docs), rule).count() == 0
    nameless = docs.select(F.lit(None).cast("long").alias("doc_id"), "source")
    assert sorted(r.position for r in source_mix.mix_report(nameless, rule).collect()) == list(range(docs.count()))


def test_mix_of_many_sources(spark):
    """600 sources, one of which is to have nine tenths of the mix; the frame grows until the least weight is a slot."""
    rows = [(i, "big") for i in range(4000)] + [(4000 + i, f"s{i % 599}") for i in range(1200)]
    weights = {"big": 0.9} | {f"s{i}": 0.1 / 599 for i in range(599)}
    out = source_mix.mix_report(spark.createDataFrame(rows, "doc_id long, source string"), source_mix.MixRule(block_rows=2, weights=weights)).toPandas().sort_values("position")
    assert list(out.position) == list(range(len(rows))) and out.frame.iloc[0] >= 5990
    big = (out.source == "big").cumsum()
    for n in (500, 1000, 2000):
        assert abs(big.iloc[n - 1] / n - 0.9) < 0.01
    assert ((out.release <= out.slot) & (out.slot < out.deadline)).all()


# --- packing ---


def test_packing(spark, docs):
    rule = retrieval_pack.PackRule(shard_docs=40)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out = retrieval_pack.packed_pieces(docs, rule).collect()
    by = defaultdict(list)
    for r in out:
        by[r.doc_id].append(r)
    for i, t in {(r.doc_id, r.text) for r in docs.collect()}:
        if i is None or i == 5:
            continue
        ids, at = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], 0
        for r in sorted(by[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    assert sum(r.length for r in by[5]) == 3 * by[5][0].doc_tokens  # three equal rows
    full = defaultdict(int)
    for r in sorted(out, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == full[r.sequence_id] and r.length > 0
        full[r.sequence_id] += r.length
    assert max(full.values()) <= 2048 and sum(n < 2048 for n in full.values()) <= 3
    assert retrieval_pack.packed_pieces(empty(spark, docs), rule).count() == 0


def packed_literally(rows, rule):
    """The whole packing by dictionaries: (doc_id, start, length, sequence_id, offset)."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = [(i, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]) for i, t in rows]
    cut = lambda ids: len(ids) // 2048 * 2048
    units = [ids[k : k + 2048] for _, ids in texts for k in range(0, cut(ids), 2048)] + [ids[cut(ids) :] for _, ids in texts]
    held, n, mean = Counter(t for u in units for t in set(u)), len(units), sum(map(len, units)) / len(units)
    idf = {t: max(0.0, np.log((n - c + 0.5) / (c + 0.5))) for t, c in held.items()}

    def key(i, ids):
        bag = Counter(ids[cut(ids) :])
        best = sorted((-idf[t] * np.log1p(c), t) for t, c in bag.items() if idf[t] > 0)[:3]
        terms = [t for _, t in best] + [-1] * (3 - len(best))
        return (*terms, zlib.crc32(np.array(ids, "<u2").tobytes()), i, len(ids))

    texts = sorted(texts, key=lambda x: key(*x))
    out = []
    for shard in range(0, len(texts), rule.shard_docs):
        part, sequence = texts[shard : shard + rule.shard_docs], shard // rule.shard_docs << 40
        for i, ids in part:
            for k in range(0, cut(ids), 2048):
                out.append((i, k, 2048, sequence, 0))
                sequence += 1
        spans = [[cut(ids), len(ids)] for _, ids in part]
        bags = [Counter(ids[a:b]) for (_, ids), (a, b) in zip(part, spans)]
        while open_ := [k for k, (a, b) in enumerate(spans) if a < b]:
            seed, room, offset = open_[0], 2048, 0
            score = lambda k: sum(idf[t] * bags[k][t] * 2.2 / (bags[k][t] + 1.2 * (0.25 + 0.75 * sum(bags[k].values()) / mean)) for t in bags[seed] if sum(t in b for b in bags) > 1)  # noqa: E731, B023
            ranked = sorted(((-round(score(k), 9), k) for k in open_[1:] if round(score(k), 9) > 0))
            follow = [seed, *(k for _, k in ranked), *(k for k in open_ if k != seed and k not in {k for _, k in ranked})]
            for k in follow:
                take = min(room, spans[k][1] - spans[k][0])
                if take:
                    out.append((part[k][0], spans[k][0], take, sequence, offset))
                spans[k][0] += take
                room, offset = room - take, offset + take
            sequence += 1
    return out


def test_packing_against_literal(spark):
    rng = random.Random(8)
    pools = [[f"topic{k}word{j}" for j in range(40)] for k in range(5)]
    rows = [(i, " ".join(rng.choice(pools[rng.randint(0, 4)] if rng.random() < 0.2 else pools[i % 5]) for _ in range(rng.randint(20, 260)))) for i in range(90)]
    rows += [(100, None), (101, " ".join(rng.choice(pools[0]) for _ in range(3000))), (102, rows[3][1])]
    rule = retrieval_pack.PackRule(shard_docs=32)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(packed_literally(rows, rule))
    for parts in (1, 5):
        out = retrieval_pack.packed_pieces(frame.repartition(parts), rule).collect()
        assert sorted((r.doc_id, r.start, r.length, r.sequence_id, r.offset) for r in out) == want


def test_packing_in_a_given_order(spark):
    rng = random.Random(2)
    rows = [(i, document(rng, rng.randint(50, 200)), 1000 - i) for i in range(60)]
    out = retrieval_pack.packed_pieces(spark.createDataFrame(rows, "doc_id long, text string, place long").repartition(3), retrieval_pack.PackRule(shard_docs=10), "place").collect()
    for r in out:
        assert r.sequence_id >> 40 == (59 - r.doc_id) // 10
    seeds = [r.doc_id for r in sorted(out, key=lambda r: r.sequence_id) if r.offset == 0 and r.sequence_id >> 40 == 0 and r.start == 0]
    assert seeds[0] == 59


def test_encoder_equals_tokenizer():
    path = public_tokenizers.path("word_bpe_49k.json")
    whole, fast = Tokenizer.from_file(path), retrieval_pack.WordEncoder(path)
    odd = ["", " ", "Été ÀÉ İstanbul K ſ ǅ ß µ ª º ² ½ x² Ⅷ 日本語 😀 <|endoftext|> don't we'LL 'S ’s a b\x85c \xadsoft a_b 3.14 É'RE ﬁ ΣΑΣ é", "\n\n", "A" * 500, "a,b;c! (x) \"q\""]
    for text in odd:
        assert fast(text).tolist() == [*whole.encode(text, add_special_tokens=False).ids, 1]


def test_encoder_of_batches():
    """Distinct words, runs of marks, long and odd ones in batches, against the tokenizer; nothing stays in the worker."""
    path = public_tokenizers.path("word_bpe_49k.json")
    whole, fast = Tokenizer.from_file(path), retrieval_pack.WordEncoder(path)
    rng = random.Random(4)
    word = lambda k: "".join(rng.choice("etaoinshrdlucmfwypvbgkjqxzßéüñÀ") for _ in range(k)).title()
    texts = [" ".join(word(rng.randint(1, 14)) + rng.choice(["", "", ",", "'s", "...", "!!!\n", "12", " ", "日"]) for _ in range(200)) for _ in range(150)]
    texts += [None, "", "a" * 63, "b" * 64, "é" * 33, "ab" * 300, "!" * 200, "aaaa aaaaa <|endoftext|>\tx", *texts[:3]]
    tracemalloc.start()
    for got, text in zip(fast.batch(pa.array(texts)), texts, strict=True):
        assert got.tolist() == [*whole.encode(text or "", add_special_tokens=False).ids, 1]
    fast.batch(pa.array([" ".join(word(9) for _ in range(500))]))
    before = tracemalloc.get_traced_memory()[0]
    for _ in range(10):
        fast.batch(pa.array([" ".join(word(9) for _ in range(2000))]))
    kept = tracemalloc.get_traced_memory()[0] - before
    tracemalloc.stop()
    assert kept < 500_000  # 20,000 new words
    assert fast.batch(pa.array([], pa.string())) == []


def test_encoder_batches_are_bounded():
    texts = ["x" * n for n in (10, 3 << 20, 2 << 20, 9 << 20, 1, 1)] + [None] * 3000
    slices = [b.num_rows for b in retrieval_pack.bounded(pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"]), 0)]
    assert slices[:3] == [2, 1, 1] and sum(slices) == len(texts) and max(slices) <= retrieval_pack.BATCH


def test_bm25_order():
    rule = retrieval_pack.PackRule(window=10)
    pieces = [np.array(x, "<u2") for x in ([1, 2, 3, 4], [9, 9, 9], [1, 2, 3], [7, 7])]
    held = np.zeros(50, int)
    for p in pieces:
        held[np.unique(p)] += 1
    sequences = retrieval_pack.pack_shard(pieces, np.log1p((4 - held + 0.5) / (held + 0.5)), 3.0, rule)
    assert sequences[0] == [(0, 0, 4), (2, 0, 3), (1, 0, 3)] and sequences[1] == [(3, 0, 2)]


def test_line_filters_in_bits():
    """The filters against sets of cells, and no more memory than their bits and the segments of the output."""
    rng, cells = random.Random(6), 1 << 22
    texts = ["\n".join(f"a line with the number {rng.randint(0, 4000)}" for _ in range(rng.randint(0, 60))) for _ in range(150)]
    batch = pa.RecordBatch.from_arrays([pa.array([*range(149), None], pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    tracemalloc.start()
    before = tracemalloc.get_traced_memory()[0]
    got = {r["segment"][0].as_py(): (r["once"][0].as_py(), r["twice"][0].as_py()) for r in line_dedup.filter_builder(cells)(iter([batch]))}
    most = tracemalloc.get_traced_memory()[1] - before
    tracemalloc.stop()
    assert most < cells  # two filters of a byte for each cell would take twice that
    seen = Counter()
    for text in texts[:149]:
        seen.update({int(c) for c in line_dedup.cells_of(line_dedup.key_hashes(text), cells).ravel()})
    for which, least in ((0, 1), (1, 2)):
        found = {k * line_dedup.SEGMENT + int(c) for k, x in got.items() for c in np.flatnonzero(np.unpackbits(np.frombuffer(x[which], np.uint8)))}
        assert found == {c for c, n in seen.items() if n >= least}


def test_lines_drop_in_slices():
    rows = pa.RecordBatch.from_arrays([pa.array(range(1300)), pa.array(["some line of text\nb"] * 1300), pa.array([None, [line_dedup.digest_of(b"some line of text")]] * 650, pa.list_(pa.binary()))], names=["row", "text", "drop"])
    out = list(line_dedup._apply(iter([rows])))
    assert max(b.num_rows for b in out) == line_dedup.SLICE and sum(b.num_rows for b in out) == 1300
    assert [r for b in out for r in b.column(1).to_pylist()] == ["some line of text\nb", "b"] * 650


# --- secrets ---


def test_secrets(spark, docs):
    body = "a1B2" * 7 + "xy"
    good, bad = f"ghp_{body}{secret_scan.crc_tail(body)}", f"ghp_{body}AAAAAA"
    texts = ["", None, "token=secret=abcdefgh", 'PASSWD : "longenough1"', "api_key=short", "AKIA" + "A1" * 6, "AKIA" + "A" * 11, "f" * 32, "f" * 31, f"x {good} {bad} npm_{body}{secret_scan.crc_tail(body)}", "toKen=abcdefghij", "İ password=abcdefgh", "pAsSwOrD='12345678'"]
    out = {r.doc_id: r for r in secret_scan.secret_spans(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}

    def base(t):
        found = [(m.start(), 0, f"assign:{m.start()}:{m.end()}") for m in re.finditer(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t) if len(m[2]) >= 8]
        found += [(m.start(), 1, f"access:{m.start()}:{m.end()}") for m in re.finditer("AKIA[A-Z0-9]+", t) if m.end() - m.start() >= 16]
        found += [(m.start(), 2, f"hex:{m.start()}:{m.end()}") for m in re.finditer("[0-9a-f]+", t) if m.end() - m.start() >= 32]
        return ",".join(x[2] for x in sorted(found))

    for i, t in enumerate(texts):
        assert out[i].base_sha256 == hashlib.sha256(base(t or "").encode()).hexdigest(), t
    assert [x.split(":")[0] for x in out[9].spans.split(",")] == ["github", "npm"]
    assert secret_scan.secret_spans(docs).count() == docs.count() and secret_scan.secret_spans(empty(spark, docs)).count() == 0


# --- media ---


def test_tiff_round_trips():
    rng = np.random.default_rng(1)
    pages = [rng.integers(0, 5, (70, 33)).astype(np.uint8), rng.integers(0, 256, (3, 64)).astype(np.uint8)]
    for compression in (media_tiff.RAW, media_tiff.LZW, media_tiff.DEFLATE, media_tiff.PACKBITS):
        for predictor in (1, 2):
            for tile in (0, 16):
                for order in "<>":
                    back = media_tiff.read_pages(media_tiff.write_tiff(pages, compression, predictor, tile, order, strip_rows=32))
                    assert all((a == b).all() for a, b in zip(pages, back)) and len(back) == 2
    for n in (0, 1, 253, 254, 255, 5000, 20000):
        data = bytes(rng.integers(0, 256, n).astype(np.uint8))
        assert media_tiff.lzw_decode(media_tiff.lzw_encode(data), n) == data


def test_tiff_vectors():
    """Known streams, not of this encoder: the examples of the format's description."""
    packed = bytes.fromhex("FEAA0280002AFDAA0380002A22F7AA")
    assert media_tiff.packbits_decode(packed, 24) == bytes.fromhex("AAAAAA80002AAAAAAAAA80002A22AAAAAAAAAAAAAAAAAAAA")
    codes = [256, 7, 258, 8, 8, 258, 6, 6, 257]  # 7 7 7 8 8 7 7 6 6
    stream = int("".join(f"{c:09b}" for c in codes).ljust(88, "0"), 2).to_bytes(11, "big")
    assert media_tiff.lzw_decode(stream, 9) == bytes([7, 7, 7, 8, 8, 7, 7, 6, 6])


def test_tiff_broken_files(spark):
    """Any damage gives a row with the error, or samples; never a failed task."""
    rng = np.random.default_rng(2)
    page = rng.integers(0, 9, (40, 48)).astype(np.uint8)
    files = []
    for compression in (media_tiff.RAW, media_tiff.LZW, media_tiff.DEFLATE, media_tiff.PACKBITS):
        for tile in (0, 16):
            good = media_tiff.write_tiff([page, page], compression, 2, tile)
            files += [good[: len(good) * k // 7] for k in range(7)]
            for _ in range(60):
                bad = bytearray(good)
                for at in rng.integers(0, len(good), 3):
                    bad[at] = rng.integers(0, 256)
                files.append(bytes(bad))
            for width in (0, 1 << 31):
                bad = bytearray(good)
                at = bad.rfind(bytes((0, 1, 4, 0, 1, 0, 0, 0)))
                bad[at + 8 : at + 12] = int(width).to_bytes(4, "little")
                files.append(bytes(bad))
    files += [b"II*\0\0\0\0\0", b"MM\0*\0\0\0\x08\0\0\0\0\0\0", b"", b"\0" * 100]
    out = media_tiff.decode_pages(spark.createDataFrame(list(enumerate(map(bytearray, files))), "media_id long, content binary").repartition(4)).collect()
    assert {r.media_id for r in out} >= set(range(len(files) - 4)) - {i for i, f in enumerate(files) if f[4:8] == bytes(4)}
    assert all((r.error is None) != (r.samples is None) for r in out)


def test_media_query(spark, docs):
    out = media_tiff.media_features(docs).collect()
    want = Counter()
    for r in docs.collect():
        raw = (r.text or "").encode()
        payload = raw + bytes(64 - len(raw) % 64 if len(raw) % 64 or not raw else 0)
        want[(r.doc_id, len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))] += 1
    assert Counter((r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in out) == want
    files = spark.createDataFrame([(1, media_tiff.stored(bytes(64))), (2, b"II*"), (3, None)], "media_id long, content binary")
    rows = {r.media_id: r for r in media_tiff.decode_pages(files).collect()}
    assert rows[1].width == 64 and rows[2].error and rows[3].error


# --- sharding ---


@pytest.mark.parametrize("rule", [histogram_shard.SplitRule(), histogram_shard.SplitRule(shards=3)])
def test_sharding(spark, docs, rule):
    rows = docs.unionByName(spark.range(1000, 1400).select(F.col("id").alias("doc_id"), F.lit("one text many have").alias("text")), allowMissingColumns=True)
    out = histogram_shard.shard_report(rows, rule).toPandas()
    assert len(out) == rows.count()
    groups = out.groupby("shard")
    assert (groups.slot.max() + 1 == groups.size()).all() and (groups.slot.nunique() == groups.size()).all()
    sizes = groups["size"].sum().reindex(range(rule.shards), fill_value=0)
    assert sizes.max() - out["size"].sum() / rule.shards <= out["size"].max() + 1
    want = Counter((r.doc_id, len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in rows.collect())
    assert Counter((None if i != i else int(i), s, c) for i, s, c in zip(out.doc_id, out["size"], out.text_crc32)) == want
    assert histogram_shard.shard_report(empty(spark, docs), rule).count() == 0


def test_sharding_against_a_literal_sort(spark):
    """Rows lie in the order of their keys, and no other cut of that order is nearer to its target than the tolerance."""
    rng = random.Random(12)
    rows = [(i, "same text " * 30 if i % 4 == 0 else "x" * rng.randint(0, 400) + str(rng.randint(0, 50))) for i in range(1500)] + [(5000, "y" * 40_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    keys = {r.doc_id: r.h for r in docs.select("doc_id", F.xxhash64(F.col("text").cast("binary")).alias("h")).collect()}
    for rule in (histogram_shard.SplitRule(), histogram_shard.SplitRule(shards=3), histogram_shard.SplitRule(shards=7, probes=2)):
        out = sorted((r.shard, r.slot, r.doc_id, r["size"]) for r in histogram_shard.shard_report(docs, rule).collect())
        assert [x[2] for x in out] == [i for _, i in sorted((keys[i], i) for i, _ in rows)]
        sizes = np.array([x[3] for x in out])
        ends, total = np.concatenate([[0], np.cumsum(sizes)]), int(sizes.sum())
        for k in range(1, rule.shards):
            cut = sum(x[3] for x in out if x[0] < k)
            target = total * k / rule.shards
            assert abs(cut - target) <= max(rule.tolerance * total / rule.shards, np.abs(ends - target).min()) + 1e-6


# --- archives ---


def test_archive(spark):
    trap = "x\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:9>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.0\r\nContent-Length: 5\r\n\r\n"
    rows = [(1, None, trap), (2, "http://a/ b", None), (3, "u", "y" * 150), (4, "u", "y" * 150), (None, "u", "y" * 150), (4, "u", "y" * 150), (5, "u", "y" * 99), (6, "u", "y" * 99), (7, "u", "é" * 60), (8, "u", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = warc_archive.archive_round_trip(pages).collect()
    want = Counter()
    for i, _, h in rows:
        raw = (h or "").encode()
        first = 3 if i == 4 else None
        want[(i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if first else "response", first)] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in out) == want
    assert warc_archive.archive_round_trip(pages.where("false")).count() == 0


def test_archive_long_url(spark):
    long = "http://h/" + "x" * 100_000
    rows = [(i, long if i == 5 else f"http://h/{i}", f"page {i} " + "y" * 200 * (i > 7)) for i in range(10)] + [(10, "http://h/5", "page 5 "), (11, "http://h/c", "z" * 300), (12, long, "z" * 300)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    out = warc_archive.archive_round_trip(pages).collect()
    assert {(r.page_id, r.url, r.payload_bytes) for r in out} == {(i, u, len(h)) for i, u, h in rows} and len(out) == len(rows)
    assert next(r for r in out if r.page_id == 12).refers_to == 11


def test_archive_in_small_ranges(spark):
    """Ranges of 700 bytes: records and payloads that hold the magic span ranges, whole records of it stand in payloads."""
    rng = random.Random(6)
    fake = warc_archive.header_of(77, "u", b"abc", "0" * 64, None) + "abc" + warc_archive.ENDS
    rows = []
    for i in range(150):
        parts = [document(rng, rng.randint(0, 40)) for _ in range(3)]
        rows.append((i, f"http://h/{i}", warc_archive.MAGIC.join(parts) if i % 7 == 0 else fake.join(parts) if i % 7 == 1 else parts[0]))
    rows += [(200, "x", "WARC/1.0"), (201, "x", "WARC/1.0\r\n"), (202, "x", "WARC/1.WARC/1.0\r\nWARC/1."), (203, "y" * 3000, "é" * 2000), (204, "z", "\r\n\r\n" * 30)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string").repartition(2)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        out = warc_archive.archive_round_trip(pages).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    want = Counter((i, len(h.encode()), hashlib.sha256(h.encode()).hexdigest(), u) for i, u, h in rows)
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.url) for r in out) == want


# --- pages ---


def test_main_text_structure():
    page = html_text.blocks_of('<body><header>Top</header><div class="cookie-notice">We use</div><main><header><h1>Tit&amp;le</h1></header><p>One <b>two</b>three<p>Four<ul><li>a<li>b</ul><section id="comments"><p>nice</p></section></main><aside>x</aside><div class="post-content">Body<script>var t="</p>";</script></div><footer>f</footer>')
    assert page.text() == "Tit&le One twothree Four a b Body"
    assert html_text.blocks_of("").text() == "" and html_text.blocks_of("<p>a<br>b  c&nbsp;d").text() == "a b c d"


def test_common_lines_against_table():
    rng = random.Random(1)
    for _ in range(500):
        a, b = ([rng.choice("abcde") for _ in range(rng.randint(0, 10))] for _ in range(2))
        best = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1, j + 1] = max(best[i, j + 1], best[i + 1, j], best[i, j] + (x == y))
        found, rest = html_text.common_lines(a, b), iter(b)
        assert len(found) == best[-1, -1] and all(any(y == a[i] for y in rest) for i in found)


def differenced_literally(rows):
    """{(page_id, url): text} by a walk over all pages in order, with the lines of the parser."""
    parts = [(i, u, re.match(r"^(?:[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*))?([^?#]*)", u or ""), html_text.blocks_of(h or "").lines) for i, u, h in rows]
    parts = [((m[1] or "").lower(), m[2].rstrip("/"), i, u, lines) for i, u, m, lines in parts]
    parts.sort(key=lambda x: (x[0], x[1], x[2] is not None, x[2] or 0, x[3] is not None, x[3] or ""))

    def steps(a, b):
        n = 0
        for x, y in zip(a.split("/"), b.split("/")):
            if x != y:
                break
            n += 1
        return n

    out = {}
    for k, (host, path, i, u, lines) in enumerate(parts):
        near = [(steps(path, parts[j][1]), k - j, parts[j][4]) for j in (k - 1, k + 1) if 0 <= j < len(parts) and parts[j][0] == host and [x.text for x in parts[j][4]] != [x.text for x in lines]]
        gone = set()
        if near:
            other = [x.text for x in max(near, key=lambda x: x[:2])[2]]
            shared = html_text.common_lines([x.text for x in lines], other)
            plain = [n for n in shared if lines[n].sort == html_text.PLAIN_LINE]
            prose = {n for n in plain if len(lines[n].text.split(" ")) >= 12}
            if not (prose and 2 * sum(len(lines[n].text) for n in plain) > sum(len(x.text) for x in lines if x.sort == html_text.PLAIN_LINE)):
                prose = set()
            gone = {n for n in shared if lines[n].sort != html_text.CONTENT_LINE and n not in prose}
        out[i, u] = " ".join(x.text for n, x in enumerate(lines) if n not in gone and x.sort != html_text.MARKED_LINE), len(gone)
    return out


def test_page_differencing(spark):
    rng = random.Random(4)
    shell = "<div>Welcome to our site</div><nav>Home<br>News</nav><div>{}</div><div>Follow us on every channel</div>"
    rows = [(i, f"http://h/x/{i}", shell.format(f"The story number {i} has words of its own, quite a few of them in fact")) for i in range(4)]
    rows += [(10, "http://h/y", "<article>Welcome to our site</article><div>Welcome to our site</div>"), (11, None, None), (None, "http://h/x/9", ""), (12, "http://k/", shell.format("alone"))]
    rows += [(20 + k, f"https://M/{k}?p=1", shell.format(" ".join(f"same{j}" for j in range(30)))) for k in range(3)]  # copies
    rows += [(30 + k, f"http://n/{k}", "<p>Menu of many short lines</p>" * 3 + f"<p>tiny {k}</p>") for k in range(2)]  # most of the page is shared, none of it prose
    edited = [f"A long line of prose number {j} with more than twelve words in it, as articles have them" for j in range(6)]
    rows += [(40, "http://o/a", "".join(f"<p>{x}</p>" for x in edited)), (41, "http://o/b", "".join(f"<p>{x}</p>" for x in [*edited[:5], "changed"]))]
    for i in range(100, 160):
        lines = [f"line {rng.randint(0, 6)}" if rng.random() < 0.5 else document(rng, 14) for _ in range(rng.randint(0, 9))]
        rows.append((i, f"http://{rng.choice('pqr')}.net/{rng.randint(0, 3)}/{rng.randint(0, 9)}", "".join(rng.choice(("<div>{}</div>", "<footer>{}</footer>", "<article>{}</article>")).format(x) for x in lines)))
    frame = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, path string")
    want = differenced_literally(rows)
    for parts in (1, 7):
        out = {(r.page_id, r.url): (r.text, r.n_shared) for r in html_text.main_text(frame.repartition(parts)).collect()}
        assert out == want
    assert sum(n > 0 for _, n in want.values()) > 15
    text = {i: t for (i, _), (t, _) in want.items()}
    assert text[1] == "The story number 1 has words of its own, quite a few of them in fact"
    assert text[12] == "Welcome to our site alone Follow us on every channel" and text[11] == ""
    assert text[30] == "tiny 0" and text[21].startswith("Welcome to our site same0") and "Welcome to our site" in text[10]
    assert text[40] == " ".join(edited)
    assert html_text.main_text(frame.where("false")).count() == 0
    again = html_text.main_text(frame.where("page_id < 4").unionByName(frame.where("page_id = 2"))).collect()
    assert len(again) == 5 and all(r.n_chars == len(r.text) and r.text == text[r.page_id] for r in again)
