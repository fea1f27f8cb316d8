"""MinHash near-dedup by order MinHash, with candidates verified by banded alignment.

Texts are sequences of words between ASCII white space. A text's k-mers of five
words are labelled by their occurrence (the second occurrence of a k-mer differs
from its first); for each of ``sketches`` hash functions the ``picked`` labelled
k-mers of least hash, in the order in which they stand in the text, are one
bucket of the text. So texts share a bucket if they share k-mers in the same
order, which follows their edit similarity. Candidates are verified by aligning
their k-mers within a band that no alignment of the required similarity leaves:
``matched / (a + b - matched) >= similarity``, for ``a`` and ``b`` k-mers.

Texts of equal words are one class to begin with, stood for by the smallest
``doc_id``. In each bucket all texts are compared with the one of least id. The
members of all buckets that aren't one class after that are joined exactly: of
two texts of the required similarity, the k-mers of each in an order of rising
frequency have one in common in a prefix of known length, so each pair of two
classes that meets in a prefix is verified and no other can be a link. Linked
texts are one class (connected components).

Edge cases: a null text has no words; texts without words are alike and one
class; texts of less than five words are a single k-mer; a null ``doc_id`` is a
class of its own row (null class) and is never dropped; rows that repeat a
``doc_id`` are one document, stood for by its smallest text; ties of hashes go to
the earlier place; an empty table gives an empty result; other columns travel
unseen.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from timbre import store
from timbre.llm.common import LEAST_HOT, MOST_HOT, SPACE_CLASS, delete_path, free_shuffles, fresh_path, narrow, spread_join

WORD_BREAKS = str.maketrans({c: " " for c in "\t\n\x0b\x0c\r"})


@dataclass(frozen=True)
class NearRule:
    """words: of a k-mer; similarity: least similarity of a link; sketches: hash
    functions; picked: k-mers of a bucket."""

    words: int = 5
    similarity: float = 0.8
    sketches: int = 16
    picked: int = 3


#: Cells of the counts that order k-mers; any order gives the same links, a better one fewer pairs.
CELLS = 1 << 18
#: Rows of a k-mer's lesser classes that meet in one task; sixteen times as many of all its rows do.
BLOCK = 256
#: Links of one task of the components.
FOREST = 250_000


def checkpointed(df: DataFrame) -> DataFrame:
    """A checkpoint, after which the driver lets go of the plans and shuffle files that it cut off."""
    out = store.checkpointed(df)
    del df
    free_shuffles(out.sparkSession)
    return out


def words_of(text: str | None) -> list[str]:
    """Words between ASCII white space (others, such as a no-break space, belong to words)."""
    return [w for w in (text or "").translate(WORD_BREAKS).split(" ") if w]


def kmers_of(words: list[str], k: int) -> np.ndarray:
    """64-bit hashes of the k-mers in order; of all words if they are fewer than ``k``."""
    if len(words) <= k:
        return np.array([xxhash.xxh3_64_intdigest(" ".join(words))], np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    out = np.zeros(len(words) - k + 1, np.uint64)
    for i in range(k):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + h[i : i + len(out)])
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser of 64-bit hashes."""
    x = (x ^ x >> np.uint64(33)) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ x >> np.uint64(33)) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ x >> np.uint64(33)


def labelled(kmers: np.ndarray) -> np.ndarray:
    """K-mers mixed with the number of their occurrence so far."""
    order = np.argsort(kmers, kind="stable")
    ranked = kmers[order]
    starts = np.r_[True, ranked[1:] != ranked[:-1]]
    nth = np.arange(len(kmers)) - np.maximum.accumulate(np.where(starts, np.arange(len(kmers)), 0))
    out = np.empty_like(kmers)
    out[order] = mix(ranked + nth.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
    return out


def buckets_of(kmers: np.ndarray, rule: NearRule) -> list[int]:
    """One signed 64-bit bucket per hash function."""
    marks = labelled(kmers)
    n = min(rule.picked, len(marks))
    seeds = np.array([0xA0761D6478BD642F * (s + 1) & 0xFFFFFFFFFFFFFFFF for s in range(rule.sketches)], np.uint64)
    if n == len(marks):
        least = np.tile(np.arange(n), (rule.sketches, 1))
    elif len(marks) <= 4096:
        least = np.argpartition(mix(marks[None, :] ^ seeds[:, None]), n - 1, axis=1)[:, :n]
    else:
        least = np.stack([np.argpartition(mix(marks ^ s), n - 1)[:n] for s in seeds])
    chosen = marks[np.sort(least, axis=1)]
    return [xxhash.xxh3_64_intdigest(row.tobytes(), seed=s) - (1 << 63) for s, row in enumerate(chosen)]


def matched_kmers(a: list[int], b: list[int], band: int) -> int:
    """Length of the longest common subsequence whose places differ by ``band`` at most.

    A bit for each place of ``b``; a row of the alignment takes a few operations
    on whole rows, within the band.
    """
    head, n = 0, min(len(a), len(b))
    while head < n and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < n - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    a, b = a[head : len(a) - tail], b[head : len(b) - tail]
    places: dict[int, int] = {}
    for j, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << j
    full = row = (1 << len(b)) - 1
    for i, x in enumerate(a):
        if hits := places.get(x):
            low = max(0, i - band)
            hits &= ((1 << (i + band + 1 - low)) - 1) << low
            if hit := row & hits:
                row = (row + hit | row - hit) & full
    return head + tail + len(b) - row.bit_count()


def similar(a: np.ndarray, b: np.ndarray, least: float) -> bool:
    """Whether the aligned k-mers are ``least`` of all or more."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) < least * len(b):
        return False
    need = least * (len(a) + len(b)) / (1 + least)
    x, y = a.tolist(), b.tolist()
    if len(x) > 64 and sum((Counter(x) & Counter(y)).values()) < need - 1e-9:
        return False
    return matched_kmers(x, y, int(len(b) - need + 1e-9)) >= need - 1e-9


PREPARED = "id long, print binary, buckets array<long>, kmers binary"


def preparer(rule: NearRule) -> Callable:
    """Texts to the digest of their words, their buckets, and their k-mers in order.

    Half of a k-mer's hash is enough to align two texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in PREPARED.split(", ")]
        for batch in batches:
            prints, buckets, kmers = [], [], []
            for text in batch.column(1):
                words = words_of(text.as_py())
                found = kmers_of(words, rule.words)
                prints.append(hashlib.sha256(" ".join(words).encode()).digest()[:16])
                buckets.append(buckets_of(found, rule))
                kmers.append((found >> np.uint64(32)).astype(np.uint32).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.binary()), pa.array(buckets, pa.list_(pa.int64())), pa.array(kmers, pa.binary())], names=names)

    return run


def prepared(docs: DataFrame, rule: NearRule) -> tuple[DataFrame, str]:
    """The table of PREPARED for all rows of ``docs`` that have an id, written once, and its path."""
    path = fresh_path(docs.sparkSession, "near")
    docs.where("doc_id is not null").select("doc_id", "text").mapInArrow(preparer(rule), PREPARED).write.parquet(path)
    return docs.sparkSession.read.parquet(path), path


def verifier(rule: NearRule) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            alike = [similar(np.frombuffer(a.as_py(), np.uint32), np.frombuffer(b.as_py(), np.uint32), rule.similarity) for a, b in zip(batch.column(2), batch.column(3))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(alike, pa.bool_())], names=["u", "v", "alike"])

    return run


def text_classes(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, first): documents and the least id with their words; (first, print, n): distinct texts."""
    prints = checkpointed(rows.groupBy("id").agg(F.min("print").alias("print")))
    firsts = checkpointed(prints.groupBy("print").agg(F.min("id").alias("first"), F.count("*").alias("n")))
    again = firsts.where("n > 1").select(F.col("print").alias("p"), "first", "n")
    joined = spread_join(prints, again, "print", "p", "n", prints.count(), F.xxhash64("id"), "left")
    return joined.select(F.col("id").alias("doc_id"), F.coalesce("first", "id").alias("first")), firsts


def star_pairs(members: DataFrame) -> DataFrame:
    """(u, v, key): each member of a bucket with the bucket's least id."""
    least = checkpointed(members.groupBy("key").agg(F.min("id").alias("u"), F.max("id").alias("most"), F.count("*").alias("n")).where("u < most").select(F.col("key").alias("k"), "u", "n"))
    total = least.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return spread_join(members, least, "key", "k", "n", total, F.xxhash64("id")).where("id > u").select("u", F.col("id").alias("v"), "key")


def apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs whose sides aren't in one class yet."""
    left = roots.select(F.col("id").alias("lid"), F.col("root").alias("lroot"))
    right = roots.select(F.col("id").alias("rid"), F.col("root").alias("rroot"))
    both = pairs.join(left, F.col("u") == F.col("lid"), "left").join(right, F.col("v") == F.col("rid"), "left")
    return both.where(F.coalesce("lroot", "u") != F.coalesce("rroot", "v")).select("u", "v", "key")


def verified(pairs: DataFrame, kmers: DataFrame, rule: NearRule) -> DataFrame:
    """(u, v, alike) of ``pairs``, which are distinct; the k-mers of both sides are fetched by id, those of a hub to several tasks."""
    hubs = checkpointed(pairs.groupBy("u").agg(F.count("*").alias("n")))
    total = hubs.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    left = hubs.join(kmers, F.col("u") == F.col("id")).select(F.col("u").alias("hub"), F.col("kmers").alias("ku"), "n")
    right = pairs.join(kmers, F.col("v") == F.col("id")).select("u", "v", F.col("kmers").alias("kv"))
    # the hubs that are hot are found from their counts alone
    limit = max(LEAST_HOT, total // MOST_HOT)
    lots = F.ceil(F.col("n") / limit).cast("int")
    hot = F.broadcast(hubs.where(F.col("n") > limit).select(F.col("u").alias("h"), lots.alias("lots")))  # MOST_HOT rows at most
    right = right.join(hot, F.col("u") == F.col("h"), "left").withColumn("lot", F.coalesce(F.pmod(F.xxhash64("v"), F.col("lots")), F.lit(0)).cast("int"))
    left = left.withColumn("copy", F.explode(F.when(F.col("n") > limit, F.sequence(F.lit(0), lots - 1)).otherwise(F.array(F.lit(0)))))
    full = right.join(left, (F.col("u") == F.col("hub")) & (F.col("lot") == F.col("copy"))).select("u", "v", "ku", "kv")
    return checkpointed(full.mapInArrow(verifier(rule), "u long, v long, alike boolean"))


def cells_of(marks: np.ndarray) -> np.ndarray:
    return (marks >> np.uint64(20)).astype(np.int64) % CELLS


def marks_of(packed: bytes) -> np.ndarray:
    return labelled(np.frombuffer(packed, np.uint32).astype(np.uint64))


def cell_counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """K-mers of the task in each cell."""
    found = np.zeros(CELLS, np.int64)
    for batch in batches:
        for packed in batch.column(0):
            np.add.at(found, cells_of(marks_of(packed.as_py())), 1)
    used = np.flatnonzero(found)
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(found[used], pa.int64())], names=["cell", "n"])


def prefix_lengths(n: int, least: float) -> tuple[int, int]:
    """K-mers of the rarest, of a text of ``n``, that meet those of a longer and of a shorter text."""
    return n - math.ceil(2 * least * n / (1 + least) - 1e-9) + 1, n - math.ceil(least * n - 1e-9) + 1


def prefix_writer(sent, rule: NearRule) -> Callable:
    """Texts to the k-mers of their prefixes, by rising count of the cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = sent.value
        for batch in batches:
            parts = []
            for i, root, packed in zip(*(c.to_pylist() for c in batch.columns)):
                marks = marks_of(packed)
                n, (short, long) = len(marks), prefix_lengths(len(marks), rule.similarity)
                first = marks[np.lexsort((marks, counts[cells_of(marks)]))[:long]]
                at = np.arange(len(first))
                parts.append((first.view(np.int64), np.full(len(first), i), np.full(len(first), root), np.full(len(first), n), at, at < short))
            if parts:
                columns = [np.concatenate(c) for c in zip(*parts)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["mark", "id", "root", "size", "at", "short"])

    return run


def cell_counts(members: DataFrame):
    """The broadcast counts of the k-mers' cells: a number for each of ``CELLS`` cells."""
    counts = np.zeros(CELLS, np.int64)
    rows = members.select("kmers").mapInArrow(cell_counter, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    counts[rows.cell.to_numpy(np.int64)] = rows.n.to_numpy(np.int64)
    return members.sparkSession.sparkContext.broadcast(counts)


def prefixes_of(members: DataFrame, roots: DataFrame, sent, rule: NearRule) -> DataFrame:
    """(mark, id, root, size, at, short): the k-mers of the prefixes of ``members`` (id, kmers)."""
    known = roots.select(F.col("id").alias("rid"), "root")
    rows = members.join(known, F.col("id") == F.col("rid"), "left").select("id", F.coalesce("root", "id").alias("root"), "kmers")
    return rows.mapInArrow(prefix_writer(sent, rule), "mark long, id long, root long, size long, at long, short boolean")


def can_link(rule: NearRule) -> Column:
    """Whether sides l and r of a mark can be alike, if it is their first common one: by their
    sizes, by the shorter text's prefix for longer ones, and by what follows the mark."""
    need = rule.similarity * (F.col("lsize") + F.col("rsize")) / (1 + rule.similarity)
    met = ((F.col("lsize") <= F.col("rsize")) & F.col("lshort")) | ((F.col("rsize") <= F.col("lsize")) & F.col("rshort"))
    met &= F.least("lsize", "rsize") >= rule.similarity * F.greatest("lsize", "rsize") - 1e-9
    return met & (F.col("lroot") != F.col("rroot")) & (F.least(F.col("lsize") - F.col("lat"), F.col("rsize") - F.col("rat")) >= need - 1e-9)


def side(rows: DataFrame, name: str, *more: str) -> DataFrame:
    return rows.select(*(F.col(c).alias(name + c) for c in ("mark", "id", "root", "size", "at", "short", *more)))


def pairs_of(joined: DataFrame) -> DataFrame:
    return checkpointed(joined.select(F.least("lid", "rid").alias("u"), F.greatest("lid", "rid").alias("v")).distinct())


def next_pairs(prefixes: DataFrame, rule: NearRule) -> DataFrame:
    """(u, v): each text with the next of the same mark in an order of hashes, if they can be alike."""
    order = Window.partitionBy("mark").orderBy(F.xxhash64("mark", "id"), "id")
    after = prefixes.withColumn("x", F.lead(F.struct("mark", "id", "root", "size", "at", "short")).over(order)).where("x is not null")
    both = after.select(*(F.col(c).alias("l" + c) for c in prefixes.columns), *(F.col(f"x.{c}").alias("r" + c) for c in prefixes.columns))
    return pairs_of(both.where(can_link(rule)))


def cross_pairs(prefixes: DataFrame, rule: NearRule) -> DataFrame:
    """(u, v): every pair of two roots that can be a link.

    Of a mark's rows, those outside its greatest class meet all rows of other
    classes: pairs within a class are never formed. Both sides are dealt in blocks.
    """
    prefixes = checkpointed(prefixes)
    classes = prefixes.groupBy("mark", "root").agg(F.count("*").alias("n")).groupBy("mark").agg(F.max(F.struct("n", "root")).alias("top"), F.sum("n").alias("all"), F.count("*").alias("roots")).where("roots > 1")
    blocks = checkpointed(classes.select(F.col("mark").alias("m"), F.col("top.root").alias("top"), "all", F.ceil((F.col("all") - F.col("top.n")) / BLOCK).alias("few"), F.ceil(F.col("all") / (16 * BLOCK)).alias("many")))
    total = blocks.agg(F.coalesce(F.sum("all"), F.lit(0))).first()[0]
    dealt = spread_join(prefixes, blocks, "mark", "m", "all", total, F.xxhash64("id"))
    deal = lambda n, seed: F.pmod(F.xxhash64("id", F.lit(seed)), F.col(n))
    to_all = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    left = side(dealt.where("root != top").withColumn("x", deal("few", 1)).withColumn("y", to_all("many")), "l", "x", "y")
    right = side(dealt.withColumn("y", deal("many", 2)).withColumn("x", to_all("few")), "r", "x", "y")
    return pairs_of(left.join(right, (F.col("lmark") == F.col("rmark")) & (F.col("lx") == F.col("rx")) & (F.col("ly") == F.col("ry")) & can_link(rule)))


def links(rows: DataFrame, firsts: DataFrame, rule: NearRule) -> DataFrame:
    """(u, v): verified links among the distinct texts ``firsts`` of ``rows`` (PREPARED)."""
    texts = firsts.select(F.col("first").alias("fid"), F.col("print").alias("fprint"))
    ours = (F.col("id") == F.col("fid")) & (F.col("print") == F.col("fprint"))
    members = rows.select("id", "print", "buckets").join(texts, ours).dropDuplicates(["id", "print"]).select("id", F.posexplode("buckets").alias("s", "b"))
    pairs = checkpointed(star_pairs(members.select("id", F.xxhash64("s", "b").alias("key"))))
    used = pairs.select(F.explode(F.array("u", "v")).alias("uid")).distinct()
    kmers = rows.select("id", "print", "kmers").join(texts, ours).dropDuplicates(["id", "print"])
    kmers = checkpointed(kmers.join(used, F.col("id") == F.col("uid"), "left_semi").select("id", "kmers"))
    checks = verified(pairs.select("u", "v").distinct(), kmers, rule)
    found = checks.where("alike").select("u", "v")
    # all members of the buckets that are of several classes so far, as far as their links to hubs tell
    roots = checkpointed(found.groupBy(F.col("v").alias("id")).agg(F.min("u").alias("root")))
    mixed = apart(pairs, roots).select("key").distinct()
    left = pairs.join(mixed, "key", "left_semi").select(F.explode(F.array("u", "v")).alias("mid")).distinct()
    held = checkpointed(kmers.join(left, F.col("id") == F.col("mid"), "left_semi"))
    sent = cell_counts(held)
    # a few pairs of each mark first, which join most classes, so that few pairs of two classes are left for the join
    tried = checks.select("u", "v")
    near = verified(next_pairs(prefixes_of(held, roots, sent, rule), rule).join(tried, ["u", "v"], "left_anti"), kmers, rule)
    found = checkpointed(found.unionByName(near.where("alike").select("u", "v")))
    tried = tried.unionByName(near.select("u", "v"))
    rest = verified(cross_pairs(prefixes_of(held, components(found), sent, rule), rule).join(tried, ["u", "v"], "left_anti"), kmers, rule)
    return found.unionByName(rest.where("alike").select("u", "v"))


def forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) of a task to a star around the least id of each of its components."""
    above: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := above.get(top, top)) != top:
            top = up
        while x != top:
            above[x], x = top, above.get(x, x)
        return top

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            x, y = root(a), root(b)
            if x != y:
                above[max(x, y)] = min(x, y)
    leaves = list(above)
    yield pa.RecordBatch.from_arrays([pa.array(leaves, pa.int64()), pa.array([root(x) for x in leaves], pa.int64())], names=["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """(id, root): each linked id with the least id of its component.

    Tasks reduce their links to stars. Then rounds: an id takes the least of its
    parents, its other parents are linked to that one, and each takes its
    parent's parent; a round that changes nothing ends it. A task holds
    ``FOREST`` links, about.
    """
    n = edges.count()
    parts = max(4, math.ceil(n / FOREST))
    stars = checkpointed(edges.select(F.col("v").alias("a"), F.col("u").alias("b")).coalesce(parts).mapInArrow(forest, "a long, b long"))
    while True:
        # a task gives an id one parent, so an id has as many as there are tasks at most
        parents = checkpointed(stars.groupBy("a").agg(F.min("b").alias("m"), F.collect_set("b").alias("all")).coalesce(parts))
        sizes = parents.groupBy("m").agg(F.count("*").alias("n"))
        up = sizes.join(parents.select(F.col("a").alias("pa"), F.col("m").alias("pm")), F.col("m") == F.col("pa")).select("pa", "pm", F.col("n").alias("pn"))
        up = checkpointed(up)
        hooks = parents.where("size(all) > 1").select(F.explode("all").alias("a"), F.col("m").alias("b")).where("a > b")
        if up.isEmpty() and hooks.isEmpty():
            return parents.select(F.col("a").alias("id"), F.col("m").alias("root"))
        moved = spread_join(parents.select("a", "m"), up, "m", "pa", "pn", n, F.xxhash64("a"), "left").select("a", F.coalesce("pm", "m").alias("b"))
        stars = checkpointed(moved.unionByName(hooks).coalesce(parts).mapInArrow(forest, "a long, b long"))


def word_print(text: Column) -> Column:
    """Digest of the words, in the order of the prints of PREPARED."""
    return F.sha2(F.btrim(F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_CLASS + "+", " "), F.lit(" ")), 256)


def near_classes(docs: DataFrame, rule: NearRule = NearRule()) -> DataFrame:
    """(doc_id, class_id): every document with the least id of its class."""
    rows = narrow(docs, doc_id="doc_id", text="text")
    ready, path = prepared(rows, rule)
    classes, firsts = text_classes(ready)
    marks = checkpointed(components(checkpointed(links(ready, firsts, rule))).withColumnRenamed("id", "linked"))
    # a class's text may have many copies: the root is looked up by distinct text, whose copies are counted
    copies = firsts.select(F.col("first").alias("f"), "n")
    moved = checkpointed(marks.join(copies, F.col("linked") == F.col("f")).select("linked", "root", F.col("n").alias("copies")))
    out = spread_join(classes, moved, "first", "linked", "copies", firsts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0], F.xxhash64("doc_id"), "left")
    out = checkpointed(out.select("doc_id", F.coalesce("root", "first").alias("class_id")))
    delete_path(docs.sparkSession, path)
    nameless = rows.where("doc_id is null").select("doc_id", F.col("doc_id").alias("class_id"))
    return out.unionByName(nameless)


def keep_one(docs: DataFrame, rule: NearRule = NearRule()) -> DataFrame:
    """The rows of ``docs`` whose document is the least id of its class, columns unchanged.

    Of rows that repeat a kept id one stays; rows without an id stay.
    """
    kept = near_classes(docs, rule).where("doc_id = class_id").select(F.col("doc_id").alias("kept_id"))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    one = rows.join(kept, F.col("row.doc_id") == F.col("kept_id"), "left_semi")
    one = one.select("row", F.count("*").over(Window.partitionBy("row.doc_id")).alias("same"))
    place = F.when(F.col("same") > 1, word_print(F.col("row.text")))
    nth = F.row_number().over(Window.partitionBy("row.doc_id").orderBy(place, F.xxhash64("row")))
    return one.select("row", nth.alias("nth")).where("nth = 1").select("row").unionByName(rows.where("row.doc_id is null")).select("row.*")
