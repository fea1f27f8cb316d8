"""Periodic runs of words: longest Lyndon words under both orders of the words, extended to maximal runs.

A run is a stretch of words with smallest period q (words q apart are equal) that
no neighbouring word extends. Each run of two periods or more holds a word that is
the longest Lyndon word at its place, as long as the period, under one of the two
orders of the words. So the longest Lyndon words of all places, found by a stack
from right to left, are all candidates; each is extended to both sides by its
longest common extensions. Long comparisons are binary searches over rolling
hashes whose outcome is then compared word by word; no suffix array is built.

A run of 12 words with two periods repeats at least six words in a row, so words
that lie in no repeated window of six can't be in one: the stack works on the
stretches between them, each for itself, and gives the same runs.

Edge cases: a null or empty text has no words and no runs; a text may be of any
length (a task holds one text and some 100 bytes for each of its words); a null
``doc_id`` is kept as it is (and its text isn't repeated by ``cycled``); repeated
rows give repeated results; an empty table gives none. Only the id and the text
are read, so other columns can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timbre.llm.common import SPACE_CLASS, narrow

MIN_LENGTH = 12

#: Moduli and bases of the two rolling hashes.
PRIMES = (2147483647, 2147483629)
BASES = (1000003727, 1390000729)
#: Words compared one by one before hashes are asked.
DIRECT = 16
MIX = np.uint64(0x9E3779B97F4A7C15)

SCHEMA = "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


class RollingHash:
    """Prefix sums of two polynomial hashes; equal stretches always have equal hashes."""

    def __init__(self, words: np.ndarray):
        n, self.tables = len(words), []
        for prime, base in zip(PRIMES, BASES):
            powers, have = np.ones(n + 1, np.uint64), 1
            while have <= n:
                more = min(have, n + 1 - have)
                powers[have : have + more] = powers[:more] * np.uint64(pow(base, have, prime)) % np.uint64(prime)
                have += more
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum((words.astype(np.uint64) + np.uint64(1)) % np.uint64(prime) * powers[:n] % np.uint64(prime), out=sums[1:])
            self.tables.append((np.uint64(prime), powers, sums % np.uint64(prime)))

    def same(self, a, b, length):
        """Whether the stretches of ``length`` words at ``a`` and at ``b`` > ``a`` have equal hashes; numbers or arrays."""
        equal = True
        for prime, powers, sums in self.tables:
            left = (sums[a + length] + prime - sums[a]) % prime * powers[b - a] % prime
            equal = equal & (left == (sums[b + length] + prime - sums[b]) % prime)
        return equal


class Stretch:
    """One stretch of words (numbers of words): comparisons of its suffixes and its runs."""

    def __init__(self, words: np.ndarray):
        self.words, self.n = words, len(words)

    @cached_property
    def hashes(self) -> RollingHash:
        return RollingHash(self.words)

    def extent(self, words: list[int], known: dict[int, tuple[int, int]], i: int, j: int) -> int:
        """Longest common extension of the suffixes at ``i`` and ``j``; ``known`` has, by distance, the last place and where equality ended."""
        gap = j - i
        first, end = known.get(gap, (self.n - gap, self.n - gap))
        if first <= i <= end:
            return end - i
        stop = first if i < first else self.n - gap
        beyond = end if i < first else stop
        at, near = i, min(stop, i + DIRECT)
        while at < near and words[at] == words[at + gap]:
            at += 1
        if at == near and at < stop:
            low, high = at, stop  # equal up to low, at most up to high
            while low < high:
                mid = (low + high + 1) // 2
                low, high = (mid, high) if self.hashes.same(at, at + gap, mid - at) else (low, mid - 1)
            differ = np.flatnonzero(self.words[at:low] != self.words[at + gap : low + gap])
            at = at + int(differ[0]) if len(differ) else low
        found = beyond if at == stop else at
        known[gap] = (i, found)
        return found - i

    def lyndon_ends(self, words: list[int]) -> list[int]:
        """End of the longest Lyndon word at each place: the next place whose suffix is smaller."""
        n, ends, known = self.n, [self.n] * self.n, {}
        for i in range(n - 2, -1, -1):
            j, mine = i + 1, words[i]
            while j < n:
                other = words[j]
                if other == mine:
                    k = self.extent(words, known, i, j)
                    if j + k == n or words[j + k] < words[i + k]:
                        break
                elif other < mine:
                    break
                j = ends[j]
            ends[i] = j
        return ends

    def reach(self, i: np.ndarray, j: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
        """For each pair of places how many words after them (``back``: before them) are equal, by hashes."""
        low, high = np.zeros_like(i), most.copy()
        while (open_ := low < high).any():
            mid = (low + high + 1) // 2
            shift = mid if back else 0
            same = self.hashes.same(i - shift, j - shift, mid)
            low, high = np.where(open_ & same, mid, low), np.where(open_ & ~same, mid - 1, high)
        return low

    def reach_by_word(self, i: np.ndarray, j: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
        """As ``reach``, word by word."""
        found = []
        for a, b, m in zip(i.tolist(), j.tolist(), most.tolist()):
            x, y = (self.words[a - m : a][::-1], self.words[b - m : b][::-1]) if back else (self.words[a : a + m], self.words[b : b + m])
            differ = np.flatnonzero(x != y)
            found.append(int(differ[0]) if len(differ) else m)
        return np.array(found, np.int64)

    def extended(self, i: np.ndarray, j: np.ndarray, least: int, reach) -> np.ndarray:
        """Distinct (start, end, period) of the candidates [i, j) that are runs of ``least`` words or more."""
        after, before = reach(i, j, self.n - j, False), reach(i, j, i, True)
        rows = np.stack([i - before, j + after, j - i], axis=1)
        return np.unique(rows[(after + before >= j - i) & (rows[:, 1] - rows[:, 0] >= least)], axis=0)

    def holds(self, start: int, end: int, period: int) -> bool:
        """Whether the words of a run are what it says and its neighbours differ."""
        w = self.words
        if not np.array_equal(w[start : end - period], w[start + period : end]):
            return False
        return (start == 0 or w[start - 1] != w[start - 1 + period]) and (end == self.n or w[end] != w[end - period])

    def runs(self, least: int) -> list[tuple[int, int, int]]:
        """(start, end, period) of all runs."""
        pairs = []
        for sign in (1, -1):
            ends = np.array(self.lyndon_ends((self.words * sign).tolist()), np.int64)
            i = np.arange(self.n)
            hit = np.zeros(self.n, bool)
            inside = ends < self.n
            hit[inside] = self.words[i[inside]] == self.words[ends[inside]]
            hit[1:] |= self.words[: self.n - 1] == self.words[ends[1:] - 1]
            pairs.append((i[hit], ends[hit]))
        i, j = (np.concatenate(x) for x in zip(*pairs))
        rows = self.extended(i, j, least, self.reach).tolist()
        if not all(self.holds(*r) for r in rows):  # two stretches with one hash
            rows = self.extended(i, j, least, self.reach_by_word).tolist()
        return [tuple(r) for r in rows]


def stretches(words: np.ndarray, window: int, least: int) -> list[tuple[int, int]]:
    """Stretches of ``least`` words or more that are covered by windows occurring twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return []
    with np.errstate(over="ignore"):
        marks = np.zeros(n, np.uint64)
        for k in range(window):
            marks = (marks ^ words[k : k + n].astype(np.uint64)) * MIX
            marks ^= marks >> np.uint64(29)
    _, place, count = np.unique(marks, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(count[place] > 1)
    if not len(starts):
        return []
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + window, -1)
    covered = np.concatenate([[0], np.cumsum(change)[:-1] > 0, [0]]).astype(np.int8)
    edges = np.flatnonzero(np.diff(covered))
    return [(a, b) for a, b in edges.reshape(-1, 2).tolist() if b - a >= least]


def runs_of(words: list, least: int = MIN_LENGTH) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of ``words`` of ``least`` words or more and two periods or more, by start and period."""
    if len(words) < least:
        return []
    numbers: dict = {}
    codes = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    found = []
    # A run repeats (its length less its period) words in a row, at least half of ``least``.
    for a, b in stretches(codes, (least + 1) // 2, least):
        found += [(a + start, end - start, period) for start, end, period in Stretch(codes[a:b]).runs(least)]
    return sorted(found, key=lambda r: (r[0], r[2]))


def without_repeats(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words that no run has after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


def run_batches(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        runs, texts = [], []
        for text in batch.column(1):
            words = (text.as_py() or b"").split()  # bytes split at ASCII white space only
            found = runs_of(words, least)
            runs.append([{"start": s, "length": n, "period": p} for s, n, p in found])
            texts.append(b" ".join(without_repeats(words, found)))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(runs, RUNS), pa.array(texts, pa.binary()).cast(pa.string())], names=["doc_id", "runs", "collapsed"])


def word_runs(docs: DataFrame, least: int = MIN_LENGTH) -> DataFrame:
    """Per document its runs of ``least`` words or more (at least 2) and its text without their repeats, words joined by a space."""
    return narrow(docs, doc_id="doc_id", text="text").withColumn("text", F.col("text").cast("binary")).mapInArrow(partial(run_batches, least=least), SCHEMA)


def cycled(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``; about a tenth of the texts, told by a CRC of the id, repeat a stretch of their words to the end."""
    rows = narrow(docs, doc_id="doc_id", text="text").withColumn("h", F.crc32(F.col("doc_id").cast("string")))
    words = F.filter(F.split(F.coalesce("text", F.lit("")), SPACE_CLASS + "+"), lambda w: w != "")
    rows = rows.withColumn("words", F.when(F.col("h") % 10 == 0, words)).withColumn("n", F.coalesce(F.size("words"), F.lit(0)))
    g = F.floor(F.col("h") / 10)
    rows = rows.withColumn("g", g).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    rows = rows.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    rest = F.col("n") - F.col("a")
    cycle = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), F.ceil(rest / F.col("p")).cast("int")))
    text = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(cycle, F.lit(1), rest)), " ")
    return rows.select("doc_id", F.when(F.col("n") > 0, text).otherwise(F.col("text")).alias("text"))


def run_report(docs: DataFrame) -> DataFrame:
    """One row per document: its number of runs, the longest of them, digests of all runs and of the collapsed text."""
    rows = word_runs(cycled(docs))
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"), r["length"].alias("length"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    rows = rows.select("doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("top"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    top = [F.col(f"top.{c}").alias(c) for c in ("start", "length", "period")]
    return rows.select("doc_id", "n_runs", *top, F.expr("1000 * top.length div top.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
