"""Lexical retrieval packing: sequences filled with BM25 neighbours of a seed.

Documents are tokenised where they are read. Whole windows of a long document
are sequences of their own; what remains of each document is a piece. The BM25
index is sharded by content: pieces are ordered by their three terms of greatest
tf-idf, so that copies and texts of the same rare terms lie together, and every
``shard_docs`` pieces of that order are one shard with an inverted index, at any
size of the corpus. Corpus statistics (document frequencies of the vocabulary,
number and mean length) cover all pieces and all whole windows. Seeds are taken
in order; a seed asks with all of its terms; unused neighbours in the order of
their score fill its window, the last one cut where the window is full, and its
rest is again unused. Where no unused piece shares a term of some weight with
the seed, the next unused pieces follow, so that all windows but the last of a
shard are full.

With ``place``, a column that numbers the rows, shards are ranges of that order
instead, seeds are taken and sequences numbered in it, so that a mix of sources
is that of the sequences too, and neighbours come from the same part of the mix.

The result depends on the rows alone, not on their partitions.

Edge cases: a null or empty text is one end token; very long texts give many
windows; repeated rows are packed each; a null ``doc_id`` is returned as null;
ties go by the digest of the ids, the id, then the length; an empty table gives
an empty result; only two columns are read.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from timbre.llm.common import checkpointed
from timbre.operators.scoring import numbered

END = 1
#: Documents, and bytes of text beyond the first document, whose ids a worker holds at once.
BATCH, BATCH_BYTES = 1024, 4 << 20


@dataclass(frozen=True)
class PackRule:
    """window: tokens of a sequence; shard_docs: pieces of an index shard; k1, b:
    BM25's parameters; tokenizer: file with the vocabulary."""

    window: int = 2048
    shard_docs: int = 1024
    k1: float = 1.2
    b: float = 0.75
    tokenizer: str = public_tokenizers.path("word_bpe_49k.json")


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of all ranges that begin at ``starts``, one range after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


class PairRanks:
    """Ranks of many pairs of symbols at once: tables by a hash, each for the pairs whose place in the one before was taken."""

    NONE = np.int32(2**31 - 1)
    EMPTY = np.uint32(2**32 - 1)  # no pair: the vocabulary has less than 65,535 symbols

    def __init__(self, left: np.ndarray, right: np.ndarray):
        keys, rank = (left << 16 | right).astype(np.uint32), np.arange(len(left), dtype=np.int32)
        self.tables = []
        while len(keys):
            bits = max(8, 2 + len(keys).bit_length())
            multiplier, shift = np.uint32(0x9E3779B1 + 0x3C6EF372 * len(self.tables) & 0xFFFFFFFF | 1), np.uint32(32 - bits)
            at = keys * multiplier >> shift
            held, ranks = np.full(1 << bits, self.EMPTY), np.full(1 << bits, self.NONE)
            held[at], ranks[at] = keys, rank
            out = held[at] != keys
            self.tables.append((multiplier, shift, held, ranks))
            keys, rank = keys[out], rank[out]

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << np.uint32(16) | right
        found = np.full(len(keys), self.NONE)
        for multiplier, shift, held, ranks in self.tables:
            at = keys * multiplier >> shift
            hit = held[at] == keys
            found[hit] = ranks[at[hit]]
        return found


class WordEncoder:
    """Token ids of many texts at once; nothing is kept from one batch to the next.

    The vocabulary's pre-tokeniser never joins text over white space, so the ids
    of a text are those of its parts between spaces and line ends. Arrow splits the
    texts of a batch and numbers their distinct parts; these are split into words,
    and the pair merges run over all distinct words side by side, in each step the
    first pair of least rank of each word. Parts of ordinary Latin-1 characters
    skip the normaliser, which leaves them as their lower case; all others, and
    words of more than ``LONGEST`` bytes, go through the tokenizer one by one.
    """

    # The file's own splitting pattern for lower-case Latin-1, and characters that its normaliser only lowers.
    SPLIT = re.compile(r"\n|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼-¾]|'(?:s|t|re|ve|m|ll|d)|[^\na-zªµºß-öø-ÿ0-9²³¹¼-¾]+")
    PLAIN = re.compile(r"[\n\x21-\x7e\xa1-\xac\xae-\xff]*")
    MARKUP = "<|"
    LONGEST = 64

    def __init__(self, path: str):
        self.whole = Tokenizer.from_file(path)
        model = json.loads(Path(path).read_text())["model"]
        vocabulary, last = model["vocab"], model["end_of_word_suffix"]
        # bytes that don't print stand as characters from 256 on
        printing = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
        marks = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in printing)}
        letters = [marks.get(b, chr(b)) for b in range(256)]
        self.inner, self.last = (np.array([vocabulary[c + end] for c in letters], np.uint32) for end in ("", last))
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left, right, self.merged = (np.array([vocabulary[x] for x in column], np.uint32) for column in zip(*((a, b, a + b) for a, b in merges)))
        self.ranks = PairRanks(left, right)

    def merge(self, data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbols of words, given their bytes one after the other and how many each has (one at least): all symbols, start and number for each word."""
        begins = np.cumsum(sizes) - sizes
        symbols = self.inner[data]
        ends = begins + sizes - 1
        symbols[ends] = self.last[data[ends]]
        ranks = np.full(len(symbols), PairRanks.NONE)
        ranks[:-1] = self.ranks(symbols[:-1], symbols[1:])
        ranks[ends] = PairRanks.NONE  # the last symbol of a word has no pair
        word, done, starts, counts, at = np.arange(len(sizes)), [], np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64), 0
        while len(word):
            least = np.minimum.reduceat(ranks, begins)
            open_ = least != PairRanks.NONE
            if not open_.all():
                of = np.repeat(open_, sizes)
                done.append(symbols[~of])
                n = sizes[~open_]
                starts[word[~open_]], counts[word[~open_]] = at + np.cumsum(n) - n, n
                at += len(done[-1])
                word, sizes, least, symbols, ranks = word[open_], sizes[open_], least[open_], symbols[of], ranks[of]
                if not len(word):
                    break
                begins = np.cumsum(sizes) - sizes
            hit = np.flatnonzero(ranks == np.repeat(least, sizes))
            if len(hit) > len(word):
                hit = hit[np.searchsorted(hit, begins)]  # the first of each word
            symbols[hit] = self.merged[least]
            keep = np.ones(len(symbols), np.bool_)
            keep[hit + 1] = False
            symbols, ranks = symbols[keep], np.delete(ranks, hit)  # the pair's own rank goes; that of its second symbol is set anew
            hit = hit - np.arange(len(hit))
            sizes = sizes - 1
            begins = np.cumsum(sizes) - sizes
            right, left = hit[hit < begins + sizes - 1], hit[hit > begins] - 1
            ranks[right] = self.ranks(symbols[right], symbols[right + 1])
            ranks[left] = self.ranks(symbols[left], symbols[left + 1])
        return np.concatenate(done) if done else symbols, starts, counts

    def words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct words, start and number for each; a line end has none."""
        sizes = pc.binary_length(words).to_numpy().astype(np.int64)
        offsets = np.frombuffer(words.buffers()[1], np.int32)[: len(words)].astype(np.int64)
        data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
        short = (sizes <= self.LONGEST) & (data[offsets] != 10)
        ids, starts, counts = self.merge(data[ragged(offsets[short], sizes[short])], sizes[short])
        begin, n = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        begin[short], n[short] = starts, counts
        return self.others(ids, begin, n, words, np.flatnonzero(sizes > self.LONGEST))

    def others(self, ids: np.ndarray, starts: np.ndarray, counts: np.ndarray, texts: pa.Array, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Adds the ids of these texts by the tokenizer itself."""
        parts, at = [ids], len(ids)
        for k in which.tolist():
            parts.append(np.array(self.whole.encode(texts[k].as_py(), add_special_tokens=False).ids, ids.dtype))
            starts[k], counts[k] = at, len(parts[-1])
            at += counts[k]
        return np.concatenate(parts), starts, counts

    def parts(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct parts, start and number for each."""
        texts, odd = parts.to_numpy(zero_copy_only=False).tolist(), []
        joined = "\n".join(texts)
        if not self.PLAIN.fullmatch(joined) or self.MARKUP in joined:
            odd = [k for k, t in enumerate(texts) if not self.PLAIN.fullmatch(t) or self.MARKUP in t]
            for k in odd:
                texts[k] = ""
            joined = "\n".join(texts)
        words = pa.array(self.SPLIT.findall(joined.lower() + "\n"), pa.string()).dictionary_encode()
        ids, starts, counts = self.words(words.dictionary)
        which = words.indices.to_numpy()
        ids, counts = ids[ragged(starts[which], counts[which])].astype("<u2"), counts[which]
        line_end = which == pc.index(words.dictionary, "\n").as_py()
        ends = np.cumsum(counts)[line_end]
        starts = np.r_[0, ends[:-1]]
        return self.others(ids, starts, ends - starts, parts, np.array(odd, np.int64))

    def batch(self, texts: pa.Array) -> list[np.ndarray]:
        """Of each text the ids and the end token, as unsigned 16-bit numbers: the vocabulary has less than 65,535."""
        if not len(texts):
            return []
        split = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
        coded = split.flatten().dictionary_encode()
        ids, starts, counts = self.parts(coded.dictionary)
        which = coded.indices.to_numpy()
        starts, counts = starts[which], counts[which]
        ends = np.r_[0, np.cumsum(counts)][np.cumsum(pc.list_value_length(split).to_numpy())]
        return [np.append(x, np.uint16(END)) for x in np.split(ids[ragged(starts, counts)], ends[:-1])]

    def __call__(self, text: str) -> np.ndarray:
        return self.batch(pa.array([text], pa.string()))[0]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The worker's encoder of this file, made once."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def vocabulary_size(path: str) -> int:
    return Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True)


def crc_of(ids: np.ndarray) -> int:
    """CRC-32 of the ids as little-endian unsigned 32-bit numbers."""
    return zlib.crc32(ids.astype("<u4").tobytes())


def bounded(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices of ``BATCH`` rows and some ``BATCH_BYTES`` of the column, one row at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy())
    i = 0
    while i < batch.num_rows:
        full = np.searchsorted(ends, (ends[i - 1] if i else 0) + BATCH_BYTES, "right")
        n = max(1, min(BATCH, int(full) - i))
        yield batch.slice(i, n)
        i += n


TOKEN_SCHEMA = "doc_id long, place long, doc_tokens long, whole_crcs array<long>, whole_terms array<binary>, rest binary, salt long"


def tokenise(rule: PackRule) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(rule.tokenizer)
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.binary()), pa.binary(), pa.int64()]
        for batch in (x for b in batches for x in bounded(b, 1)):
            out = []
            for ids in encode.batch(batch.column(1)):
                whole = len(ids) // rule.window * rule.window
                windows = [ids[i : i + rule.window] for i in range(0, whole, rule.window)]
                out.append((len(ids), [crc_of(w) for w in windows], [np.unique(w).tobytes() for w in windows], ids[whole:].tobytes(), zlib.crc32(ids.tobytes())))
            columns = list(zip(*out))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *(pa.array(c, k) for c, k in zip(columns, kinds))], names=[x.split()[0] for x in TOKEN_SCHEMA.split(", ")])

    return run


#: Pieces whose terms are counted side by side.
TOGETHER = 512


def counted_terms(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(piece, token, count) of the distinct tokens of each piece, by piece and token."""
    sizes = np.array([len(p) // 2 for p in pieces], np.int64)
    keys = np.repeat(np.arange(len(pieces), dtype=np.uint32) << np.uint32(16), sizes) | np.frombuffer(b"".join(pieces), "<u2")
    keys.sort()
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return (keys[first] >> np.uint32(16)).astype(np.int64), (keys[first] & np.uint32(0xFFFF)).astype(np.int64), np.diff(np.r_[first, len(keys)])


def in_turns(column: pa.Array) -> Iterator[tuple[int, list]]:
    """(start, values) of ``TOGETHER`` rows after the other."""
    for start in range(0, len(column), TOGETHER):
        yield start, column.slice(start, TOGETHER).to_pylist()


def frequency_counter(size: int, window: int) -> Callable:
    """In how many pieces and whole windows of the task each token is; and their number and tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, pieces, tokens = np.zeros(size, np.int64), 0, 0
        for batch in batches:
            for _, rests in in_turns(batch.column(0)):
                pieces, tokens = pieces + len(rests), tokens + sum(map(len, rests)) // 2
                found += np.bincount(counted_terms(rests)[1], minlength=size)
            for wholes in batch.column(1):
                for terms in wholes.as_py():
                    pieces, tokens = pieces + 1, tokens + window
                    found[np.frombuffer(terms, "<u2")] += 1
        used = np.flatnonzero(found)
        token = np.r_[-1, -2, used]
        yield pa.RecordBatch.from_arrays([pa.array(token, pa.int32()), pa.array(np.r_[pieces, tokens, found[used]], pa.int64())], names=["token", "n"])

    return run


def corpus_frequencies(pieces: DataFrame, size: int, window: int) -> tuple[np.ndarray, int, int]:
    """Pieces and windows that hold each token, their number, tokens: a row for each token of the vocabulary at most."""
    rows = pieces.select("rest", "whole_terms").mapInArrow(frequency_counter(size, window), "token int, n long").groupBy("token").agg(F.sum("n").alias("n")).toPandas()
    counts = dict(zip(rows.token, rows.n))
    out = np.zeros(size, np.int64)
    for token, n in counts.items():
        if token >= 0:
            out[token] = n
    return out, int(counts.get(-1, 0)), int(counts.get(-2, 0))


def term_weights(held: np.ndarray, n: int) -> np.ndarray:
    """BM25's idf; a term that half of the pieces or more hold weighs nothing."""
    return np.maximum(np.log((n - held + 0.5) / (held + 0.5)), 0.0)


TERM_SCHEMA = "piece long, salt long, doc_id long, doc_tokens long, t1 int, t2 int, t3 int"


def leading_terms(sent) -> Callable:
    """The three tokens of greatest tf-idf of each piece; ties go to the lower token, -1 stands for none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, _ = sent.value
        for batch in batches:
            out = np.full((batch.num_rows, 3), -1, np.int32)
            for start, rests in in_turns(batch.column(4)):
                piece, terms, counts = counted_terms(rests)
                weight = idf[terms] * np.log1p(counts)
                piece, terms, weight = piece[weight > 0], terms[weight > 0], weight[weight > 0]
                for k in range(3):
                    if not len(piece):
                        break
                    begins = np.flatnonzero(np.r_[True, piece[1:] != piece[:-1]])
                    greatest = np.repeat(np.maximum.reduceat(weight, begins), np.diff(np.r_[begins, len(piece)]))
                    best = np.flatnonzero(weight == greatest)
                    best = best[np.searchsorted(best, begins)]  # the lowest token of each piece
                    out[start + piece[best], k] = terms[best]
                    piece, terms, weight = (np.delete(x, best) for x in (piece, terms, weight))
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], *(pa.array(out[:, k]) for k in range(3))], names=[x.split()[0] for x in TERM_SCHEMA.split(", ")])

    return run


PIECE_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class ShardIndex:
    """Postings of one shard: for each token the pieces that hold it and their BM25 weights."""

    def __init__(self, pieces: list[np.ndarray], idf: np.ndarray, mean_length: float, rule: PackRule):
        lengths = np.array([len(p) for p in pieces])
        at = np.repeat(np.arange(len(pieces)), lengths)
        joined = np.concatenate(pieces).astype(np.int64) if len(pieces) else np.zeros(0, np.int64)
        weighty = idf[joined] > 0
        pairs, counts = np.unique(joined[weighty] * len(pieces) + at[weighty], return_counts=True)
        self.piece, token = (pairs % max(1, len(pieces))).astype(np.int64), pairs // max(1, len(pieces))
        scale = rule.k1 * (1 - rule.b + rule.b * lengths[self.piece] / mean_length)
        self.weight = idf[token] * counts * (rule.k1 + 1) / (counts + scale)
        self.starts = np.searchsorted(token, np.arange(len(idf) + 1))
        self.n = len(pieces)

    def scores(self, seed: np.ndarray) -> np.ndarray:
        """BM25 score of every piece for all of the seed's terms."""
        terms = np.unique(seed).astype(np.int64)
        low, sizes = self.starts[terms], self.starts[terms + 1] - self.starts[terms]
        low, sizes = low[sizes > 1], sizes[sizes > 1]  # the seed itself is one
        at = np.arange(sizes.sum()) + np.repeat(low - np.r_[0, np.cumsum(sizes)[:-1]], sizes)
        return np.bincount(self.piece[at], self.weight[at], minlength=self.n)


def pack_shard(pieces: list[np.ndarray], idf: np.ndarray, mean_length: float, rule: PackRule) -> list[list[tuple[int, int, int]]]:
    """Sequences of (piece, start, length): neighbours of a seed fill its window."""
    index = ShardIndex(pieces, idf, mean_length, rule)
    begin = np.zeros(len(pieces), np.int64)
    left = np.array([len(p) for p in pieces], np.int64)
    sequences, following = [], 0
    while True:
        while following < len(pieces) and not left[following]:
            following += 1
        if following == len(pieces):
            return sequences
        seed, room, sequence = following, rule.window, []

        def take(k: int) -> None:
            nonlocal room
            n = min(room, int(left[k]))
            sequence.append((k, int(begin[k]), n))
            begin[k] += n
            left[k] -= n
            room -= n

        take(seed)
        if room:
            scores = np.where(left > 0, index.scores(pieces[seed]), 0.0)
            ranked = np.flatnonzero(scores > 0)
            for k in ranked[np.argsort(-scores[ranked], kind="stable")]:
                if not room:
                    break
                take(int(k))
        k = following
        while room and k < len(pieces):
            if left[k]:
                take(k)
            k += 1
        sequences.append(sequence)


def shard_packer(sent, rule: PackRule) -> Callable:
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        idf, mean_length = sent.value
        frame = frame.sort_values("nth", kind="stable")
        first = int(frame["shard"].iloc[0]) << 40
        pieces = [np.frombuffer(x, "<u2") for x in frame["rest"]]
        ids, tokens = frame.doc_id.tolist(), frame.doc_tokens.tolist()
        rows, sequence_id = [], first
        for doc_id, n, crcs in zip(ids, tokens, frame.whole_crcs):
            for k, crc in enumerate(crcs):
                rows.append((doc_id, k * rule.window, rule.window, crc, n, sequence_id, 0))
                sequence_id += 1
        for sequence in pack_shard(pieces, idf, mean_length, rule):
            offset = 0
            for k, start, length in sequence:
                base = tokens[k] - len(pieces[k])
                rows.append((ids[k], base + start, length, crc_of(pieces[k][start : start + length]), tokens[k], sequence_id, offset))
                offset += length
            sequence_id += 1
        out = pd.DataFrame(rows, columns=[x.split()[0] for x in PIECE_SCHEMA.split(", ")])
        return out.astype({c: "Int64" if c == "doc_id" else "int64" for c in out.columns})

    return run


def packed_pieces(docs: DataFrame, rule: PackRule = PackRule(), place: str | None = None) -> DataFrame:
    """One row per piece of a document: what it holds and where it is in which sequence."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id"), F.col("text"), (F.lit(0) if place is None else F.col(f"`{place}`")).cast("long").alias("place"))
    pieces = checkpointed(rows.mapInArrow(tokenise(rule), TOKEN_SCHEMA).withColumn("piece", F.monotonically_increasing_id()))
    size = vocabulary_size(rule.tokenizer)
    held, n, tokens = corpus_frequencies(pieces, size, rule.window)
    sent = spark.sparkContext.broadcast((term_weights(held, n), max(1.0, tokens / max(1, n))))  # a number for each token of the vocabulary
    if place is None:
        keys = pieces.select("piece", "salt", "doc_id", "doc_tokens", "rest").mapInArrow(leading_terms(sent), TERM_SCHEMA)
        keys = checkpointed(keys)  # ranges are sampled before they are dealt
        order = ["t1", "t2", "t3", "salt", "doc_id", "doc_tokens", "piece"]
    else:
        keys, order = pieces.select("piece", "place"), ["place", "piece"]
    # numbers of narrow rows; pieces themselves are exchanged to their shard once
    nth = numbered(keys, [F.col(c) for c in order], "nth").select(F.col("piece").alias("p"), "nth")
    dealt = pieces.select("piece", "doc_id", "doc_tokens", "whole_crcs", "rest").join(nth, F.col("piece") == F.col("p"))
    dealt = dealt.select(F.expr(f"nth div {rule.shard_docs}").cast("int").alias("shard"), "nth", "doc_id", "doc_tokens", "whole_crcs", "rest")
    return dealt.groupBy("shard").applyInPandas(shard_packer(sent, rule), PIECE_SCHEMA)
