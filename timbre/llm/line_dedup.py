"""Line dedup: two Bloom filters single out suspected repeats, a shuffle confirms them.

Pass 1: every task sets, for the hash of each distinct line key of a document,
``PROBES`` cells in a "once" filter, and in a "twice" filter those cells that
were set before. Two pairs of filters merge exactly, cell by cell
(``twice = a.twice | b.twice | a.once & b.once``), so a key that two documents
hold has all its cells in the merged "twice" filter. Pass 2: only lines whose
cells are all set there are shuffled, as digests; an aggregate by digest
confirms those of two documents or more and finds the smallest ``doc_id``.
Then each document gets the digests that it must lose.

The filters have about eight cells per line and ``MAX_CELLS`` at most (16 MiB
each, in bits from the start), whatever the corpus; beyond that more lines are suspected, so
more of them shuffle, and the result stays the same.

Edge cases: a null or empty text is one empty line; a row with a null ``doc_id``
can't be ordered, so its lines neither count nor go; rows that repeat a
``doc_id`` are one document, whose lines stay in all of its rows; keys of less
than ten code points always stay; an empty table gives an empty result; other
columns travel in a struct and can't clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from timbre.llm.common import checkpointed, narrow, spread_join

MIN_KEY = 10
PROBES = 3
CELLS_PER_LINE = 8
MIN_CELLS, MAX_CELLS = 1 << 16, 1 << 27
#: Cells of one segment of the filters, which is the unit of merging.
SEGMENT = 1 << 18
DIGEST = 16
#: Documents whose kept lines a worker holds at once.
SLICE = 512


def key_of(line: bytes) -> bytes | None:
    """The line's key, or None where it has less than ``MIN_KEY`` code points."""
    key = line.strip(b" \t\n\x0b\x0c\r").lower()  # bytes.lower() touches A-Z only
    if len(key) < MIN_KEY or len(key) < 4 * MIN_KEY and len(key.decode()) < MIN_KEY:
        return None
    return key


def digest_of(key: bytes) -> bytes:
    return hashlib.sha256(key).digest()[:DIGEST]


def key_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of the document's distinct keys."""
    keys = {k for line in (text or "").encode().split(b"\n") if (k := key_of(line)) is not None}
    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))


def cells_of(hashes: np.ndarray, cells: int) -> np.ndarray:
    """``PROBES`` cells of each hash, one row each."""
    h1, h2 = hashes & np.uint64(0xFFFFFFFF), hashes >> np.uint64(32) | np.uint64(1)
    return np.stack([(h1 + np.uint64(i) * h2) % np.uint64(cells) for i in range(PROBES)], axis=1).astype(np.int64)


def packed(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The cells as bits: distinct bytes of a filter, and the bits in each (as ``np.packbits`` has them)."""
    cells = np.unique(cells)
    byte, bit = cells >> 3, np.uint8(128) >> (cells & 7).astype(np.uint8)
    first = np.flatnonzero(np.r_[True, byte[1:] != byte[:-1]])
    return byte[first], np.bitwise_or.reduceat(bit, first)


def filter_cells(lines: int) -> int:
    """A power of two: about ``CELLS_PER_LINE`` cells a line, within the bounds."""
    return min(MAX_CELLS, max(MIN_CELLS, 1 << (CELLS_PER_LINE * max(lines, 1) - 1).bit_length()))


def filter_builder(cells: int) -> Callable:
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(cells // 8, np.uint8), np.zeros(cells // 8, np.uint8)
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                if not doc_id.is_valid or not len(h := key_hashes(text.as_py())):
                    continue
                # one document sets a cell once, whichever of its keys do
                at, bits = packed(cells_of(h, cells))
                twice[at] |= once[at] & bits
                once[at] |= bits
        for k in range(0, cells, SEGMENT):
            a, b = (x[k // 8 : (k + SEGMENT) // 8] for x in (once, twice))
            if a.any():
                yield pa.RecordBatch.from_arrays([pa.array([k // SEGMENT], pa.int32()), pa.array([a.tobytes()]), pa.array([b.tobytes()])], names=["segment", "once", "twice"])

    return build


def merge_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merges the filters of each segment seen in this task; at most all segments are held."""
    once: dict[int, np.ndarray] = {}
    twice: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, a, b in zip(*(batch.column(i) for i in range(3))):
            k = k.as_py()
            a, b = (np.frombuffer(x.as_py(), np.uint8) for x in (a, b))
            if k in once:
                twice[k] = twice[k] | b | once[k] & a
                once[k] = once[k] | a
            else:
                once[k], twice[k] = a, b
    for k in once:
        yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([once[k].tobytes()]), pa.array([twice[k].tobytes()])], names=["segment", "once", "twice"])


def twice_filter(rows: DataFrame, cells: int) -> np.ndarray:
    """The merged packed "twice" filter: ``cells / 8`` bytes, 16 MiB at most."""
    schema = "segment int, once binary, twice binary"
    parts = rows.mapInArrow(filter_builder(cells), schema)
    # a tree of merges: few filters of a segment meet in one task
    parts = parts.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(16)))
    parts = parts.repartition("segment", "salt").select("segment", "once", "twice").mapInArrow(merge_segments, schema)
    parts = parts.repartition("segment").mapInArrow(merge_segments, schema).select("segment", "twice")
    packed = np.zeros(cells // 8, np.uint8)
    size = min(SEGMENT, cells) // 8
    for row in parts.toLocalIterator():
        packed[row.segment * size : (row.segment + 1) * size] = np.frombuffer(row.twice, np.uint8)
    return packed


def suspect_scanner(filter_bytes, cells: int) -> Callable:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = np.frombuffer(filter_bytes.value, np.uint8)
        for batch in batches:
            ids, digests = [], []
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                if not doc_id.is_valid:
                    continue
                keys = list({k for line in (text.as_py() or "").encode().split(b"\n") if (k := key_of(line)) is not None})
                if not keys:
                    continue
                cell = cells_of(np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys)), cells)
                hit = (packed[cell >> 3] >> (7 - (cell & 7)) & 1).all(axis=1)
                for i in np.flatnonzero(hit):
                    ids.append(doc_id.as_py())
                    digests.append(digest_of(keys[i]))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(digests, pa.binary())], names=["doc_id", "digest"])

    return scan


def repeated_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, drop): the digests of the keys that each document must lose."""
    rows = narrow(docs, doc_id="doc_id", text="text")
    lines = rows.agg(F.sum(F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1)).first()[0] or 0
    cells = filter_cells(lines)
    sent = docs.sparkSession.sparkContext.broadcast(twice_filter(rows, cells).tobytes())
    suspects = checkpointed(rows.mapInArrow(suspect_scanner(sent, cells), "doc_id long, digest binary"))
    confirmed = suspects.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"), F.count("*").alias("n")).where("first_id < last_id")
    confirmed = checkpointed(confirmed.select(F.col("digest").alias("d"), "first_id", "n"))
    total = confirmed.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    losing = spread_join(suspects, confirmed, "digest", "d", "n", total, F.xxhash64("doc_id")).where("doc_id > first_id")
    return losing.groupBy("doc_id").agg(F.collect_set("digest").alias("drop"))


def deduped_text(text: str | None, drop: set[bytes]) -> tuple[str, int, int]:
    """Kept lines joined, lines before, lines dropped."""
    lines = (text or "").split("\n")
    if not drop:
        return text or "", len(lines), 0
    kept = [x for x in lines if (k := key_of(x.encode())) is None or digest_of(k) not in drop]
    return "\n".join(kept), len(lines), len(lines) - len(kept)


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (b.slice(i, SLICE) for b in batches for i in range(0, b.num_rows, SLICE)):
        out = [deduped_text(t.as_py(), set(d.as_py() or ())) for t, d in zip(batch.column(1), batch.column(2))]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.int64()), pa.array([x[2] for x in out], pa.int64())],
            names=["row", "text", "n_lines", "n_dropped"],
        )


def line_deduped(docs: DataFrame) -> DataFrame:
    """``row`` (the columns of ``docs`` but the text), ``text`` without repeated lines, ``n_lines``, ``n_dropped``."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    rows = docs.select(F.col("doc_id").alias("id"), F.struct(*others).alias("row"), "text")
    losing = repeated_lines(docs).select(F.col("doc_id").alias("losing_id"), "drop")
    # rows without an id lose nothing; they get keys of their own, so that they don't meet in one task
    rows = rows.withColumn("nameless", F.when(F.col("id").isNull(), F.monotonically_increasing_id()))
    losing = losing.withColumn("named", F.lit(None).cast("long"))
    joined = rows.join(losing, F.col("id").eqNullSafe(F.col("losing_id")) & F.col("nameless").eqNullSafe(F.col("named")), "left").select("row", "text", "drop")
    kind = T.StructType([joined.schema["row"], T.StructField("text", T.StringType()), T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    return joined.mapInArrow(_apply, kind)


def drop_repeated_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated lines removed, columns unchanged.

    ``n_chars`` (code points of the text) follows the text where there is such a column.
    """
    out = line_deduped(docs)
    changed = {"text": F.col("text"), "n_chars": F.when(F.col("n_dropped") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("row.n_chars"))} if "n_chars" in docs.columns else {"text": F.col("text")}
    return out.select(*(changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))


def line_report(docs: DataFrame) -> DataFrame:
    """One row per document: lines before, lines dropped, digest of the kept text."""
    return line_deduped(narrow(docs, doc_id="doc_id", text="text")).select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
