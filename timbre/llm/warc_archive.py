"""WARC archives: written by Spark's text writer, read by boundary-chain verification.

A record is ASCII header lines, an empty line, the payload and two line ends.
Spark's text writer with two line ends as its separator writes such records on
any file system, with its own commit protocol; files may be of any size.

To read, files are split into byte ranges (Spark's text reader, with the version
line as separator), one task each. A task emits, for each place that looks like
a record, its offset and that of the record that would follow it, which may lie
in a later range. Inside a range the task follows these links itself, so that
only the places at which a chain can enter a range are left; pointer jumping
over them, from the start of each file, finds the entries that are reached, and
each range then marks its records from its entry on. A version line inside a
payload is reached by no chain and is part of its record's payload again.

Pages whose payloads are equal and have at least 100 bytes are stored once: the
page with the smallest id is a response, the others are revisits of it.

Edge cases: a null html is an empty payload; a null url has no target line; a
null ``page_id`` is always a response; a url, header or payload of any length is
read back; rows that repeat a ``page_id`` get a record each, all of the same
type; an empty table gives an empty result; only three columns are read, so
others can't clash. A damaged record ends its file's chain: the records after it
aren't reached.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from timbre.llm.common import checkpointed, delete_path, fresh_path, narrow, spread_join

MIN_REVISIT = 100
ENDS = "\r\n\r\n"
#: Records are split at this; the rest of the version line follows.
MAGIC = "WARC/1."
VERSIONS = (b"0\r\n", b"1\r\n")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"


def header_of(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> str:
    lines = [f"{MAGIC}0", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", "WARC-Date: 1970-01-01T00:00:00Z"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    lines.append(f"WARC-Payload-Digest: sha256:{digest}")
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    lines += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}"]
    return "\r\n".join(lines) + ENDS


def packed_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Payloads compressed for the exchange, with their digest."""
    press = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        raw = [(x.as_py() or "").encode() for x in batch.column(2)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([press.compress(x) for x in raw], pa.binary()), pa.array([hashlib.sha256(x).hexdigest() for x in raw], pa.string())],
            names=["page_id", "url", "packed", "digest"],
        )


def record_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The text of each record, without the two line ends behind it."""
    unpress = zstandard.ZstdDecompressor()
    for batch in batches:
        out = []
        for page_id, url, packed, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
            payload = b"" if refers_to is not None else unpress.decompress(packed)
            out.append(header_of(page_id, url, payload, digest, refers_to) + payload.decode())
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])


def write_archive(pages: DataFrame, path: str) -> None:
    """One record per row of ``pages`` (page_id, url, html) in files under ``path``."""
    rows = narrow(pages, page_id="page_id", url="url", html="html")
    payload = F.coalesce("html", F.lit("")).cast("binary")
    prints = rows.select("page_id", F.octet_length(payload).alias("size"), F.sha2(payload, 256).alias("digest"))
    prints = checkpointed(prints.where(f"size >= {MIN_REVISIT} and page_id is not null").select("page_id", "digest"))
    firsts = prints.groupBy("digest").agg(F.min("page_id").alias("first_id"), F.max("page_id").alias("last_id"), F.count("*").alias("n"))
    firsts = checkpointed(firsts.where("first_id < last_id").select(F.col("digest").alias("d"), "first_id", "n"))
    total = firsts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    again = spread_join(prints, firsts, "digest", "d", "n", total, F.xxhash64("page_id")).where("page_id > first_id").select(F.col("page_id").alias("again_id"), F.col("first_id").alias("refers_to")).distinct()
    packed = rows.mapInArrow(packed_batches, "page_id long, url string, packed binary, digest string")
    # a null id refers to nothing; it gets a key of its own that no id is joined with, so that nulls don't meet in one task
    packed = packed.withColumn("nth", F.when(F.col("page_id").isNull(), F.monotonically_increasing_id()).otherwise(F.lit(-1).cast("long")))
    records = packed.join(again.withColumn("none", F.lit(-1).cast("long")), (F.col("page_id").eqNullSafe(F.col("again_id"))) & (F.col("nth") == F.col("none")), "left")
    records = records.select("page_id", "url", "packed", "digest", "refers_to").mapInArrow(record_batches, "value string")
    records.write.option("lineSep", ENDS).text(path)


def header_fields(data: bytes) -> tuple[dict[bytes, bytes], int] | None:
    """Fields of the header that begins behind the magic, and where its payload starts; None if it isn't one."""
    if data[:3] not in VERSIONS:
        return None
    fields, line_at = {}, 3
    # line by line: a header may be of any length, and text that isn't one ends at its first line without a colon
    while (end := data.find(b"\r\n", line_at)) != line_at:
        name, colon, value = data[line_at:end].partition(b":")
        if end < 0 or not colon:
            return None
        fields[name.strip().lower()] = value.strip()
        line_at = end + 2
    return fields, end + 2


CANDIDATE_SCHEMA = "file long, block long, at long, size long, head long, length long, page_id long, url string, record_type string, refers_to long, payload_digest binary"
_CANDIDATE_KINDS = [*[pa.int64()] * 7, pa.string(), pa.string(), pa.int64(), pa.binary()]


def segment_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What lies between two magics, as a candidate record.

    ``at`` is its place behind the bytes of earlier segments of the same range;
    ``head`` and ``length`` are null where it can't be a record. The digest is
    that of the payload if the segment holds all of it.
    """
    number = lambda fields, name: int(m[1]) if (m := re.fullmatch(rb"<urn:page:(-?\d+)>", fields.get(name, b""))) else None
    names = [x.split()[0] for x in CANDIDATE_SCHEMA.split(", ")]
    block, at = None, 0
    for batch in batches:
        rows = []
        for file, start, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            if block != (file, start):
                block, at = (file, start), 0
            data = value.as_py()
            parsed = header_fields(data)
            length = parsed and parsed[0].get(b"content-length", b"")
            if not parsed or not length.isdigit():
                rows.append((file, start, at, len(data), *[None] * 7))
            else:
                (fields, head), length = parsed, int(length)
                url, payload = fields.get(b"warc-target-uri"), data[head : head + length]
                digest = hashlib.sha256(payload).digest() if len(payload) == length else None
                rows.append((file, start, at, len(data), head, length, number(fields, b"warc-record-id"), url and url.decode(errors="replace"), fields.get(b"warc-type", b"").decode(errors="replace"), number(fields, b"warc-refers-to"), digest))
            at += len(data) + len(MAGIC)
        columns = list(zip(*rows)) or [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _CANDIDATE_KINDS)], names=names)


def segments(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, value): the bytes between two magics, in the file's order within a byte range; a file is known by the hash of its path."""
    rows = spark.read.option("lineSep", MAGIC).option("pathGlobFilter", "part-*").text(path)
    return rows.select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("value"))


LINK_SCHEMA = "file long, block long, offset long, next long"


def exits(frame: pd.DataFrame) -> pd.DataFrame:
    """Each place of a range with the first place behind the range that its chain comes to; null if it ends in the range."""
    frame = frame.sort_values("offset")
    last, out = frame.offset.iloc[-1], {}
    for offset, after in zip(frame.offset[::-1].tolist(), frame.next[::-1].tolist()):
        out[offset] = None if after != after or after is None else int(after) if after > last else out.get(int(after))
    return pd.DataFrame({"file": frame.file.iloc[0], "block": frame.block.iloc[0], "offset": list(out), "next": pd.array(list(out.values()), "Int64")})


def marked(frame: pd.DataFrame) -> pd.DataFrame:
    """The places of a range that the chain from its entry reaches."""
    after = dict(zip(frame.offset.tolist(), frame.next.tolist()))
    at, found = next((int(x) for x in frame.entry if x == x), None), []
    while at is not None and at in after:
        found.append(at)
        step = after[at]
        at = None if step != step or step is None else int(step)
    return pd.DataFrame({"file": frame.file.iloc[0], "offset": pd.Series(found, dtype="int64")})


def reachable(links: DataFrame) -> DataFrame:
    """(file, offset) of the places (file, block, offset, next) on the chain from each file's start.

    Pointer jumping over the entries of ranges: a round doubles the length of
    all pointers and marks what the marked entries point to, so a chain through
    n ranges takes log2(n) rounds.
    """
    out = checkpointed(links.groupBy("file", "block").applyInPandas(exits, LINK_SCHEMA))
    entered = out.select(F.col("file").alias("nf"), F.col("next").alias("nn")).where("nn is not null").distinct()
    nodes = out.join(entered, (F.col("file") == F.col("nf")) & (F.col("offset") == F.col("nn")), "left_semi").where("offset > 0").unionByName(out.where("offset = 0"))
    nodes = checkpointed(nodes.select("file", "block", F.col("offset").alias("a"), F.col("next").alias("b"), (F.col("offset") == 0).alias("on")))
    while not nodes.where("`on` and b is not null").isEmpty():
        marks = nodes.where("`on` and b is not null").select(F.col("file").alias("mf"), F.col("b").alias("mb")).distinct()
        ends = nodes.select(F.col("file").alias("ef"), F.col("a").alias("ea"), F.col("b").alias("eb"))
        step = nodes.join(ends, (F.col("file") == F.col("ef")) & (F.col("b") == F.col("ea")), "left")
        step = step.join(marks, (F.col("file") == F.col("mf")) & (F.col("a") == F.col("mb")), "left")
        nodes = checkpointed(step.select("file", "block", "a", F.col("eb").alias("b"), (F.col("on") | F.col("mb").isNotNull()).alias("on")))
    entries = nodes.where("`on`").select(F.col("file").alias("ef"), F.col("block").alias("eb"), F.col("a").alias("entry"))
    known = links.join(entries, (F.col("file") == F.col("ef")) & (F.col("block") == F.col("eb"))).select("file", "block", "offset", "next", "entry")
    return known.groupBy("file", "block").applyInPandas(marked, "file long, offset long")


def scan_archive(spark: SparkSession, path: str) -> DataFrame:
    """The records of the archive files under ``path`` (not compressed), as they stand."""
    found = checkpointed(segments(spark, path).mapInArrow(segment_batches, CANDIDATE_SCHEMA))
    # bytes of the ranges before each range of its file: a row for each range
    sums = found.groupBy("file", "block").agg(F.sum(F.col("size") + len(MAGIC)).alias("held"))
    before = F.sum("held").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.select(F.col("file").alias("sf"), F.col("block").alias("sb"), F.coalesce(before, F.lit(0)).alias("before"))
    # a record's offset is that of its magic; the segment before a file's first magic is empty and not a record
    placed = found.join(sums, (F.col("file") == F.col("sf")) & (F.col("block") == F.col("sb"))).drop("sf", "sb").withColumn("offset", F.col("before") + F.col("at") - len(MAGIC))
    placed = placed.where("length is not null").withColumn("next", F.col("offset") + len(MAGIC) + F.col("head") + F.col("length") + len(ENDS)).drop("size", "at", "before")
    on = checkpointed(reachable(placed.select("file", "block", "offset", "next")).withColumnRenamed("file", "rf").withColumnRenamed("offset", "ro"))
    records = placed.join(on, (F.col("file") == F.col("rf")) & (F.col("offset") == F.col("ro"))).drop("rf", "ro", "block", "next")
    torn = checkpointed(records.where("payload_digest is null").select("file", "offset", "head", "length"))
    if torn.isEmpty():
        return records
    whole = mended(spark, path, torn, sums).withColumnRenamed("file", "wf").withColumnRenamed("offset", "wo")
    joined = records.join(whole, (F.col("file") == F.col("wf")) & (F.col("offset") == F.col("wo")), "left")
    return joined.withColumn("payload_digest", F.coalesce("payload_digest", "mended_digest")).drop("wf", "wo", "mended_digest")


def mended(spark: SparkSession, path: str, torn: DataFrame, sums: DataFrame) -> DataFrame:
    """(file, offset, mended_digest) of records whose payload holds the magic: their segments are read again and put together."""
    ranges = sums.join(torn, F.col("sf") == F.col("file")).where(F.col("before") <= F.col("offset") + len(MAGIC) + F.col("head") + F.col("length"))
    last = F.lead("before").over(Window.partitionBy("file", "offset").orderBy("sb"))
    # the ranges from the last one that begins at or before the record
    ranges = ranges.withColumn("after", last).where("after is null or after > offset").select("sf", "sb", "before", F.col("offset").alias("start"), "head", "length")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, at = None, 0
        for batch in batches:
            places = []
            for file, start, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if block != (file, start):
                    block, at = (file, start), 0
                places.append(at)
                at += len(value.as_py()) + len(MAGIC)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(places, pa.int64())], names=["file", "block", "value", "at"])

    parts = segments(spark, path).mapInArrow(pieces, "file long, block long, value binary, at long")
    parts = parts.join(ranges, (F.col("file") == F.col("sf")) & (F.col("block") == F.col("sb"))).withColumn("place", F.col("before") + F.col("at") - len(MAGIC))
    parts = parts.where((F.col("place") >= F.col("start")) & (F.col("place") < F.col("start") + len(MAGIC) + F.col("head") + F.col("length")))

    def joined(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("place")
        data = MAGIC.encode().join(frame.value)
        head, length = int(frame["head"].iloc[0]), int(frame["length"].iloc[0])
        digest = hashlib.sha256(data[head : head + length]).digest()
        return pd.DataFrame({"file": [frame.file.iloc[0]], "offset": [int(frame.start.iloc[0])], "mended_digest": [digest]})

    return parts.select("file", "start", "head", "length", "place", "value").groupBy("file", "start").applyInPandas(joined, "file long, offset long, mended_digest binary")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """One row per record; revisits have the size and digest of the payload they refer to."""
    records = checkpointed(scan_archive(spark, path).select("page_id", "url", "record_type", "refers_to", F.col("length").alias("payload_bytes"), F.lower(F.hex("payload_digest")).alias("payload_digest")))
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")
    revisits = records.where("refers_to is not null")
    wanted = checkpointed(revisits.groupBy(F.col("refers_to").alias("first_id")).agg(F.count("*").alias("n")))
    full = records.where("record_type = 'response' and page_id is not null").join(wanted, F.col("page_id") == F.col("first_id"), "left_semi").groupBy("page_id").agg(F.max("payload_bytes").alias("full_bytes"), F.max("payload_digest").alias("full_digest"))
    full = checkpointed(wanted.join(full, F.col("first_id") == F.col("page_id"), "left").select("first_id", "n", "full_bytes", "full_digest"))
    total = full.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    joined = spread_join(revisits.drop("payload_bytes", "payload_digest"), full, "refers_to", "first_id", "n", total, F.xxhash64("page_id", "url"))
    joined = joined.withColumnsRenamed({"full_bytes": "payload_bytes", "full_digest": "payload_digest"})
    return records.where("refers_to is null").select(*names).unionByName(joined.select(*names))


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Writes an archive of ``pages`` into the shared folder, reads it back and drops it."""
    spark = pages.sparkSession
    path = fresh_path(spark, "warc")
    write_archive(pages, path)
    records = read_archive(spark, path)  # its records are in a checkpoint by now
    delete_path(spark, path)
    return records
