"""Tar shards by offset: an index of members from the headers alone, and reads of the byte ranges that rows ask for.

A first pass reads the headers of each tar (a task per large tar or per many small
ones, no payload) and stores them. Members are paired and chosen as rows of that index; what they hold is then fetched by
tasks that each take a range of a tar, open it once and read neighbouring members
together. So tars may be of any size, a task holds one run of members at a time,
and members that nobody asks for aren't read. Tars are uncompressed and lie in
any store that ``pyarrow.fs`` opens by its address.
"""

from __future__ import annotations

import tarfile
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from timbre.sources.shards import is_audio, stem
from timbre.sources.staged import opened
from timbre.store import checkpointed

INDEX = "tar string, shard string, position long, member string, offset long, size long, error string"
#: Members that lie nearer than this are read together; bytes that a task holds of one run, unless a member is larger.
NEAR, RUN = 1 << 16, 8 << 20
#: Bytes that a fetching task reads, about.
TASK_BYTES = 128 << 20
#: Bytes that opening a tar counts as, where tars are dealt to indexing tasks.
OPEN_BYTES = 1 << 20
BATCH = 1024


def tar_files(spark: SparkSession, path: str) -> DataFrame:
    """(tar, size) of the tars under ``path``; contents aren't read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.tar").option("recursiveFileLookup", "true").load(path)
    return files.select(F.col("path").alias("tar"), F.col("length").alias("size"))


def shard_tasks(spark: SparkSession, path: str) -> DataFrame:
    """(task_id): stems of the tars, sorted."""
    return tar_files(spark, path).select(F.regexp_extract("tar", r"([^/]+)\.tar$", 1).alias("task_id")).orderBy("task_id")


def headers(handle) -> Iterator[tuple[int, str, int, int]]:
    """(position, name, offset, size) of the regular files of an open tar."""
    with tarfile.open(fileobj=handle, mode="r:") as tar:
        position = 0
        while (m := tar.next()) is not None:
            tar.members = []  # the list would grow with the tar
            if m.isfile():
                yield position, m.name, m.offset_data, m.size
            position += 1


def _index_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = pa.schema([("tar", pa.string()), ("shard", pa.string()), ("position", pa.int64()), ("member", pa.string()), ("offset", pa.int64()), ("size", pa.int64()), ("error", pa.string())])
    for batch in batches:
        for tar in batch.column(0).to_pylist():
            shard, rows = tar.rsplit("/", 1)[-1].removesuffix(".tar"), []
            try:
                store, place = opened(tar)
                with store.open_input_file(place) as handle:
                    end = handle.size()
                    for position, name, offset, size in headers(handle):
                        if offset + size > end:
                            raise tarfile.ReadError(f"member {name} ends after the file")
                        rows.append((tar, shard, position, name, offset, size, None))
                        if len(rows) == BATCH:
                            yield pa.RecordBatch.from_pylist([dict(zip(kinds.names, r)) for r in rows], kinds)
                            rows = []
            except tarfile.TarError as e:
                rows.append((tar, shard, None, None, None, None, str(e)))
            if rows:
                yield pa.RecordBatch.from_pylist([dict(zip(kinds.names, r)) for r in rows], kinds)


def member_index(spark: SparkSession, path: str, tasks: int | None = None) -> DataFrame:
    """A row per regular member of each tar; a damaged tar has a row with the error after its last whole member.

    Headers are read once, whatever is done with the rows. Small tars share tasks, which are dealt by bytes and opened files.
    """
    files = checkpointed(tar_files(spark, path))
    count, size = files.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    shares = max(-(-(size + count * OPEN_BYTES) // TASK_BYTES), spark.sparkContext.defaultParallelism)
    spread = files.select("tar").repartition(tasks or max(1, min(count, shares)))
    return checkpointed(spread.mapInArrow(_index_batches, INDEX))


def paired(index: DataFrame) -> DataFrame:
    """A row per audio member whose stem has a JSON sidecar (the last one of that stem), with both places."""
    members = index.where("error IS NULL").withColumn("clip_id", stem(F.col("member")))
    sidecar = members.where(F.lower("member").endswith(".json")).groupBy("tar", "clip_id").agg(F.max_by(F.struct("offset", "size"), "position").alias("s"))
    return members.where(is_audio(F.col("member"))).join(sidecar, ["tar", "clip_id"]).select("tar", "shard", "clip_id", "position", "member", "offset", "size", F.col("s.offset").alias("sidecar_offset"), F.col("s.size").alias("sidecar_size"))


def last_audio(index: DataFrame) -> DataFrame:
    """(tar, shard, clip_id, member, offset, size): the last audio member of each stem."""
    members = index.where("error IS NULL").where(is_audio(F.col("member"))).withColumn("clip_id", stem(F.col("member")))
    return members.groupBy("tar", "shard", "clip_id").agg(F.max_by(F.struct("member", "offset", "size"), "position").alias("m")).select("tar", "shard", "clip_id", "m.*")


def runs(wanted: Sequence[tuple[int, int]], near: int) -> list[tuple[int, int]]:
    """(start, end) of reads that cover the wanted (offset, size), joined where they lie nearer than ``near``."""
    joined: list[list[int]] = []
    for offset, size in sorted(wanted):
        if joined and offset <= joined[-1][1] + near:
            joined[-1][1] = max(joined[-1][1], offset + size)
        else:
            joined.append([offset, offset + size])
    return [(a, b) for a, b in joined]


def read_members(handle, wanted: Sequence[tuple[int, int]], near: int) -> tuple[list[bytes], int]:
    """What lies at the wanted (offset, size), in their order, and the bytes read for it."""
    found, spans = {}, runs(wanted, near)
    at = iter(sorted(set(wanted)))
    place = next(at, None)
    for start, end in spans:
        handle.seek(start)
        data = handle.read(end - start)
        if len(data) < end - start:
            raise OSError(f"the file ends at {start + len(data)}, {end} was asked for")
        while place is not None and place[0] + place[1] <= end and place[0] >= start:
            found[place] = data[place[0] - start : place[0] - start + place[1]]
            place = next(at, None)
    return [found[w] for w in wanted], sum(b - a for a, b in spans)


def _fetcher(file: str, parts: Sequence[tuple[str, str, str]], near: int, run: int):
    """A function over batches that come sorted by file and place: adds a binary column for each (name, offset, size) and ``read_bytes``."""

    def flush(handle, rows: list[dict]) -> list[dict]:
        wanted = [(r[o], r[s]) for r in rows for _, o, s in parts if r[o] is not None]
        got, count = read_members(handle, wanted, near) if wanted else ([], 0)
        data = iter(got)
        for r in rows:
            for name, o, _ in parts:
                r[name] = next(data) if r[o] is not None else None
            r["read_bytes"], count = count, 0
        return rows

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        handle, tar, held, weight, schema = None, None, [], 0, None
        for batch in batches:
            if schema is None:
                schema = pa.schema([*batch.schema, *((name, pa.binary()) for name, _, _ in parts), ("read_bytes", pa.int64())])
            for row in batch.to_pylist():
                size = sum(row[s] or 0 for _, _, s in parts)
                if held and (row[file] != tar or weight + size > run or len(held) == BATCH):
                    yield pa.RecordBatch.from_pylist(flush(handle, held), schema)
                    held, weight = [], 0
                if row[file] != tar:
                    if handle is not None:
                        handle.close()
                    tar, handle = row[file], None
                    if tar is not None:
                        store, place = opened(tar)
                        handle = store.open_input_file(place)
                held.append(row)
                weight += size
        if held:
            yield pa.RecordBatch.from_pylist(flush(handle, held), schema)
        if handle is not None:
            handle.close()

    return fetch


def fetched(rows: DataFrame, parts: Sequence[tuple[str, str, str]], near: int = NEAR, run: int = RUN, task_bytes: int = TASK_BYTES, file: str = "tar") -> DataFrame:
    """``rows`` (with the address of a ``file``) and what lies at each of ``parts``, (new column, offset column, size column); null where the offset is.

    Rows are ordered by file and place over as many ranges as the bytes need, so
    each task reads its part of a file forwards. ``read_bytes`` has, on the first
    row of each run, the bytes that were read for it. ``rows`` are worked out once
    and stored, since their bytes, their ranges and their order are asked for.
    """
    rows = checkpointed(rows)
    total = rows.agg(*(F.sum(F.coalesce(s, F.lit(0))) for _, _, s in parts)).first()
    tasks = max(1, -(-sum(x or 0 for x in total) // task_bytes))
    spread = rows.repartitionByRange(int(tasks), file, parts[0][1]).sortWithinPartitions(file, parts[0][1])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields) + "".join(f", `{name}` binary" for name, _, _ in parts) + ", read_bytes long"
    return spread.mapInArrow(_fetcher(file, parts, near, run), schema)


def read_clips(spark: SparkSession, path: str, audio: bool = True) -> DataFrame:
    """(shard, clip_id, position, member, audio, sidecar) of all tars under ``path``; without ``audio`` only the sidecars are read."""
    parts = [("audio", "offset", "size")] * audio + [("sidecar", "sidecar_offset", "sidecar_size")]
    rows = fetched(paired(member_index(spark, path)), parts)
    text = F.make_valid_utf8(F.col("sidecar").cast("string"))
    return rows.select("shard", "clip_id", "position", "member", *["audio"] * audio, text.alias("sidecar"))


def attached(entries: DataFrame, index: DataFrame, shard: str = "source_shard", key: str = "clip_id") -> DataFrame:
    """``entries`` with audio, audio_ext and has_audio from their source shards; a missing shard or member leaves a null audio.

    Every entry stays, in one row for each of its rows; only the members asked for are read.
    """
    found = last_audio(index).select(F.col("shard").alias("__shard"), F.col("clip_id").alias("__clip"), "tar", "member", "offset", "size")
    rows = entries.join(found, (F.col(shard) == F.col("__shard")) & (F.col(key) == F.col("__clip")), "left").drop("__shard", "__clip")
    rows = fetched(rows, [("audio", "offset", "size")])
    extension = F.regexp_extract("member", r"\.([^./]*)$", 1)
    return rows.select(*entries.columns, "audio", extension.alias("audio_ext"), F.col("audio").isNotNull().alias("has_audio"), "read_bytes")
