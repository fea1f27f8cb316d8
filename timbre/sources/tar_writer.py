"""A data source that writes tar shards and the manifest of what they hold.

Rows come with their shard and their place in it; those of one shard must come to
one task in order (``write_shards`` sees to that). A task streams its members into
one tar after the other and its manifest rows into a file beside them.
"""

from __future__ import annotations

import io
import tarfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource
from pyspark.sql.types import StructType

from timbre.sources.staged import Staged, StagedWriter

#: What a row must have; its other columns go to the manifest as they are.
MEMBERS = ("shard", "position", "clip_id", "audio_ext", "audio", "sidecar")
FLUSH = 1024


class Unlisted(list):
    """The member list of a tar that is only written: it would grow with the shard."""

    def append(self, item: object) -> None:
        pass


class OpenTar:
    """A tar that is streamed to a store."""

    def __init__(self, store: fs.FileSystem, path: str):
        self.out = store.open_output_stream(path)
        self.tar = tarfile.open(fileobj=self.out, mode="w", format=tarfile.PAX_FORMAT)
        self.tar.members, self.clips = Unlisted(), 0

    def add(self, name: str, data: bytes) -> None:
        info = tarfile.TarInfo(name)
        info.size = len(data)
        self.tar.addfile(info, io.BytesIO(data))

    def close(self) -> None:
        self.tar.close()
        self.out.close()


class TarWriter(StagedWriter):
    def write_files(self, store: fs.FileSystem, root: str, own: str, batches: Iterator[pa.RecordBatch]) -> Staged:
        staged, seen, rows = Staged(), set(), []
        shard = tar = manifest = kinds = None
        for batch in batches:
            if kinds is None:
                extra = [f for f in batch.schema if f.name not in MEMBERS]
                kinds = pa.schema([("shard", pa.string()), ("offset", pa.int64()), ("clip_id", pa.string()), ("member", pa.string()), ("has_audio", pa.bool_()), ("audio_bytes", pa.int64()), ("sidecar_bytes", pa.int64()), *extra])
                place = f"{own}/manifest.parquet"
                manifest = pq.ParquetWriter(place, kinds, filesystem=store, compression="zstd")
                staged.manifests.append((place, f"{root}/manifest/part-{uuid.uuid4().hex}.parquet"))
            for i in range(batch.num_rows):
                (row,) = batch.slice(i, 1).to_pylist()  # one payload at a time
                if tar is None or row["shard"] != shard:
                    if tar is not None:
                        tar.close()
                    shard = row["shard"]
                    if shard in seen:
                        raise ValueError(f"rows of shard {shard} aren't together")
                    seen.add(shard)
                    place = f"{own}/{len(staged.files)}.tar"
                    tar = OpenTar(store, place)
                    staged.files.append((place, f"{root}/{shard}.tar"))
                audio, sidecar = row["audio"], (row["sidecar"] if row["sidecar"] is not None else "{}").encode()
                member = None if audio is None else f"{row['clip_id']}.{row['audio_ext']}"
                if member is not None:
                    tar.add(member, audio)
                tar.add(f"{row['clip_id']}.json", sidecar)
                rows.append((shard, tar.clips, row["clip_id"], member, member is not None, len(audio or b""), len(sidecar), *(row[f.name] for f in extra)))
                tar.clips += 1
                if len(rows) == FLUSH:
                    manifest.write_table(pa.Table.from_pylist([dict(zip(kinds.names, r)) for r in rows], kinds))
                    rows = []
        if tar is not None:
            tar.close()
            manifest.write_table(pa.Table.from_pylist([dict(zip(kinds.names, r)) for r in rows], kinds))
            manifest.close()
        return staged


class TarShards(DataSource):
    """Format ``tar_shards``: writes shard tars with their manifest under ``path``."""

    @classmethod
    def name(cls) -> str:
        return "tar_shards"

    def writer(self, schema: StructType, overwrite: bool) -> TarWriter:
        if missing := sorted(set(MEMBERS) - set(schema.names)):
            raise ValueError(f"columns that a shard's rows need: {', '.join(missing)}")
        return TarWriter(self.options["path"], overwrite)


def write_shards(rows: DataFrame, path: str, tasks: int | None = None, mode: str = "append") -> DataFrame:
    """Writes rows (shard, position, clip_id, audio_ext, audio, sidecar and others) as tars under ``path``; returns the manifest.

    Shards are of bounded size (``rollover`` or slices), so a task may take whole
    ones. Rows without audio keep their sidecar; null sidecars are empty documents.
    """
    rows.sparkSession.dataSource.register(TarShards)
    spread = rows.repartition(tasks, "shard") if tasks else rows.repartition("shard")
    spread.sortWithinPartitions("shard", "position").write.format("tar_shards").mode(mode).save(path)
    return read_manifest(rows.sparkSession, path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """A row per packed clip: shard, offset (its number in the shard), clip_id, member, has_audio, bytes and the columns that came with it."""
    return spark.read.option("mergeSchema", "true").parquet(f"{path.rstrip('/')}/manifest")


def shard_name(tier: str, number: str, prefix: str = "shard") -> Column:
    """``tier/prefix-NNNNN`` of a column of tiers and one of numbers."""
    return F.concat(F.col(tier), F.format_string(f"/{prefix}-%05d", F.col(number)))
