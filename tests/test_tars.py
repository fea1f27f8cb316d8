"""Tar shards and vector files by offset: against whole-file reads, after failures, with the bytes that are read."""

from __future__ import annotations

import io
import os
import random
import tarfile
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from timbre.functions import signal
from timbre.sources import shards, staged, tar_writer, tars, vector_files


def tar_bytes(members, kind=tarfile.GNU_FORMAT):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w", format=kind) as tar:
        for name, data in members:
            info = tarfile.TarInfo(name)
            if data is None:
                info.type = tarfile.DIRTYPE
                tar.addfile(info)
                continue
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))
    return out.getvalue()


def base(name):
    name = name.rsplit("/", 1)[-1]
    return name.rsplit(".", 1)[0] if "." in name[1:] else name


def whole_read(data):
    """All audio members whose stem has a sidecar, the last of its name."""
    with tarfile.open(fileobj=io.BytesIO(data)) as tar:
        members = tar.getmembers()
        sidecars = {base(m.name): m for m in members if m.isfile() and m.name.lower().endswith(".json")}
        for n, m in enumerate(members):
            if m.isfile() and m.name.lower().endswith(shards.AUDIO) and base(m.name) in sidecars:
                yield base(m.name), n, m.name, tar.extractfile(m).read(), tar.extractfile(sidecars[base(m.name)]).read().decode("utf-8", "replace")


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    rng, path = random.Random(1), tmp_path_factory.mktemp("tars")
    long = "x" * 150
    members = [("a.flac", b"one"), ("a.json", b'{"id": 1}'), ("d", None), ("d/b.WAV", b"old"), ("d/b.WAV", b"new"), ("e/b.mp3", b"third"), ("b.json", b"{}"), ("b.JSON", b'{"last": true}')]
    members += [("orphan.flac", b"x"), ("alone.json", b"{}"), (f"{long}.opus", b"long name"), (f"{long}.json", b"{}"), ("é.x.ogg", b""), ("é.x.json", b"\xff{}"), (".flac", b"no stem"), (".json", b"{}"), ("note.txt", b"n")]
    (path / "T1.tar").write_bytes(tar_bytes(members))
    (path / "T2.tar").write_bytes(tar_bytes(members, tarfile.PAX_FORMAT))
    (path / "T0.tar").write_bytes(tar_bytes([]))
    (path / "deep").mkdir()
    many = [(f"c{k}{s}", rng.randbytes(rng.randint(0, 3000))) for k in range(300) for s in (".flac", ".json")]
    rng.shuffle(many)
    (path / "deep" / "T3.tar").write_bytes(tar_bytes(many))
    return path


def test_clips_equal_whole_reads(spark, folder):
    want = Counter()
    for name in ("T1", "T2", "deep/T3"):
        want.update((name.rsplit("/", 1)[-1], *clip) for clip in whole_read((folder / f"{name}.tar").read_bytes()))
    got = Counter((r.shard, r.clip_id, r.position, r.member, bytes(r.audio), r.sidecar) for r in tars.read_clips(spark, str(folder)).collect())
    assert sum(want.values()) > 300
    utf8 = lambda rows: Counter({k[:5]: n for k, n in rows.items()})  # noqa: E731  random sidecars aren't UTF-8, whose mending isn't compared
    assert utf8(got) == utf8(want)
    assert {k for k in got if k[0] != "T3"} == {k for k in want if k[0] != "T3"}
    only = tars.read_clips(spark, str(folder), audio=False)
    assert only.columns == ["shard", "clip_id", "position", "member", "sidecar"] and only.count() == sum(want.values())
    assert [r.task_id for r in tars.shard_tasks(spark, str(folder)).collect()] == ["T0", "T1", "T2", "T3"]


def test_small_runs_give_the_same(spark, folder):
    rows = tars.paired(tars.member_index(spark, str(folder)))
    parts = [("audio", "offset", "size"), ("sidecar", "sidecar_offset", "sidecar_size")]
    key = lambda df: Counter((r.tar, r.position, bytes(r.audio), bytes(r.sidecar)) for r in df.collect())
    want = key(tars.fetched(rows, parts))
    for near, run, task in ((0, 1, 20_000), (100, 5000, 50_000), (1 << 20, 1 << 20, 1)):
        out = tars.fetched(rows, parts, near, run, task)
        assert key(out) == want
    asked = rows.agg(F.sum(F.col("size") + F.col("sidecar_size"))).first()[0]
    read = tars.fetched(rows, parts, near=0).agg(F.sum("read_bytes")).first()[0]
    assert read <= 1.1 * asked  # pairs whose members are apart may be read with what lies between


def test_reads_are_joined_by_distance():
    data = bytes(range(256)) * 40

    class Counted(io.BytesIO):
        reads: list = []

        def read(self, n=-1):
            self.reads.append(n)
            return super().read(n)

    wanted = [(5000, 10), (0, 5), (5, 5), (20, 10), (5002, 3), (9000, 0), (0, 5)]
    got, count = tars.read_members(Counted(data), wanted, near=10)
    assert got == [data[a : a + n] for a, n in wanted] and Counted.reads == [30, 10, 0] and count == 40
    with pytest.raises(OSError):
        tars.read_members(io.BytesIO(data), [(10_239, 2)], 0)


def test_tar_beyond_two_gigabytes(spark, tmp_path):
    """A sparse member of 3 GB before the clips: only headers and clips are read."""
    hole = 3 << 30
    info = tarfile.TarInfo("hole.bin")
    info.size = hole
    with open(tmp_path / "big.tar", "wb") as f:
        f.write(info.tobuf(tarfile.GNU_FORMAT))
        f.seek(hole, os.SEEK_CUR)
        f.write(tar_bytes([("z.flac", b"far away"), ("z.json", b'{"spk": "s"}')]))
    row = tars.read_clips(spark, str(tmp_path)).first()
    assert (row.clip_id, bytes(row.audio), row.sidecar) == ("z", b"far away", '{"spk": "s"}')
    assert tars.member_index(spark, str(tmp_path)).where("member = 'z.flac'").first().offset > hole


def test_damaged_tars_are_told(spark, tmp_path):
    whole = tar_bytes([("a.flac", b"x" * 2000), ("a.json", b"{}"), ("b.flac", b"y" * 2000)])
    (tmp_path / "cut.tar").write_bytes(whole[: whole.index(b"y" * 500) + 100])
    (tmp_path / "junk.tar").write_bytes(b"no tar" * 200)
    rows = tars.member_index(spark, str(tmp_path)).collect()
    assert {r.shard for r in rows if r.error} == {"cut", "junk"}
    assert [r.clip_id for r in tars.read_clips(spark, str(tmp_path)).collect()] == ["a"]


def test_sidecar_fields(spark, tmp_path):
    voice = signal.encode_wav(signal.synthetic_voice(0.5), 16000)
    (tmp_path / "T.tar").write_bytes(tar_bytes([("a.wav", voice), ("a.json", shards.sidecar_of(id="a", text="hi", spk="s", lang="en", dur="x", dnsmos=3.5)), ("d.wav", voice), ("d.json", b'{"wav": "D"}')]))
    clips = tars.read_clips(spark, str(tmp_path))
    rows = {r.clip_id: r for r in shards.resolved(clips).collect()}
    assert rows["d"].original_id == "D" and rows["a"].original_speaker == "s" and rows["a"].duration_s is None and rows["a"].original_dnsmos == 3.5
    features = clips.select("clip_id", signal.features_udf()("audio").alias("f")).select("clip_id", "f.*").collect()
    assert all(abs(r.duration_s - 0.5) < 1e-9 for r in features)


def test_entries_get_their_audio(spark, folder):
    entries = spark.createDataFrame([("T1", "b", 1), ("T1", "b", 2), ("T1", "gone", 3), ("T9", "a", 4), ("T3", "c7", 5), (None, None, 6)], "source_shard string, clip_id string, n int")
    index = tars.member_index(spark, str(folder))
    rows = {r.n: r for r in tars.attached(entries, index).collect()}
    assert [rows[n].has_audio for n in range(1, 7)] == [True, True, False, False, True, False]
    assert bytes(rows[1].audio) == b"third" and rows[1].audio_ext == "mp3" and rows[3].audio is None
    asked = sum(len(r.audio) for r in rows.values() if r.audio is not None)
    assert sum(r.read_bytes for r in rows.values()) <= asked  # of a tar of half a megabyte


def clip_rows(spark, n=120):
    rows = [(f"prime/shard-{k % 7:05d}", k, f"c{k:04d}", "flac", None if k % 11 == 0 else bytes([k % 256]) * (k % 50), None if k % 13 == 0 else f'{{"n": {k}}}', k * 0.5) for k in range(n)]
    return rows, spark.createDataFrame(rows, "shard string, position long, clip_id string, audio_ext string, audio binary, sidecar string, score double").repartition(5)


def members_of(path):
    found = {}
    for root, _, names in os.walk(path):
        for name in names:
            if name.endswith(".tar"):
                with tarfile.open(os.path.join(root, name)) as tar:
                    found[os.path.relpath(os.path.join(root, name), path)[:-4]] = [(m.name, tar.extractfile(m).read()) for m in tar]
    return found


def expected(rows):
    found = {}
    for shard, _, clip, ext, audio, sidecar, _ in sorted(rows):
        found.setdefault(shard, []).extend([*([(f"{clip}.{ext}", audio)] if audio is not None else []), (f"{clip}.json", (sidecar or "{}").encode())])
    return found


def test_shards_and_manifest(spark, tmp_path):
    rows, df = clip_rows(spark)
    path = str(tmp_path / "out")
    manifest = tar_writer.write_shards(df, path, tasks=3)
    assert members_of(path) == expected(rows) and not os.path.exists(f"{path}/_staged/")or not os.listdir(f"{path}/_staged")
    got = {(r.shard, r.offset): (r.clip_id, r.has_audio, r.audio_bytes, r.sidecar_bytes, r.score) for r in manifest.collect()}
    at = Counter()
    for shard, _, clip, _, audio, sidecar, score in sorted(rows):
        assert got.pop((shard, at[shard])) == (clip, audio is not None, len(audio or b""), len(sidecar or "{}"), score)
        at[shard] += 1
    assert not got
    tar_writer.write_shards(df.where("position < 10"), path, mode="overwrite")
    assert members_of(path) == expected(rows[:10])


def attempt(writer, rows, schema, fail=False):
    def batches():
        for r in sorted(rows):
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r))], schema)
        if fail:
            raise RuntimeError("lost")

    return writer.write(batches())


def test_failed_and_repeated_tasks(tmp_path):
    schema = pa.schema([("shard", pa.string()), ("position", pa.int64()), ("clip_id", pa.string()), ("audio_ext", pa.string()), ("audio", pa.binary()), ("sidecar", pa.string())])
    rows = [(f"s{k // 4}", k, f"c{k}", "wav", bytes(k), "{}") for k in range(12)]
    writer = tar_writer.TarWriter(str(tmp_path), overwrite=False)
    with pytest.raises(RuntimeError):
        attempt(writer, rows[:8], schema, fail=True)
    attempt(writer, rows[:8], schema)  # finished, but not the attempt that counts
    messages = [attempt(writer, rows[:8], schema), None, attempt(writer, rows[8:], schema), attempt(writer, [], schema)]
    kept = writer.abort
    writer.abort = lambda m: (_ for _ in ()).throw(RuntimeError("the driver is lost at the end of its commit"))
    with pytest.raises(RuntimeError):
        writer.commit(messages)
    writer.abort = kept
    writer.commit(messages)
    want = expected([(*r, 0) for r in rows])
    assert members_of(str(tmp_path)) == want and len(os.listdir(tmp_path / "manifest")) == 2
    other = tar_writer.TarWriter(str(tmp_path), overwrite=False)
    with pytest.raises(ValueError):
        other.commit([attempt(other, rows[:4], schema), attempt(other, rows[:4], schema)])
    with pytest.raises(ValueError):
        attempt(other, [("a", 0, "c", "x", b"", ""), ("b", 1, "c", "x", b"", "")], schema) and other.write(iter([pa.RecordBatch.from_pylist([dict(zip(schema.names, (s, 0, "c", "x", b"", ""))) for s in "aba"], schema)]))
    other.abort([])
    assert members_of(str(tmp_path)) == want and not os.listdir(tmp_path / "_staged")


def test_vectors_by_pointer(spark, tmp_path):
    rng, path = np.random.default_rng(3), "file://" + str(tmp_path)
    vectors = rng.normal(size=(90, 12)).astype(np.float32)
    rows = spark.createDataFrame([(f"emb-{k % 4}.npy", k // 4, v.tolist()) for k, v in enumerate(vectors)], "emb_file string, emb_row long, embedding array<float>").repartition(4)
    vector_files.write_vectors(rows, path, tasks=2)
    for k in range(4):
        assert np.array_equal(np.load(tmp_path / f"emb-{k}.npy"), vectors[k::4].astype(np.float16))
    asked = [("emb-1.npy", 3, "x"), ("emb-1.npy", 3, "y"), ("emb-0.npy", 22, "x"), ("emb-3.npy", 99, "x"), ("none.npy", 0, "x"), ("emb-2.npy", -1, "x"), (None, 0, "x"), ("emb-2.npy", None, "x")]
    out = vector_files.read_vectors(spark.createDataFrame(asked, "emb_file string, emb_row long, kind string"), path).collect()
    got = {(r.emb_file, r.emb_row, r.kind): r.vector for r in out}
    for file, row, kind in asked[:3]:
        assert got[file, row, kind] == vectors[row * 4 + int(file[4])].astype(np.float16).astype(np.float32).tolist()
    assert all(got[a] is None for a in asked[3:]) and len(out) == len(asked)
    assert sum(r.read_bytes for r in out) == 2 * 24  # the row asked for twice is read once
    with pytest.raises(Exception, match="numbers"):
        vector_files.write_vectors(rows.withColumn("embedding", F.when(F.col("emb_row") == 2, F.array(F.lit(1.0))).otherwise(F.col("embedding"))), path + "/other")
    assert staged.opened("file:/a/b")[1] == "/a/b"


def counted_rows(spark, df):
    """``df``, and a count of the rows that tasks have worked out for it."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    return df.mapInArrow(count, df.schema), seen


def test_small_tars_share_tasks(spark, tmp_path):
    """Tasks don't grow with the number of small tars; headers and the rows to fetch are worked out once."""
    for k in range(40):
        (tmp_path / f"s{k}.tar").write_bytes(tar_bytes([(f"c{k}.flac", bytes([k])), (f"c{k}.json", b"{}")]))
    index = tars.member_index(spark, str(tmp_path))
    assert index.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism and index.count() == 80
    assert "MapInArrow" not in index._jdf.queryExecution().toString()
    rows, seen = counted_rows(spark, tars.paired(index))
    out = tars.fetched(rows, [("audio", "offset", "size")], task_bytes=10).collect()
    assert sorted(bytes(r.audio) for r in out) == [bytes([k]) for k in range(40)] and seen.value == 40
