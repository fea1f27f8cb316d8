"""Vector files: half-precision rows of fixed width, addressed by (file, row).

A file is an array of numpy's format with a row per vector. Writers stage files as
those of ``staged`` do; readers take the headers of the files that pointers name
and then only the byte ranges of their rows.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource
from pyspark.sql.types import StructType

from timbre.sources.staged import Staged, StagedWriter, opened
from timbre.sources.tars import fetched

#: More than a header of two dimensions ever takes.
HEADER = 1024
HEADERS = "emb_file string, data_offset long, dims long, rows long"


def header_of(rows: int, dims: int) -> bytes:
    out = io.BytesIO()
    np.lib.format.write_array_header_1_0(out, {"descr": "<f2", "fortran_order": False, "shape": (rows, dims)})
    return out.getvalue()


def read_header(start: bytes) -> tuple[int, int, int]:
    """(offset of the data, dims, rows) of a file by its first bytes."""
    f = io.BytesIO(start)
    read = {(1, 0): np.lib.format.read_array_header_1_0, (2, 0): np.lib.format.read_array_header_2_0}[np.lib.format.read_magic(f)]
    shape, by_column, kind = read(f)
    if kind != np.dtype("<f2") or by_column or len(shape) != 2:
        raise ValueError(f"not rows of half precision: {kind}, {shape}")
    return f.tell(), shape[1], shape[0]


class VectorWriter(StagedWriter):
    def write_files(self, store: fs.FileSystem, root: str, own: str, batches: Iterator[pa.RecordBatch]) -> Staged:
        staged, name, out, seen = Staged(), None, None, set()
        dims = left = 0
        for batch in batches:
            files, rows, vectors = batch.column("emb_file").to_pylist(), batch.column("emb_rows").to_pylist(), batch.column("embedding")
            for file, n, vector in zip(files, rows, vectors):
                if out is None or file != name:
                    if left:
                        raise ValueError(f"{name} lacks {left} of its rows")
                    if out is not None:
                        out.close()
                    if file in seen:
                        raise ValueError(f"rows of {file} aren't together")
                    seen.add(file)
                    name, left, dims = file, n, len(vector)
                    place = f"{own}/{len(staged.files)}.npy"
                    out = store.open_output_stream(place)
                    out.write(header_of(n, dims))
                    staged.files.append((place, f"{root}/{file}"))
                values = vector.values.to_numpy(zero_copy_only=False).astype("<f2")
                if len(values) != dims or not left:
                    raise ValueError(f"{name} has rows of {dims} and {len(values)} numbers" if left else f"{name} has more rows than it says")
                out.write(values.tobytes())
                left -= 1
        if left:
            raise ValueError(f"{name} lacks {left} of its rows")
        if out is not None:
            out.close()
        return staged


class VectorFiles(DataSource):
    """Format ``half_vectors``: writes vector files under ``path``."""

    @classmethod
    def name(cls) -> str:
        return "half_vectors"

    def writer(self, schema: StructType, overwrite: bool) -> VectorWriter:
        return VectorWriter(self.options["path"], overwrite)


def write_vectors(rows: DataFrame, path: str, tasks: int | None = None, mode: str = "append") -> None:
    """Writes the vectors of ``rows`` (emb_file, emb_row, embedding): each file has rows 0 to n - 1 of one width.

    A file belongs to a shard, whose size is bounded, so a task may take whole ones.
    """
    rows.sparkSession.dataSource.register(VectorFiles)
    sizes = rows.groupBy("emb_file").agg(F.count("*").alias("emb_rows"))
    rows = rows.select("emb_file", "emb_row", F.col("embedding").cast("array<float>").alias("embedding")).join(sizes, "emb_file")
    spread = rows.repartition(tasks, "emb_file") if tasks else rows.repartition("emb_file")
    spread.sortWithinPartitions("emb_file", "emb_row").write.format("half_vectors").mode(mode).save(path)


def _headers(path: str):
    kinds = pa.schema([("emb_file", pa.string()), ("data_offset", pa.int64()), ("dims", pa.int64()), ("rows", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = opened(path)
        for batch in batches:
            rows = []
            for file in batch.column(0).to_pylist():
                place = f"{root.rstrip('/')}/{file}"
                if store.get_file_info(place).type == fs.FileType.File:
                    with store.open_input_file(place) as f:
                        rows.append(dict(zip(kinds.names, (file, *read_header(f.read(HEADER))))))
            yield pa.RecordBatch.from_pylist(rows, kinds)

    return read


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw = batch.column(batch.num_columns - 2)
        vectors = [None if v is None else np.frombuffer(v, "<f2").astype(np.float32) for v in raw.to_pylist()]
        columns = [*batch.columns[:-2], pa.array(vectors, pa.list_(pa.float32())), batch.columns[-1]]
        yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-2], "vector", "read_bytes"])


def read_vectors(pointers: DataFrame, path: str) -> DataFrame:
    """``pointers`` (with emb_file and emb_row) and the vector at each; null where there is no such file or row. Other rows aren't read."""
    headers = pointers.select("emb_file").distinct().where("emb_file IS NOT NULL").mapInArrow(_headers(path), HEADERS)
    inside = (F.col("emb_row") >= 0) & (F.col("emb_row") < F.col("rows"))
    width = F.when(inside, F.col("dims") * 2)
    rows = pointers.join(headers, "emb_file", "left").select(*pointers.columns, F.concat(F.lit(path.rstrip("/") + "/"), "emb_file").alias("__file"), (F.col("data_offset") + F.col("emb_row") * width).alias("__offset"), width.alias("__width"))
    rows = rows.withColumn("__file", F.when(F.col("__offset").isNotNull(), F.col("__file")))
    out = fetched(rows, [("vector", "__offset", "__width")], file="__file")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields) + ", vector array<float>, read_bytes long"
    return out.mapInArrow(_decoded, schema).drop("__file", "__offset", "__width")
