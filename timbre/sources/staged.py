"""Staged writes: tasks write files into folders of their own, one commit moves those of accepted tasks into place.

A commit message only names files, so what goes to the driver grows with the files
and not with the rows. Manifests are moved after the files that they name. A task
that failed or ran twice leaves nothing behind, and a commit may be repeated.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs
from pyspark.sql.datasource import DataSourceArrowWriter, WriterCommitMessage

#: Moves that a commit makes at a time.
MOVERS = 16


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The store of an address and the path in it; ``file:/x`` as Hadoop writes it is known too."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[5:]
    return fs.FileSystem.from_uri(path)


@dataclass
class Staged(WriterCommitMessage):
    """Files of one task: (staged, final)."""

    files: list[tuple[str, str]] = field(default_factory=list)
    manifests: list[tuple[str, str]] = field(default_factory=list)


class StagedWriter(DataSourceArrowWriter):
    """A writer whose ``write_files`` streams batches into files of its own folder."""

    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite, self.job = path.rstrip("/"), overwrite, uuid.uuid4().hex

    def write_files(self, store: fs.FileSystem, root: str, own: str, batches: Iterator[pa.RecordBatch]) -> Staged:
        raise NotImplementedError

    def staging(self, root: str) -> str:
        return f"{root}/_staged/{self.job}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        store, root = opened(self.path)
        own = f"{self.staging(root)}/{uuid.uuid4().hex}"
        store.create_dir(own)
        return self.write_files(store, root, own, iterator)

    def commit(self, messages: list[Staged | None]) -> None:
        store, root = opened(self.path)
        done = [m for m in messages if m is not None]
        finals = [final for m in done for _, final in m.files]
        if len(set(finals)) < len(finals):
            self.abort(messages)
            raise ValueError(f"files written by several tasks: {', '.join(sorted({f for f in finals if finals.count(f) > 1}))}")
        if self.overwrite:
            found = store.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
            fresh = {final for m in done for _, final in (*m.files, *m.manifests)}
            old = [f.path for f in found if f.type == fs.FileType.File and "/_staged/" not in f.path and f.path not in fresh]
            for path in sorted(old, key=lambda p: "/manifest/" not in p):  # a manifest before what it names
                store.delete_file(path)

        def move(pair: tuple[str, str]) -> None:
            staged, final = pair
            if store.get_file_info(staged).type == fs.FileType.File:  # else an earlier commit has moved it
                store.move(staged, final)

        with ThreadPoolExecutor(MOVERS) as pool:
            for kind in ("files", "manifests"):
                pairs = [pair for m in done for pair in getattr(m, kind)]
                for folder in sorted({final.rsplit("/", 1)[0] for _, final in pairs}):
                    store.create_dir(folder)
                list(pool.map(move, pairs))  # all files are in place before a manifest is
        self.abort(messages)

    def abort(self, messages: list[Staged | None]) -> None:
        """Deletes what the tasks of this job have staged."""
        store, root = opened(self.path)
        if store.get_file_info(self.staging(root)).type == fs.FileType.Directory:
            store.delete_dir(self.staging(root))
