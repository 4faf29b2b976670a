"""Folders of files as a data source, for batches and for streams.

``spark.read.format("folders")`` lists the files below a root; ``spark.readStream`` hands
out whole folders, each in one batch and never again. Options: ``path``, ``pattern`` (of
file names), ``depth`` (folders lie so many levels below the root; without it every folder
that holds a matching file counts), ``settle`` (seconds that a folder must have been
unchanged), ``perpartition`` (folders of a task), and for streams ``log`` and ``maxfolders``.

A stream's offset is the number of a batch, and the folders of each batch are listed in a
file of the log, written once before the batch is announced. So a batch that is planned
again has the same folders, and the offsets stay small however many folders there are.
Files are listed in tasks; the driver lists folders only where ``depth`` is given.
"""

from __future__ import annotations

import fnmatch
import json
import time
from collections.abc import Iterator, Sequence

import pyarrow.fs
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "folder string, path string, size long, modified timestamp"
MAX_FOLDERS = 1000
PER_PARTITION = 16


def file_system(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a path or URI, and the path inside it."""
    if "://" in path or path.startswith("file:"):
        scheme, _, rest = path.partition(":")
        if scheme == "file":
            return pyarrow.fs.LocalFileSystem(), "/" + rest.lstrip("/")
        return pyarrow.fs.FileSystem.from_uri(path)
    return pyarrow.fs.LocalFileSystem(), path


class Folders(InputPartition):
    def __init__(self, names: Sequence[str]):
        self.names = list(names)


class _Listing:
    """What batches and streams share: finding folders, and listing the files of some."""

    def __init__(self, options):
        self.root = options["path"].rstrip("/")
        self.pattern = options.get("pattern", "*.nc")
        self.depth = int(options["depth"]) if options.get("depth") else None
        self.settle = float(options.get("settle", 0))
        self.per_partition = int(options.get("perpartition", PER_PARTITION))

    def folders(self) -> list[str]:
        fs, root = file_system(self.root)
        kind = pyarrow.fs.FileType
        if fs.get_file_info(root).type != kind.Directory:
            raise ValueError(f"{self.root} is no folder")
        if self.depth is not None:
            level = [root]
            for _ in range(self.depth):
                level = [x.path for f in level for x in fs.get_file_info(pyarrow.fs.FileSelector(f)) if x.type == kind.Directory]
            return sorted(level)
        found: dict[str, float] = {}
        for x in fs.get_file_info(pyarrow.fs.FileSelector(root, recursive=True)):
            if x.type == kind.File and fnmatch.fnmatch(x.base_name, self.pattern):
                parent = x.path.rpartition("/")[0]
                found[parent] = max(found.get(parent, 0.0), x.mtime.timestamp() if x.mtime else 0.0)
        return sorted(f for f, changed in found.items() if time.time() - changed >= self.settle)

    def parts(self, folders: Sequence[str]) -> list[Folders]:
        return [Folders(folders[k : k + self.per_partition]) for k in range(0, len(folders), self.per_partition)]

    def read(self, partition: Folders) -> Iterator[tuple]:
        fs, _ = file_system(self.root)
        for folder in partition.names:
            for x in sorted(fs.get_file_info(pyarrow.fs.FileSelector(folder)), key=lambda x: x.path):
                if x.type == pyarrow.fs.FileType.File and fnmatch.fnmatch(x.base_name, self.pattern):
                    yield folder, x.path, x.size, x.mtime


class _FolderReader(_Listing, DataSourceReader):
    def partitions(self) -> list[Folders]:
        found = self.folders()
        if not found:
            raise ValueError(f"no files {self.pattern} below {self.root}")
        return self.parts(found)


class _FolderStream(_Listing, DataSourceStreamReader):
    def __init__(self, options):
        super().__init__(options)
        self.log = options["log"].rstrip("/")
        self.most = int(options.get("maxfolders", MAX_FOLDERS))
        self.seen: set[str] = set()
        self.last = 0

    def initialOffset(self) -> dict:
        return {"batch": 0}

    def _entry(self, number: int) -> list[str] | None:
        fs, log = file_system(self.log)
        path = f"{log}/{number:09d}.json"
        if fs.get_file_info(path).type != pyarrow.fs.FileType.File:
            return None
        with fs.open_input_stream(path) as f:
            return json.loads(f.read())

    def latestOffset(self) -> dict:
        while (known := self._entry(self.last + 1)) is not None:
            self.seen.update(known)
            self.last += 1
        fresh = [f for f in self.folders() if f not in self.seen][: self.most]
        if fresh:
            fs, log = file_system(self.log)
            fs.create_dir(log, recursive=True)
            number = self.last + 1
            with fs.open_output_stream(f"{log}/.{number:09d}.tmp") as f:
                f.write(json.dumps(fresh).encode())
            fs.move(f"{log}/.{number:09d}.tmp", f"{log}/{number:09d}.json")
            self.seen.update(fresh)
            self.last = number
        return {"batch": self.last}

    def partitions(self, start: dict, end: dict) -> list[Folders]:
        return self.parts([f for n in range(start["batch"] + 1, end["batch"] + 1) for f in self._entry(n) or ()])

    def commit(self, end: dict) -> None:
        """The log stays: it says which folders have been handed out."""


class FolderSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "folders"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _FolderReader(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _FolderStream(self.options)
