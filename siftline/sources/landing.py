"""Recorded payloads as a data source (X1): ``spark.readStream.format("payloads")``.

Fetchers leave what they get as JSON lines in ``<path>/<source type>/<feed>/``, in
files whose names rise (a time or a number); each line is a ``RAW_FETCH`` row as
an object, with times as ``YYYY-MM-DD HH:MM:SS`` in UTC. As a stream, the source
remembers the last file read of each feed (its offset) and gives a micro-batch's
new files to one partition for each source type and ``files_a_partition`` files.
As a batch it reads all files. Files are read by the tasks; the driver lists them.

    spark.dataSource.register(Payloads)
    raw = spark.readStream.format("payloads").option("path", landing).load()
"""

from __future__ import annotations

import json
from datetime import datetime
from typing import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from ..plans.sweep_run import RAW_FETCH

TIME = "%Y-%m-%d %H:%M:%S"


class Files(InputPartition):
    def __init__(self, source_type: str, paths: list[str]):
        self.source_type, self.paths = source_type, paths


def _store(path: str):
    from pyarrow import fs as pafs
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path.removeprefix("file:"))


def listed(path: str) -> dict[str, list[str]]:
    """The files of each feed (source type/feed), in order."""
    from pyarrow import fs as pafs
    store, base = _store(path)
    out: dict[str, list[str]] = {}
    for f in store.get_file_info(pafs.FileSelector(base, recursive=True, allow_not_found=True)):
        parts = f.path[len(base.rstrip("/")) + 1:].split("/")
        if f.type == pafs.FileType.File and len(parts) == 3 and parts[2].endswith(".jsonl") and parts[2][0] not in "._":
            out.setdefault("/".join(parts[:2]), []).append(parts[2])
    return {feed: sorted(names) for feed, names in sorted(out.items())}


def partitions(files: dict[str, list[str]], size: int) -> list[Files]:
    """Each source type's files, ``size`` a partition."""
    own: dict[str, list[str]] = {}
    for feed, names in files.items():
        own.setdefault(feed.split("/")[0], []).extend(f"{feed}/{n}" for n in names)
    return [Files(kind, paths[k:k + size]) for kind, paths in own.items() for k in range(0, len(paths), size)]


def rows(path: str, schema: StructType, part: Files) -> Iterator[tuple]:
    """The rows of a partition's files; a line that is no object, or lacks a
    readable field, is an error that names its file."""
    store, base = _store(path)
    for name in part.paths:
        with store.open_input_stream(f"{base.rstrip('/')}/{name}") as f:
            text = f.read().decode("utf-8")
        for n, line in enumerate(text.splitlines(), 1):
            if not line.strip():
                continue
            try:
                row = {"source_type": part.source_type, **json.loads(line)}
                yield tuple(datetime.strptime(row[c.name], TIME) if c.name == "sweep_ts" and row.get(c.name) else row.get(c.name)
                            for c in schema)
            except (ValueError, TypeError) as e:
                raise ValueError(f"{name}, line {n}: {e}") from e


class Payloads(DataSource):
    """Options: ``path``; ``files_a_partition`` (64)."""

    @classmethod
    def name(cls) -> str:
        return "payloads"

    def schema(self) -> str:
        return RAW_FETCH

    def reader(self, schema: StructType) -> DataSourceReader:
        return PayloadReader(schema, self.options)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return PayloadStream(schema, self.options)


class PayloadReader(DataSourceReader):
    def __init__(self, schema: StructType, options):
        self.schema, self.path, self.size = schema, options["path"], int(options.get("files_a_partition", "64"))

    def partitions(self) -> list[Files]:
        return partitions(listed(self.path), self.size) or [Files("", [])]

    def read(self, partition: Files) -> Iterator[tuple]:
        return rows(self.path, self.schema, partition)


class PayloadStream(DataSourceStreamReader):
    """The offset is the name of the last file of each feed."""

    def __init__(self, schema: StructType, options):
        self.schema, self.path, self.size = schema, options["path"], int(options.get("files_a_partition", "64"))

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return {feed: names[-1] for feed, names in listed(self.path).items()}

    def partitions(self, start: dict, end: dict) -> list[Files]:
        new = {feed: [n for n in names if start.get(feed, "") < n <= end.get(feed, "")] for feed, names in listed(self.path).items()}
        return partitions(new, self.size) or [Files("", [])]

    def read(self, partition: Files) -> Iterator[tuple]:
        return rows(self.path, self.schema, partition)
