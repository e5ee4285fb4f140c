"""Directory listing as a Spark data source (S1 for what file readers miss),
in batch and as a stream of scans (T1).

Spark's file readers skip ``.``/``_`` names and have no rows for empty
directories, but an intake listing must see both (a dot-file can match ``*``,
an empty ``.d`` directory is an entry of size 0). This source lists folders
visible to the executors (local or mounted shares). Nothing is listed on the
driver: a root is dealt to ``slices`` tasks, each lists its first level and takes
the names of its slice (by a hash), with all that is below them. Rows are stat
results, times in UTC; no file content is read. Links are followed, as the
watched folders may be links themselves; a linked directory that leads back to
one of its parents is listed but not entered.

A root that is missing or can't be read raises: a lost mount must not look
like an empty scan. So does a sub-directory that can't be read, unless it has
gone since the scan began.

    spark.dataSource.register(ListingDataSource)
    spark.read.format("intake_listing").option("roots", "/a,/b").load()

The stream lists all roots once a trigger. Each root also gives one row without
``rel``; where the root can't be read, it says why in ``error``, so empty and
failed scans are rows too. A listing can't be repeated: land a batch before
anything else reads it (``streaming.landing``).

    spark.dataSource.register(ScanDataSource)
    spark.readStream.format("intake_scans").option("roots", "/a,/b").load()
"""

from __future__ import annotations

import os
import stat
import time
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "watch string, rel string, name string, abs string, is_dir boolean, size long, mtime timestamp_ntz"
SCAN_SCHEMA = f"{SCHEMA}, scan_ts timestamp_ntz, error string"
SLICES = 8


def utc(seconds: float) -> datetime:
    return datetime.fromtimestamp(seconds, timezone.utc).replace(tzinfo=None)


def _row(root: str, path: str) -> tuple | None:
    """One entry; None if it has gone, or is a link to nothing."""
    try:
        st = os.stat(path)
    except FileNotFoundError:
        return None
    is_dir = stat.S_ISDIR(st.st_mode)
    return (root, os.path.relpath(path, root), os.path.basename(path), path, is_dir,
            0 if is_dir else int(st.st_size), utc(st.st_mtime))


def walk(root: str, part: int, parts: int, recursive: bool) -> Iterator[tuple]:
    """The entries of one slice of a root; raises if the root can't be read."""
    todo = []
    with os.scandir(root) as it:
        for e in it:
            if zlib.crc32(e.name.encode("utf-8", "surrogateescape")) % parts == part:
                row = _row(root, os.path.join(root, e.name))
                if row is not None:
                    yield row
                    if row[4] and recursive:
                        todo.append((row[3], (os.path.realpath(root),)))
    while todo:
        folder, above = todo.pop()
        real = os.path.realpath(folder)
        if real in above:
            continue
        try:
            names = os.listdir(folder)
        except FileNotFoundError:
            continue
        for name in names:
            row = _row(root, os.path.join(folder, name))
            if row is not None:
                yield row
                if row[4]:
                    todo.append((row[3], (*above, real)))


class _Slice(InputPartition):
    def __init__(self, root: str, part: int, parts: int, at_ms: int = 0):
        super().__init__((root, part, parts, at_ms))
        self.root, self.part, self.parts, self.at_ms = root, part, parts, at_ms


def _settings(options: dict) -> tuple[list[str], int, bool]:
    roots = [r.strip() for r in options.get("roots", "").split(",") if r.strip()]
    return roots, int(options.get("slices", SLICES)), options.get("recursive", "true").lower() == "true"


class ListingReader(DataSourceReader):
    def __init__(self, options: dict):
        self.roots, self.slices, self.recursive = _settings(options)

    def partitions(self):
        return [_Slice(r, k, self.slices) for r in self.roots for k in range(self.slices)] or [_Slice("", 0, 1)]

    def read(self, partition):
        if partition.root:
            yield from walk(partition.root, partition.part, partition.parts, self.recursive)


class ListingDataSource(DataSource):
    @classmethod
    def name(cls):
        return "intake_listing"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return ListingReader(self.options)


class ScanStreamReader(DataSourceStreamReader):
    """Offsets are the times of the scans in milliseconds, one more a trigger."""

    def __init__(self, options: dict):
        self.roots, self.slices, self.recursive = _settings(options)
        self.last = 0

    def initialOffset(self):
        return {"scan": 0}

    def latestOffset(self):
        self.last = max(self.last + 1, int(time.time() * 1000))
        return {"scan": self.last}

    def partitions(self, start, end):
        return [_Slice(r, k, self.slices, end["scan"]) for r in self.roots for k in range(self.slices)]

    def read(self, partition):
        at, root = utc(partition.at_ms / 1000), partition.root
        error = None
        try:
            for row in walk(root, partition.part, partition.parts, self.recursive):
                yield (*row, at, None)
        except OSError as e:
            error = f"{type(e).__name__}: {e.strerror}"
        if error is not None or partition.part == 0:
            yield (root, None, None, None, None, None, None, at, error)


class ScanDataSource(DataSource):
    @classmethod
    def name(cls):
        return "intake_scans"

    def schema(self):
        return SCAN_SCHEMA

    def streamReader(self, schema):
        return ScanStreamReader(self.options)
