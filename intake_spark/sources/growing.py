"""Lines of growing text files as a stream (S5, S6: markers that get lines
appended through a job's life).

Spark's file stream reads a file once. Here offsets are sizes by file, so what
was appended since the last batch is read. A line belongs to the batch in which
its line end appears: half a line waits, and is read whole, from its start, when
it is complete. A file that is shorter than before was cut or replaced: it is
read from its start again, its rows ``restarted``.

The driver lists the folder (names and sizes) once a trigger; contents are read
in tasks, long appendices in pieces of ``PIECE`` bytes. A task reads short pieces
one after another, up to ``TASK_BYTES`` together, as starting a task costs as much
as reading some thousand lines. Rows leave a task in batches. An offset has an entry a
file, so files should leave the folder when their jobs are done, or be older than
``max_age_s``, which leaves them out once they were quiet for so long.

    spark.dataSource.register(GrowingDataSource)
    spark.readStream.format("intake_growing").option("path", "/jobs").option("suffix", ".txt").load()
"""

from __future__ import annotations

import os
import time
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

SCHEMA = "file string, pos long, line string, restarted boolean"
NAMES = ["file", "pos", "line", "restarted"]
TYPES = [pa.string(), pa.int64(), pa.string(), pa.bool_()]
PIECE = 32 << 20
TASK_BYTES = 4 << 20  # of pieces that are shorter than this; a longer one has its own task
BATCH_ROWS = 10_000
BACK = 1 << 16  # bytes looked at at once for the start of a line


class _Pieces(InputPartition):
    """What one task reads: (name, start, end, restarted) of each piece."""

    def __init__(self, pieces: list[tuple[str, int, int, bool]]):
        super().__init__(pieces)
        self.pieces = pieces


def _line_start(f, at: int) -> int:
    """The position after the last line end before ``at``."""
    while at > 0:
        lo = max(0, at - BACK)
        f.seek(lo)
        cut = f.read(at - lo).rfind(b"\n")
        if cut >= 0:
            return lo + cut + 1
        at = lo
    return 0


def lines(path: str, start: int, end: int) -> Iterator[tuple[int, str]]:
    """(position, text) of the lines whose end lies in [start, end)."""
    with open(path, "rb") as f:
        pos = _line_start(f, start)
        f.seek(pos)
        while pos < end:
            raw = f.readline(end - pos)
            if not raw.endswith(b"\n"):
                return
            yield pos, raw[:-1].removesuffix(b"\r").decode("utf-8", "replace")
            pos += len(raw)


class GrowingReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.path, self.suffix = options["path"].removeprefix("file:"), options.get("suffix", "")
        self.max_age_s = float(options.get("max_age_s", "inf"))

    def initialOffset(self):
        return {}

    def latestOffset(self):
        found, oldest = {}, time.time() - self.max_age_s
        with os.scandir(self.path) as it:
            for e in it:
                if e.name.endswith(self.suffix) and e.is_file():
                    st = e.stat()
                    if st.st_mtime >= oldest:
                        found[e.name] = st.st_size
        return found

    def partitions(self, start, end):
        out, room = [], 0
        for name, size in sorted(end.items()):
            seen = start.get(name, 0)
            restarted = size < seen
            for lo in range(0 if restarted else seen, size, PIECE):
                hi = min(size, lo + PIECE)
                if not out or hi - lo > room:
                    out.append(_Pieces([]))
                    room = TASK_BYTES
                out[-1].pieces.append((name, lo, hi, restarted))
                room -= hi - lo
        return out or [_Pieces([])]

    def read(self, partition):
        rows = self._rows(partition.pieces)
        while batch := list(islice(rows, BATCH_ROWS)):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*batch), TYPES)], names=NAMES)

    def _rows(self, pieces) -> Iterator[tuple[str, int, str, bool]]:
        for name, start, end, restarted in pieces:
            try:
                for pos, text in lines(os.path.join(self.path, name), start, end):
                    yield name, pos, text, restarted
            except FileNotFoundError:  # its job is gone
                continue


class GrowingDataSource(DataSource):
    @classmethod
    def name(cls):
        return "intake_growing"

    def schema(self):
        return SCHEMA

    def streamReader(self, schema):
        return GrowingReader(self.options)
