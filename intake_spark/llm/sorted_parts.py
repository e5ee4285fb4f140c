"""A table of sorted keys with values, in files of the shared folder, looked up
from tasks.

``write`` sorts (key, value) rows by range and writes parts of at most
``PART_ROWS`` rows; only each part's first key and name go through the driver.
A task asks for sorted distinct keys, reads the parts that may hold them and
keeps at most ``CACHE_BYTES`` of parts, so its memory doesn't depend on the
table's size.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from ..session import scratch_path
from .files import make_folder, read_file, write_file

PART_ROWS = 1 << 18
CACHE_BYTES = 96 << 20

_PARTS: OrderedDict[tuple[str, str], tuple[np.ndarray, np.ndarray]] = OrderedDict()


@dataclass
class SortedParts:
    uri: str
    first: np.ndarray   # first key of each part
    names: list[str]

    def find(self, keys: np.ndarray, missing: int = 0) -> np.ndarray:
        """Values of sorted int64 keys; ``missing`` where there is none."""
        out = np.full(len(keys), missing, np.int64)
        if not len(self.names):
            return out
        part = np.searchsorted(self.first, keys, "right") - 1
        cuts = np.searchsorted(part, np.arange(len(self.names) + 1))
        for i in np.flatnonzero(np.diff(cuts)).tolist():
            have, value = self._part(self.names[i])
            asked = keys[cuts[i]: cuts[i + 1]]
            at = np.minimum(np.searchsorted(have, asked), len(have) - 1)
            hit = have[at] == asked
            out[cuts[i]: cuts[i + 1]][hit] = value[at[hit]]
        return out

    def _part(self, name: str) -> tuple[np.ndarray, np.ndarray]:
        if (self.uri, name) not in _PARTS:
            raw = read_file(self.uri, name)
            n = len(raw) // 16
            _PARTS[self.uri, name] = np.frombuffer(raw, np.int64, n), np.frombuffer(raw, np.int64, n, 8 * n)
            held = sum(16 * len(k) for k, _ in _PARTS.values())
            while held > CACHE_BYTES and len(_PARTS) > 1:
                _, (k, _) = _PARTS.popitem(last=False)
                held -= 16 * len(k)
        _PARTS.move_to_end((self.uri, name))
        return _PARTS[self.uri, name]


def write(rows: DataFrame, name: str, part_rows: int = PART_ROWS) -> SortedParts:
    """Parts of ``rows`` (key long, value long); keys are distinct."""
    uri = scratch_path(rows.sparkSession, name)
    make_folder(uri)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        held: list[np.ndarray] = [np.zeros(0, np.int64)] * 2

        def flush(n: int) -> pa.RecordBatch:
            nonlocal held, made
            key, value = held[0][:n], held[1][:n]
            held = [x[n:] for x in held]
            made += 1
            write_file(uri, f"{task}-{made}", key.tobytes() + value.tobytes())
            return pa.RecordBatch.from_arrays([pa.array(key[:1]), pa.array([f"{task}-{made}"])], names=["first", "name"])

        for batch in batches:
            held = [np.concatenate([old, batch.column(c).to_numpy()]) for old, c in zip(held, ("key", "value"))]
            while len(held[0]) >= part_rows:
                yield flush(part_rows)
        if len(held[0]):
            yield flush(len(held[0]))

    found = sorted((r["first"], r["name"]) for r in rows.select("key", "value").repartitionByRange("key")
                   .sortWithinPartitions("key").mapInArrow(run, "first long, name string").toLocalIterator())
    return SortedParts(uri, np.array([f for f, _ in found], np.int64), [n for _, n in found])
