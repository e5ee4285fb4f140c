"""Memo of per-segment encodings, looked up by hash for a whole block at once.

A tokenizer that never merges across a known set of cut points encodes a text
as the concatenation of its segments' encodings. Tasks keep one table per
worker: segments already seen are found by binary search in a sorted hash
array, new ones are encoded once. The table is emptied when it reaches its
bound, which only costs re-encoding; results never depend on it.

A segment is identified by a 64-bit hash of its code points and length; with
the bounded table a false match has odds under 1e-12 a new segment.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np

from .textbytes import U64, Prefix, mix, ragged

MAX_SEGMENTS = 1_500_000


class _Pool:
    """Append-only ragged array."""

    def __init__(self, dtype) -> None:
        self.data = np.zeros(1 << 12, dtype)
        self.used = 0
        self.start = np.zeros(1 << 10, np.int64)
        self.length = np.zeros(1 << 10, np.int64)
        self.items = 0

    def extend(self, values: Sequence) -> None:
        lens = np.fromiter((len(v) for v in values), np.int64, len(values))
        flat = (np.frombuffer(b"".join(values), np.uint8) if self.data.dtype == np.uint8
                else np.array([x for v in values for x in v], self.data.dtype))
        while self.used + len(flat) > len(self.data):
            self.data = np.concatenate([self.data, np.zeros_like(self.data)])
        while self.items + len(lens) > len(self.start):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
            self.length = np.concatenate([self.length, np.zeros_like(self.length)])
        self.data[self.used: self.used + len(flat)] = flat
        ends = self.used + np.cumsum(lens)
        self.start[self.items: self.items + len(lens)] = ends - lens
        self.length[self.items: self.items + len(lens)] = lens
        self.used += len(flat)
        self.items += len(lens)

    def gather(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Concatenated values of the slots, and each slot's length."""
        n = self.length[slots]
        return self.data[ragged(self.start[slots], n)], n


class SegmentTable:
    """``encode(strings) -> one list of sequences per pool`` fills the pools."""

    def __init__(self, encode: Callable[[list[str]], list[list]], dtypes: Sequence,
                 max_segments: int = MAX_SEGMENTS) -> None:
        self._encode, self._dtypes, self._max = encode, dtypes, max_segments
        self._clear()

    def _clear(self) -> None:
        self._keys = np.zeros(0, U64)
        self._slots = np.zeros(0, np.int32)
        self.pools = [_Pool(d) for d in self._dtypes]

    def slots(self, cps: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Pool slot of every segment; segments are cps[starts[i]:starts[i+1]],
        the last one ends with cps."""
        if len(starts) == 0:
            return np.zeros(0, np.int64)
        if len(self._keys) >= self._max:
            self._clear()
        ends = np.append(starts[1:], len(cps))
        h = mix(Prefix(cps.astype(U64) * U64(2) + U64(1)).span(starts, ends) + (ends - starts).astype(U64))
        keys, at, inverse = np.unique(h, return_index=True, return_inverse=True)
        pos = np.searchsorted(self._keys, keys)
        known = np.zeros(len(keys), bool)
        inside = pos < len(self._keys)
        known[inside] = self._keys[pos[inside]] == keys[inside]
        new = np.flatnonzero(~known)
        if len(new):
            a, b = starts[at[new]].tolist(), ends[at[new]].tolist()
            text = cps.tobytes().decode("utf-32-le")
            values = self._encode([text[x:y] for x, y in zip(a, b)])
            first = self.pools[0].items
            for pool, v in zip(self.pools, values):
                pool.extend(v)
            self._keys = np.insert(self._keys, pos[new], keys[new])
            self._slots = np.insert(self._slots, pos[new], np.arange(first, first + len(new), dtype=np.int32))
            pos = np.searchsorted(self._keys, keys)
        return self._slots[pos].astype(np.int64)[inverse]
