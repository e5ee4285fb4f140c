"""Vectorised views of a text column: bytes, code points, words, rolling hashes.

Used inside ``mapInArrow`` tasks. A text column arrives as one Arrow buffer
plus offsets; everything here works on blocks of that buffer (a bounded number
of bytes, at least one whole text), so no per-row Python strings are made and
memory does not depend on the number of rows in an Arrow batch.

Hashes are polynomial over 64-bit integers (wrapping), taken from prefix sums:
``hash(s) = sum(code(s[i]) * B**i)``; two spans of equal content have equal
hashes wherever they stand.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U64 = np.uint64
# Odd multipliers (base of the polynomial, its inverse, mixers).
BASE = 0x9E3779B97F4A7C15
BASE_INV = pow(BASE, -1, 1 << 64)
MIX_A = U64(0xBF58476D1CE4E5B9)
MIX_B = U64(0x94D049BB133111EB)

BLOCK_BYTES = 1 << 20
SMALL_BLOCK = 1 << 18    # where a block takes many times its bytes

_BYTE = np.arange(256)
LOWER = np.where((_BYTE >= 65) & (_BYTE <= 90), _BYTE + 32, _BYTE).astype(np.uint8)
#: After lower-casing A-Z: digits, a-z and every byte of a non-ASCII character.
IS_WORD = ((_BYTE >= 0x30) & (_BYTE <= 0x39)) | ((_BYTE >= 0x61) & (_BYTE <= 0x7A)) | (_BYTE >= 0x80)
BYTE_CODE = np.random.default_rng(20240131).integers(1, 1 << 63, 256, dtype=np.int64).astype(U64) | U64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply); a bijection on uint64."""
    x = x ^ (x >> U64(30))
    x = x * MIX_A
    x = x ^ (x >> U64(27))
    x = x * MIX_B
    return x ^ (x >> U64(31))


class _Powers:
    def __init__(self) -> None:
        self.up = np.ones(1, U64)
        self.down = np.ones(1, U64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = n + n // 4
            for name, b in (("up", BASE), ("down", BASE_INV)):
                p = np.full(size, b, U64)
                p[0] = 1
                setattr(self, name, np.cumprod(p, dtype=U64))
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


class Prefix:
    """Prefix hash sums of a code sequence; ``span(a, b)`` hashes spans [a, b)."""

    def __init__(self, codes: np.ndarray) -> None:
        up, self._down = _POWERS.get(len(codes) + 1)
        self._sum = np.zeros(len(codes) + 1, U64)
        np.cumsum(codes * up[: len(codes)], out=self._sum[1:])

    def span(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (self._sum[b] - self._sum[a]) * self._down[a]

    def runs(self, n: int) -> np.ndarray:
        """Hash of every run of n codes, by start."""
        m = len(self._sum) - n
        if m <= 0:
            return np.zeros(0, U64)
        return (self._sum[n:] - self._sum[:m]) * self._down[:m]


def text_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and int64 offsets of a string column; null texts are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offs, data = col.buffers()
    n = len(col)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offs, np.int64 if wide else np.int32)[col.offset: col.offset + n + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), off


def blocks(col: pa.Array, max_bytes: int = BLOCK_BYTES):
    """(lo, hi, bytes, offsets) over consecutive rows; at least one row each."""
    data, off = text_buffers(col)
    n, lo = len(off) - 1, 0
    while lo < n:
        hi = min(n, max(lo + 1, int(np.searchsorted(off, off[lo] + max_bytes, "right")) - 1))
        yield lo, hi, data[off[lo]: off[hi]], off[lo: hi + 1] - off[lo]
        lo = hi


def code_points(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of a block and the texts' offsets counted in them."""
    cps = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    if len(cps) == len(data):
        return cps, off
    lead = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=lead[1:])
    return cps, lead[off]


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased word hashes of a block, the word's byte starts, and word
    offsets by text. Words are maximal runs of digits, letters and non-ASCII
    characters; they never cross texts."""
    low = LOWER[data]
    w = IS_WORD[low]
    n = len(w)
    if n == 0:
        return np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    first = np.zeros(n + 1, bool)
    first[off] = True
    start = w.copy()
    start[1:] &= ~w[:-1] | first[1:n]
    end = w.copy()
    end[:-1] &= ~w[1:] | first[1:n]
    a = np.flatnonzero(start)
    b = np.flatnonzero(end) + 1
    h = mix(Prefix(BYTE_CODE[low]).span(a, b) + (b - a).astype(U64))
    return h, a, np.searchsorted(a, off)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenated ranges start, start+1, ... of the given lengths."""
    total = int(lengths.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def shingles(wh: np.ndarray, woff: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every run of k words and offsets by text. A text of fewer
    words, but not none, is one shingle of all its words."""
    n = np.diff(woff)
    count = np.where(n >= k, n - k + 1, (n > 0).astype(np.int64))
    soff = np.concatenate([[0], np.cumsum(count)])
    at = ragged(woff[:-1], count)
    # positions past a short text's end read an own filler, not the next text
    padded = np.concatenate([wh, np.zeros(k, U64)])
    last = np.repeat(woff[1:], count)
    h = np.zeros(len(at), U64)
    for j in range(k):
        part = padded[at + j]
        if (n < k).any():
            part = np.where(at + j < last, part, U64(0))
        h = (h ^ part) * MIX_A + U64(j + 1)
        h ^= h >> U64(29)
    return mix(h), soff
