"""Pre-token starts of a byte-level BPE tokenizer, for a block of code points.

States the splitting rule of the public GPT-2 pattern with array operations:
contractions, letter runs, number runs and other runs (each with one preceding
space), and white space, whose last character goes to what follows.
"""

from __future__ import annotations

import sys
import unicodedata

import numpy as np

SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3
# Unicode White_Space.
WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# Endings that an apostrophe takes along.
ENDINGS = ("s", "t", "m", "d", "re", "ve", "ll")

_CLASSES: np.ndarray | None = None


def classes() -> np.ndarray:
    """Class of each code point (built once per worker)."""
    global _CLASSES
    if _CLASSES is None:
        c = np.full(sys.maxunicode + 1, OTHER, np.uint8)
        kinds = {"L": LETTER, "N": NUMBER}
        for i in range(sys.maxunicode + 1):
            k = kinds.get(unicodedata.category(chr(i))[0])
            if k:
                c[i] = k
        c[WHITE] = SPACE
        _CLASSES = c
    return _CLASSES


def pretoken_starts(cps: np.ndarray, off: np.ndarray) -> np.ndarray:
    n = len(cps)
    if n == 0:
        return np.zeros(0, np.int64)
    c = classes()[cps]
    first = np.zeros(n + 1, bool)
    first[off] = True  # text starts, and the end of the block
    prev = np.empty(n, np.uint8)
    prev[0] = 255
    prev[1:] = c[:-1]
    prev[first[:n]] = 255
    nxt = np.empty(n, np.uint8)
    nxt[-1] = 255
    nxt[:-1] = c[1:]
    nxt[first[1:]] = 255
    white = c == SPACE
    after_blank = np.zeros(n, bool)
    after_blank[1:] = cps[:-1] == 32
    after_blank &= prev == SPACE
    start = np.where(white, (prev != SPACE) | ((nxt != SPACE) & (nxt != 255)), (prev != c) & ~after_blank)
    start[first[:n]] = True
    quotes = np.flatnonzero((cps == 39) & start & (nxt == LETTER))
    if len(quotes):
        end_of = off[np.searchsorted(off, quotes, "right")]
        for e in ENDINGS:
            hit = quotes + len(e) < end_of
            for j, ch in enumerate(e):
                hit[hit] = cps[quotes[hit] + 1 + j] == ord(ch)
            q = quotes[hit]
            for j in range(len(e)):
                start[q + 1 + j] = False
            tail = q + 1 + len(e)
            start[tail[tail < end_of[hit]]] = True
    return np.flatnonzero(start)
