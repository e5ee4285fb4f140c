"""Spans of documents that repeat an earlier span.

Occurrences of a content (two 64-bit hashes) are shuffled by content and sorted
by (content, row, position); in that order an occurrence is a repeat if the one
before it has the same content. The stream holds one row at a time, so a
content may occur any number of times. Repeats that a task sees within one
block of texts are settled there and not shuffled by content, so a passage
that a third of all documents share sends one row a block.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_in_block(*keys: np.ndarray) -> np.ndarray:
    """Whether each element is the first with its keys (in array order)."""
    n = len(keys[0])
    if n == 0:
        return np.zeros(0, bool)
    order = np.lexsort(keys[::-1])
    same = np.ones(n - 1, bool)
    for k in keys:
        k = k[order]
        same &= k[1:] == k[:-1]
    out = np.ones(n, bool)
    out[order[1:][same]] = False
    return out


def merge_ranges(row: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Union of ranges [a, b) by row, as disjoint ranges in order."""
    if len(row) == 0:
        return row, a, b
    order = np.lexsort((a, row))
    row, a, b = row[order], a[order].astype(np.int64), b[order].astype(np.int64)
    new_row = np.append(True, row[1:] != row[:-1])
    # running maximum of ends by row: shift rows apart
    gap = int(b.max()) + 1
    number = np.cumsum(new_row)
    reach = np.maximum.accumulate(b + number * gap) - number * gap
    start = new_row.copy()
    start[1:] |= a[1:] > reach[:-1]
    first = np.flatnonzero(start)
    last = np.append(first[1:], len(row)) - 1
    return row[first], a[first], reach[last]


def by_content(found: DataFrame, *keys: str) -> DataFrame:
    """Rows shuffled by ``route`` and sorted by content, row and position."""
    return found.repartition("route").sortWithinPartitions(*keys)


def ranges_by_row(ranges: DataFrame) -> DataFrame:
    """(row, ranges): the ranges of each row as arrays a and b."""
    return ranges.groupBy("row").agg(F.collect_list(F.struct("a", "b")).alias("ranges"))
