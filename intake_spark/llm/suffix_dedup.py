"""Removes bytes covered by repeated strings of ``LENGTH`` bytes (operator 10).

A byte goes if it lies in a string of ``LENGTH`` bytes that also starts earlier
(in a row before, or earlier in the same text). The result is exact.

1. Anchors. Only a sample of suffixes is sorted: in every string of ``LENGTH``
   bytes the ``GRAM``-byte grams with the least hash are anchors. Equal strings
   have equal anchors, so every repeat shows as two anchors of equal gram and
   equal surroundings. About one position in 35 is an anchor.
2. Settling by surroundings. An anchor's surroundings are all bytes of all
   strings of ``LENGTH`` that contain it. Anchors are shuffled by gram and
   sorted by (gram, surroundings, row, position); one with the same
   surroundings as the one before is covered as a whole. Grams with a single
   surroundings need nothing else. Within a block of texts this is done before
   the shuffle, so a common passage sends one row a block.
3. Deep-shallow sorting. Grams with several surroundings are at the edges of
   repeats. Their surroundings are cut from the texts, and the suffixes from
   the anchor (and, for what stands before it, the reversed prefixes) of each
   gram are sorted: multikey quicksort, eight bytes a key, to a shallow depth
   of ``SHALLOW`` bytes; groups with a longer common prefix go into blind
   tries. The common prefix lengths of sorted neighbours tell, for each string
   around an anchor, which occurrences are equal, and so whether an earlier one
   exists.
4. A gram with more than ``HOT_GROUP`` surroundings is not sorted by one task:
   its strings are hashed one by one, and settled as in step 2.

Steps 2 and 4 compare 128-bit hashes, step 3 bytes.

Defined results: null and empty texts, and texts under ``LENGTH`` bytes, lose
nothing; rows with equal ids are texts of their own, in order of their text,
null ids first; an empty table gives no rows; other columns are kept where
texts are returned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .files import stored
from .rows import ROW, numbered
from .spans import by_content, first_in_block, merge_ranges, ranges_by_row
from .textbytes import BYTE_CODE, U64, Prefix, blocks, mix, ragged

LENGTH = 100
GRAM = 32
SHALLOW = 16
HOT_GROUP = 20_000
FOUND = "route long, known byte, content long, row long, pos int, a int, b int"


# ------------------------------------------------------------------ anchors

def _sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """pick over every run of ``width`` values."""
    span, out = 1, x
    while span * 2 <= width:
        out = pick(out[:-span], out[span:])
        span *= 2
    return pick(out[: len(out) - (width - span)], out[width - span:]) if width > span else out


def anchors(data: np.ndarray, off: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(position, gram hash, text, prefix sums) of a block's anchors."""
    n = len(data)
    sums = Prefix(BYTE_CODE[data])
    none = np.zeros(0, np.int64)
    width = length - gram + 1
    if n < length:
        return none, none.view(U64), none, sums
    h = mix(sums.runs(gram)) | U64(1)
    least = _sliding(h, width, np.minimum)  # by string start
    text = np.repeat(np.arange(len(off) - 1), np.diff(off))
    least = np.where(np.arange(len(least)) + length <= off[1:][text[: len(least)]], least, U64(0))
    pad = np.zeros(width - 1, U64)
    most = _sliding(np.concatenate([pad, least, pad]), width, np.maximum)  # by gram start
    pos = np.flatnonzero(most == h)
    return pos, h[pos], text[pos], sums


def find_anchors(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """Anchors with their surroundings [a, b), and ranges known as covered."""
    reach = length - gram

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = batch.column("row").to_numpy()
            for lo, hi, data, off in blocks(batch.column("text")):
                pos, h, text, sums = anchors(data, off, length, gram)
                a, b = np.maximum(off[text], pos - reach), np.minimum(off[text + 1], pos + length)
                content = mix(sums.span(a, b) + ((pos - a) << 8 | (b - pos)).astype(U64))
                row, base = number[lo:hi][text], off[text]
                order = np.lexsort((pos, row))
                pos, h, content, a, b, row, base = (x[order] for x in (pos, h, content, a, b, row, base))
                first = first_in_block(h, content)
                r, x, y = merge_ranges(row[~first], (a - base)[~first], (b - base)[~first])
                yield _found(h[first], content[first], row[first], (pos - base)[first], (a - base)[first],
                             (b - base)[first], r, x, y)

    return texts.mapInArrow(run, FOUND)


def _found(h, content, row, pos, a, b, r, x, y) -> pa.RecordBatch:
    cat, n, m = np.concatenate, len(h), len(r)
    zero = np.zeros(m, np.int64)
    cols = [cat([h, mix(r.astype(np.int64).view(U64))]).view(np.int64), cat([np.zeros(n, np.int8), np.ones(m, np.int8)]),
            cat([content, zero.view(U64)]).view(np.int64), cat([row, r]).astype(np.int64),
            *(cat([p, q]).astype(np.int32) for p, q in ((pos, zero), (a, x), (b, y)))]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in cols],
                                      names=["route", "known", "content", "row", "pos", "a", "b"])


def settle(found: DataFrame) -> DataFrame:
    """(gram, row, pos, a, b): covered ranges (gram null), and one occurrence of
    each surroundings of a gram that has several."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple | None = None       # known, gram and content of the row before
        first_of: tuple | None = None   # the last surroundings' first occurrence, and whether it is out
        for batch in batches:
            if not batch.num_rows:
                continue
            known, gram, content, row, pos, a, b = (batch.column(c).to_numpy() for c in (
                "known", "route", "content", "row", "pos", "a", "b"))
            same_gram = np.zeros(len(gram), bool)
            same_gram[1:] = (gram[1:] == gram[:-1]) & (known[1:] == 0) & (known[:-1] == 0)
            repeat = same_gram.copy()
            repeat[1:] &= content[1:] == content[:-1]
            if last is not None and known[0] == 0:
                same_gram[0] = last[:2] == (0, gram[0])
                repeat[0] = same_gram[0] and last[2] == content[0]
            last = (int(known[-1]), gram[-1], content[-1])
            r, x, y = merge_ranges(*(c[repeat | (known == 1)] for c in (row, a, b)))
            head = np.flatnonzero(~repeat & (known == 0))
            edge = same_gram[head]
            edge[:-1] |= edge[1:]  # the next surroundings has the same gram
            late: list[tuple] = []
            if len(head):
                if first_of is not None and same_gram[head[0]] and not first_of[-1]:
                    late.append(first_of[:-1])
                k = head[-1]
                first_of = (gram[k], row[k], pos[k], a[k], b[k], bool(edge[-1]))
            pick = head[edge]
            cat, n = np.concatenate, len(late)
            prev = [np.array([t[i] for t in late], np.int64) for i in range(5)]
            g = cat([prev[0], gram[pick], np.zeros(len(r), np.int64)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(g, mask=np.arange(len(g)) >= n + len(pick)),
                 pa.array(cat([prev[1], row[pick], r])),
                 *(pa.array(cat([p, q[pick], z]).astype(np.int32))
                   for p, q, z in ((prev[2], pos, np.zeros(len(r), np.int64)), (prev[3], a, x), (prev[4], b, y)))],
                names=["gram", "row", "pos", "a", "b"])

    return (by_content(found, "known", "route", "content", "row", "pos")
            .mapInArrow(run, "gram long, row long, pos int, a int, b int"))


# ------------------------------------------------------ deep-shallow sorting

class BlindTrie:
    """Order and common prefix lengths of distinct strings. Nodes hold a depth
    and branch on one byte; what lies between is compared only against one
    string of the subtree."""

    def __init__(self) -> None:
        self.root = None

    def add(self, s: bytes, name: int) -> None:
        leaf = (s, name)
        if self.root is None:
            self.root = leaf
            return
        node = self.root
        while len(node) == 3:  # blind descent to any leaf with the same branch bytes
            child = node[1].get(s[node[0]] if node[0] < len(s) else -1)
            node = child if child is not None else node[2]
        t, d = node[0], 0
        top = min(len(s), len(t))
        step = 1
        while d < top:  # length of the common prefix, by growing pieces
            if s[d: d + step] == t[d: d + step] and d + step <= top:
                d, step = d + step, step * 2
            elif step > 1:
                step = 1
            else:
                break
        mine, theirs = (x[d] if d < len(x) else -1 for x in (s, t))
        above, node = None, self.root
        while len(node) == 3 and node[0] < d:
            above = node
            node = node[1][s[node[0]] if node[0] < len(s) else -1]
        if len(node) == 3 and node[0] == d:
            node[1][mine] = leaf
            return
        fresh = (d, {mine: leaf, theirs: node}, leaf)
        if above is None:
            self.root = fresh
        else:
            above[1][s[above[0]] if above[0] < len(s) else -1] = fresh

    def walk(self) -> Iterator[tuple[int, int]]:
        """(name, common prefix length with the string before; 0 first)."""
        stack: list[tuple] = [(self.root, 0)] if self.root is not None else []
        while stack:
            node, lcp = stack.pop()
            if len(node) == 2:
                yield node[1], lcp
                continue
            for i, k in enumerate(sorted(node[1], reverse=True)):
                stack.append((node[1][k], node[0] if i < len(node[1]) - 1 else lcp))


def deep_shallow_sort(group: np.ndarray, strings: list[bytes], skip: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(order, lcp): the strings in order within each group, and the common
    prefix length of each with the one before it in order (-1 at a group's
    start). Strings of a group are known to agree in the first ``skip`` bytes."""
    n = len(strings)
    lens = np.array([len(s) for s in strings], np.int64)
    width = SHALLOW // 8
    keys = np.zeros((n, width), ">u8")
    flat = np.frombuffer(b"".join(s[skip: skip + SHALLOW].ljust(SHALLOW, b"\0") for s in strings), ">u8")
    keys[:] = flat.reshape(n, width)
    # multikey quicksort: sort by a key, then each group of equal keys by the next
    order = np.argsort(group, kind="stable")
    part = np.cumsum(np.append(True, np.diff(group[order]) != 0))
    for d in range(width):
        k = keys[order, d]
        move = np.lexsort((k, part))
        order, k = order[move], k[move]
        part = np.cumsum(np.append(True, (part[1:] != part[:-1]) | (k[1:] != k[:-1])))
    lcp = np.zeros(n, np.int64)
    ends = np.flatnonzero(np.append(part[1:] != part[:-1], True)) + 1
    begins = np.append(0, ends[:-1])
    for lo, hi in zip(begins.tolist(), ends.tolist()):
        if hi - lo == 1:
            continue
        same: dict[bytes, list[int]] = {}
        for i in order[lo:hi].tolist():
            same.setdefault(strings[i], []).append(i)
        names = list(same.values())
        trie = BlindTrie()
        for j, s in enumerate(same):
            trie.add(s, j)
        out = lo
        for j, common in trie.walk():
            for i in names[j]:
                order[out] = i
                if out > lo:
                    lcp[out] = common if i == names[j][0] else lens[i]
                out += 1
    # neighbours that differ within the shallow depth
    at = begins[1:]
    x, y = keys[order[at]], keys[order[at - 1]]
    diff = (x ^ y).astype(">u8").view(np.uint8).reshape(-1, SHALLOW) != 0
    lcp[at] = np.minimum(skip + diff.argmax(axis=1), np.minimum(lens[order[at]], lens[order[at - 1]]))
    lcp[np.flatnonzero(np.append(True, np.diff(group[order]) != 0))] = -1
    return order, lcp


def repeats_around(group: np.ndarray, rank: np.ndarray, left: list[bytes], right: list[bytes],
                   length: int, gram: int) -> np.ndarray:
    """For each occurrence of an anchor and each l, whether the string that
    starts l bytes before the anchor also starts earlier (in the order of
    ``rank``) around the same gram. ``left`` holds the bytes before the anchor
    reversed, ``right`` those from it."""
    n, reach = len(group), length - gram
    r_order, r_lcp = deep_shallow_sort(group, right, gram)
    l_order, l_lcp = deep_shallow_sort(group, left)
    r_len, l_len = (np.array([len(s) for s in x], np.int64) for x in (right, left))
    out = np.zeros((n, reach + 1), bool)
    by_rank = np.argsort(rank, kind="stable")
    r_class, l_class = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for k in range(reach + 1):
        ok = (l_len >= k) & (r_len >= length - k)
        r_class[r_order] = np.cumsum(r_lcp < length - k)
        l_class[l_order] = np.cumsum(l_lcp < k)
        use = by_rank[ok[by_rank]]
        if len(use) > 1:
            out[use, k] = ~first_in_block(r_class[use], l_class[use])
    return out


def resolve_edges(contexts: DataFrame, length: int, gram: int) -> DataFrame:
    """(row, a, b) from surroundings sorted by gram within each task."""
    def one(t: pa.Table) -> pa.RecordBatch:
        g, row, pos = (t.column(c).to_numpy() for c in ("gram", "row", "pos"))
        left = [x[::-1] for x in t.column("before").to_pylist()]
        group = np.cumsum(np.append(True, np.diff(g) != 0))
        rank = np.empty(len(g), np.int64)
        rank[np.lexsort((pos, row))] = np.arange(len(g))
        hit = repeats_around(group, rank, left, t.column("after").to_pylist(), length, gram)
        i, k = np.nonzero(hit)
        a = pos[i].astype(np.int64) - k
        r, x, y = merge_ranges(row[i], a, a + length)
        return pa.RecordBatch.from_arrays([pa.array(r), pa.array(x.astype(np.int32)), pa.array(y.astype(np.int32))],
                                          names=["row", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            g = batch.column("gram").to_numpy()
            cut = np.flatnonzero(g[1:] != g[:-1]) + 1
            if held and held[-1].column("gram")[-1].as_py() != g[0]:
                cut = np.append(0, cut)
            # whole grams, in portions
            if rows + batch.num_rows > 4096 and len(cut):
                k = int(cut[-1])
                ready = pa.Table.from_batches([*held, batch.slice(0, k)]).combine_chunks()
                if ready.num_rows:
                    yield one(ready)
                held, rows = [batch.slice(k)], batch.num_rows - k
            else:
                held.append(batch)
                rows += batch.num_rows
        if rows:
            yield one(pa.Table.from_batches(held).combine_chunks())

    return contexts.mapInArrow(run, "row long, a int, b int")


def _each_row(batch: pa.RecordBatch):
    """(row, text bytes, struct array of the row's wanted anchors)."""
    number, wanted = batch.column("row").to_numpy(), batch.column("wanted")
    for lo, hi, data, off in blocks(batch.column("text")):
        for i in range(lo, hi):
            yield number[i], data[off[i - lo]: off[i - lo + 1]].tobytes(), wanted[i].values


def cut_contexts(wanted: DataFrame, length: int, gram: int) -> DataFrame:
    """The surroundings' bytes of each wanted anchor."""
    reach = length - gram

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for row, text, want in _each_row(batch):
                pos = want.field("pos").to_pylist()
                out[0] += want.field("gram").to_pylist()
                out[1] += [row] * len(pos)
                out[2] += pos
                out[3] += [text[max(0, p - reach): p] for p in pos]
                out[4] += [text[p: p + length] for p in pos]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, k) for x, k in zip(out, (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()))],
                names=["gram", "row", "pos", "before", "after"])

    return wanted.mapInArrow(run, "gram long, row long, pos int, before binary, after binary")


def hash_strings(wanted: DataFrame, length: int, gram: int) -> DataFrame:
    """Every string of ``length`` around the wanted anchors, as if each were an
    anchor with itself for surroundings."""
    reach = length - gram

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text, want in _each_row(batch):
                data = np.frombuffer(text, np.uint8)
                pos = want.field("pos").to_numpy().astype(np.int64)
                lo, hi = np.maximum(0, pos - reach), np.minimum(pos, len(data) - length)
                s = np.unique(ragged(lo, hi - lo + 1))
                one = Prefix(BYTE_CODE[data])
                two = Prefix(mix(BYTE_CODE[data]))
                h, g = mix(one.span(s, s + length)), mix(two.span(s, s + length))
                none = np.zeros(0, np.int64)
                yield _found(h, g, np.full(len(s), row), s, s, s + length, none, none, none)

    return wanted.mapInArrow(run, FOUND)


# -------------------------------------------------------------------- whole

def covered(texts: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(row, a, b): byte ranges of ``texts`` (row, text) whose bytes go. Ranges
    may overlap; their union is the result."""
    spark = texts.sparkSession
    met = stored(spark, settle(find_anchors(texts, length, gram)), "anchors")
    edges = met.where(F.col("gram").isNotNull())
    hot = edges.groupBy("gram").count().where(F.col("count") > HOT_GROUP).select("gram")
    any_hot = not hot.isEmpty()

    def with_text(part: DataFrame) -> DataFrame:
        return (part.groupBy("row").agg(F.collect_list(F.struct("gram", "pos")).alias("wanted"))
                .join(texts, "row").select("row", "text", "wanted"))

    usual = edges.join(hot, "gram", "left_anti") if any_hot else edges
    contexts = (cut_contexts(with_text(usual), length, gram)
                .repartition("gram").sortWithinPartitions("gram", "row", "pos"))
    out = met.where(F.col("gram").isNull()).select("row", "a", "b").union(resolve_edges(contexts, length, gram))
    if any_hot:
        strings = settle(hash_strings(with_text(edges.join(hot, "gram")), length, gram))
        out = out.union(strings.where(F.col("gram").isNull()).select("row", "a", "b"))
    return out


def dedup(docs: DataFrame, key: str = "doc_id", length: int = LENGTH, gram: int = GRAM,
          with_text: bool = False) -> DataFrame:
    """``kept`` (the columns of ``docs`` but the text), n_bytes, n_removed,
    n_spans, kept_sha256; what is left (binary, as cuts may fall inside a
    character) on request."""
    rows = numbered(docs, key)
    texts = rows.select(F.col(ROW).alias("row"), F.col("kept.text").alias("text"))
    ranges = ranges_by_row(covered(texts, length, gram))
    others = F.struct(*[F.col(f"kept.`{c}`") for c in docs.columns if c != "text"]).alias("kept")
    joined = (texts.join(ranges, "row", "left")
              .join(rows.select(F.col(ROW).alias("row"), others), "row").select("kept", "text", "ranges"))
    schema = (f"kept {rows.select(others).schema['kept'].dataType.simpleString()}, n_bytes long, n_removed long, "
              "n_spans long, kept_sha256 string" + ", kept_bytes binary" * with_text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column("ranges")
            for lo, hi, data, off in blocks(batch.column("text")):
                part = spans.slice(lo, hi - lo)
                per = np.nan_to_num(part.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
                flat, base = part.flatten(), np.repeat(off[:-1], per)
                step = np.zeros(len(data) + 1, np.int32)
                np.add.at(step, base + flat.field("a").to_numpy(), 1)
                np.add.at(step, base + flat.field("b").to_numpy(), -1)
                gone = np.cumsum(step[:-1]) > 0
                head = gone.copy()
                head[1:] &= ~gone[:-1]
                inner = off[:-1][off[:-1] < len(data)]
                head[inner] = gone[inner]
                count = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[off])
                left = data[~gone].tobytes()
                at = np.concatenate([[0], np.cumsum(~gone)])[off].tolist()
                pieces = [left[x:y] for x, y in zip(at, at[1:])]
                cols = [batch.column("kept").slice(lo, hi - lo), pa.array(np.diff(off)), pa.array(count(gone)),
                        pa.array(count(head)), pa.array([hashlib.sha256(p).hexdigest() for p in pieces], pa.string())]
                names = ["kept", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
                if with_text:
                    cols.append(pa.array(pieces, pa.binary()))
                    names.append("kept_bytes")
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return joined.mapInArrow(run, schema)


def digest(docs: DataFrame) -> DataFrame:
    return dedup(docs.select("doc_id", "text")).select(
        "kept.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
