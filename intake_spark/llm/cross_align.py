"""Cross-tokenizer alignment (operator 13).

Two tokenizers, A (byte-level) and B (pieces), encode the same bytes: a space
and the text. The byte offsets where tokens of both end cut a document into
groups; tokens whose byte ranges overlap are linked. Between two neighbouring
ends of either kind lies exactly one link, so a document's links are read off
its merged ends.

Counts of linked id pairs over all documents: an array gives each A id the B id
of the same bytes. A group of one A token and that B token is counted in a
vector by A id, as long as A's vocabulary, one a task. Only links of the other
groups become pair rows, combined in the task before the shuffle. The summed
vectors and each B id's highest count are as long as the vocabularies and are
sent to all tasks; counts of irregular pairs lie in sorted parts in the shared
folder and are looked up by block.

Texts are encoded once: ids are written, and counted and judged from there.

Defined results: a null or empty text, and one whose bytes either tokenizer
doesn't give back (B can't tell U+2581 from a space), has no tokens: zeros and
an empty ``groups`` text; special tokens' strings in a text are plain text;
repeated rows count each; an empty table gives no rows; other columns aren't
read.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import sorted_parts
from .files import stored
from .id_store import ByteBpe
from .piece_codec import PieceBpe
from .segments import SegmentTable
from .textbytes import blocks, ragged, text_buffers

BLOCK = 1 << 18         # bytes of text, or ids, handled at once
HELD_PAIRS = 1 << 18    # distinct pairs that a task combines before it hands them on
HELD_SEGMENTS = 300_000 # encodings that a tokenizer remembers in a worker


# ---------------------------------------------------------------- vocabularies

class Vocabulary:
    """Bytes of each id, one after another."""

    def __init__(self, entries: list[bytes]) -> None:
        self.size = np.array([len(e) for e in entries], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(entries), np.uint8)

    def text(self, ids: np.ndarray) -> np.ndarray:
        return self.data[ragged(self.start[ids], self.size[ids])]


@functools.lru_cache(maxsize=2)
def byte_tokenizer(path: str) -> tuple[ByteBpe, list[bytes]]:
    enc = ByteBpe(path)
    enc.special = []
    enc.lib.encode_special_tokens = True
    enc.table = SegmentTable(enc._encode, [enc.dtype], HELD_SEGMENTS)
    byte_of = {c: b for b, c in enc._chars.items()}
    names = [""] * enc.lib.get_vocab_size()
    for name, i in enc.lib.get_vocab().items():
        names[i] = name
    return enc, [bytes(byte_of[c] for c in n) if all(c in byte_of for c in n) else n.encode() for n in names]


@functools.lru_cache(maxsize=2)
def piece_tokenizer(path: str) -> PieceBpe:
    enc = PieceBpe(path)
    enc.table = SegmentTable(enc._segments, [np.uint32, np.uint8], HELD_SEGMENTS)
    return enc


def piece_entries(path: str) -> list[bytes]:
    enc = piece_tokenizer(path)
    return [bytes([enc.byte_of[i]]) if i in enc.byte_of else enc.plain.get(i, b"") for i in range(len(enc.pieces))]


def identity(a_path: str, b_path: str) -> np.ndarray:
    """The B id of the same bytes for each A id, or -1. Where a byte piece and
    a plain piece have the same byte, the plain one, as the encoder prefers it."""
    enc = piece_tokenizer(b_path)
    by_bytes = {bytes([b]): i for i, b in enc.byte_of.items()} | {p: i for i, p in enc.plain.items()}
    return np.array([by_bytes.get(e, -1) if e else -1 for e in byte_tokenizer(a_path)[1]], np.int64)


def id_type(vocabulary: Vocabulary) -> np.dtype:
    return np.dtype("<u2" if len(vocabulary.size) <= 1 << 16 else "<u4")


class Pair(NamedTuple):
    """What the tasks after the encoding need of both vocabularies."""
    a: Vocabulary
    b: Vocabulary
    same: np.ndarray    # the B id of the same bytes, by A id


@functools.lru_cache(maxsize=2)
def pair_of(a_path: str, b_path: str) -> Pair:
    return Pair(Vocabulary(byte_tokenizer(a_path)[1]), Vocabulary(piece_entries(b_path)), identity(a_path, b_path))


# -------------------------------------------------------------------- encoding

def encode_block(data: np.ndarray, off: np.ndarray, a_path: str, b_path: str):
    """(A ids, their offsets by text, B ids, their offsets by text); none for
    texts that don't come back byte for byte."""
    filled = np.diff(off) > 0
    spaced = np.insert(data, off[:-1][filled], 32)
    soff = off + np.concatenate([[0], np.cumsum(filled)])
    a, n = byte_tokenizer(a_path)[0].encode(spaced, soff)
    aoff = np.concatenate([[0], np.cumsum(n)])
    b, boff, _, _ = piece_tokenizer(b_path).encode_block(data, off)
    a, b = a.astype(np.int64), b.astype(np.int64)
    same = filled
    for ids, ioff, vocabulary in zip((a, b), (aoff, boff), pair_of(a_path, b_path)):
        ends = np.concatenate([[0], np.cumsum(vocabulary.size[ids])])[ioff]
        text = vocabulary.text(ids)
        if len(text) == len(spaced) and np.array_equal(ends, soff) and np.array_equal(text, spaced):
            continue
        same = same & np.array([x.tobytes() == y.tobytes() for x, y in
                                zip(np.split(text, ends[1:-1]), np.split(spaced, soff[1:-1]))], bool)
    out = []
    for ids, ioff in ((a, aoff), (b, boff)):
        count = np.where(same, np.diff(ioff), 0)
        out += [ids[ragged(ioff[:-1], count)], np.concatenate([[0], np.cumsum(count)])]
    return tuple(out)


def encode_both(docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """id, a, b: the ids of both tokenizers for every text, as unsigned
    little-endian numbers of ``id_type`` one after another (binary)."""
    kinds = [id_type(v) for v in pair_of(a_path, b_path)[:2]]
    rows = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, off in blocks(batch.column("text"), BLOCK):
                a, aoff, b, boff = encode_block(data, off, a_path, b_path)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(lo, hi - lo),
                     *(_binary(x.astype(kind), o) for x, o, kind in zip((a, b), (aoff, boff), kinds))], names=["id", "a", "b"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, a binary, b binary")


def _binary(ids: np.ndarray, off: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(off) - 1, [None, pa.py_buffer((off * ids.itemsize).astype(np.int32)), pa.py_buffer(ids)])


# ------------------------------------------------------------------- alignment

class Aligned:
    """Links and groups of consecutive documents, all in one byte line."""

    def __init__(self, a: np.ndarray, aoff: np.ndarray, b: np.ndarray, boff: np.ndarray, pair: Pair) -> None:
        ends_a, ends_b = np.cumsum(pair.a.size[a]), np.cumsum(pair.b.size[b])
        ends = np.union1d(ends_a, ends_b)
        self.of_a, self.of_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
        self.a, self.b = a[self.of_a], b[self.of_b]  # the link that ends here
        self.cut = (ends_a[self.of_a] == ends_b[self.of_b]) if len(ends) else np.zeros(0, bool)
        alone = self.cut & np.concatenate([[True], self.cut[:-1]]) if len(ends) else self.cut
        self.plain = alone & (pair.same[self.a] == self.b)
        # links by document: a document's last end is an end of both
        last = np.where(np.diff(aoff) > 0, aoff[1:] - 1, -1)
        until = np.where(last >= 0, np.searchsorted(ends, ends_a[last]) + 1 if len(ends) else 0, 0)
        self.off = np.concatenate([[0], np.maximum.accumulate(until)]) if len(until) else np.zeros(1, np.int64)

    def by_document(self, values: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
        return total[self.off[1:]] - total[self.off[:-1]]


def _blocks_of_ids(batch: pa.RecordBatch, pair: Pair):
    """(lo, hi, a, aoff, b, boff) over consecutive rows of at most ``BLOCK``
    ids, at least one row each."""
    if not batch.num_rows:
        return
    cols = []
    for c, v in (("a", pair.a), ("b", pair.b)):
        data, off = text_buffers(batch.column(c))
        kind = id_type(v)
        cols.append((data[off[0]: off[-1]].view(kind), (off - off[0]) // kind.itemsize))
    (a, aoff), (b, boff) = cols
    both, lo = aoff + boff, 0
    while lo < batch.num_rows:
        hi = min(batch.num_rows, max(lo + 1, int(np.searchsorted(both, both[lo] + BLOCK, "right")) - 1))
        yield (lo, hi, a[aoff[lo]: aoff[hi]].astype(np.int64), aoff[lo: hi + 1] - aoff[lo],
               b[boff[lo]: boff[hi]].astype(np.int64), boff[lo: hi + 1] - boff[lo])
        lo = hi


def _packed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a << 32 | b


def count_links(encoded: DataFrame, pair: Pair) -> DataFrame:
    """(a, b, n): how many links hold an id pair; rows with b = -1 are the
    summed vector of groups of one token each with the same bytes."""
    shared = encoded.sparkSession.sparkContext.broadcast(pair)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = shared.value
        vector = np.zeros(len(pair.same), np.int64)
        keys, n = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def rows(a, b, n):
            return pa.RecordBatch.from_arrays([pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(n)],
                                              names=["a", "b", "n"])

        for batch in batches:
            for _, _, *ids in _blocks_of_ids(batch, pair):
                al = Aligned(*ids, pair)
                vector += np.bincount(al.a[al.plain], minlength=len(vector))
                own, m = np.unique(_packed(al.a[~al.plain], al.b[~al.plain]), return_counts=True)
                merged, at = np.unique(np.concatenate([keys, own]), return_inverse=True)
                total = np.zeros(len(merged), np.int64)
                np.add.at(total, at, np.concatenate([n, m]))
                keys, n = merged, total
                if len(keys) > HELD_PAIRS:
                    yield rows(keys >> 32, keys & 0xFFFFFFFF, n)
                    keys, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        yield rows(keys >> 32, keys & 0xFFFFFFFF, n)
        used = np.flatnonzero(vector)
        yield rows(used, np.full(len(used), -1), vector[used])

    return encoded.select("a", "b").mapInArrow(run, "a int, b int, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))


class Counts:
    """Corpus counts of id pairs: of plain groups by A id, and the highest by
    B id, as vectors; of the other pairs in sorted parts."""

    def __init__(self, spark: SparkSession, links: DataFrame, pair: Pair) -> None:
        same = pair.same
        self.plain = np.zeros(len(same), np.int64)      # count of (a, same bytes), by a
        for r in links.where("b = -1").toLocalIterator():   # at most one row an A id
            self.plain[r["a"]] = r["n"]
        ids = np.flatnonzero(same >= 0)
        named = spark.createDataFrame(pa.table({"a": pa.array(ids.astype(np.int32)), "to": pa.array(same[ids].astype(np.int32))}))
        whole = stored(spark, links.join(F.broadcast(named), "a", "left")  # a row an A id
                       .withColumn("b", F.when(F.col("b") == -1, F.col("to")).otherwise(F.col("b")))
                       .groupBy("a", "b").agg(F.sum("n").alias("n"), (F.max(F.col("b") == F.col("to"))).alias("same")), "pairs")
        for r in whole.where("same").toLocalIterator():     # plain pairs, with their irregular links
            self.plain[r["a"]] = r["n"]
        self.highest = np.zeros(len(pair.b.size), np.int64)
        for r in whole.groupBy("b").agg(F.max("n").alias("n")).toLocalIterator():   # at most one row a B id
            self.highest[r["b"]] = r["n"]
        key = F.shiftleft(F.col("a").cast("long"), 32).bitwiseOR(F.col("b").cast("long"))
        self.pairs = sorted_parts.write(whole.select(key.alias("key"), F.col("n").alias("value")), "pair-counts")

    def of(self, al: Aligned) -> np.ndarray:
        """The count of every link's pair."""
        out = self.plain[al.a]
        odd = np.flatnonzero(~al.plain)
        keys, at = np.unique(_packed(al.a[odd], al.b[odd]), return_inverse=True)
        out[odd] = self.pairs.find(keys)[at]
        return out


def _group_text(al: Aligned, a: np.ndarray, aoff: np.ndarray, b: np.ndarray, boff: np.ndarray) -> tuple[bytes, np.ndarray]:
    """``a1,a2|b1;a3|b2`` of all documents, one after another, each with a last
    mark, and the documents' offsets."""
    at = np.flatnonzero(al.cut)
    if not len(at):
        return b"", np.zeros(len(aoff), np.int64)
    to_a, to_b = al.of_a[at] + 1, al.of_b[at] + 1
    na, nb = np.diff(to_a, prepend=0), np.diff(to_b, prepend=0)
    n = len(a) + len(b)
    begin = np.cumsum(na + nb) - (na + nb)
    ids, mark = np.empty(n, np.int64), np.full(n, ord(","), np.uint8)
    ids[ragged(begin, na)], ids[ragged(begin + na, nb)] = a, b
    mark[begin + na - 1], mark[begin + na + nb - 1] = ord("|"), ord(";")
    digits = np.ones(n, np.int64)
    for p in range(1, 10):
        digits += ids >= 10 ** p
    ends = np.cumsum(digits + 1)
    out = np.empty(int(ends[-1]), np.uint8)
    out[ends - 1] = mark
    for p in range(10):
        have = digits > p
        if not have.any():
            break
        out[ends[have] - 2 - p] = ids[have] // 10 ** p % 10 + 48
    return out.tobytes(), np.concatenate([[0], ends])[aoff + boff]


def align(encoded: DataFrame, counts: Counts, pair: Pair, with_groups: bool = False) -> DataFrame:
    """One row a document: id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256, and the groups' text on request."""
    held = encoded.sparkSession.sparkContext.broadcast((counts, pair))
    schema = (f"id {encoded.schema['id'].dataType.simpleString()}, n_a long, n_b long, n_groups long, n_links long, "
              "n_best long, count_sum long, groups_sha256 string" + ", groups string" * with_groups)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, pair = held.value
        for batch in batches:
            for lo, hi, *ids in _blocks_of_ids(batch, pair):
                al = Aligned(*ids, pair)
                n = c.of(al)
                text, off = _group_text(al, *ids)
                off, view = off.tolist(), memoryview(text)
                texts = [view[i: j - 1] if j > i else None for i, j in zip(off, off[1:])]
                cols = [batch.column("id").slice(lo, hi - lo), pa.array(np.diff(ids[1])), pa.array(np.diff(ids[3])),
                        pa.array(al.by_document(al.cut)), pa.array(np.diff(al.off)),
                        pa.array(al.by_document(n == c.highest[al.b])), pa.array(al.by_document(n)),
                        pa.array(["" if t is None else hashlib.sha256(t).hexdigest() for t in texts])]
                names = ["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
                if with_groups:
                    cols.append(pa.array(["" if t is None else bytes(t).decode() for t in texts]))
                    names.append("groups")
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return encoded.mapInArrow(run, schema)


def cross_align(docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text",
                with_groups: bool = False) -> DataFrame:
    """Encode, count and judge every text of ``docs``."""
    spark = docs.sparkSession
    encoded = stored(spark, encode_both(docs, a_path, b_path, key, text), "both-ids")
    pair = pair_of(a_path, b_path)
    links = stored(spark, count_links(encoded, pair), "links")
    return align(encoded, Counts(spark, links, pair), pair, with_groups)


def digest(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    return cross_align(docs, a_path, b_path).withColumnRenamed("id", "doc_id")
