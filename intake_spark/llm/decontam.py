"""Benchmark decontamination with a positional inverted index (operator 9).

1. ``build_index`` stores the training tokens' postings: the documents are cut
   into blocks, and each block becomes one row: its distinct terms (64-bit word
   hashes, sorted), and each term's sorted word positions. The index depends on
   the documents alone and is split as they are; nothing is shuffled.
2. ``search`` counts the test terms' postings over the whole index, orders each
   test phrase's terms from the rarest, and intersects offset-adjusted posting
   lists in that order, in every block. It returns exact phrase matches (word
   spans and items) and proximity matches.

Words: maximal runs of digits, letters and non-ASCII characters after
lower-casing A-Z. Phrases: every run of ``window`` words of an item; an item
of fewer words, but not none, is one phrase. Proximity: at least ``NEAR_NEED``
of the item's ``NEAR_TERMS`` rarest distinct terms stand in one document at
offsets that agree within ``NEAR_SLACK`` words.

The test set goes to the tasks in blocks of at most ``ITEM_BLOCK_BYTES`` of
text, so its size is bounded at each time.

Defined results: null and empty texts have no words and match nothing; an item
without words is never found; repeated documents each give a row, repeated
items count once by id; a null item id counts as the empty string; empty tables
give no rows or no matches; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .textbytes import U64, blocks, ragged, text_buffers, words

WINDOW = 13
NEAR_TERMS, NEAR_NEED, NEAR_SLACK = 8, 6, 4
ITEM_BLOCK_BYTES = 16 << 20


# -------------------------------------------------------------------- index

def index_block(wh: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(terms, ends of their lists, positions) of a block's word hashes."""
    order = np.argsort(wh, kind="stable")
    terms, first = np.unique(wh[order], return_index=True)
    return terms, np.append(first[1:], len(wh)).astype(np.int64), order.astype(np.int32)


def build_index(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Store the positional index of ``docs`` under ``path``; one row a block."""
    kind = docs.schema[key].dataType.simpleString()
    schema = (f"part int, block int, keys array<{kind}>, word_off binary, terms binary, ends binary, "
              "positions binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, no = TaskContext.get().partitionId(), 0
        for batch in batches:
            keys = batch.column("key")
            for lo, hi, data, off in blocks(batch.column("text")):
                wh, _, woff = words(data, off)
                terms, ends, positions = index_block(wh)
                cols = [pa.array([part], pa.int32()), pa.array([no], pa.int32()),
                        pa.ListArray.from_arrays(pa.array([0, hi - lo], pa.int32()), keys.slice(lo, hi - lo)),
                        *(pa.array([x.tobytes()], pa.binary()) for x in (woff.astype(np.int64), terms, ends, positions))]
                yield pa.RecordBatch.from_arrays(cols, names=["part", "block", "keys", "word_off", "terms", "ends", "positions"])
                no += 1

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, schema)
    rows.write.parquet(path)
    return docs.sparkSession.read.schema(schema).parquet(path)


class Postings:
    """One block of the index."""

    def __init__(self, terms: bytes, ends: bytes, positions: bytes) -> None:
        self.terms = np.frombuffer(terms, U64)
        self.ends = np.frombuffer(ends, np.int64)
        self.positions = np.frombuffer(positions, np.int32)

    def lists(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, length) in ``positions`` of each term's list; length 0 if
        the block hasn't the term."""
        if not len(self.terms):
            return np.zeros(len(terms), np.int64), np.zeros(len(terms), np.int64)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        start = np.where(at > 0, self.ends[at - 1], 0)
        return start, np.where(self.terms[at] == terms, self.ends[at] - start, 0)


# ------------------------------------------------------------------ queries

class Phrases:
    """Phrases of a block of test items, before the terms are ordered."""

    def __init__(self, items: list[tuple[str, str]], window: int) -> None:
        data, off = text_buffers(pa.array([t or "" for _, t in items], pa.string()))
        wh, _, woff = words(data, off)
        self.ids = [i for i, _ in items]
        self.vocab, term = np.unique(wh, return_inverse=True)
        n = np.diff(woff)
        count = np.where(n >= window, n - window + 1, (n > 0).astype(np.int64))
        self.item = np.repeat(np.arange(len(items)), count)
        start = ragged(woff[:-1], count)
        self.length = np.minimum(n, window)[self.item]
        at = start[:, None] + np.arange(window)[None, :]
        inside = np.arange(window)[None, :] < self.length[:, None]
        padded = np.append(term, np.zeros(window, np.int64))
        self.terms = np.where(inside, padded[np.where(inside, at, 0)], -1)
        seen: dict[bytes, list[int]] = {}
        for i, row in enumerate(self.terms):  # equal phrases are searched once
            seen.setdefault(row.tobytes(), []).append(i)
        pick = np.array([v[0] for v in seen.values()], np.int64)
        self.items_of = [sorted({int(self.item[i]) for i in v}) for v in seen.values()]
        self.terms, self.length = self.terms[pick], self.length[pick]
        self.first = []  # each item's distinct terms with their first offset
        for a, b in zip(woff[:-1], woff[1:]):
            t, o = np.unique(term[a:b], return_index=True)
            self.first.append((t, o))

    def ordered(self, postings: np.ndarray) -> None:
        """Order each phrase's offsets, and choose each item's proximity terms,
        from the rarest; ``postings`` counts each vocabulary term."""
        count = np.append(postings, np.iinfo(np.int64).max)
        self.offsets = np.argsort(count[self.terms], axis=1, kind="stable").astype(np.int64)
        near_t, near_o, near_i = [], [], []
        for i, (t, o) in enumerate(self.first):
            best = np.argsort(count[t], kind="stable")[:NEAR_TERMS]
            if len(best) >= NEAR_NEED:
                near_t.append(t[best])
                near_o.append(o[best])
                near_i.append(np.full(len(best), i))
        cat = lambda x: np.concatenate([np.zeros(0, np.int64), *x]).astype(np.int64)
        self.near_terms, self.near_offsets, self.near_items = cat(near_t), cat(near_o), cat(near_i)


def phrase_matches(p: Postings, q: Phrases, word_off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(phrase, first word) of every exact occurrence in a block."""
    start, length = p.lists(q.vocab)
    start, length = np.append(start, 0), np.append(length, 0)
    rows = np.arange(len(q.terms))
    rare = q.terms[rows, q.offsets[:, 0]]
    full = np.where(q.terms < 0, 1, length[q.terms]).min(axis=1) > 0 if len(rows) else np.zeros(0, bool)
    rows, rare = rows[full], rare[full]
    n = length[rare]
    ph = np.repeat(rows, n)
    at = p.positions[ragged(start[rare], n)].astype(np.int64) - np.repeat(q.offsets[rows, 0], n)
    doc = np.searchsorted(word_off, at, "right") - 1
    ok = at >= 0
    ok[ok] = at[ok] + q.length[ph[ok]] <= word_off[doc[ok] + 1]
    ph, at = ph[ok], at[ok]
    list_of = np.repeat(np.arange(len(p.ends)), np.diff(np.concatenate([[0], p.ends])))
    keyed = list_of << 32 | p.positions  # postings in order of (list, position)
    number = np.minimum(np.searchsorted(p.terms, q.vocab), max(0, len(p.terms) - 1))
    for j in range(1, q.terms.shape[1]):
        if not len(ph):
            break
        o = q.offsets[ph, j]
        t = q.terms[ph, o]
        probe = number[t] << 32 | (at + o)
        where = np.minimum(np.searchsorted(keyed, probe), len(keyed) - 1)
        keep = (t < 0) | (keyed[where] == probe)
        ph, at = ph[keep], at[keep]
    return ph, at


def near_matches(p: Postings, q: Phrases, word_off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, item) of the proximity matches in a block."""
    none = np.zeros(0, np.int64)
    start, length = p.lists(q.vocab)
    if not len(q.near_terms):
        return none, none
    have = np.bincount(q.near_items, length[q.near_terms] > 0, minlength=len(q.ids)) >= NEAR_NEED
    use = have[q.near_items]
    t, o, item = q.near_terms[use], q.near_offsets[use], q.near_items[use]
    n = length[t]
    at = p.positions[ragged(start[t], n)].astype(np.int64)
    doc = np.searchsorted(word_off, at, "right") - 1
    at, item, t = at - np.repeat(o, n), np.repeat(item, n), np.repeat(t, n)
    order = np.lexsort((t, at, doc, item))
    at, item, t, doc = at[order], item[order], t[order], doc[order]
    found_doc, found_item = [], []
    ends = np.flatnonzero(np.append((np.diff(item) != 0) | (np.diff(doc) != 0), True)) + 1 if len(at) else none
    begin = 0
    for end in ends.tolist():
        if end - begin >= NEAR_NEED and len(np.unique(t[begin:end])) >= NEAR_NEED:
            a, terms = at[begin:end], t[begin:end]
            last = np.searchsorted(a, a + NEAR_SLACK, "right")
            for i in np.flatnonzero(last - np.arange(len(a)) >= NEAR_NEED).tolist():
                if len(set(terms[i:last[i]].tolist())) >= NEAR_NEED:
                    found_doc.append(doc[begin])
                    found_item.append(item[begin])
                    break
        begin = end
    return np.array(found_doc, np.int64), np.array(found_item, np.int64)


def search(index: DataFrame, items: DataFrame, key: str = "doc_id", item_key: str = "item_id",
           text: str = "text", window: int = WINDOW) -> DataFrame:
    """One row a document: ``key``, n_words, spans (maximal hit word ranges,
    end exclusive), items (ids, as strings, sorted, of items with an exact
    phrase match), near_items (ids of items with a proximity match)."""
    spark = index.sparkSession
    sc = spark.sparkContext
    asked = items.select(F.coalesce(F.col(item_key).cast("string"), F.lit("")).alias("i"), F.col(text).alias("t"))
    total = asked.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n_blocks = max(1, -(-total // ITEM_BLOCK_BYTES))
    queries = []
    for b in range(n_blocks):
        part = asked.where(F.pmod(F.xxhash64("i"), F.lit(n_blocks)) == b) if n_blocks > 1 else asked
        q = Phrases([(r["i"], r["t"]) for r in part.toLocalIterator()], window)
        vocab = sc.broadcast(q.vocab)

        def count(batches: Iterator[pa.RecordBatch], vocab=vocab) -> Iterator[pa.RecordBatch]:
            total = np.zeros(len(vocab.value), np.int64)
            for batch in batches:
                for terms, ends in zip(batch.column("terms"), batch.column("ends")):
                    total += Postings(terms.as_py(), ends.as_py(), b"").lists(vocab.value)[1]
            have = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(have), pa.array(total[have])], names=["term", "n"])

        counted = np.zeros(len(q.vocab), np.int64)
        for r in (index.select("terms", "ends").mapInArrow(count, "term long, n long")
                  .groupBy("term").agg(F.sum("n").alias("n")).toLocalIterator()):
            counted[r["term"]] = r["n"]
        q.ordered(counted)
        queries.append(sc.broadcast(q))

    kind = index.schema["keys"].dataType.elementType.simpleString()
    schema = (f"`{key}` {kind}, n_words long, spans array<struct<start:int,end:int>>, items array<string>, "
              "near_items array<string>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                keys = batch.column("keys")[i].values
                get = lambda c: batch.column(c)[i].as_py()  # noqa: E731, B023
                word_off = np.frombuffer(get("word_off"), np.int64)
                p, n_docs = Postings(get("terms"), get("ends"), get("positions")), len(word_off) - 1
                step = np.zeros(int(word_off[-1]) + 1, np.int64)
                found: list[set] = [set() for _ in range(n_docs)]
                near: list[set] = [set() for _ in range(n_docs)]
                for held in queries:
                    q = held.value
                    ph, at = phrase_matches(p, q, word_off)
                    np.add.at(step, at, 1)
                    np.add.at(step, at + q.length[ph], -1)
                    doc = np.searchsorted(word_off, at, "right") - 1
                    for d, f in np.unique(np.stack([doc, ph], 1), axis=0).tolist() if len(ph) else []:
                        found[d].update(q.ids[x] for x in q.items_of[f])
                    for d, f in zip(*(x.tolist() for x in near_matches(p, q, word_off))):
                        near[d].add(q.ids[f])
                hit = np.cumsum(step[:-1]) > 0
                edge = hit.copy()
                edge[1:] &= ~hit[:-1]
                edge[word_off[word_off < len(hit)]] |= hit[word_off[word_off < len(hit)]]
                first = np.flatnonzero(edge)
                nxt = np.append(first[1:], len(hit))
                gaps = np.flatnonzero(~hit)
                stop = np.append(gaps, len(hit))[np.searchsorted(gaps, first)]
                stop = np.minimum(stop, nxt)
                doc = np.searchsorted(word_off, first, "right") - 1
                spans = pa.StructArray.from_arrays(
                    [pa.array((first - word_off[doc]).astype(np.int32)), pa.array((stop - word_off[doc]).astype(np.int32))],
                    names=["start", "end"])
                span_off = np.searchsorted(doc, np.arange(n_docs + 1))
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.array(np.diff(word_off)), pa.ListArray.from_arrays(pa.array(span_off, pa.int32()), spans),
                     pa.array([sorted(x) for x in found], pa.list_(pa.string())),
                     pa.array([sorted(x) for x in near], pa.list_(pa.string()))],
                    names=[key, "n_words", "spans", "items", "near_items"])

    return index.select("keys", "word_off", "terms", "ends", "positions").mapInArrow(run, schema)


def hits(docs: DataFrame, items: DataFrame, key: str = "doc_id") -> DataFrame:
    """``search`` over a fresh index of ``docs``, with n_hit and the rule:
    a document is contaminated if one word in twenty, or more, is hit."""
    index = build_index(docs, scratch_path(docs.sparkSession, "postings"), key=key)
    found = search(index, items, key=key)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + (s["end"] - s["start"]))
    return (found.withColumn("n_hit", n_hit)
            .withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words"))))


def digest(docs: DataFrame, items: DataFrame) -> DataFrame:
    return hits(docs, items).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"), "contaminated")


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that aren't contaminated, unchanged. Rows are
    matched by id and text, so rows with equal ids are judged apart."""
    row = F.concat_ws(":", F.col("doc_id").cast("string"), F.md5(F.coalesce("text", F.lit(""))))
    bad = (hits(docs.select(row.alias("row"), "text"), items, key="row")
           .where("contaminated").select("row").distinct())
    kept = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("kept")
    return docs.select(kept, row.alias("row")).join(bad, "row", "left_anti").select("kept.*")
