"""Toxicity scores with a factorization machine over hashed terms (operator 6).

A text's features are its distinct words, hashed to ``BUCKETS``. The score is

    sigmoid(w0 + sum_i w_i + (|sum_i v_i|^2 - sum_i |v_i|^2) / (2 n))

over the n distinct terms i that training has seen often enough: the weights of
single terms, and the inner products of the terms' factors, which learn pairs (an
insult next to a mention of a group) that no single weight can. The pair sum is
divided by n so that long texts don't drown in it. Other terms count nowhere, so
adding unseen words changes no score.

Training reads a sample of at most about ``TRAIN_ROWS`` labelled rows, chosen
by a hash of the key (all rows where there are fewer); their terms come to the
driver, where the factors are fitted with mini-batches. The model has a fixed
size, and every text is scored whole where it lies, without a shuffle.

Defined results: a null or empty text has no terms, its score is the base rate's;
rows with null labels don't train; repeated labels of a key train once each;
repeated rows give repeated results; without labels every score is 0; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textbytes import U64, blocks, ragged, words

BITS = 18
BUCKETS = 1 << BITS
FACTORS = 6
TRAIN_ROWS = 30_000
MIN_TEXTS = 10      # of the sample, for a term to have weights
CHECK_SHARE = 5     # one sample row in so many fits the scale of the score
EPOCHS = 10
BATCH = 256
STEP = 0.15
DECAY = 1e-3        # pull of weights and factors to 0
SPARSE = 1e-3       # what a term's weight must gain to leave 0
DAMP = 1.0          # of the first steps


def terms(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed terms of each text of a block, and offsets by text."""
    wh, _, woff = words(data, off)
    doc = np.repeat(np.arange(len(off) - 1), np.diff(woff))
    u = np.unique(doc << BITS | (wh >> U64(64 - BITS)).astype(np.int64))
    return (u & (BUCKETS - 1)).astype(np.int32), np.searchsorted(u >> BITS, np.arange(len(off)))


@dataclass
class Model:
    bias: float
    weight: np.ndarray   # by term
    factor: np.ndarray   # by term and factor
    scale: float = 1.0   # of the margin, fitted on rows that the factors haven't seen
    shift: float = 0.0
    known: np.ndarray | None = None  # by term: whether it counts (None: all do)

    def scores(self, idx: np.ndarray, off: np.ndarray) -> np.ndarray:
        return sigmoid(self.scale * self.margins(idx, off) + self.shift)

    def margins(self, idx: np.ndarray, off: np.ndarray) -> np.ndarray:
        if self.known is not None:
            counts = self.known[idx]
            idx, off = idx[counts], np.concatenate([[0], np.cumsum(counts)])[off]
        n = np.diff(off)
        out = np.full(len(n), self.bias)
        some = n > 0
        if some.any():
            at = off[:-1][some]
            v = self.factor[idx]
            total = np.add.reduceat(v, at, axis=0)
            square = np.add.reduceat((v * v).sum(axis=1), at)
            out[some] += np.add.reduceat(self.weight[idx], at) + ((total * total).sum(axis=1) - square) / (2 * n[some])
        return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def rows_of(idx: np.ndarray, off: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = np.diff(off)[rows]
    return idx[ragged(off[rows], n)], np.concatenate([[0], np.cumsum(n)])


def fit(idx: np.ndarray, off: np.ndarray, label: np.ndarray) -> Model:
    """Factors from most rows, the scale of the score from the others."""
    held = np.arange(len(label)) % CHECK_SHARE == CHECK_SHARE - 1
    if held.sum() < 50 or len(np.unique(label[held])) < 2:
        return fit_factors(idx, off, label)
    most = np.flatnonzero(~held)
    model = fit_factors(*rows_of(idx, off, most), label[most])
    x, y = model.margins(*rows_of(idx, off, np.flatnonzero(held))), label[held]
    # logistic regression of the label on the margin, with smoothed targets
    t = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = sigmoid(a * x + b)
        g, w = np.array([((p - t) * x).sum(), (p - t).sum()]), p * (1 - p) + 1e-9
        h = np.array([[(w * x * x).sum() + 1e-6, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-6]])
        da, db = np.linalg.solve(h, g)
        a, b = a - np.clip(da, -1, 1), b - np.clip(db, -2, 2)
    if a > 0:
        model.scale, model.shift = float(a), float(b)
    return model


def fit_factors(idx: np.ndarray, off: np.ndarray, label: np.ndarray, seed: int = 11) -> Model:
    """Mini-batch fit with per-parameter step sizes."""
    known = np.bincount(idx, minlength=BUCKETS) >= min(MIN_TEXTS, 1 + len(label) // 50)
    common = known[idx]
    off = np.concatenate([[0], np.cumsum(common)])[off]
    idx = idx[common]
    rng = np.random.default_rng(seed)
    rate = (label.sum() + 1) / (len(label) + 2)
    m = Model(float(np.log(rate / (1 - rate))), np.zeros(BUCKETS, np.float32),
              np.where(known[:, None], rng.normal(0, 0.02, (BUCKETS, FACTORS)), 0).astype(np.float32), known=known)
    sum_w, sum_v = np.full(BUCKETS, DAMP, np.float32), np.full((BUCKETS, FACTORS), DAMP, np.float32)
    n_all = np.diff(off)
    for epoch in range(EPOCHS):
        step = STEP / (1 + epoch)
        order = rng.permutation(len(label))
        for b in range(0, len(order), BATCH):
            rows = order[b: b + BATCH]
            n = n_all[rows]
            rows, n = rows[n > 0], n[n > 0]
            if not len(rows):
                continue
            at = idx[ragged(off[rows], n)]
            start = np.cumsum(n) - n
            v = m.factor[at]
            total = np.add.reduceat(v, start, axis=0)
            margin = m.bias + np.add.reduceat(m.weight[at], start) + (
                (total * total).sum(axis=1) - np.add.reduceat((v * v).sum(axis=1), start)) / (2 * n)
            g = (sigmoid(margin) - label[rows]).astype(np.float32)
            m.bias -= 0.05 * step * float(g.mean())
            each = np.repeat(g, n)
            touched, inv = np.unique(at, return_inverse=True)
            gw = np.bincount(inv, each, len(touched)).astype(np.float32) + DECAY * len(rows) * m.weight[touched]
            pull = (each / np.repeat(n, n).astype(np.float32))[:, None] * (np.repeat(total, n, axis=0) - v)
            gv = np.stack([np.bincount(inv, pull[:, f], len(touched)) for f in range(FACTORS)], 1).astype(np.float32)
            gv += DECAY * len(rows) * m.factor[touched]
            sum_w[touched] += gw * gw
            sum_v[touched] += gv * gv
            rate_w = step / np.sqrt(sum_w[touched])
            w = m.weight[touched] - rate_w * gw
            m.weight[touched] = np.sign(w) * np.maximum(np.abs(w) - rate_w * SPARSE * len(rows), 0)
            m.factor[touched] -= step * gv / np.sqrt(sum_v[touched])
    return m


def held_out(key: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
          label: str = "toxic") -> Model | None:
    """Model of a bounded sample of the labelled rows; None without labels."""
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).select(
        F.col(key).alias("k"), F.col(label).cast("double").alias("y"))
    share = min(1.0, TRAIN_ROWS / max(1, known.count()))
    known = known.where(F.pmod(F.xxhash64("k"), F.lit(1_000_000)) < int(share * 1_000_000) + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, off in blocks(batch.column("t")):
                idx, toff = terms(data, off)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("k").slice(lo, hi - lo),
                     pa.ListArray.from_arrays(pa.array(toff, pa.int32()), pa.array(idx))], names=["k", "terms"])

    kind = docs.schema[key].dataType.simpleString()
    chosen = F.pmod(F.xxhash64(F.col(key)), F.lit(1_000_000)) < int(share * 1_000_000) + 1
    rows = (docs.where(chosen & ~held_out(key)).select(F.col(key).alias("k"), F.col(text).alias("t"))
            .mapInArrow(run, f"k {kind}, terms array<int>").join(known, "k").select("k", "terms", "y").toArrow())
    if rows.num_rows == 0:
        return None
    rows = rows.sort_by("k").combine_chunks()
    col = rows.column("terms").combine_chunks()
    return fit(col.flatten().to_numpy(), np.concatenate([[0], np.cumsum(col.value_lengths().to_numpy())]),
               rows.column("y").to_numpy())


def score_texts(docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(``key``, score) of every row."""
    if model is None:
        return docs.select(key, F.lit(0.0).alias("score"))
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, off in blocks(batch.column("t")):
                score = held.value.scores(*terms(data, off))
                yield pa.RecordBatch.from_arrays([batch.column("k").slice(lo, hi - lo), pa.array(score)],
                                                 names=[key, "score"])

    kind = docs.schema[key].dataType.simpleString()
    return (docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
            .mapInArrow(run, f"`{key}` {kind}, score double"))


def predict(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = train(docs.select("doc_id", "text"), labels.where(~held_out()).select("doc_id", "toxic"))
    return score_texts(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
