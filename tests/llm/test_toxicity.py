"""Operator 6: the machine's formula, what pairs add, held-out accuracy."""
import numpy as np
import pyarrow as pa
from conftest import SF
from llm_data import awkward, documents, fresh, repeated
from pyspark.sql import functions as F

from intake_spark.llm import toxicity as T
from intake_spark.llm.queries import op6_toxicity
from intake_spark.llm.textbytes import blocks


def test_margin_is_the_pairwise_sum():
    rng = np.random.default_rng(1)
    m = T.Model(0.3, rng.normal(size=T.BUCKETS), rng.normal(size=(T.BUCKETS, T.FACTORS)))
    idx, off = np.array([5, 9, 11, 7, 5]), np.array([0, 3, 3, 5])
    want = []
    for a, b in zip(off, off[1:]):
        x = idx[a:b]
        pairs = sum(m.factor[x[i]] @ m.factor[x[j]] for i in range(len(x)) for j in range(i))
        want.append(0.3 + m.weight[x].sum() + pairs / max(1, len(x)))
    assert np.allclose(m.margins(idx, off), want)


def test_pairs_are_learned():
    """Neither word alone says anything; both together, or none, do."""
    rng = np.random.default_rng(0)
    texts, label = [], []
    for _ in range(3000):
        a, b = rng.random() < .5, rng.random() < .5
        noise = [f"w{rng.integers(30)}" for _ in range(3)]
        texts.append(" ".join(noise + ["insult"] * a + ["group"] * b))
        label.append(float(a == b))
    (_, _, d, o), = blocks(pa.array(texts))
    idx, off = T.terms(d, o)
    y = np.array(label)
    half = np.arange(2000), np.arange(2000, 3000)
    old, T.SPARSE = T.SPARSE, 0.0
    try:
        m = T.fit(*T.rows_of(idx, off, half[0]), y[half[0]])
    finally:
        T.SPARSE = old
    acc = ((m.scores(*T.rows_of(idx, off, half[1])) >= .5) == (y[half[1]] > 0)).mean()
    assert acc > 0.8


def test_held_out_rows(spark):
    got = op6_toxicity(spark, SF["0.1"])
    labels = spark.read.parquet(SF["0.1"] + "/labels.parquet")
    r = (got.where("held_out").join(labels, "doc_id").groupBy("toxic").agg(F.avg("predicted").alias("p"), F.avg("score").alias("s"))
         .orderBy("toxic").collect())
    assert r[0].p < 0.02 and r[1].p > 0.5
    assert got.where("score < 0 or score > 1 or score is null").isEmpty()


def test_awkward_rows(spark):
    rows = repeated(awkward(fresh()))
    docs = documents(spark, rows)
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(45)] + [(1, 1, None), (None, 1, 1), (2, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    got = T.predict(docs, labels)
    assert got.count() == len(rows)
    assert got.where("score < 0 or score > 1 or score is null or predicted is null").isEmpty()
    same = {r.score for r in got.where("doc_id in (3, 4, 5)").collect()}
    assert len(same) == 1  # no terms: the base rate
    assert {r.score for r in T.predict(docs, labels.limit(0)).collect()} == {0.0}
    assert T.predict(documents(spark, []), labels).count() == 0


def test_unseen_words_change_no_score():
    rng = np.random.default_rng(5)
    texts = [" ".join([f"w{rng.integers(40)}" for _ in range(12)] + ["bad"] * (i % 2)) for i in range(900)]
    (_, _, d, o), = blocks(pa.array(texts))
    m = T.fit(*T.terms(d, o), np.arange(900) % 2.0)
    plain = texts[:20]
    noisy = [t + "".join(f" new{i}x{j}" for j in range(60)) for i, t in enumerate(plain)]
    (_, _, d, o), = blocks(pa.array(plain + noisy))
    idx, off = T.terms(d, o)
    unseen = ~m.known[idx]
    assert unseen.sum() >= 20 * 55  # but for hashes that meet a known word's
    s = m.scores(*T.terms(d, o))
    same = np.array([m.known[idx[off[20 + i]: off[21 + i]]].sum() == m.known[idx[off[i]: off[i + 1]]].sum() for i in range(20)])
    assert same.sum() >= 15 and np.array_equal(s[:20][same], s[20:][same])
