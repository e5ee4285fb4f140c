"""Operator 5 against all pairs."""
import numpy as np
import pytest
from conftest import SF

from intake_spark.llm import embed_dedup as E
from intake_spark.llm.queries import op5_embed_dedup


def brute(rows, t=0.95):
    fit = []
    for i, (_, v) in enumerate(rows):
        x = None if v is None or None in v else np.array(v, np.float64)
        fit.append(x if x is not None and len(x) and np.isfinite(x).all() and (x != 0).any() else None)
    n = len(rows)
    link = [[j for j in range(n) if i != j and fit[i] is not None and fit[j] is not None and len(fit[i]) == len(fit[j])
             and fit[i] @ fit[j] / np.sqrt((fit[i] @ fit[i]) * (fit[j] @ fit[j])) >= t] for i in range(n)]
    comp = list(range(n))
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in link[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        comp[i] = min(ids) if ids else None
    return sorted(((rows[i][0], len(link[i]), comp[i], rows[i][0] == comp[i]) for i in range(n)), key=str)


def check(spark, rows, kind="float"):
    df = spark.createDataFrame([(i, v, 1, None) for i, v in rows], f"vec_id long, embedding array<{kind}>, v int, cid string")
    got = sorted(map(tuple, E.near_duplicates(df).collect()), key=str)
    if kind == "float":
        rows = [(i, None if v is None else [None if y is None else float(np.float32(y)) for y in v]) for i, v in rows]
    assert got == brute(rows)


def clustered(rnd, groups, dim=12):
    rng = np.random.default_rng(rnd)
    out = []
    for g in range(groups):
        c = rng.normal(size=dim)
        for _ in range(int(rng.integers(1, 9))):
            out.append((c + rng.normal(size=dim) * rng.choice([0.05, 0.2, 0.3])).tolist())
    order = rng.permutation(len(out))
    return [(int(i), out[k]) for i, k in enumerate(order)]


def test_clusters(spark):
    check(spark, clustered(1, 40))
    check(spark, clustered(2, 40), "double")


def test_awkward_vectors(spark):
    rows = clustered(3, 10)
    v = rows[0][1]
    rows += [(500, None), (501, []), (502, [0.0] * 12), (503, [None] + v[1:]), (504, [float("nan")] + v[1:]),
             (505, [float("inf")] + v[1:]), (506, v), (507, [x * 3 for x in v]), (508, [-x for x in v]), (509, v[:6]),
             (510, v[:6]), (None, v), (None, [1.0] + [0.0] * 11), (506, v), (511, [-0.0] * 11 + [1e-30]), (512, [0.0] * 11 + [1.0])]
    check(spark, rows, "double")
    check(spark, [])


@pytest.mark.parametrize("block", [2, 7])
def test_large_buckets_are_cut_into_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(E, "BLOCK", block)
    rng = np.random.default_rng(4)
    c = rng.normal(size=8)
    check(spark, [(i, (c + rng.normal(size=8) * .15).tolist()) for i in range(60)], "double")


def test_whole_table(spark):
    got = op5_embed_dedup(spark, SF["0.1"]).toPandas().set_index("vec_id")
    e = spark.read.parquet(SF["0.1"] + "/embeddings.parquet").toPandas()
    x = np.stack(e.embedding).astype(float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    links = (x @ x.T >= .95).sum(1) - 1
    assert (got.loc[e.vec_id].n_links.to_numpy() == links).all()


def test_odds_of_missing_a_pair():
    for n in (10, 10_000, 10**9):
        bits, tables = E.shape(n, .95)
        assert (1 - (1 - np.arccos(.95) / np.pi) ** bits) ** tables <= E.MISS * 1.0001
