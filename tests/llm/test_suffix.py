"""Operator 10 against a brute-force version; the sort against sorted()."""
import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_data import awkward, documents, fresh, prose, repeated

from intake_spark.llm import suffix_dedup as S


def brute(rows, length=S.LENGTH):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    seen, out = set(), []
    for d, t in order:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - length + 1):
            k = b[s: s + length]
            if k in seen:
                gone[s: s + length] = True
            seen.add(k)
        heads = int((gone & ~np.append(False, gone[:-1])).sum())
        left = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out.append((d, len(b), int(gone.sum()), heads, hashlib.sha256(left).hexdigest()))
    return out


def key(r):
    return (r[0] is not None, r[0] or 0, *r[1:])


def check(spark, rows):
    got = S.digest(documents(spark, rows))
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(brute(rows), key=key)


def overlapping(rnd, n):
    base = "".join(rnd.choice("abcdefgh ") for _ in range(3000))
    rows = []
    for i in range(n):
        t = ""
        for _ in range(rnd.randint(1, 5)):
            a = rnd.randrange(len(base))
            t += base[a: a + rnd.randint(20, 400)] + "".join(rnd.choice("abcdefgh ") for _ in range(rnd.randint(0, 40)))
        rows.append((i, t))
    return rows


def test_awkward_rows(spark):
    rows = awkward(fresh()) + [(100, "ab" * 200), (101, "x" * 99), (102, "x" * 100), (103, "x" * 101), (104, "\0" * 300 + "q"),
                               (105, "\0" * 150), (106, "é" * 120)]
    check(spark, rows)
    check(spark, repeated(rows))
    check(spark, [])


@pytest.mark.parametrize("hot", [3, S.HOT_GROUP])
def test_overlapping_repeats(spark, monkeypatch, hot):
    monkeypatch.setattr(S, "HOT_GROUP", hot)
    check(spark, overlapping(fresh(hot), 200))


def test_common_passage(spark):
    rnd = fresh(8)
    passage = prose(rnd, 60)
    check(spark, [(i, f"{prose(rnd, rnd.randint(0, 12))}{passage if i % 3 else ''}{prose(rnd, rnd.randint(0, 12))}") for i in range(250)])


def test_text_left(spark):
    rows = [(1, "q" * 50 + "w" * 160), (2, "é" + "w" * 160 + "z")]
    got = S.dedup(documents(spark, rows), with_text=True).select("kept.doc_id", "kept.row", "kept_bytes").collect()
    assert {r.doc_id: bytes(r.kept_bytes) for r in got} == {1: b"q" * 50 + b"w", 2: "é".encode() + b"z"}


def common(a, b):
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.binary(max_size=3).map(lambda b: (b * 20)[:45]) | st.sampled_from(
    [b"", b"ab", b"ab\0", b"ab\0c", b"a" * 16, b"a" * 17, b"a" * 40, b"a" * 40 + b"b", b"a" * 39 + b"b\0"])), max_size=30))
def test_deep_shallow_sort(pairs):
    group, strings = np.array([g for g, _ in pairs], np.int64), [s for _, s in pairs]
    if not strings:
        return
    order, lcp = S.deep_shallow_sort(group, strings)
    got = [(group[i], strings[i]) for i in order]
    assert got == sorted(pairs)
    for k, (g, s) in enumerate(got):
        assert lcp[k] == (-1 if k == 0 or got[k - 1][0] != g else common(got[k - 1][1], s))
