"""Operator 9 against a brute-force version."""
import hashlib
import re

import pytest
from llm_data import SCHEMA, awkward, documents, fresh, prose, repeated

from intake_spark.llm import decontam as D
from intake_spark.session import scratch_path

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(t):
    return WORD.findall((t or "").translate(LOW))


def brute(rows, items, window=13):
    phrases = {}
    for i, t in items:
        w = tokens(t)
        if w:
            for k in range(max(1, len(w) - window + 1)):
                phrases.setdefault(tuple(w[k: k + window]), set()).add("" if i is None else str(i))
    out = []
    for d, t in rows:
        w, hit, ids = tokens(t), set(), set()
        for n in {len(p) for p in phrases}:
            for k in range(len(w) - n + 1):
                found = phrases.get(tuple(w[k: k + n]))
                if found:
                    hit.update(range(k, k + n))
                    ids |= found
        out.append((d, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(),
                    len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def bench(spark, items):
    return spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")


def cases(rnd):
    items = [(i, prose(rnd, rnd.randint(5, 50))) for i in range(12)]
    items += [(20, "short item"), (21, ""), (22, None), (23, "!!!"), (None, prose(rnd, 20)), (3, items[4][1]), (24, "a a a a"),
              (25, "the " * 30)]
    rows = awkward(rnd)
    for k in range(40):
        t = tokens(rnd.choice(items)[1])
        a = rnd.randint(0, max(0, len(t) - 3))
        rows.append((100 + k, f"{prose(rnd, rnd.randint(0, 90))} {' - '.join(t[a: a + rnd.randint(8, 30)]).upper()}, {prose(rnd, rnd.randint(0, 60))}"))
    rows += [(200, "a " * 9), (201, "the " * 50), (202, "Short, ITEM"), (203, "short"), (204, "item short item")]
    return rows, items


def test_against_brute_force(spark):
    rows, items = cases(fresh())
    got = D.digest(documents(spark, repeated(rows)), bench(spark, items))
    assert sorted(map(tuple, got.collect()), key=str) == brute(repeated(rows), items)


@pytest.mark.parametrize("limit", [60, 600])
def test_test_sets_in_blocks(spark, monkeypatch, limit):
    monkeypatch.setattr(D, "ITEM_BLOCK_BYTES", limit)
    rows, items = cases(fresh(9))
    got = D.digest(documents(spark, rows), bench(spark, items))
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, items)


def test_spans_and_proximity(spark):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    rows = [(1, f"x y {item} z"), (2, "one two three four oops five six seven eight nine ten eleven twelve thirteen fourteen"),
            (3, "thirteen five nine x x x x x one x x x x x x seven x x x x two"), (4, f"{item} {item}")]
    index = D.build_index(documents(spark, rows), scratch_path(spark, "t9"))
    got = {r.doc_id: r for r in D.search(index, bench(spark, [(7, item)])).collect()}
    assert [tuple(s) for s in got[1].spans] == [(2, 16)] and got[1]["items"] == ["7"]
    assert not got[2].spans and not got[2]["items"] and got[2].near_items == ["7"]
    assert not got[3].near_items
    assert [tuple(s) for s in got[4].spans] == [(0, 28)]


def test_empty_tables_and_clean_rows(spark):
    rows, items = cases(fresh(2))
    docs = documents(spark, repeated(rows))
    assert D.digest(documents(spark, []), bench(spark, items)).count() == 0
    assert D.digest(docs, bench(spark, [])).where("n_hit > 0 or n_items > 0 or contaminated").isEmpty()
    out = D.clean(docs, bench(spark, items))
    assert out.columns == docs.columns and len(SCHEMA.split(",")) == len(out.columns)
    bad = [r[0] for r in brute(repeated(rows), items) if r[5]]
    assert out.count() == docs.count() - len(bad)
    assert bad and not {r.doc_id for r in out.collect()} & set(bad)


def test_clean_keeps_columns_of_any_name(spark):
    phrase = " ".join(f"w{i}" for i in range(13))
    docs = spark.createDataFrame([(1, phrase, "x", "k"), (2, "a clean text", "y", "l")], "doc_id long, text string, row string, __row string")
    items = spark.createDataFrame([("i", phrase)], "item_id string, text string")
    out = D.clean(docs, items)
    assert out.columns == docs.columns and [tuple(r) for r in out.collect()] == [(2, "a clean text", "y", "l")]
