"""Collocations against a plain count of all phrases."""
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SF
from llm_data import awkward, documents, fresh, prose, repeated

import __spark_entry__ as E
from intake_spark.llm import collocations as C
from tools.compare import digest

UPPER = {i: i + 32 for i in range(65, 91)}


def plain(rows, min_count=10, top=2000):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f[lang].update(tuple(w[i: i + m]) for m in (1, 2, 3) for i in range(len(w) - m + 1))
    out = []
    for lang, count in f.items():
        found = {p: a for p, a in count.items() if len(p) > 1 and a >= min_count}
        longer = Counter()
        for p, a in found.items():
            if len(p) == 3:
                for q in (p[:2], p[1:]):
                    longer[q] = max(longer[q], a)
        rows = []
        for p, a in found.items():
            if len(p) == 2 and longer[p] and 100 * longer[p] >= 50 * a:
                continue
            score, _, l, r = min((1000000 * a * a // (count[p[:k]] * count[p[k:]]), k, count[p[:k]], count[p[k:]])
                                 for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (s, a, phrase, l, r) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def result(df):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


def texts(docs):
    return [(r.text, r.lang) for r in docs.collect()]


@pytest.mark.parametrize("trigger", [1, 3, 12, 10**9])
def test_any_chunk_length_gives_the_same_counts(spark, monkeypatch, trigger):
    monkeypatch.setattr(C, "TRIGGER", trigger)
    monkeypatch.setattr(C, "HELD_WINDOWS", 500)
    rnd = fresh()
    few = ["on", "The", "tree", "a", "house", "é", "x y", "b\tb", "—", "Ünder"]
    rows = repeated(awkward(rnd)) + [(100 + i, prose(rnd, 60, few)) for i in range(25)] + [(200, "same same same " * 40)]
    docs = documents(spark, rows)
    assert result(C.mine(docs, min_count=3)) == plain(texts(docs), 3)
    if trigger == 12:
        assert result(C.mine(docs, min_count=2, top=7)) == plain(texts(docs), 2, 7)
        assert result(C.mine(docs.limit(0))) == []


def test_copies_fall_into_the_same_chunks(spark):
    rnd = fresh()
    passage = prose(rnd, 200)
    one = spark.createDataFrame([(passage, "en")], "text string, lang string")
    many = spark.createDataFrame([(f"{prose(rnd, 3)} {passage}", "en") for _ in range(50)], "text string, lang string")
    alone = C.dictionary(one).count()
    assert C.dictionary(many).count() < 3 * alone + 50 * 4
    assert C.dictionary(many.repartition(9)).where("n >= 50").count() > 0.5 * alone


def test_numbers_that_clash_get_another_seed(spark, monkeypatch):
    docs = documents(spark, awkward(fresh()))
    want = plain(texts(docs), 3)
    count, seeds = C.count_words, []

    def clash(chunks, seed=0):
        seeds.append(seed)
        rows = count(chunks, seed)
        if seed < 2:
            rows = rows.withColumn("number", rows["number"].bitwiseAND(3))
        return rows

    monkeypatch.setattr(C, "count_words", clash)
    assert result(C.mine(docs, min_count=3)) == want
    assert seeds == [0, 1, 2]


def test_scores_pass_64_bits(spark):
    big = 900_000_000_000
    row = spark.createDataFrame([(big, big + 7, big * 3 + 1)], "a long, l long, r long")
    got = row.select(C._score(row.l, row.r).alias("s")).first().s
    assert got == 1000000 * big * big // ((big + 7) * (big * 3 + 1))


def test_words_and_pieces_of_a_block():
    text = "A b,c  d\te. f\r\ng ;"
    low = C.LOWER[np.frombuffer(text.encode(), np.uint8)]
    a, b, piece = C._words(low, np.array([0, len(low)]))
    assert [bytes(low[i:j]).decode() for i, j in zip(a, b)] == ["a", "b", "c", "d", "e", " f", "g"]
    assert piece.tolist() == [True, False, True, False, False, True, True]


def test_query_equals_its_sql(spark, duck):
    sf = SF["0.01"]
    got = E.queries()["op12_collocations"](spark, sf).toPandas()
    want = duck(sf).execute(E.oracle_sql()["op12_collocations"]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want) > 1000 and digest(got) == digest(want)
