"""Operator 3: model against a plain Kneser-Ney, held-out accuracy, rejection."""
import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from conftest import SF
from llm_data import awkward, documents, fresh, repeated
from pyspark.sql import functions as F

from intake_spark.llm import langid
from intake_spark.llm.queries import op3_langid
from intake_spark.llm.textbytes import blocks


def padded(text):
    t = langid.fold_table()
    codes, out = [int(t[ord(c)]) for c in text], []
    for c in codes:
        if c != langid.BLANK or (out and out[-1] != langid.BLANK):
            out.append(c)
    return [langid.BLANK] * 3 + out


def plain_model(texts):
    """Interpolated Kneser-Ney of order 4 by dictionaries."""
    grams = {4: Counter(tuple(p[i: i + 4]) for p in map(padded, texts) for i in range(len(p) - 3))}
    for k in (3, 2, 1):
        grams[k] = Counter(g[1:] for g in grams[k + 1])
    d, total, kinds = {}, {}, {}
    for k, g in grams.items():
        one, two = sum(n == 1 for n in g.values()), sum(n == 2 for n in g.values())
        d[k] = one / (one + 2 * two) if one and two else .5
        total[k], kinds[k] = defaultdict(int), defaultdict(int)
        for key, n in g.items():
            total[k][key[:-1]] += n
            kinds[k][key[:-1]] += 1
    return grams, d, total, kinds


def plain_prob(model, key, alphabet):
    grams, d, total, kinds = model
    p = 1 / alphabet
    for k in range(1, 5):
        g = key[4 - k:]
        n = total[k].get(g[:-1], 0)
        if n:
            p = max(grams[k][g] - d[k], 0) / n + d[k] * kinds[k][g[:-1]] / n * p
    return p


def test_probabilities_equal_a_plain_model():
    texts = {"x": ["abra cadabra", "a bra ca da bra!"], "y": ["öl und öde", "mäd chen öl"]}
    counts = {}
    for lang, ts in texts.items():
        got = [g for *_, d, o in blocks(pa.array(ts)) for g in [langid.grams(d, o)[0]]]
        counts[lang] = np.unique(np.concatenate(got), return_counts=True)
    model = langid.build_model(counts, 4)
    plain = {k: plain_model(v) for k, v in texts.items()}
    alphabet = len({c for ts in texts.values() for t in ts for c in padded(t)[3:]}) + 1
    probe = ["abra öl", "quatsch", "cad und", "123", "ö"]
    for *_, d, o in blocks(pa.array(probe)):
        g, off, letters = langid.grams(d, o)
        logs = model.log_probs(g)
        assert letters.tolist() == [6, 7, 6, 0, 1]
        at = 0
        for t in probe:
            p = padded(t)
            for i in range(len(p) - 3):
                for j, lang in enumerate(model.langs):
                    assert math.isclose(logs[at][j], math.log(plain_prob(plain[lang], tuple(p[i: i + 4]), alphabet)), rel_tol=1e-4)
                at += 1


def test_held_out_accuracy(spark):
    got = op3_langid(spark, SF["0.01"])
    docs = spark.read.parquet(SF["0.01"] + "/documents.parquet").select("doc_id", "lang")
    held = got.where("held_out").join(docs, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert held[1] > 200 and held[0] > 0.98
    assert got.where("score < 0 or score > 1 or lang_pred is null").isEmpty()


def test_awkward_rows(spark):
    rows = repeated(awkward(fresh()))
    got = langid.predict(documents(spark, rows))
    out = {(r.doc_id, r.lang_pred) for r in got.collect()}
    assert got.count() == len(rows)
    assert {(3, "und"), (4, "und"), (5, "und"), (7, "und")} <= out
    assert langid.predict(documents(spark, [])).count() == 0
    no_labels = documents(spark, rows).withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.predict(no_labels).collect()} == {"und"}
    assert langid.keep_known(no_labels).count() == 0


def test_unknown_texts_go_and_known_stay(spark):
    docs = spark.read.parquet(SF["0.01"] + "/documents.parquet")
    strange = spark.createDataFrame([(10_000_000 + i, t, None, None, len(t or "")) for i, t in enumerate(
        ["Съешь же ещё этих мягких французских булок да выпей чаю", "日本語の文章はここにあります。とても長いです。",
         "xqzvk jjwqx zzkvq wqxkz qqqzx vkkjx zwqqx jvxkq zzxqv kkqjz", "0123 4567", "", None])], docs.schema)
    both = docs.union(strange)
    kept = langid.keep_known(both)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.where("doc_id >= 10000000").collect()} == set()
    lost = docs.join(kept, "doc_id", "left_anti").where(F.col("text").rlike("[A-Za-z]")).count()
    assert lost <= docs.count() // 200


def test_the_order_stays_at_any_size_and_parts_give_the_plain_model(spark, monkeypatch):
    monkeypatch.setattr(langid, "MAX_GRAMS", 10, raising=False)  # an earlier bound on the corpus's n-grams
    texts = {"x": ["abra cadabra", "a bra ca da bra!"], "y": ["öl und öde", "mäd chen öl"], "z": ["日本語の文章", "文章の日本"]}
    rows = spark.createDataFrame([(t, k) for k, ts in texts.items() for t in ts], "text string, lang string")
    model = langid.train(rows)
    plain = {k: plain_model(v) for k, v in texts.items()}
    alphabet = len({c for ts in texts.values() for t in ts for c in padded(t)[3:]}) + 1
    probe = ["abra öl", "quatsch", "cad und", "123", "日本の章"]
    want = [[math.log(plain_prob(plain[k], tuple(padded(t)[i: i + 4]), alphabet)) for k in model.langs]
            for t in probe for i in range(len(padded(t)) - 3)]
    for *_, d, o in blocks(pa.array(probe)):
        g = langid.grams(d, o)[0]
        assert np.allclose(model.log_probs(g), want, rtol=1e-4)
        small = langid.train(rows, part_rows=5)
        assert len(small.index[4][1]) > 3
        monkeypatch.setattr(langid, "CACHE_BYTES", 200)
        assert np.array_equal(model.log_probs(g), small.log_probs(g))


def test_marks_stay_with_their_letters():
    text = "हिन्दी में लिखा ภาษาไทย éa ☀️ ́x 123"
    for *_, d, o in blocks(pa.array([text, "́a"])):
        cps, coff = langid.code_points(d, o)
        code, letter = langid.coded(cps, coff)
    words = "".join(" " if c == langid.BLANK else chr(c) for c in code[: coff[1]]).split()
    assert words == ["हिन्दी", "में", "लिखा", "ภาษาไทย", "éa", "x"]
    assert code[coff[1]] == langid.BLANK and letter[coff[1] + 1]  # a mark in front of a text follows no letter


def test_sums_in_portions_equal_the_whole(spark, monkeypatch):
    rows = spark.createDataFrame([("abra cadabra und", "x"), ("öl und öde mäd chen", "y")] * 30, "text string, lang string")
    model = langid.train(rows)
    texts = ["abra öl", "", "quatsch " * 300, None, "123", "ö"]
    for *_, d, o in blocks(pa.array(texts)):
        g, goff, _ = langid.grams(d, o)
        logs = model.log_probs(g).astype(float)
        want = [logs[a:b].sum(axis=0) for a, b in zip(goff, goff[1:])]
        for cells in (1 << 19, 2100):
            monkeypatch.setattr(langid, "SCORE_CELLS", cells)
            assert np.allclose(model.text_sums(g, goff), want)


def test_all_labelled_rows_are_counted_and_all_calibrate(spark):
    texts = {k: [f"{w} {a}{b}" for a in "abcdefghij" for b in "klmnopqrst"] for k, w in (("x", "abra cadabra"), ("y", "öl und mädchen"))}
    rows = spark.createDataFrame([(t, k) for k, ts in texts.items() for t in ts], "text string, lang string")
    scored, score = [], langid.score_rows
    try:
        langid.score_rows = lambda r, *a: scored.append([x.text for x in r.collect()]) or score(r, *a)
        model = langid.train(rows)
    finally:
        langid.score_rows = score
    assert sorted(t for s in scored for t in s) == sorted(t for ts in texts.values() for t in ts)
    plain = {k: plain_model(v) for k, v in texts.items()}
    alphabet = len({c for ts in texts.values() for t in ts for c in padded(t)[3:]}) + 1
    probe = texts["x"][:50] + texts["y"][:50]
    want = [[math.log(plain_prob(plain[k], tuple(padded(t)[i: i + 4]), alphabet)) for k in model.langs]
            for t in probe for i in range(len(padded(t)) - 3)]
    for *_, d, o in blocks(pa.array(probe)):
        assert np.allclose(model.log_probs(langid.grams(d, o)[0]), want, rtol=1e-4)
    assert (model.limit < -model.floor).all()  # both languages calibrated


def test_one_text_alone_teaches_its_language(spark):
    docs = documents(spark, [(1, "abra cadabra abra")] * 3).withColumn("lang", F.lit("x"))
    assert langid.keep_known(docs).count() == 3


def test_calibration_rows_are_not_counted(spark):
    rows = spark.createDataFrame([(f"word{i} " + "abcdefg"[i % 7] * 5, "x") for i in range(400)], "text string, lang string")
    seen = []
    count, calibrate = langid.count_grams, langid.calibrate
    try:
        langid.count_grams = lambda r, *a: seen.append({x.text for x in r.collect()}) or count(r, *a)
        langid.calibrate = lambda m, r, *a: seen.append({x.text for x in r.collect()}) or calibrate(m, r, *a)
        langid.train(rows)
    finally:
        langid.count_grams, langid.calibrate = count, calibrate
    assert seen[0] and seen[1] and not seen[0] & seen[1] and len(seen[0] | seen[1]) == 400
