"""Mixing sources: targets, complete epochs, sampling by quality."""
import math
import re
from collections import Counter, defaultdict
from fractions import Fraction

from conftest import SF
from llm_data import awkward, documents, fresh, repeated

import __spark_entry__ as E
from intake_spark.llm import mixing
from tools.compare import digest


def plain_targets(sizes, weights=mixing.WEIGHTS, most=mixing.MAX_EPOCHS):
    """Targets by the rule as it is said: cut, and share the excess again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, target, done = Fraction(sum(sizes.values())), {}, set()
    while True:
        rest = [s for s in names if s not in done]
        if not rest:
            return target
        left = total - sum(target[s] for s in done)
        units = sum(weight[s] for s in rest)
        for s in rest:
            target[s] = left * weight[s] / units
        over = [s for s in rest if target[s] >= most * sizes[s]]
        if not over:
            return target
        for s in over:
            target[s] = Fraction(most * sizes[s])
            done.add(s)


def words(text):
    return len(re.findall(mixing.WORD, text or ""))


def rows_of(df):
    return sorted(df.collect(), key=str)


def check(rows, docs):
    sizes = defaultdict(int)
    for r in docs:
        sizes[r.source] += words(r.text)
    target = plain_targets(sizes)
    assert Counter((r.id, r.source, r.size) for r in rows) == Counter((r.doc_id, r.source, words(r.text)) for r in docs)
    by = defaultdict(list)
    for r in rows:
        by[r.source].append(r)
        assert r.taken == r.size * r.copies <= mixing.MAX_EPOCHS * r.size
        assert r.source_size == sizes[r.source]
        assert math.isclose(r.target, target[r.source], rel_tol=1e-12, abs_tol=1e-9)
    for s, own in by.items():
        epochs = math.floor(own[0].target / sizes[s]) if sizes[s] else 0
        assert {r.copies for r in own} <= {epochs, epochs + 1}
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(r.size for r in own) / 2 + 1e-6


def test_targets_with_limits_reached_in_turns(spark):
    sizes = {"a": 1, "b": 2, "c": 4, "d": 40, "e": 1000, "f": 3000, "g": 0, None: 10_000}
    rows = spark.createDataFrame([(s is None, s or "", n) for s, n in sizes.items()],
                                 "no_source boolean, source string, source_size long")
    got = {None if r.no_source else r.source: r.target for r in mixing.targets(rows).collect()}
    want = plain_targets(sizes)
    assert got.keys() == want.keys()
    assert all(math.isclose(got[s], want[s], rel_tol=1e-12) for s in sizes)
    assert math.isclose(sum(got.values()), sum(sizes.values()))
    assert got["a"] == 3 and got["g"] == 0


def test_awkward_rows_meet_the_targets_and_reruns_agree(spark):
    docs = documents(spark, repeated(awkward(fresh())))
    got = rows_of(mixing.mix(docs))
    check(got, docs.collect())
    assert got == rows_of(mixing.mix(docs.repartition(5)))
    assert mixing.mix(docs.limit(0)).count() == 0


def test_one_source_over_many_ranges_and_equal_rows(spark):
    same = [(7, "one two three", "hot")] * 400
    rows = same + [(i, "w " * (i % 9), "hot") for i in range(600)] + [(i, "word", "cold") for i in range(50)] + [(9, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs).collect()
    check(got, docs.collect())


def test_better_documents_come_first(spark):
    docs = spark.createDataFrame([(i, "a b c", "thin" if i < 4000 else "wide") for i in range(8000)],
                                 "doc_id long, text string, source string")
    quality = spark.createDataFrame([(i, [4.0, 0.0, None, float("nan")][i % 4]) for i in range(4000)], "id long, weight double")
    got = [r for r in mixing.mix(docs, quality, weights=(1, 5)).collect() if r.source == "thin"]
    share = {k: sum(r.copies for r in got if r.id % 4 == k) / 1000 for k in range(4)}
    assert share[0] > share[2] + 0.1 and share[1] == share[3] == 0  # a third of the source is taken
    assert abs(sum(r.copies for r in got) - 4000 / 3) <= 1


def test_the_mix_itself(spark):
    docs = documents(spark, awkward(fresh()))
    mixed = mixing.mix(docs, keep=docs.columns)
    copies = {r.id: r.copies for r in mixed.collect()}
    out = mixing.repeat_kept(mixed)
    assert out.columns == docs.columns
    assert Counter(r.doc_id for r in out.collect()) == {i: n for i, n in copies.items() if n}


def test_query_equals_its_sql(spark, duck):
    sf = SF["0.001"]
    got = E.queries()["op11_mixing"](spark, sf).toPandas()
    want = duck(sf).execute(E.oracle_sql()["op11_mixing"]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert digest(got) == digest(want)


def test_main_path_has_no_python(spark):
    plan = E.queries()["op11_mixing"](spark, SF["0.001"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
