"""Operator 1 against a brute-force version."""
import re

from conftest import SF
from llm_data import awkward, documents, fresh, prose, repeated

import __spark_entry__ as E

from intake_spark.llm import substring_dedup as S
from tools.compare import digest

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
CUT = re.compile(r"(?:(?<=[.!?])[ \t\n\r\x0b\x0c]|\n)[ \t\n\r\x0b\x0c]*|(?<=[。！？])")


def split(text):
    cuts = [0] + [m.end() for m in CUT.finditer(text)] + [len(text)]
    out = []
    for a, b in zip(cuts, cuts[1:]):
        found = list(WORD.finditer(text[a:b].translate(LOW)))
        w = tuple(m[0] for m in found)
        if w:
            places = {0}
            if len(w) > S.LONG_WORDS:
                head = [x.encode()[:8] for x in w]
                for i in range(len(w) - S.CUT_WINDOW + 1):
                    window = range(i, i + S.CUT_WINDOW)
                    least = min(head[j] for j in window)
                    places.add(max(j for j in window if head[j] == least))
            places = sorted(places)
            for x, y in zip(places, [*places[1:], len(w)]):
                out.append([a + found[x].start() if x else a, w[x:y]])
    if out:
        out[0][0] = 0
    return out


def brute(rows, n=S.MIN_SENTENCES, m=S.MIN_WORDS):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    seen, out = set(), []
    for d, t in order:
        s = split(t or "")
        runs = set()
        for i in range(len(s)):
            if len(s[i][1]) >= S.LONG_WORDS:
                runs.add((i, i + 1))
            size = 0
            for e in range(i, len(s)):
                size += len(s[e][1])
                if e - i + 1 >= n and size >= m:
                    runs.add((i, e + 1))
                    break
            size = 0
            for b in range(i, -1, -1):
                size += len(s[b][1])
                if i - b + 1 >= n and size >= m:
                    runs.add((b, i + 1))
                    break
        gone = set()
        for a, b in sorted(runs):
            key = tuple(x[1] for x in s[a:b])
            gone.update(range(a, b)) if key in seen else seen.add(key)
        text = t
        if s:
            ends = [x[0] for x in s[1:]] + [len(t)]
            text = "".join(t[x[0]:e] for i, (x, e) in enumerate(zip(s, ends)) if i not in gone)
        out.append((d, len(s), len(gone), text))
    return out


def key(r):
    return (r[0] is not None, r[0] or 0, r[3] is not None, r[3] or "", r[1], r[2])


def check(spark, rows):
    got = S.digest(documents(spark, rows))
    assert sorted(map(tuple, got.collect()), key=key) == sorted(brute(rows), key=key)


def test_awkward_rows(spark):
    rows = awkward(fresh())
    check(spark, rows)
    check(spark, repeated(rows))
    check(spark, [])


def test_shared_passages(spark):
    rnd = fresh(4)
    passages = [prose(rnd, 60) for _ in range(4)]
    rows = []
    for i in range(120):
        parts = [prose(rnd, rnd.randint(0, 40))]
        for p in rnd.sample(passages, rnd.randint(0, 3)):
            parts += [p, prose(rnd, rnd.randint(1, 30))]
        rows.append((i, rnd.choice([". ", ".\n"]).join(parts)))
    check(spark, rows)


def test_passages_of_fifty_words_go_and_clean_texts_stay(spark):
    rnd = fresh(6)
    passage = ". ".join(" ".join(f"p{i}{j}" for j in range(9)) for i in range(6)) + "."
    own = [". ".join(" ".join(f"d{k}x{i}{j}" for j in range(8)) for i in range(5)) + "." for k in range(6)]
    rows = [(k, f"{t} {passage} {t[::-1]}") for k, t in enumerate(own[:3])] + [(k + 3, t) for k, t in enumerate(own[3:])]
    out = {r.doc_id: r.text for r in S.digest(documents(spark, rows)).collect()}
    assert out[0] == rows[0][1]
    assert [out[k] for k in (3, 4, 5)] == own[3:]
    for k in (1, 2):
        assert not set(WORD.findall(passage)[9:-9]) & set(WORD.findall(out[k]))
        assert own[k] in out[k]


def test_other_columns_are_kept(spark):
    docs = documents(spark, awkward(fresh()))
    out = S.clean(docs)
    assert out.columns == docs.columns
    assert sorted(map(str, out.drop("text", "n_chars").collect())) == sorted(map(str, docs.drop("text", "n_chars").collect()))
    assert out.where("n_chars <> length(text)").isEmpty()


def test_clean_drops_repeats_of_one_sentence_and_inside_text_without_marks(spark):
    rnd = fresh(9)

    def unmarked(name, n, sep=" "):
        return sep.join(f"{name}{i}{rnd.choice('abcdefgh')}" for i in range(n))

    one, passage = unmarked("one", 120), unmarked("cell", 60, " | ")
    rows = [(0, one), (1, one.upper()), (2, f"{unmarked('x', 40, ' | ')} | {passage} | {unmarked('y', 30, ' | ')}"),
            (3, f"{unmarked('z', 70, ' | ')} | {passage} | {unmarked('w', 50, ' | ')}"), (4, unmarked("short", 11)),
            (5, unmarked("own", 90)), (6, one + ". " + unmarked("tail", 5))]
    rows.append((7, rows[4][1]))
    out = {r.doc_id: r.text for r in S.clean(documents(spark, rows)).collect()}
    assert all(out[i] == rows[i][1] for i in (0, 2, 4, 5, 7))
    assert out[1] == "" and "one" not in out[6] and "tail4" in out[6]
    left = set(WORD.findall(out[3]))
    gone = set(WORD.findall(rows[3][1])) - left
    assert gone <= set(WORD.findall(passage)) and len(gone) >= 30


def test_one_sentence_runs_equal_a_plain_count(spark):
    rnd = fresh(11)
    pool = [" ".join(prose(rnd, 1, ["ab", "cd", "ef", "gh"]) + str(i) for i in range(rnd.randint(25, 60))) for _ in range(12)]
    rows = [(i, rnd.choice(pool)) for i in range(60)]
    seen, want = set(), {}
    for i, t in rows:
        want[i] = "" if t in seen else t
        seen.add(t)
    assert {r.doc_id: r.text for r in S.clean(documents(spark, rows)).collect()} == want


def test_query_equals_its_sql(spark, duck):
    sf = SF["0.001"]
    got = E.queries()["op1_substring_dedup"](spark, sf).toPandas()
    want = duck(sf).execute(E.oracle_sql()["op1_substring_dedup"]).df()
    assert digest(got) == digest(want)


def test_long_sentences_equal_a_plain_count(spark):
    rnd = fresh(12)
    pool = [" | ".join(prose(rnd, 1, ["Ab", "cd", "éf", "abcdefghij"]).strip(".!?\n") + str(rnd.randrange(30)) for _ in range(70)) for _ in range(5)]
    rows = []
    for i in range(60):
        w = rnd.choice(pool).split(" | ")
        a = rnd.randrange(20)
        rows.append((i, rnd.choice([" ", " | ", ", "]).join(w[a: a + rnd.randrange(20, 60)])))
    check(spark, rows)
