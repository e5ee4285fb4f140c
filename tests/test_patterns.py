"""Glob dialects and pattern normalisation against Python's own rules."""
import fnmatch
from pathlib import PurePosixPath

import pytest
from pyspark.sql import functions as F

from intake_spark.functions.patterns import (fnmatch_regex, normalize_patterns,
                                             path_glob_regex)

NAMES = ["a.raw", "A.RAW", "x_std.raw", ".hidden_std.raw", "_under_std.raw", "sub/x_std.raw",
         "sub/deep/y.raw", "run[1].raw", "weird\nname.raw", "x.d", "X.D", "y.raw", "a", "ab", "b.raw",
         "sub/.hidden.raw", "e/x5.raw", "f/x5.raw", "1.raw", "en/12.raw", "en/1/2.raw", "a[b"]
PATTERNS = ["*", "?", "[!a]*", "a[b", "run[1].raw", "*std.raw", "sub/*.raw", "*.raw", "?.raw",
            "[a-c]*", "*[05].raw", "[!e]*/*[05].raw", "**/*.raw", "sub/**", "*/1?.raw", "a*b", "*.[dD]",
            "[]]*", "x_std.raw"]


def _spark_match(spark, pairs, rx_fn):
    rows = [(p, n, rx_fn(p)) for p, n in pairs]
    df = spark.createDataFrame(rows, "p string, n string, rx string")
    return {(r.p, r.n): r.m for r in df.select("p", "n", F.expr("n RLIKE rx").alias("m")).collect()}


def test_fnmatch_dialect_equals_python(spark):
    pairs = [(p, n) for p in PATTERNS for n in NAMES]
    got = _spark_match(spark, pairs, fnmatch_regex)
    for p, n in pairs:
        assert got[(p, n)] == fnmatch.fnmatchcase(n, p), (p, n)


@pytest.mark.parametrize("recursive", [False, True])
def test_path_glob_dialect_equals_pathlib(spark, recursive):
    pairs = [(p, n) for p in PATTERNS for n in NAMES if "\n" not in n]
    got = _spark_match(spark, pairs, lambda p: path_glob_regex(p, recursive))
    for p, n in pairs:
        want = PurePosixPath(n).full_match(("**/" + p) if recursive else p)
        assert got[(p, n)] == want, (p, n, recursive)


# pattern string -> normalised patterns
EDGE = {"*std.raw": ["*std.raw", "*std.d"], "*std.raw,*.d": ["*std.raw", "*std.d", "*.d"],
        "a.raw|a.raw; ,b.RAW": ["a.raw", "a.d", "b.RAW"], "": [], "x.d,x.raw": ["x.d", "x.raw"],
        "  *.raw  ": ["*.raw", "*.d"], "a;b;a": ["a", "b"], "q.raw,q.d": ["q.raw", "q.d"]}


def test_normalize_patterns(spark):
    df = spark.createDataFrame([(s,) for s in EDGE], "s string")
    assert {r.s: list(r.l) for r in df.select("s", normalize_patterns(F.col("s")).alias("l")).collect()} == EDGE


def test_odd_bracket_expressions(spark):
    pairs = [(p, n) for p in ("[z-a]*", "[!z-a]x", "[a-]", "[]-]", "x[b-ac]", "[--/]q", "[[]", "[^a]", "[a&&b]", "[a")
             for n in ("", "a", "ax", "x", "xc", "xb", "-", "]", "z", ".q", "[", "^", "&", "b", "[a")]
    got = _spark_match(spark, pairs, fnmatch_regex)
    bad = [(p, n) for p, n in pairs if got[(p, n)] != fnmatch.fnmatchcase(n, p)]
    assert not bad


def test_ignore_literals_route_to_the_right_column(spark):
    from intake_spark.operators.inventory import ignore_filter
    entries = spark.createDataFrame([
        ("w", "top.raw", "top.raw", "/r/top.raw"), ("w", "d/x.raw", "x.raw", "/r/d/x.raw"),
        ("w", "d/y.raw", "y.raw", "/r/d/y.raw"), ("w", "e/z.raw", "z.raw", "/r/e/z.raw"),
        ("w", "keep.raw", "keep.raw", "/r/keep.raw")], "watch string, rel string, name string, abs string")
    pats = spark.createDataFrame([("top.raw",), ("x.raw",), ("d/y.raw",), ("/r/e/z.raw",), ("d/keep.raw",)],
                                 "pattern string")
    left = sorted(r.rel for r in ignore_filter(entries, pats).collect())
    # brute force: fnmatch on a literal is equality with rel, name or abs
    want = sorted(rel for _, rel, name, abs_ in entries.collect()
                  if not any(p in (rel, name, abs_) for (p,) in pats.collect()))
    assert left == want == ["keep.raw"]


def _random_cases(seed, n=400):
    import random
    rnd = random.Random(seed)
    pat_atoms = ["a", "b", ".", "/", "*", "?", "[ab]", "[!a]", "[a-c]", "[", "]", "-", "x", "**"]
    name_atoms = ["a", "b", "c", ".", "/", "x", "-", "[", "]"]
    fill = {"*": lambda: "".join(rnd.choice(name_atoms) for _ in range(rnd.randint(0, 3))),
            "**": lambda: "".join(rnd.choice(name_atoms) for _ in range(rnd.randint(0, 4))),
            "?": lambda: rnd.choice(name_atoms), "[ab]": lambda: rnd.choice("ab"),
            "[!a]": lambda: rnd.choice("bcx."), "[a-c]": lambda: rnd.choice("abc")}
    cases = []
    for i in range(n):
        atoms = [rnd.choice(pat_atoms) for _ in range(rnd.randint(1, 5))]
        p = "".join(atoms)
        if i % 2:  # a name built from the pattern itself, so matches are common
            s = "".join(fill[a]() if a in fill else a for a in atoms)
        else:
            s = "".join(rnd.choice(name_atoms) for _ in range(rnd.randint(0, 6)))
        cases.append((p, s))
    return cases


def test_fnmatch_dialect_random_equals_python(spark):
    pairs = _random_cases(11)
    got = _spark_match(spark, pairs, fnmatch_regex)
    bad = [(p, n) for p, n in pairs if got[(p, n)] != fnmatch.fnmatchcase(n, p)]
    assert not bad, bad[:10]


def test_path_glob_dialect_random_equals_pathlib(spark):
    # pathlib rejects empty segments and ".." handling differs by design; keep well-formed paths
    pairs = [(p, n) for p, n in _random_cases(12)
             if n and "//" not in n and not n.startswith("/") and not n.endswith("/")
             and "//" not in p and not p.startswith("/") and not p.endswith("/")
             and ".." not in n.split("/") and "." not in n.split("/")
             and ".." not in p.split("/") and "." not in p.split("/")]
    got = _spark_match(spark, pairs, lambda p: path_glob_regex(p, False))
    bad = [(p, n) for p, n in pairs if got[(p, n)] != PurePosixPath(n).full_match(p)]
    assert not bad, bad[:10]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_include_path_for_any_number_of_watches(spark):
    from intake_spark.operators.inventory import include_filter
    rows = [(w, n, n, "/r/" + n, False) for w in ("w0", "w7", "blank", "unlisted") for n in ("a.raw", "b.tdf", "c.x")]
    entries = spark.createDataFrame(rows, "watch string, rel string, name string, abs string, is_dir boolean")
    for n in (1, 300, 5000):
        config = {f"w{i}": "*.tdf, c.?" if i == 0 else "nothing*, *.x" for i in range(n)} | {"blank": " "}
        for c in (config, spark.createDataFrame(list(config.items()), "watch string, pattern string")):
            df = include_filter(entries, c, "*.raw", True)
            want = {("w0", "b.tdf"), ("w0", "c.x"), ("blank", "a.raw"), ("unlisted", "a.raw")}
            want.add(("w7", "c.x") if n > 7 else ("w7", "a.raw"))
            assert {(r.watch, r.rel) for r in df.collect()} == want
            assert "NestedLoop" not in _plan(df) and "Cartesian" not in _plan(df)


def test_one_ignore_path_for_any_number_of_lines(spark):
    from intake_spark.operators.inventory import ignore_filter
    rows = [("w", r, r.split("/")[-1], "/r/" + r) for r in ["a/x1.raw", "a/y2.raw", "b/z3.d", "q.tmp", "keep.raw", "x[1].raw", "x1.raw"]]
    entries = spark.createDataFrame(rows, "watch string, rel string, name string, abs string")
    ledger = spark.createDataFrame([("x[1].raw",), ("*keep*",), ("[a-z]*",)], "pattern string")
    for n in (1, 300, 5000):
        globs = [f"zz{i}*" for i in range(n)] + ["*.tmp", "a/x?.raw", "/r/b/*", "[z-a]*"]
        df = ignore_filter(entries, spark.createDataFrame([(g,) for g in globs], "pattern string"), ledger)
        want = sorted(rel for _, rel, name, abs_ in rows if rel != "x[1].raw"
                      and not any(fnmatch.fnmatchcase(c, g) for g in globs for c in (rel, name, abs_)))
        assert sorted(r.rel for r in df.collect()) == want == ["a/y2.raw", "keep.raw", "x1.raw"]
        assert "NestedLoop" not in _plan(df)


def test_unreadable_ignore_list_raises(spark, tmp_path):
    import pytest
    from intake_spark.operators.inventory import read_ignore_list
    assert read_ignore_list(spark, str(tmp_path / "none.txt")).count() == 0
    with pytest.raises(Exception):
        read_ignore_list(spark, "nosuchscheme://x/y").count()


def test_automaton_equals_one_pattern_at_a_time():
    from intake_spark.functions.globset import GlobSet, required_literal
    cases = _random_cases(21, 600)
    globs = sorted({p for p, _ in cases})
    names = sorted({n for _, n in cases})
    found = GlobSet([(None, g) for g in globs])
    for n in names:
        assert found.match(n) == any(fnmatch.fnmatchcase(n, g) for g in globs)
    for g in globs:
        one, literal = GlobSet([(None, g)]), required_literal(g, False)
        for n in names:
            hit = fnmatch.fnmatchcase(n, g)
            assert one.match(n) == hit and (not hit or literal in n)


def test_path_automaton_equals_pathlib():
    from intake_spark.functions.globset import GlobSet, required_literal

    def fine(x):
        parts = x.split("/")
        return x and "//" not in x and not x.startswith("/") and not x.endswith("/") and ".." not in parts and "." not in parts
    pairs = [(p, n) for p, n in _random_cases(22, 900) if fine(p) and fine(n)]
    for g, n in pairs:
        hit = PurePosixPath(n).full_match(g)
        assert GlobSet([(None, g)], True).match(n) == hit, (g, n)
        assert not hit or required_literal(g, True) in n
        deep = PurePosixPath(n).full_match(g) or PurePosixPath(n).full_match("**/" + g)
        assert GlobSet([(None, g)], True, True).match(n) == deep, (g, n)


def test_owners_have_their_own_globs():
    from intake_spark.functions.globset import GlobSet
    found = GlobSet([("a", "*.raw"), ("b", "*.tdf"), (None, "?"), ("a", "[xy]*")])
    assert found.match("f.raw", "a") and not found.match("f.raw", "b") and not found.match("f.raw")
    assert found.match("x", None) and found.match("y1", "a") and not found.match("y1", "b")


def test_many_lines_and_watches_cost_little_more_than_ten(spark):
    import time
    from intake_spark.operators import inventory as I
    entries = spark.range(60_000).selectExpr("concat('w', id % 6000) as watch", "concat('run', id % 97, '/sample_', id, '.raw') as rel",
                                             "concat('sample_', id, '.raw') as name", "concat('/in/run', id % 97, '/sample_', id, '.raw') as abs",
                                             "false as is_dir").cache()
    entries.count()

    def took(make):
        make().count()  # compiled, workers started
        best = 1e9
        for _ in range(2):
            t = time.perf_counter()
            make().write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - t)
        return best

    def lines(n):
        pats = spark.createDataFrame([(f"*sample_{i}7?.raw",) for i in range(n)] + [("*.tmp",)], "pattern string").cache()
        return took(lambda: I.in_globs(entries, [(None, r.pattern) for r in pats.collect()], ["name", "rel", "abs"], None, False, False, False))

    def watches(n):
        config = {f"w{i}": f"*_{i}*.raw, other{i}*" for i in range(n)}
        return took(lambda: I.include_filter(entries, config, "*.d", True))

    few = I.FEW
    try:
        I.FEW = 0  # the same path for both
        assert lines(10_000) < 3 * lines(10) + 0.5
        assert watches(5_000) < 3 * watches(10) + 0.5
    finally:
        I.FEW = few
