"""Scalar functions F2-F10 against plain-Python statements of the same rules."""
import hashlib
import json
import re
from pathlib import PurePosixPath

from pyspark.sql import functions as F

from intake_spark.functions import jsonfmt
from intake_spark.functions import paths as P

NAMES = ["a.b.raw", ".raw", "x.d", "analysis", "a.", "..raw", "a..b", "/x/y/z.raw", "dir/", "", "r u n.RAW"]


def _py_slug(s):
    return re.sub(r"[^A-Za-z0-9._-]+", "_", str(s).strip()) or "x"


def test_row_key_equals_sha1_and_documented_collision(spark):
    rows = [("a1", 2), ("a", 12), ("/p/q.raw", 123456789)]
    got = {(r.n, r.s): r.k for r in spark.createDataFrame(rows, "n string, s long")
           .select("n", "s", P.row_key(F.col("n"), F.col("s")).alias("k")).collect()}
    for n, s in rows:
        assert got[(n, s)] == hashlib.sha1((n + str(s)).encode()).hexdigest()
    assert got[("a1", 2)] == got[("a", 12)]


def test_stem_basename_slug(spark):
    df = spark.createDataFrame([(n,) for n in NAMES], "n string")
    out = df.select("n", P.stem(F.col("n")).alias("stem"), P.basename(F.col("n")).alias("base"),
                    P.slug(F.col("n")).alias("slug")).collect()
    for r in out:
        if r.n and "/" not in r.n:
            assert r.stem == PurePosixPath(r.n).stem, r.n
        if r.n:
            assert r.base == PurePosixPath(r.n).name, r.n
        assert r.slug == _py_slug(r.n), r.n


def test_resolve_and_target_name(spark):
    df = spark.createDataFrame([("a.raw", "/in/", "S1_std.raw", 7), ("/abs/b.d", "/in", None, 8),
                                ("c", "/in", "", 9)], "n string, f string, src string, job long")
    got = [(r.abs, r.t) for r in df.select(P.resolve(F.col("n"), F.col("f")).alias("abs"),
                                           P.target_name(F.col("src"), F.col("job")).alias("t")).collect()]
    assert got == [("/in/a.raw", "S1_std.hdf5"), ("/abs/b.d", "8.hdf5"), ("/in/c", "9.hdf5")]


def test_spec_placeholders_escape_and_exact_leaf(spark):
    tmpl = ('{"main_input_folder": "%%%INPUT%%%", "keep": "x %%%FASTA%%% y", '
            '"list": ["%%%FASTA%%%%", 1], "%%%FASTA%%%": "key stays", "nested": {"f": "%%%FASTA%%%"}}')
    df = spark.createDataFrame([(tmpl, 'C:\\in "q"', "/ref/a.fasta"), (tmpl, "/i", None),
                                ("not json %%%FASTA%%%", "/i", "/ref/a.fasta")], "t string, i string, f string")
    df = df.withColumn("spec", jsonfmt.fill_io(F.col("t"), F.col("i"), F.col("i")))
    df = jsonfmt.fill_reference(df, "spec", F.col("f"), jsonfmt.FASTA_PHS, "main_fasta_file")
    r0, r1, r2 = [r.spec for r in df.collect()]
    d0 = json.loads(r0)
    assert d0["main_input_folder"] == 'C:\\in "q"'          # F6 values are JSON-escaped
    assert d0["keep"] == "x %%%FASTA%%% y"                  # not an exact leaf
    assert d0["list"][0] == "/ref/a.fasta" and d0["nested"]["f"] == "/ref/a.fasta"
    assert d0["%%%FASTA%%%"] == "key stays"                 # keys are never replaced
    assert d0["main_fasta_file"] == "/ref/a.fasta"          # top-level field set
    assert "main_fasta_file" not in json.loads(r1)         # no reference file: unchanged
    assert r2 == "not json %%%FASTA%%%"                    # not JSON: unchanged


def test_metadata_keeps_null_fields(spark):
    df = spark.createDataFrame([("h", None)], "hash string, f string")
    meta = F.struct("hash", F.struct(F.col("f").alias("file")).alias("fasta"),
                    F.lit(None).cast("struct<input_root:string>").alias("watch"))
    js = json.loads(df.select(jsonfmt.metadata_json(meta).alias("j")).first().j)
    assert js == {"hash": "h", "fasta": {"file": None}, "watch": None}


def test_time_text_is_zone_free(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = spark.sql("SELECT timestamp_ntz'1998-04-05 02:00:00.75' AS t")  # inside a DST gap in that zone
        r = df.select(P.iso_seconds(F.col("t")).alias("iso"), P.compact_ts(F.col("t")).alias("c")).first()
        assert (r.iso, r.c) == ("1998-04-05T02:00:00", "19980405-020000")
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_seconds_between_is_zone_free(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = spark.sql("SELECT timestamp_ntz'1998-04-05 01:00:00' AS a, timestamp_ntz'1998-04-05 02:00:00' AS b, "
                       "timestamp_ntz'1998-04-07 00:30:05' AS c")
        r = df.select(P.seconds_between(F.col("a"), F.col("b")).alias("ab"),
                      P.seconds_between(F.col("a"), F.col("c")).alias("ac")).first()
        assert (r.ab, r.ac) == (3600, 2 * 86400 - 1800 + 5)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_spec_values_with_control_characters_and_placeholders(spark):
    values = ["a\x01b\x0bc", "%%%OUTPUT%%%", "é \u2028 \\ \"", "tab\tline\n", "", None]
    tmpl = '{"i": "%%%INPUT%%%", "o": "%%%OUTPUT%%%", "both": "%%%INPUT%%%/%%%OUTPUT%%%"}'
    df = spark.createDataFrame([(v, "%%%INPUT%%%") for v in values], "i string, o string")
    rows = df.select("i", jsonfmt.fill_io(F.lit(tmpl), F.col("i"), F.col("o")).alias("spec")).collect()
    for r in rows:
        assert r.spec is None if r.i is None else json.loads(r.spec) == {
            "i": r.i, "o": "%%%INPUT%%%", "both": f"{r.i}/%%%INPUT%%%"}


def plain_reference(spec, path, placeholders, field):
    """F7 by walking the parsed text."""
    if path is None:
        return spec
    try:
        doc = json.loads(spec)
    except ValueError:
        return spec
    if not isinstance(doc, dict):
        return spec
    doc[field] = path

    def walk(v):
        if isinstance(v, dict):
            return {k: walk(x) for k, x in v.items()}
        return [walk(x) for x in v] if isinstance(v, list) else path if isinstance(v, str) and v in placeholders else v
    return walk(doc)


def test_every_row_has_a_template_of_its_own(spark):
    import random
    rnd = random.Random(4)
    texts = ["%%%FASTA%%%", "%%%FASTA%%%%", "x %%%FASTA%%%", '"%%%FASTA%%%"', '\\', '\\"%%%FASTA%%%', "é", "", "a\nb", "%%%FASTA%%%%%", "}", ":"]

    def value(depth):
        k = rnd.randrange(8 if depth else 5)
        if k < 4:
            return rnd.choice(texts)
        if k == 4:
            return rnd.choice([1, 2.5, True, None, -7])
        if k == 5:
            return [value(depth - 1) for _ in range(rnd.randrange(4))]
        return {rnd.choice(texts) + str(i): value(depth - 1) for i in range(rnd.randrange(4))}

    specs = []
    for i in range(120):
        doc = {f"k{j}": value(3) for j in range(rnd.randrange(4))} | ({"main": value(1)} if i % 3 == 0 else {})
        specs.append(json.dumps(doc, ensure_ascii=bool(i % 2), indent=rnd.choice([None, 2])))
    specs += ['"%%%FASTA%%%"', '["%%%FASTA%%%"]', "no json", "{", "null", "", '{"a": "\\u0025%%FASTA%%%"}']
    paths = ["/ref/$1\\a \"b\".fasta", None, "/r", "%%%FASTA%%%"]
    df = spark.createDataFrame([(s, paths[i % 4]) for i, s in enumerate(specs)], "s string, p string")
    out = df.select("s", "p", jsonfmt.set_reference(F.col("s"), F.col("p"), jsonfmt.FASTA_PHS, "main").alias("o"))
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
    for r in out.collect():
        want = plain_reference(r.s, r.p, jsonfmt.FASTA_PHS, "main")
        assert (r.o == want) if isinstance(want, str) else json.loads(r.o) == want, (r.s, r.p, r.o)
