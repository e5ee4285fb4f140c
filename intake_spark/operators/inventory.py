"""Inventory operators: include (J1/U2), ignore (J2/U1), entry kind (P3),
directory roll-up (A1) and last-wins listing (A6).

Patterns come from configuration: watch definitions and lines that people
wrote. No pattern is ever compiled for a row:

* few of them (``FEW`` expressions or watches, as in most deployments) become
  literal regex predicates, which stay in generated JVM code;
* many go into an automaton over the literals that their matches must contain
  (``functions.globset``), built once a worker; a name is scanned once, and only
  globs whose literal it has are tried. The list is sent to the workers in parts
  of at most ``GLOBS_A_SET``, so a part's size is bounded.

Both give the same results. The processed ledger grows by one name a file and is
matched literally: its names, and the literal lines, become equi anti-joins,
each literal routed to the one column (name, rel or abs) it can equal.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.globset import glob_set
from ..functions.patterns import (combined_regex, fnmatch_regex, is_glob, normalize_patterns,
                                  path_glob_regex, strip_ws)
from ..functions.paths import entry_kind_ok

FEW = 64              # expressions, watches or lines that become literal predicates
GLOBS_A_SET = 50_000  # globs in one automaton


# --------------------------------------------------------------------------- include

def watch_globs(config: DataFrame, default: str) -> tuple[dict[str, tuple[str, ...]], tuple[str, ...]]:
    """F1 over ``(watch, pattern)``: each watch's globs, and the default's. One
    row a watch, read by the driver as configuration is."""
    blank = F.coalesce(strip_ws(F.col("pattern")), F.lit("")) == ""
    own = config.filter(F.col("watch").isNotNull()).select(
        "watch", F.when(blank, F.lit(default)).otherwise(F.col("pattern")).alias("pattern"))
    fallback = config.sparkSession.range(1).select(F.lit(None).cast("string").alias("watch"), F.lit(default).alias("pattern"))
    globs: dict[str | None, dict[str, None]] = defaultdict(dict)
    for r in own.unionByName(fallback).select("watch", normalize_patterns(F.col("pattern")).alias("globs")).toLocalIterator():
        globs[r["watch"]].update(dict.fromkeys(r["globs"]))
    whole = {w: tuple(g) for w, g in globs.items()}
    return whole, whole.pop(None)


def in_globs(df: DataFrame, globs: list[tuple[str | None, str]], columns: list[str], owner: Column | None,
             path_rules: bool, recursive: bool, keep: bool) -> DataFrame:
    """The rows of which one of ``columns`` matches (``keep``) or none does."""
    shared = df.sparkSession.sparkContext.broadcast(tuple(globs))
    names = [f"_t{i}" for i in range(len(columns))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = glob_set(shared.value, path_rules, recursive)
        for batch in batches:
            owners = batch.column("_o").to_pylist()
            hit = [False] * batch.num_rows
            for n in names:
                for i, text in enumerate(batch.column(n).to_pylist()):
                    if text is not None and not hit[i]:
                        hit[i] = found.match(text, owners[i])
            yield pa.RecordBatch.from_arrays([batch.column("_row")], names=["_row"]).filter(pa.array([h == keep for h in hit]))

    asked = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"),
                      (F.lit(None).cast("string") if owner is None else owner).alias("_o"),
                      *[F.col(c).alias(n) for c, n in zip(columns, names)])
    kind = asked.schema["_row"].dataType.simpleString()
    return asked.mapInArrow(run, f"_row {kind}").select("_row.*")


def include_filter(entries: DataFrame, config: dict[str, str] | DataFrame, default: str,
                   recursive: bool = False) -> DataFrame:
    """J1 + U2 + P3: entries that match a pattern of their watch.

    ``config`` is a dict or a table ``(watch, pattern)``; a null or blank
    pattern, and a watch that isn't listed, mean the default. An entry that
    matches several patterns appears once.
    """
    spark = entries.sparkSession
    if isinstance(config, dict):
        config = spark.createDataFrame(list(config.items()), "watch string, pattern string")
    own, other = watch_globs(config, default)
    entries = entries.filter(entry_kind_ok(F.col("is_dir"), F.col("name")))
    if len(own) <= FEW:
        by_globs = defaultdict(list)
        for w, globs in own.items():
            by_globs[globs].append(w)
        keep = _any_glob(other, recursive) & ~F.coalesce(F.col("watch").isin(*own), F.lit(False)) if own else _any_glob(other, recursive)
        for globs, watches in by_globs.items():
            keep = keep | (F.col("watch").isin(*watches) & _any_glob(globs, recursive))
        return entries.filter(keep)
    # watches that aren't listed have the default's globs, under no owner
    listed = spark.createDataFrame([(w,) for w in own], "_w string")
    marked = entries.join(listed, F.col("watch") == F.col("_w"), "left")
    pairs = [(None, g) for g in other] + [(w, g) for w, globs in own.items() for g in globs]
    parts = [in_globs(marked, [p for p in pairs[i: i + GLOBS_A_SET]], ["rel"], F.col("_w"), True, recursive, True)
             for i in range(0, len(pairs), GLOBS_A_SET)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out = out.select(*entries.columns)
    return out if len(parts) == 1 else out.distinct()


def _any_glob(globs: tuple[str, ...], recursive: bool) -> Column:
    rx = combined_regex([path_glob_regex(g, recursive) for g in globs])
    return F.lit(False) if rx is None else F.col("rel").rlike(rx)


# --------------------------------------------------------------------------- ignore

def clean_ignore_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """Strip, drop blanks and comment lines (also indented ones), drop bad bytes."""
    v = strip_ws(F.regexp_replace(F.col(col), "�", ""))
    return (lines.select(v.alias("pattern"))
            .filter((F.col("pattern") != "") & ~F.col("pattern").startswith("#")))


def read_ignore_list(spark: SparkSession, path: str) -> DataFrame:
    """S2 over a text file; a missing file is an empty list, other errors raise."""
    try:
        lines = spark.read.text(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "pattern string")
    return clean_ignore_lines(lines)


def merge_ignore_lists(*lists: DataFrame) -> DataFrame:
    """Union of ignore lists, duplicates removed."""
    out = lists[0].select("pattern")
    for other in lists[1:]:
        out = out.unionByName(other.select("pattern"))
    return out.distinct()


def drop_literals(entries: DataFrame, literals: DataFrame) -> DataFrame:
    """Entries whose rel, name or abs equals none of ``literals(pattern)``.

    A literal can only equal one of the three columns: ``abs`` always starts
    with '/', ``rel`` of a nested entry contains '/', ``name`` never does (a
    top-level ``rel`` equals its ``name``). So each goes to one join: the large
    ledger of basenames meets ``name`` only.
    """
    lits = literals.select(F.col("pattern").alias("_lit")).distinct()
    slash = F.instr(F.col("_lit"), "/") > 0
    by_col = {"name": lits.filter(~slash),
              "abs": lits.filter(F.col("_lit").startswith("/")),
              "rel": lits.filter(slash & ~F.col("_lit").startswith("/"))}
    for c, lit_set in by_col.items():
        entries = entries.join(lit_set, F.col(c) == F.col("_lit"), "left_anti")
    return entries


def ignore_filter(entries: DataFrame, user: DataFrame, ledger: DataFrame | None = None) -> DataFrame:
    """Drop entries whose rel, name or abs matches any ignore line.

    ``user(pattern)``: lines that people wrote (configuration), wildcards and
    literals. ``ledger(pattern)``: processed names, always literal, never read
    by the driver.
    """
    pats = user.select("pattern").distinct()
    literal = pats.filter(~is_glob(F.col("pattern")))
    out = drop_literals(entries, literal if ledger is None else literal.unionByName(ledger.select("pattern")))
    globs = sorted(r.pattern for r in pats.filter(is_glob(F.col("pattern"))).toLocalIterator())
    if len(globs) <= FEW:
        rx = combined_regex([fnmatch_regex(p) for p in globs])
        return out if rx is None else out.filter(~(F.col("rel").rlike(rx) | F.col("name").rlike(rx) | F.col("abs").rlike(rx)))
    for i in range(0, len(globs), GLOBS_A_SET):
        out = in_globs(out, [(None, g) for g in globs[i: i + GLOBS_A_SET]], ["name", "rel", "abs"], None, False, False, False)
    return out


# --------------------------------------------------------------------------- roll-ups

def dir_root(path: Column) -> Column:
    """First path component when it is a ``.d`` directory (any case), else ''."""
    return F.regexp_extract(path, "^([^/]*\\.[dD])/", 1)


def dir_size_rollup(members: DataFrame, dirs: DataFrame | None = None) -> DataFrame:
    """A1: size of each ``.d`` directory = sum of every file below it.

    ``dirs(dir)`` lists directories that exist even when empty; they report 0.
    The sum is algebraic, so a huge directory is pre-aggregated map-side.
    """
    sums = (members.withColumn("dir", dir_root(F.col("path"))).filter(F.col("dir") != "")
            .groupBy("dir").agg(F.sum("size").cast("bigint").alias("size"),
                                F.count(F.lit(1)).alias("n_files")))
    if dirs is None:
        return sums
    return (dirs.select("dir").distinct().join(sums, "dir", "full_outer")
            .select("dir", F.coalesce("size", F.lit(0)).cast("bigint").alias("size"),
                    F.coalesce("n_files", F.lit(0)).cast("bigint").alias("n_files")))


def last_wins(listing: DataFrame) -> DataFrame:
    """One row per ``name``; the last entry in ``lower(rel)`` order wins.

    ``max_by`` with the whole ordering key (plus size for exact ties) is a
    partial aggregate, so a name shared by a large share of rows is combined
    map-side before the shuffle.
    """
    order = F.struct(F.lower("rel"), F.col("rel"), F.col("size"))
    win = F.max_by(F.struct("rel", "size"), order)
    return listing.groupBy("name").agg(win.alias("_w")).select("name", "_w.rel", "_w.size")


def listing_order(df: DataFrame) -> DataFrame:
    """O1: presentation order of a listing."""
    return df.orderBy(F.lower("rel"), "rel")
