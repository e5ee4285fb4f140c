"""Mixing sources to target weights (operator 11).

A document's size is its number of words. A source's target is its weight's
share of all words, but at most ``MAX_EPOCHS`` times its own size; what is cut
off there goes to the other sources by their weights. A mix first takes every
document of a source ``floor(target / size)`` times (complete epochs). The rest
of the target is filled by Efraimidis-Spirakis sampling: a document's key is
``-ln(u) / w`` with u from a hash of its id and w its quality weight; documents
are sorted by key within their source, and those whose middle word lies within
the rest, by the running sum of sizes, are taken once more. So a source's words
miss its target by at most half a document.

Everything is DataFrame functions. Sizes and keys are counted once and written;
the narrow rows are sorted by range over (source, key), so a source of any
share is spread over tasks, and running sums are taken inside the written
ranges, with one sum a range and source carried over. Targets come from rounds
of one-row aggregates, never from a list of sources.

Defined results: null texts have size 0; a null source is a source of its own,
the last one; a source without words has target 0; rows with equal ids have
equal keys and are ordered by text; a null id counts as an empty one; a weight
that is null or isn't given is 1, one of 0 or less, or NaN, comes after all
others; an empty table gives no rows; only the columns named are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordering import global_row_number
from .files import stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)     # of the sources in order, repeating
MAX_EPOCHS = 3
SEED = "mix:"
#: Sampling weight of a document by its ``quality`` label.
QUALITY = {1: 2.0, 0: 0.5}


def uniform(key: str) -> Column:
    """A number between 0 and 1 from a hash of the key: 52 bits, never 0 or 1."""
    text = F.concat(F.lit(SEED), F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")))
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") + 0.5) / float(1 << 52)


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MAX_EPOCHS) -> DataFrame:
    """``sources`` (no_source, source, source_size) with ``target`` (double).

    Sources whose share reaches their limit get the limit; the others' share a
    unit of weight grows by what is left, until none reaches it. Products are
    compared exactly."""
    cycle = F.lit([int(w) for w in weights])
    named = global_row_number(sources, ["no_source", "source"], "place")
    named = stored(sources.sparkSession, named.select(
        "no_source", "source", "source_size",
        F.element_at(cycle, F.pmod(F.col("place") - 1, F.lit(len(weights))).cast("int") + 1).cast("long").alias("weight"),
        (F.col("source_size") * most).alias("limit")), "sources")
    total, units = named.agg(F.sum("source_size"), F.sum("weight")).first()
    words, rest = total or 0, units or 0

    def reached() -> Column:
        def wide(c):
            return c.cast("decimal(19,0)")
        return wide(F.lit(words)) * wide(F.col("weight")) >= wide(F.col("limit")) * wide(F.lit(rest))

    while rest:
        cut, left = named.agg(F.sum(F.when(reached(), F.col("limit")).otherwise(0)),
                              F.sum(F.when(reached(), 0).otherwise(F.col("weight")))).first()
        if left == rest:
            break
        words, rest = total - cut, left
    share = F.col("weight") * F.lit(words).cast("double") / F.lit(rest or 1).cast("double")
    return named.select("no_source", "source", "source_size",
                        F.when(reached(), F.col("limit").cast("double")).otherwise(share).alias("target"))


def mix(docs: DataFrame, quality: DataFrame | None = None, weights: Sequence[int] = WEIGHTS,
        most: int = MAX_EPOCHS, key: str = "doc_id", source: str = "source", text: str = "text",
        keep: Sequence[str] = ()) -> DataFrame:
    """How often the mix takes each document.

    ``quality`` (id, weight): sampling weights by document id, one row an id.
    Returns id, source, size, source_size, target (of its source), copies
    (long), taken (size times copies), and kept (a struct of the columns
    ``keep``) if any are asked for; ``repeat_kept`` makes the mix of it."""
    spark = docs.sparkSession
    name = F.col(f"`{source}`").cast("string")
    kept = [F.struct(*[F.col(f"`{c}`") for c in keep]).alias("kept")] if keep else []
    rows = docs.select(
        F.col(f"`{key}`").alias("id"), name.isNull().alias("no_source"), F.coalesce(name, F.lit("")).alias("source"),
        F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        uniform(key).alias("u"), F.xxhash64(F.col(f"`{text}`")).alias("tie"), *kept)
    sized = stored(spark, rows, "sizes")
    weight = F.lit(1.0)
    if quality is not None:
        own = quality.select(F.col("id").alias("_of"), F.col("weight").cast("double").alias("_w"))
        sized, weight = sized.join(own, F.col("id") == F.col("_of"), "left"), F.coalesce("_w", F.lit(1.0))
    usable = (weight > 0) & ~F.isnan(weight)
    ranked = sized.withColumn("late", F.when(usable, -F.log("u") / weight).otherwise(F.lit(float("inf")))).drop("u", "_of", "_w")
    order = ["no_source", "source", "late", "id", "tie", "size"]
    # equal rows may be parted anywhere: the salt only splits them over tasks
    ranges = stored(spark, ranked.withColumn("salt", F.monotonically_increasing_id())
                    .repartitionByRange(*order, "salt").sortWithinPartitions(*order, "salt")
                    .withColumn("part", F.spark_partition_id()).withColumn("place", F.monotonically_increasing_id())
                    .drop("late", "tie", "salt"), "ranges")
    sums = stored(spark, ranges.groupBy("part", "no_source", "source").agg(F.sum("size").alias("words")), "sums")
    sources = sums.groupBy("no_source", "source").agg(F.sum("words").alias("source_size"))
    carried = Window.partitionBy("no_source", "source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    head = sums.withColumn("ahead", F.coalesce(F.sum("words").over(carried), F.lit(0))).drop("words")
    group = ["part", "no_source", "source"]
    inside = Window.partitionBy(*group).orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    before = (F.col("ahead") + F.coalesce(F.sum("size").over(inside), F.lit(0))).alias("before")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    found = (ranges.join(head.join(targets(sources, weights, most), ["no_source", "source"]), group)
             .select("*", before, epochs.cast("long").alias("epochs"))
             .withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")))
    more = ((F.col("before") * 2 + F.col("size")) <= F.col("rest") * 2) & (F.col("rest") > 0)
    copies = F.col("epochs") + more.cast("long")
    return found.select("id", F.when(~F.col("no_source"), F.col("source")).alias("source"), "size", "source_size", "target",
                        copies.alias("copies"), (F.col("size") * copies).alias("taken"), *(["kept"] if keep else []))


def repeat_kept(mixed: DataFrame) -> DataFrame:
    """The mix itself: the kept columns, a row for each copy taken."""
    times = F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))
    return mixed.where("copies > 0").select("kept", times).select("kept.*")


def quality_weights(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """(id, weight) from quality labels; of several labels the highest counts."""
    weight = F.lit(1.0)
    for value, w in QUALITY.items():
        weight = F.when(F.col("q") == value, F.lit(w)).otherwise(weight)
    return (labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("id")).agg(F.max("quality").alias("q"))
            .select("id", weight.alias("weight")))


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken."""
    return mix(docs, quality_weights(labels)).withColumnRenamed("id", "doc_id")
