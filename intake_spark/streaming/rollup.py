"""Directory sizes kept up from changes (A1).

``scan_changes`` compares two scans' files: what was added, went or changed its
size. ``rollup_handler`` adds the differences of a batch of changes to the sums
of the directories they touch. Sums lie in hash buckets; a batch reads and
writes the buckets of its directories only, and a small index says which
batch wrote each bucket last. After every batch the sums equal a full roll-up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.inventory import dir_root
from ..session import delete
from .commits import BatchTables, names

BUCKETS = 64
CHANGE_SCHEMA = "path string, before long, after long"
SUM_SCHEMA = "dir string, size long, n_files long"
INDEX_SCHEMA = "bucket int, folder string"


def scan_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """(path, before, after) of the files whose size differs between two scans
    ``(path, size)``; null where a file isn't there. Paths are distinct."""
    b = before.select("path", F.col("size").alias("before"), F.lit(True).alias("_b"))
    a = after.select("path", F.col("size").alias("after"), F.lit(True).alias("_a"))
    both = b.join(a, "path", "full_outer")
    same = F.col("_a").isNotNull() & F.col("_b").isNotNull() & F.col("before").eqNullSafe(F.col("after"))
    return both.filter(~same).select("path", "before", "after")


def differences(changes: DataFrame) -> DataFrame:
    """(dir, size, n_files) to be added, one row a touched directory."""
    there = lambda c: F.col(c).isNotNull().cast("long")
    size = F.coalesce("after", F.lit(0)) - F.coalesce("before", F.lit(0))
    return (changes.withColumn("dir", dir_root(F.col("path"))).filter(F.col("dir") != "")
            .groupBy("dir").agg(F.sum(size).alias("size"), F.sum(there("after") - there("before")).alias("n_files")))


def _open(tables: BatchTables, folders: list[str]) -> DataFrame:
    if not folders:
        return tables.spark.createDataFrame([], SUM_SCHEMA)
    return tables.spark.read.schema(SUM_SCHEMA).parquet(*folders)


def rollup_handler(root: str, buckets: int = BUCKETS):
    """``foreachBatch`` handler for a stream of changes."""
    bucket = F.pmod(F.xxhash64("dir"), F.lit(buckets)).cast("int").alias("bucket")

    def handle(df: DataFrame, batch_id: int) -> None:
        tables = BatchTables(df.sparkSession, root)
        index = {}
        with tables.begin(batch_id) as step:
            if step is not None:
                index = {r["bucket"]: r["folder"] for r in tables.at("index", batch_id - 1, INDEX_SCHEMA).collect()}  # at most ``buckets`` rows
                deltas = step.write("differences", differences(df).select("*", bucket))
                touched = {r["bucket"] for r in deltas.select("bucket").distinct().collect()}
                old = _open(tables, [index[b] for b in sorted(touched & set(index))])
                new = (old.unionByName(deltas.drop("bucket")).groupBy("dir").agg(F.sum("size").alias("size"), F.sum("n_files").alias("n_files"))
                       .filter(F.col("n_files") > 0).select("*", bucket))
                step.write("sums", new.repartition("bucket"), ["bucket"])
                folder = tables.folder("sums", batch_id, step.attempt)
                made = {int(n.partition("=")[2]) for n in names(tables.spark, folder) if n.startswith("bucket=")}
                now = {b: f for b, f in index.items() if b not in touched} | {b: f"{folder}/bucket={b}" for b in made}
                step.write("index", tables.spark.createDataFrame(sorted(now.items()), INDEX_SCHEMA).coalesce(1))
                index = {b: f for b, f in index.items() if b in touched}  # replaced
        tables.sweep(batch_id, ("differences", "index"))
        for f in index.values():
            delete(tables.spark, f)
    return handle


def read_sums(tables: BatchTables) -> DataFrame:
    """(dir, size, n_files) after the last committed batch."""
    done = tables.records()
    if not done:
        return tables.spark.createDataFrame([], SUM_SCHEMA)
    index = tables.at("index", done[-1]["batch_id"], INDEX_SCHEMA)
    return _open(tables, [r["folder"] for r in index.collect()])
