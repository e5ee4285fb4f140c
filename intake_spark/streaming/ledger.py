"""A processed ledger that a batch opens in part (T5, J3, K2), and the step from
candidates to jobs with all its writes (E2: K1, K2, K3 committed together).

Keys ``(name, size)`` lie in hash buckets. Each batch's keys are a table of the
batch's commit, ``ledger``, with a Bloom filter beside it, ``filters``: the words
of ``FILTER_BITS`` bits a bucket that aren't zero. A lookup reads the filters of
the buckets that its keys fall into, and opens only those buckets of the ledger
whose filter may hold one of them. Paths are given one by one, so nothing else
is even listed.

``fold`` rewrites the ledger as one segment once ``FOLD_EVERY`` batches have been
added, with so many buckets that one holds ``BUCKET_KEYS`` keys at most on
average: a bucket's size doesn't grow with the ledger, and what a batch reads
depends on its own number of keys. A fold appears by a record, like a batch.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.paths import row_key
from ..operators.intake import first_per_key
from ..session import delete
from .commits import BatchTables, Step, names, put_if_absent

KEYS = ["name", "size"]
KEY_SCHEMA = "name string, size long"
FILTER_SCHEMA = "word int, bits long"
FIRST_BITS = 4              # two to the power of it: buckets before the first fold
FILTER_BITS = 1 << 20       # of a bucket's filter
HASHES = 4
BUCKET_KEYS = 1 << 16
FOLD_EVERY = 32


def in_bucket(keys: DataFrame, bits: int) -> DataFrame:
    return keys.withColumn("bucket", F.xxhash64(*KEYS).bitwiseAND(F.lit((1 << bits) - 1)).cast("int"))


def marked_bits(keys: DataFrame) -> DataFrame:
    """(the columns, word, bit): the ``HASHES`` places of each key in its bucket's filter."""
    places = F.array(*[F.xxhash64(*KEYS, F.lit(i)).bitwiseAND(F.lit(FILTER_BITS - 1)) for i in range(HASHES)])
    return (keys.withColumn("_p", F.explode(F.array_distinct(places)))
            .withColumns({"word": F.shiftright("_p", 6).cast("int"), "bit": F.expr("shiftleft(1L, cast(_p & 63 as int))")}).drop("_p"))


def filter_rows(keys: DataFrame) -> DataFrame:
    """(bucket, word, bits) of the keys' filters."""
    return marked_bits(keys).groupBy("bucket", "word").agg(F.bit_or("bit").alias("bits"))


class Ledger:
    def __init__(self, tables: BatchTables) -> None:
        self.tables, self.spark = tables, tables.spark

    # -- segments

    def last_fold(self) -> dict:
        folds = [int(n.partition(".")[0]) for n in names(self.spark, f"{self.tables.root}/folds") if n.endswith(".json") and n[0] != "."]
        if not folds:
            return {"fold": -1, "upto": -1, "bits": FIRST_BITS, "path": None}
        return json.loads(self.spark.read.text(f"{self.tables.root}/folds/{max(folds)}.json").first()[0])

    def segments(self, table: str, fold: dict) -> list[str]:
        """Folders of the live segments: the last fold, and the batches after it."""
        done = [int(n.partition(".")[0]) for n in names(self.spark, f"{self.tables.root}/commits") if n.endswith(".json") and n[0] != "."]
        after = [self.tables.folder(table, b, self.tables.winner(b)) for b in sorted(done) if b > fold["upto"]]
        return ([f"{fold['path']}/{table}"] if fold["path"] else []) + after

    def open(self, table: str, schema: str, fold: dict, buckets: set[int] | None) -> DataFrame:
        """The rows of a table in ``buckets`` (None: all), with ``bucket``."""
        paths = []
        for folder in self.segments(table, fold):
            have = {int(n.partition("=")[2]) for n in names(self.spark, folder) if n.startswith("bucket=")}
            paths += [f"{folder}/bucket={b}" for b in sorted(have if buckets is None else have & buckets)]
        parts = [self.spark.read.schema(schema).parquet(*paths[i: i + 1000]).withColumn(
            "bucket", F.regexp_extract(F.input_file_name(), "/bucket=([0-9]+)/", 1).cast("int")) for i in range(0, len(paths), 1000)]
        out = parts[0] if parts else self.spark.createDataFrame([], f"{schema}, bucket int")
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    # -- lookups

    def maybe(self, keys: DataFrame, fold: dict) -> DataFrame:
        """The keys (name, size, bucket) that a filter may hold."""
        touched = {r["bucket"] for r in keys.select("bucket").distinct().toLocalIterator()}  # at most one a key
        filters = (self.open("filters", FILTER_SCHEMA, fold, touched).groupBy("bucket", "word").agg(F.bit_or("bits").alias("bits")))
        hit = marked_bits(keys).join(filters, ["bucket", "word"], "left")
        missed = F.coalesce(F.col("bits").bitwiseAND(F.col("bit")) == 0, F.lit(True))
        return hit.groupBy(*KEYS, "bucket").agg(F.bool_or(missed).alias("_no")).filter(~F.col("_no")).drop("_no")

    def known(self, keys: DataFrame) -> DataFrame:
        """The distinct ``keys`` (name, size) that the ledger holds."""
        fold = self.last_fold()
        asked = in_bucket(keys.select(*KEYS).distinct(), fold["bits"])
        maybe = self.maybe(asked, fold)
        opened = {r["bucket"] for r in maybe.select("bucket").distinct().toLocalIterator()}
        return maybe.join(self.open("ledger", KEY_SCHEMA, fold, opened), [*KEYS, "bucket"], "left_semi").select(*KEYS)

    # -- writes

    def add(self, step: Step, new: DataFrame) -> None:
        """Write a batch's new keys, and their filters, as part of its commit."""
        keys = in_bucket(new.select(*KEYS), self.last_fold()["bits"])
        keys = step.write("ledger", keys.repartition("bucket"), ["bucket"])
        step.write("filters", filter_rows(keys).repartition("bucket"), ["bucket"])

    def fold(self, every: int = FOLD_EVERY, bucket_keys: int = BUCKET_KEYS) -> bool:
        """Rewrite the live segments as one, if ``every`` batches came since the
        last fold; whether that was done. What the fold before replaced is deleted."""
        fold = self.last_fold()
        batches = [int(n.partition(".")[0]) for n in names(self.spark, f"{self.tables.root}/commits") if n.endswith(".json") and n[0] != "."]
        batches = sorted(b for b in batches if b > fold["upto"])
        if len(batches) < every:
            return False
        keys = self.open("ledger", KEY_SCHEMA, fold, None).select(*KEYS).distinct()
        bits = max(fold["bits"], (-(-max(1, keys.count()) // bucket_keys) - 1).bit_length())
        path = f"{self.tables.root}/folded/{fold['fold'] + 1}-{uuid.uuid4().hex[:12]}"
        in_bucket(keys, bits).repartition("bucket").write.partitionBy("bucket").parquet(f"{path}/ledger")
        written = self.spark.read.schema(f"{KEY_SCHEMA}, bucket int").parquet(f"{path}/ledger")
        filter_rows(written).repartition("bucket").write.partitionBy("bucket").parquet(f"{path}/filters")
        record = {"fold": fold["fold"] + 1, "upto": batches[-1], "bits": bits, "path": path, "from": fold["upto"], "before": fold["path"]}
        if not put_if_absent(self.spark, f"{self.tables.root}/folds/{record['fold']}.json", json.dumps(record)):
            delete(self.spark, path)
            return False
        if fold["path"] and fold.get("before"):
            delete(self.spark, fold["before"])
        for b in range(fold.get("from", -1) + 1, fold["upto"] + 1):
            for table in ("ledger", "filters"):
                delete(self.spark, f"{self.tables.root}/{table}/batch_id={b}")
        return True

    def read(self) -> DataFrame:
        """All keys."""
        return self.open("ledger", KEY_SCHEMA, self.last_fold(), None).select(*KEYS)


# ------------------------------------------------------------------- handlers

def dedup_handler(root: str, fold_every: int = FOLD_EVERY):
    """T5 as a ``foreachBatch`` handler: a batch's keys that the ledger doesn't
    hold are added to it."""
    def handle(df: DataFrame, batch_id: int) -> None:
        tables = BatchTables(df.sparkSession, root)
        ledger = Ledger(tables)
        with tables.begin(batch_id) as step:
            if step is not None:
                keys = step.write("arrived", df.select(*KEYS).distinct())
                ledger.add(step, keys.join(ledger.known(keys), KEYS, "left_anti"))
        tables.sweep(batch_id, ("arrived",), keep=1)
        ledger.fold(fold_every)
    return handle


def intake_handler(root: str, order: list[str], documents: dict[str, Callable[[DataFrame], DataFrame]], fold_every: int = FOLD_EVERY):
    """E2 as a ``foreachBatch`` handler: of a batch's candidates the first of each
    (name, size) in ``order`` that the ledger doesn't hold becomes a job. Its
    candidate row (with F2 ``hash``), the rows that ``documents`` makes of it
    (table name -> function of the new candidates), and its ledger line are
    committed together, so no ledger line is without its job."""
    def handle(df: DataFrame, batch_id: int) -> None:
        tables = BatchTables(df.sparkSession, root)
        ledger = Ledger(tables)
        with tables.begin(batch_id) as step:
            if step is not None:
                first = step.write("arrived", first_per_key(df, KEYS, order))
                new = first.join(ledger.known(first), KEYS, "left_anti")
                new = step.write("candidates", new.withColumn("hash", row_key(F.col("name"), F.col("size"))))
                for name, make in documents.items():
                    step.write(name, make(new))
                ledger.add(step, new)
        tables.sweep(batch_id, ("arrived",), keep=1)
        ledger.fold(fold_every)
    return handle
