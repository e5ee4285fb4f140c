"""De-duplicated intake: first-per-key (U3), processed anti-join (J3),
source-still-exists semi-join (J4), ledger append-if-absent (K2) and the
keep-if-exists job spec / metadata write (K3).

Copies of one file under many watches form one (name, size) group that can
hold a large share of all rows. Every "first/any per key" step here is an
aggregate (``min_by`` / ``distinct``), which Spark combines map-side before
the shuffle, instead of a window that would sort the whole group in one task.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .inventory import clean_ignore_lines


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per ``keys``: the row with the smallest ``order`` tuple.

    ``order`` must make rows unique within a key (add an id as the last item).
    """
    payload = [c for c in df.columns if c not in keys]
    win = F.min_by(F.struct(*payload), F.struct(*order))
    return df.groupBy(*keys).agg(win.alias("_w")).select(*keys, *[F.col(f"_w.{c}") for c in payload])


def first_unprocessed(df: DataFrame, keys: list[str], order: list[str], flag: str) -> DataFrame:
    """U3 + J3 in one aggregate, when the processed mark travels with the candidates.

    Per key: the first row in ``order`` and whether any row of the key is
    marked processed; keys with a processed row are dropped. One shuffle, and
    a group of copies is combined map-side before it.
    """
    payload = [c for c in df.columns if c not in keys and c != flag]
    agg = df.groupBy(*keys).agg(F.min_by(F.struct(*payload), F.struct(*order)).alias("_w"),
                                F.bool_or(F.col(flag)).alias("_done"))
    return agg.filter(~F.col("_done")).select(*keys, *[F.col(f"_w.{c}") for c in payload])


def not_processed(candidates: DataFrame, processed: DataFrame,
                  keys: tuple[str, ...] = ("name", "size")) -> DataFrame:
    """Candidates whose (name, size) is not in the processed ledger."""
    ledger = processed.select(*keys).distinct()
    return candidates.join(ledger, list(keys), "left_anti")


def still_exists(jobs: DataFrame, inventory: DataFrame, key: str = "abs") -> DataFrame:
    """Keep jobs whose source path is in the latest inventory.

    The inventory side is reduced to distinct paths first (map-side combine),
    so a path listed many times does not pile up in one join task.
    """
    return jobs.join(inventory.select(key).distinct(), key, "left_semi")


def ledger_new_rows(batch: DataFrame, ledger_lines: DataFrame, col: str = "name") -> DataFrame:
    """K2: names of ``batch`` not yet in the ledger (comment and blank lines ignored).

    Names are trimmed; duplicates inside the batch are written once.
    """
    existing = clean_ignore_lines(ledger_lines, "value").select(F.col("pattern").alias(col))
    names = batch.select(F.trim(F.col(col)).alias(col)).filter(F.col(col) != "")
    return names.distinct().join(existing, col, "left_anti")


def append_ledger(new_rows: DataFrame, path: str, batch_id: int) -> None:
    """K2 sink: write one batch's rows under ``batch_id=<n>``.

    Dynamic partition overwrite makes a retried batch replace its own
    partition instead of appending twice (idempotent under task/job retry).
    """
    (new_rows.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_id").parquet(path))


def keep_new(specs: DataFrame, existing: DataFrame, key: str = "hash") -> DataFrame:
    """K3: keep-if-exists - only keys without a written spec/metadata are emitted."""
    return specs.join(existing.select(key).distinct(), key, "left_anti")


def write_keep_if_exists(docs: DataFrame, path: str, key: str = "hash", text_col: str = "json") -> int:
    """K3 sink: append one JSON line per new ``key``; keys already written are kept as they are.

    Existing keys are read back from ``path`` (JSON lines with the key field),
    so a rerun after a committed write adds nothing. Returns the rows added.
    """
    spark = docs.sparkSession
    try:
        existing = spark.read.schema(f"{key} string").json(path).select(key)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":  # nothing written yet
            raise
        existing = spark.createDataFrame([], f"{key} string")
    new = keep_new(docs.dropDuplicates([key]), existing, key).select(text_col)
    n = new.count()  # evaluated before the write, against the same existing keys
    if n:
        new.write.mode("append").text(path)
    return n
