"""Stability detection: run length of equal sizes over consecutive scans.

W1  per (watch, name): same size as in the immediately preceding successful
    scan -> count + 1, else 1; a scan without the name resets it; capped at
    one million.
P4  candidates are rows with count >= min_stable (2).
W2  the snapshot of a scan = its candidate rows; "latest" is taken from the
    scans table so that an empty latest scan gives an empty snapshot.
A5  per-scan counts, scans without candidates kept.

W1 is gaps-and-islands. A single window over (watch, name) would put every
observation of one name into one task, and one file may be observed in a large
share of all scans. So the scan axis is cut into blocks of ``block_scans``
scans: lag and the running "last break" are computed per (watch, name, block)
- bounded groups that hash to different tasks - and a small per-block summary
carries the run start across block borders (a two-level prefix scan). The
summary has one row per (watch, name, block), it never holds observations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.paths import MAX_STABLE_COUNT, row_key

# Fixed value: stable scans required before a file becomes a candidate.
MIN_STABLE_SCANS = 2
DEFAULT_BLOCK_SCANS = 4096


def number_scans(scans: DataFrame, order_col: str = "scan_ts") -> DataFrame:
    """Gap-free ``scan_no`` per watch over *successful* scans (T4: errors take no number).

    ``scans`` has one row per (watch, scan); it is small (watches x scans), the
    window per watch runs on it, never on observations.
    """
    w = Window.partitionBy("watch").orderBy(order_col)
    ok = scans.filter(F.coalesce(F.col("status"), F.lit("ok")) == "ok") \
        if "status" in scans.columns else scans
    return ok.withColumn("scan_no", F.row_number().over(w).cast("bigint"))


def blocked_observations(log: DataFrame, block_scans: int = DEFAULT_BLOCK_SCANS,
                         keys: tuple[str, ...] = ("watch", "name"), start_col: str | None = None) -> DataFrame:
    """W1's single exchange: observations hash-partitioned on (keys, block of scans).

    One file's history is cut into blocks, so it lands in several tasks.
    Both W1 branches start from this same subtree, so the shuffle is written
    once and reused (ReusedExchange). Null keys never join; filtering them
    up front keeps the two subtrees identical (no one-sided inferred
    filters), which reuse needs.
    """
    k = list(keys)
    blk = F.floor(F.col("scan_no") / F.lit(block_scans)).cast("bigint")
    not_null = F.col("scan_no").isNotNull()
    for c in k:
        not_null = not_null & F.col(c).isNotNull()
    extra = [start_col] if start_col else []
    return (log.select(*k, "scan_no", "size", *extra).filter(not_null)
            .withColumn("_blk", blk).filter(F.col("_blk").isNotNull()).repartition(*k, "_blk"))


def stability_counts(log: DataFrame, block_scans: int = DEFAULT_BLOCK_SCANS,
                     keys: tuple[str, ...] = ("watch", "name"), start_col: str | None = None) -> DataFrame:
    """W1 over a scan log ``(watch, scan_no, name, size)`` -> the same columns plus ``count``.

    ``start_col`` (optional) seeds runs from earlier history: a row with a
    non-null start is a key's first row whose run began at that scan (a state
    row ``scan_no - cnt + 1``); the column is kept in the output.
    """
    k = list(keys)
    obs = blocked_observations(log, block_scans, keys, start_col)
    # where a row's run would start if it breaks: its own scan, or a seed's recorded start
    brk_at = F.coalesce(F.col(start_col), F.col("scan_no")) if start_col else F.col("scan_no")

    wkb = Window.partitionBy(*k, "_blk").orderBy("scan_no")
    prev_scan = F.lag("scan_no").over(wkb)
    prev_size = F.lag("size").over(wkb)
    breaks_here = (prev_scan != F.col("scan_no") - 1) | ~prev_size.eqNullSafe(F.col("size"))
    obs = (obs
           .withColumn("_brk", F.when(prev_scan.isNotNull() & breaks_here, brk_at))
           .withColumn("_lastbrk", F.max("_brk").over(
               wkb.rowsBetween(Window.unboundedPreceding, Window.currentRow))))

    summ = obs.groupBy(*k, "_blk").agg(
        F.min_by(brk_at, F.col("scan_no")).alias("_fs"),
        F.min("scan_no").alias("_fscan"),
        F.min_by("size", "scan_no").alias("_fsz"),
        F.max("scan_no").alias("_ls"),
        F.max_by("size", "scan_no").alias("_lsz"),
        F.max("_brk").alias("_mb"),
    )
    wk = Window.partitionBy(*k).orderBy("_blk")
    p_last = F.lag("_ls").over(wk)
    p_lsz = F.lag("_lsz").over(wk)
    first_breaks = p_last.isNull() | (p_last != F.col("_fscan") - 1) | ~p_lsz.eqNullSafe(F.col("_fsz"))
    summ = (summ
            .withColumn("_fbrk", first_breaks)
            .withColumn("_bmax", F.greatest(F.col("_mb"), F.when(F.col("_fbrk"), F.col("_fs"))))
            .withColumn("_carry", F.max("_bmax").over(
                wk.rowsBetween(Window.unboundedPreceding, -1)))
            .select(*k, "_blk", "_fs", "_fbrk", "_carry"))

    run_start = F.coalesce(F.col("_lastbrk"), F.when(F.col("_fbrk"), F.col("_fs")), F.col("_carry"))
    cnt = F.least(F.col("scan_no") - run_start + 1, F.lit(MAX_STABLE_COUNT)).cast("bigint")
    out = obs.join(summ, on=[*k, "_blk"], how="inner").withColumn("count", cnt)
    return out.drop("_blk", "_brk", "_lastbrk", "_fs", "_fbrk", "_carry")


def stable_candidates(counted: DataFrame, min_stable: int = MIN_STABLE_SCANS) -> DataFrame:
    """P4 + F2: candidate rows with their row key."""
    return (counted.filter(F.col("count") >= F.lit(min_stable))
            .withColumn("hash", row_key(F.col("name"), F.col("size"))))


def latest_scans(scans: DataFrame) -> DataFrame:
    """Latest successful scan per watch, from the scans table (not from rows)."""
    return scans.groupBy("watch").agg(F.max("scan_no").alias("scan_no"))


def snapshot_at(candidates: DataFrame, which: DataFrame) -> DataFrame:
    """The candidate rows of the scans listed in ``which(watch, scan_no)``.

    ``which`` has one row per watch; AQE broadcasts it after measuring it.
    """
    return candidates.join(which, ["watch", "scan_no"], "left_semi")


def scan_counts(scans: DataFrame, counted: DataFrame, min_stable: int = MIN_STABLE_SCANS) -> DataFrame:
    """A5: files seen and candidates per scan; scans with no rows report 0."""
    per_scan = counted.groupBy("watch", "scan_no").agg(
        F.count(F.lit(1)).alias("n_files"),
        F.count_if(F.col("count") >= F.lit(min_stable)).alias("n_candidates"),
        F.max("count").alias("max_count"),
    )
    return (scans.select("watch", "scan_no").join(per_scan, ["watch", "scan_no"], "left")
            .select("watch", "scan_no",
                    F.coalesce("n_files", F.lit(0)).cast("bigint").alias("n_files"),
                    F.coalesce("n_candidates", F.lit(0)).cast("bigint").alias("n_candidates"),
                    F.coalesce("max_count", F.lit(0)).cast("bigint").alias("max_count")))


def scan_events(attempts: DataFrame, candidates: DataFrame) -> DataFrame:
    """K1 T4: one event per scan attempt: ``snapshot`` with its number of
    candidates, ``empty`` without any, ``error`` (no scan number) when it failed.

    ``attempts(watch, scan_ts, status, message)``; failed attempts take no
    number, so run lengths go on over them.
    """
    ok = number_scans(attempts)
    per = candidates.groupBy("watch", "scan_no").agg(F.count(F.lit(1)).alias("n_candidates"))
    n = F.coalesce("n_candidates", F.lit(0)).cast("bigint")
    good = ok.join(per, ["watch", "scan_no"], "left").select(
        "watch", "scan_ts", F.when(n > 0, F.lit("snapshot")).otherwise(F.lit("empty")).alias("kind"), "scan_no",
        n.alias("n_candidates"), F.lit(None).cast("string").alias("message"))
    bad = attempts.filter(F.coalesce(F.col("status"), F.lit("ok")) != "ok").select(
        "watch", "scan_ts", F.lit("error").alias("kind"), F.lit(None).cast("bigint").alias("scan_no"),
        F.lit(0).cast("bigint").alias("n_candidates"), "message")
    return good.unionByName(bad)


def write_snapshots(candidates: DataFrame, scans: DataFrame, path: str) -> None:
    """K1: one snapshot per scan, empty snapshots included.

    Candidate rows land under ``watch=/scan_no=`` partitions; the per-scan
    event table (``kind = 'snapshot'`` with its size, zero for an empty scan)
    goes to ``<path>/_events``. Dynamic partition overwrite makes a rewrite of
    the same scans idempotent.
    """
    (candidates.select("watch", "scan_no", "name", "size", "hash", "count")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("watch", "scan_no").parquet(path))
    per = candidates.groupBy("watch", "scan_no").agg(F.count(F.lit(1)).alias("n_candidates"))
    events = (scans.select("watch", "scan_no", "scan_ts").join(per, ["watch", "scan_no"], "left")
              .select("watch", "scan_no", "scan_ts", F.lit("snapshot").alias("kind"),
                      F.coalesce("n_candidates", F.lit(0)).cast("bigint").alias("n_candidates")))
    (events.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("watch").parquet(f"{path.rstrip('/')}/_events"))
