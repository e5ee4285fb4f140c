"""Incremental stability detection (T2, T3, T4) on the scan-log stream.

Two forms share one rule. State per (watch, name) is three numbers - last
scan, last size, run length - O(1) per live file. A row whose scan is not
newer than its key's state is a replay or late arrival: it is reported with
``late = true`` and no count. A file that skipped a scan restarts at 1
(absence is detected from the scan gap).

* ``advance_counts`` / ``state_table_handler`` (used by the registered
  stream and the incremental batch query): the state is a versioned table;
  each batch seeds the blocked W1 of ``operators.stability`` with it - JVM
  only, skew-safe, and the state keeps just the files of the two latest scans
  and each watch's highest scan. Rows below that scan are replays, also of
  files that have gone since; a scan may be split over consecutive batches, as
  long as it comes whole before the next one (``streaming.scans`` needs no such order).
* ``stream_counts``: the same rule in ``applyInPandasWithState``, rows
  sorted by scan inside each group; keys idle longer than ``idle_timeout``
  are evicted so dead files do not accumulate in the state store.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.paths import MAX_STABLE_COUNT, row_key
from ..operators.stability import MIN_STABLE_SCANS, stability_counts
from ..session import delete
from .runner import read_table

OUTPUT_SCHEMA = "watch string, scan_no long, name string, size long, count long, late boolean"
STATE_SCHEMA = "scan_no long, size long, cnt long"


def _advance(key: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState,
             idle_timeout_ms: int) -> Iterator[pd.DataFrame]:
    if state.hasTimedOut:
        state.remove()
        return
    watch, name = key
    frames = [p[["scan_no", "size"]] for p in pdfs]
    rows = pd.concat(frames, ignore_index=True).sort_values("scan_no", kind="stable") if frames else None
    if rows is None or rows.empty:
        return
    if state.exists:
        last_scan, last_size, cnt = state.get
    else:
        last_scan, last_size, cnt = None, None, 0
    out_scan, out_size, out_cnt, out_late = [], [], [], []
    for scan_no, size in zip(rows["scan_no"].tolist(), rows["size"].tolist()):
        size = None if pd.isna(size) else int(size)
        if last_scan is not None and scan_no <= last_scan:
            out_scan.append(scan_no); out_size.append(size); out_cnt.append(None); out_late.append(True)
            continue
        same = last_scan is not None and scan_no == last_scan + 1 and size == last_size
        cnt = min(cnt + 1, MAX_STABLE_COUNT) if same else 1
        last_scan, last_size = scan_no, size
        out_scan.append(scan_no); out_size.append(size); out_cnt.append(cnt); out_late.append(False)
    state.update((int(last_scan), last_size, int(cnt)))
    if idle_timeout_ms > 0:
        state.setTimeoutDuration(idle_timeout_ms)
    yield pd.DataFrame({
        "watch": watch, "scan_no": pd.Series(out_scan, dtype="int64"), "name": name,
        "size": pd.Series(out_size, dtype="Int64"), "count": pd.Series(out_cnt, dtype="Int64"),
        "late": pd.Series(out_late, dtype="bool")})


def stream_counts(log: DataFrame, idle_timeout_s: int = 0) -> DataFrame:
    """Per observation its run length (``late`` rows carry no count)."""
    ms = int(idle_timeout_s) * 1000

    def fn(key, pdfs, state):
        return _advance(key, pdfs, state, ms)

    return (log.select("watch", "scan_no", "name", "size")
            .groupBy("watch", "name")
            .applyInPandasWithState(fn, OUTPUT_SCHEMA, STATE_SCHEMA, "append",
                                    GroupStateTimeout.ProcessingTimeTimeout if ms > 0
                                    else GroupStateTimeout.NoTimeout))


def stream_candidates(counts: DataFrame, min_stable: int = MIN_STABLE_SCANS) -> DataFrame:
    """P4 + F2 after the stateful step (stateless, allowed in append mode)."""
    return (counts.filter(~F.col("late") & (F.col("count") >= F.lit(min_stable)))
            .withColumn("hash", row_key(F.col("name"), F.col("size")))
            .select("watch", "scan_no", "name", "size", "hash", "count"))


# --------------------------------------------------------------------------- JVM-side form

STATE_TABLE_SCHEMA = "watch string, name string, scan_no long, size long, cnt long"


def advance_counts(batch: DataFrame, state: DataFrame) -> DataFrame:
    """T2-T4 for one micro-batch (or one incremental batch run): counted rows.
    A scan may go on in the next batch; then its new names count there.

    ``state(watch, name, scan_no, size, cnt)`` holds each live file's last
    observation and run length, and each watch's highest scan (null name).
    Each file's row joins the new rows as a seed whose run began at ``scan_no -
    cnt + 1``; the blocked W1 of ``operators.stability`` then counts seed + new
    rows, so a file seen in many new scans is still split over tasks. Rows of a
    scan below their watch's highest one, or of that scan and a name that the
    state has there, are replays: ``late = true``, no count.
    """
    b = batch.select("watch", "name", "scan_no", "size")
    b = b.join(state.groupBy("watch").agg(F.max("scan_no").alias("_s0")), "watch", "left")
    known = state.filter(F.col("name").isNotNull())
    here = known.groupBy("watch", "name").agg(F.max("scan_no").alias("_s1"))
    b = b.join(here, ["watch", "name"], "left")
    late = F.coalesce((F.col("scan_no") < F.col("_s0")) | (F.col("scan_no") <= F.col("_s1")), F.lit(False))
    fresh = b.filter(~late).select("watch", "name", "scan_no", "size",
                                   F.lit(None).cast("long").alias("_start"))
    last = F.max_by(F.struct("size", "cnt"), F.col("scan_no"))
    seeds = known.groupBy("watch", "name").agg(F.max("scan_no").alias("scan_no"), last.alias("_l")).select(
        "watch", "name", "scan_no", "_l.size", (F.col("scan_no") - F.col("_l.cnt") + 1).alias("_start"))
    rows = stability_counts(fresh.unionByName(seeds), start_col="_start")
    return (rows.filter(F.col("_start").isNull())
            .select("watch", "scan_no", "name", "size", F.col("count").cast("long"), F.lit(False).alias("late"))
            .unionByName(b.filter(late).select("watch", "scan_no", "name", "size",
                                               F.lit(None).cast("long").alias("count"),
                                               F.lit(True).alias("late"))))


def next_state(counted: DataFrame, state: DataFrame) -> DataFrame:
    """State after a batch: the files of each watch's two latest scans (the last
    one may go on in the next batch), and the number of the last.

    Built from the batch's counted rows (already written by the handler, so
    the run lengths are not recomputed) and the previous state.
    """
    fresh = counted.filter(~F.col("late")).select("watch", "name", "scan_no", "size",
                                                   F.col("count").alias("cnt"))
    rows = fresh.unionByName(state.select("watch", "name", "scan_no", "size", "cnt"))
    top = rows.groupBy("watch").agg(F.max("scan_no").alias("scan_no"))
    mark = top.select("watch", F.lit(None).cast("string").alias("name"), "scan_no",
                      F.lit(None).cast("long").alias("size"), F.lit(0).cast("long").alias("cnt"))
    live = rows.filter(F.col("name").isNotNull()).join(top.withColumnRenamed("scan_no", "_top"), "watch")
    live = live.filter(F.col("scan_no") >= F.col("_top") - 1)
    return live.select("watch", "name", "scan_no", "size", F.col("cnt").cast("long").alias("cnt")).unionByName(mark)


def state_table_handler(state_path: str, out_path: str):
    """``foreachBatch`` handler: read state v(n-1), write rows and state v(n).

    Both writes go to a folder of the batch id, so a retried batch recomputes
    from the same previous state and replaces its own output. Only the two
    newest state versions are kept. ``streaming.scans`` is the form for logs
    with manifests: there a scan counts once it is complete.
    """
    def handle(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        prev = read_table(spark, f"{state_path}/batch_id={batch_id - 1}", STATE_TABLE_SCHEMA, batch_id == 0)
        # a folder of its own, so that a batch without rows leaves its schema there
        advance_counts(df, prev).write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")
        written = spark.read.schema(OUTPUT_SCHEMA).parquet(f"{out_path}/batch_id={batch_id}")
        next_state(written, prev).write.mode("overwrite").parquet(f"{state_path}/batch_id={batch_id}")
        delete(spark, f"{state_path}/batch_id={batch_id - 2}")  # a retry of this batch needs n-1 only
    return handle
