"""Scan completeness for incremental stability.

A scan's rows may arrive in any number of batches, and so does its manifest:
``(watch, attempt, status, n_rows)``, one row an attempt, failed and empty ones
included. Attempts of a watch are numbered 1, 2, 3, ...; only those that went
well take a scan number. Rows and manifests wait in the state until the attempt
is complete (it failed, or as many different names are there as the manifest
says) and every attempt of the watch before it is settled. Then its rows are
counted by the same blocked W1 as in the batch form, and one event is written:
``snapshot``, ``empty`` or ``error``.

Both kinds of rows come in one stream, told apart by ``status``: null for an
observation. Rows of attempts that are settled already are replays: ``late``,
without a count. A name that comes twice in an attempt counts once (its largest
size). An attempt with more rows than its manifest says stops the batch.

State, one version a committed batch: what waits, each watch's mark (last
settled attempt and scan number), and the files of its last settled scan. Its
size is that of the open scans and one listing, whatever the history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.stability import MIN_STABLE_SCANS
from .commits import BatchTables
from .stability import STATE_TABLE_SCHEMA, advance_counts

INPUT_SCHEMA = ("watch string, attempt long, name string, size long, "
                "status string, n_rows long, scan_ts timestamp_ntz, message string")
PENDING_SCHEMA = "watch string, attempt long, name string, size long"
SCANS_SCHEMA = ("watch string, attempt long, status string, n_rows long, scan_ts timestamp_ntz, message string, "
                "n_seen long, settled boolean, scan_no long")
MARKS_SCHEMA = "watch string, attempt long, scan_no long"
COUNTS_SCHEMA = "watch string, attempt long, scan_no long, name string, size long, count long, late boolean"


class OverfullScan(RuntimeError):
    """More rows of a scan have come than its manifest says."""


def rows_of(observations: DataFrame) -> DataFrame:
    """(watch, attempt, name, size) in the stream's form."""
    none = {"status": "string", "n_rows": "long", "scan_ts": "timestamp_ntz", "message": "string"}
    return observations.select("watch", "attempt", "name", "size", *[F.lit(None).cast(t).alias(c) for c, t in none.items()])


def manifests_of(scans: DataFrame) -> DataFrame:
    """(watch, attempt, status, n_rows, scan_ts, message) in the stream's form."""
    return scans.select("watch", "attempt", F.lit(None).cast("string").alias("name"), F.lit(None).cast("long").alias("size"),
                        F.coalesce("status", F.lit("ok")).alias("status"), "n_rows", "scan_ts", "message")


def settle(rows: DataFrame, manifests: DataFrame, marks: DataFrame) -> DataFrame:
    """The waiting manifests with ``n_seen``, whether they are settled now, and
    their scan number. One row an open attempt; ``rows`` are counted by a
    map-side combined aggregate."""
    seen = rows.groupBy("watch", "attempt").agg(F.count(F.lit(1)).alias("n_seen"))
    m = marks.select("watch", F.col("attempt").alias("_done"), F.col("scan_no").alias("_scans"))
    open_ = (manifests.groupBy("watch", "attempt").agg(
        F.min("status").alias("status"), F.max("n_rows").alias("n_rows"), F.max("scan_ts").alias("scan_ts"), F.max("message").alias("message"))
        .join(seen, ["watch", "attempt"], "left").join(m, "watch", "left")
        .withColumn("n_seen", F.coalesce("n_seen", F.lit(0))))
    ok = F.col("status") == "ok"
    up_to = Window.partitionBy("watch").orderBy("attempt").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    complete = ~ok | (F.col("n_seen") == F.coalesce("n_rows", F.lit(0)))
    next_one = F.col("attempt") == F.coalesce("_done", F.lit(0)) + F.count(F.lit(1)).over(up_to)
    settled = F.min(complete).over(up_to) & next_one
    number = F.coalesce("_scans", F.lit(0)) + F.count_if(ok).over(up_to)
    return (open_.withColumn("settled", settled).withColumn("scan_no", F.when(F.col("settled") & ok, number))
            .select("watch", "attempt", "status", "n_rows", "scan_ts", "message", "n_seen", "settled", "scan_no"))


def _after(df: DataFrame, marks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of attempts that aren't settled yet, the others)."""
    m = marks.select("watch", F.col("attempt").alias("_done"))
    joined = df.join(m, "watch", "left")
    late = F.col("attempt") <= F.coalesce("_done", F.lit(0))
    return joined.filter(~late).drop("_done"), joined.filter(late).drop("_done")


def advance(step, batch: DataFrame, tables: BatchTables) -> None:
    """One micro-batch: from the state of the batch before to all its tables."""
    before = step.batch_id - 1
    marks = tables.at("marks", before, MARKS_SCHEMA)
    files = tables.at("files", before, STATE_TABLE_SCHEMA)
    was_open = tables.at("scans", before, SCANS_SCHEMA)
    gone = was_open.filter("settled").select("watch", "attempt")
    waiting = tables.at("pending", before, PENDING_SCHEMA).join(gone, ["watch", "attempt"], "left_anti")
    columns = ["watch", "attempt", "status", "n_rows", "scan_ts", "message"]

    fresh, replays = _after(batch.filter(F.col("status").isNull()).select("watch", "attempt", "name", "size"), marks)
    pending = step.write("pending", waiting.unionByName(fresh).groupBy("watch", "attempt", "name").agg(F.max("size").alias("size")))
    told, _ = _after(batch.filter(F.col("status").isNotNull()).select(*columns), marks)
    scans = step.write("scans", settle(pending, was_open.filter(~F.col("settled")).select(*columns).unionByName(told), marks))
    over = scans.filter((F.col("status") == "ok") & (F.col("n_seen") > F.coalesce("n_rows", F.lit(0)))).head()
    if over is not None:
        raise OverfullScan(f"{over['watch']}, attempt {over['attempt']}: {over['n_seen']} rows, {over['n_rows']} announced")

    done = scans.filter("settled")
    ready = pending.join(done.filter(F.col("scan_no").isNotNull()).select("watch", "attempt", "scan_no"), ["watch", "attempt"])
    counted = advance_counts(ready, files).filter(~F.col("late"))
    number = done.select("watch", "scan_no", "attempt")
    counts = step.write("counts", counted.join(number, ["watch", "scan_no"])
                        .select("watch", "attempt", "scan_no", "name", "size", "count", "late")
                        .unionByName(replays.select("watch", "attempt", F.lit(None).cast("long").alias("scan_no"), "name", "size",
                                                    F.lit(None).cast("long").alias("count"), F.lit(True).alias("late"))))
    marks = step.write("marks", done.select("watch", "attempt", "scan_no").unionByName(marks).groupBy("watch").agg(
        F.max("attempt").alias("attempt"), F.coalesce(F.max("scan_no"), F.lit(0).cast("long")).alias("scan_no")))
    live = (counts.filter(~F.col("late")).select("watch", "name", "scan_no", "size", F.col("count").alias("cnt"))
            .unionByName(files.select("watch", "name", "scan_no", "size", "cnt")))
    step.write("files", live.join(marks.select("watch", "scan_no"), ["watch", "scan_no"], "left_semi"))


def scan_handler(root: str):
    """``foreachBatch`` handler: counts, scans and state of a batch are
    committed together; a batch that comes again changes nothing."""
    def handle(df: DataFrame, batch_id: int) -> None:
        tables = BatchTables(df.sparkSession, root)
        with tables.begin(batch_id) as step:
            if step is not None:
                advance(step, df, tables)
        tables.sweep(batch_id, ("pending", "marks", "files"))
    return handle


def read_counts(tables: BatchTables) -> DataFrame:
    """All counted rows of the committed batches; late ones without a count."""
    return tables.read("counts", COUNTS_SCHEMA).drop("batch_id")


def read_events(tables: BatchTables, min_stable: int = MIN_STABLE_SCANS) -> DataFrame:
    """K1: one event a settled attempt, failed and empty ones included."""
    done = tables.read("scans", SCANS_SCHEMA).filter("settled").drop("batch_id")
    per = read_counts(tables).filter(~F.col("late")).groupBy("watch", "attempt").agg(
        F.count(F.lit(1)).alias("n_files"), F.count_if(F.col("count") >= min_stable).alias("n_candidates"),
        F.sum("count").alias("n_counts"))
    kind = (F.when(F.col("status") != "ok", F.lit("error")).when(F.coalesce("n_candidates", F.lit(0)) > 0, F.lit("snapshot"))
            .otherwise(F.lit("empty")))
    return done.join(per, ["watch", "attempt"], "left").select(
        "watch", "attempt", "scan_ts", kind.alias("kind"), "scan_no",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_files", "n_candidates", "n_counts")], "message")
