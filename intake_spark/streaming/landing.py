"""Scans of live folders landed as a log.

One batch of ``intake_scans`` is one attempt at every root. The batch is written
first, as a listing can't be repeated; what include and ignore patterns leave of
it becomes the observations ``log``, and ``scans`` says of every root whether the
attempt went well, with its number of rows: empty and failed attempts are rows.
Both are committed together. ``scan_log`` numbers the attempts that went well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.scan import observe
from ..operators.stability import number_scans
from .commits import BatchTables

LOG_SCHEMA = "watch string, attempt long, name string, size long"
SCANS_SCHEMA = "watch string, attempt long, status string, n_rows long, scan_ts timestamp_ntz, message string"


def landing_handler(root: str, include: dict[str, str], default: str, ignores: DataFrame | None = None, recursive: bool = False):
    """``foreachBatch`` handler for a stream of ``intake_scans``."""
    def handle(df: DataFrame, batch_id: int) -> None:
        tables = BatchTables(df.sparkSession, root)
        with tables.begin(batch_id) as step:
            if step is not None:
                listing = step.write("listing", df)
                per = listing.groupBy("watch").agg(F.max("scan_ts").alias("scan_ts"), F.max("error").alias("message"))
                failed = per.filter(F.col("message").isNotNull()).select("watch")
                entries = listing.filter(F.col("rel").isNotNull()).drop("scan_ts", "error").join(failed, "watch", "left_anti")
                attempt = F.lit(batch_id + 1).cast("long").alias("attempt")
                log = step.write("log", observe(entries, include, default, ignores, recursive).select("watch", attempt, "name", "size"))
                n = log.groupBy("watch").agg(F.count(F.lit(1)).alias("n"))
                ok = F.col("message").isNull()
                step.write("scans", per.join(n, "watch", "left").select(
                    "watch", attempt, F.when(ok, F.lit("ok")).otherwise(F.lit("error")).alias("status"),
                    F.when(ok, F.coalesce("n", F.lit(0))).cast("long").alias("n_rows"), "scan_ts", "message"))
        tables.sweep(batch_id, ("listing",), keep=1)
    return handle


def scans(tables: BatchTables) -> DataFrame:
    return tables.read("scans", SCANS_SCHEMA).drop("batch_id")


def scan_log(tables: BatchTables) -> DataFrame:
    """(watch, scan_no, scan_ts, name, size) of the attempts that went well."""
    ok = number_scans(scans(tables), "attempt").select("watch", "attempt", "scan_no", "scan_ts")
    return tables.read("log", LOG_SCHEMA).drop("batch_id").join(ok, ["watch", "attempt"]).select("watch", "scan_no", "scan_ts", "name", "size")
