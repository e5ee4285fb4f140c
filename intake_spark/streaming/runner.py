"""Stream plumbing: interval trigger (T1), ``foreachBatch`` driver with the
pre-batch hook (X1), ledger de-duplication (T5) and the job-state stream (T6).

Sinks write under the shared checkpoint folder; every batch sink is keyed by
the batch id with dynamic partition overwrite, so a batch replayed after a
failure replaces its own output instead of appending twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.intake import append_ledger
from ..operators.jobs import return_code
from ..session import delete

MIN_TRIGGER_S = 1


def interval_trigger(interval_s: int | None) -> dict:
    """``processingTime`` of the watch interval, at least one second."""
    return {"processingTime": f"{max(MIN_TRIGGER_S, int(interval_s or 0))} seconds"}


def with_hook(handler: Callable[[DataFrame, int], None],
              before_batch: Callable[[DataFrame, int], None] | None = None):
    """Call ``before_batch`` first; its failures are swallowed, as a scan hook's are."""
    def run(df: DataFrame, batch_id: int) -> None:
        if before_batch is not None:
            try:
                before_batch(df, batch_id)
            except Exception:  # noqa: BLE001 - a hook must never stop the stream
                pass
        handler(df, batch_id)
    return run


def read_table(spark, path: str, schema: str, may_be_missing: bool) -> DataFrame:
    """A state or ledger table with a known schema. Only a path that isn't
    there yet, where the caller allows it, is an empty table; any other read
    error stops the batch."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if not may_be_missing or e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def ledger_dedup_handler(ledger_path: str, keys: tuple[str, ...] = ("name", "size")):
    """T5 as a ``foreachBatch`` handler: keys not yet in the ledger are appended.

    The ledger is a table, so de-duplication survives restarts and its state
    does not live in executor memory; a retried batch overwrites its own
    ``batch_id`` partition and never sees its own rows as already present.
    """
    schema = "name string, size long, batch_id long"

    def handle(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        ledger = read_table(spark, ledger_path, schema, True).filter(F.col("batch_id") != batch_id)
        new = df.select(*keys).dropDuplicates(list(keys)).join(ledger.select(*keys), list(keys), "left_anti")
        append_ledger(new, ledger_path, batch_id)
    return handle


def stream_dedup(df: DataFrame, keys: tuple[str, ...] = ("name", "size")) -> DataFrame:
    """T5, pure-stream form: first arrival of each key (state for the life of the query)."""
    return df.dropDuplicates(list(keys))


JOB_EVENT_SCHEMA = "job long, seq long, event string, ts timestamp_ntz, value string"


def job_state_stream(events: DataFrame) -> DataFrame:
    """T6 incremental: per-job aggregate in update mode (one row per changed job)."""
    def at(name: str):
        return F.max(F.when(F.col("event") == name, F.col("ts")))
    code = return_code()
    rc = F.max_by(code, F.when(code.isNotNull(), F.col("seq")))
    return events.groupBy("job").agg(
        at("ready").alias("ready_ts"), at("started").alias("started_ts"), at("finished").alias("finished_ts"),
        rc.alias("rc"), F.max(F.when(F.col("event") == "error", 1).otherwise(0)).alias("n_err"))


def versioned_sink_handler(path: str):
    """``foreachBatch`` sink for update-mode output: rows land under their batch id."""
    def handle(df: DataFrame, batch_id: int) -> None:
        (df.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(path))
    return handle


def latest_version(df: DataFrame, key: str = "job") -> DataFrame:
    """Current row per key from a versioned sink (highest batch id wins)."""
    cols = [c for c in df.columns if c not in (key, "batch_id")]
    w = F.max_by(F.struct(*cols), F.col("batch_id"))
    return df.groupBy(key).agg(w.alias("_v")).select(key, *[F.col(f"_v.{c}") for c in cols])


def fold_job_facts(rows: DataFrame, *more: Column) -> DataFrame:
    """Per-job facts from any number of versions of them, in any order. Every
    fact only grows, so an event that comes after its job has left the state
    adds to the job's earlier versions instead of replacing them. ``more`` are
    further aggregates."""
    return rows.groupBy("job").agg(
        F.max("ready_ts").alias("ready_ts"), F.max("started_ts").alias("started_ts"),
        F.max("finished_ts").alias("finished_ts"),
        F.max_by("rc", F.when(F.col("rc").isNotNull(), F.col("rc_seq"))).alias("rc"),
        F.max("rc_seq").alias("rc_seq"), F.max("n_err").alias("n_err"), *more)


JOB_STATE_SCHEMA = ("job long, ready_ts timestamp_ntz, started_ts timestamp_ntz, finished_ts timestamp_ntz, "
                    "rc long, rc_seq long, n_err int")


def merge_job_events(events: DataFrame, state: DataFrame) -> DataFrame:
    """T6 for one micro-batch: the merged facts of every job that the batch
    touches, from its new events and its in-flight row."""
    def at(name: str):
        return F.max(F.when(F.col("event") == name, F.col("ts")))
    code = return_code()
    code_seq = F.when(code.isNotNull(), F.col("seq"))
    fresh = events.groupBy("job").agg(
        at("ready").alias("ready_ts"), at("started").alias("started_ts"), at("finished").alias("finished_ts"),
        F.max_by(code, code_seq).alias("rc"), F.max(code_seq).alias("rc_seq"),
        F.max(F.when(F.col("event") == "error", 1).otherwise(0)).alias("n_err"))
    # the batch is read once: a job is touched if one of its rows comes from it
    rows = fresh.withColumn("new", F.lit(True)).unionByName(state.withColumn("new", F.lit(False)))
    changed = fold_job_facts(rows, F.bool_or("new").alias("new")).filter("new").drop("new")
    return changed


def next_job_state(changed: DataFrame, state: DataFrame) -> DataFrame:
    """The state after a batch: jobs that aren't final yet. ``changed`` is what
    the batch has written, so it isn't computed again."""
    final = (F.col("n_err") > 0) | F.col("rc").isNotNull()
    return (state.join(changed.select("job"), "job", "left_anti")
            .unionByName(changed.select(*state.columns).filter(~final)))


def job_state_table_handler(state_path: str, out_path: str):
    """``foreachBatch`` handler for T6 with bounded state (in-flight jobs only)."""
    def handle(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        prev = read_table(spark, f"{state_path}/batch_id={batch_id - 1}", JOB_STATE_SCHEMA, batch_id == 0)
        # a folder of its own, so that a batch without events leaves its schema there
        merge_job_events(df, prev).write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")
        written = spark.read.schema(JOB_STATE_SCHEMA).parquet(f"{out_path}/batch_id={batch_id}")
        next_job_state(written, prev).write.mode("overwrite").parquet(f"{state_path}/batch_id={batch_id}")
        delete(spark, f"{state_path}/batch_id={batch_id - 2}")  # a retry of this batch needs n-1 only
    return handle
