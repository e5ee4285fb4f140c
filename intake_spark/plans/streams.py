"""Registered streaming queries: land derived data, run the stream to the end
(``availableNow``), read the sink back. Each equals a batch query's SQL."""

from __future__ import annotations

import os

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import jsonfmt
from ..operators import jobs as jobs_ops
from ..session import local_path, scratch_path
from ..sources.growing import GrowingDataSource
from ..streaming import ledger as led
from ..streaming import queue, rollup, runner
from ..streaming import scans as scn
from ..streaming import stability as sst
from ..streaming.commits import BatchTables
from . import derive as D
from .queries import _content_candidates

LOG_SCHEMA = "watch string, scan_no long, name string, size long"
LANDINGS = 3        # the input lands in so many portions, each a micro-batch of its own
ROWS_A_FILE = 1000  # at least, so that every file of a portion gets rows


def _run(src: DataFrame, handler, base: str) -> None:
    """Run a stream over the landed files to its end."""
    q = (src.writeStream.foreachBatch(handler).option("checkpointLocation", f"{base}/ckpt")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def _land(portions: list[DataFrame], path: str) -> int:
    """Write the portions one after another, each as the same number of files;
    returns that number, for ``maxFilesPerTrigger``."""
    spark = portions[0].sparkSession
    least = min(p.count() for p in portions)
    files = max(1, min(spark.sparkContext.defaultParallelism, least // ROWS_A_FILE))
    for p in portions:
        p.repartition(files).write.mode("append").parquet(path)
    return files


def _split(df: DataFrame, part) -> list[DataFrame]:
    return [df.filter(part == i) for i in range(LANDINGS)]


def stream_stability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run lengths over the landed scan log, carried between micro-batches
    in a versioned state table (``foreachBatch``, JVM-side); candidates read back.
    The last landing repeats the scans of the first: replays count nothing."""
    base = scratch_path(spark, "stability")
    log = D.scan_log(spark, sf_dir).select("watch", "scan_no", "name", "size")
    log.write.parquet(f"{base}/all")
    log = spark.read.schema(LOG_SCHEMA).parquet(f"{base}/all")
    cut = log.groupBy("watch").agg(F.floor(F.max("scan_no") / 2).cast("bigint").alias("_cut"))
    tagged = log.join(cut, "watch").withColumn("_late", F.col("scan_no") > F.col("_cut")).drop("_cut")
    first, second = tagged.filter(~F.col("_late")).drop("_late"), tagged.filter("_late").drop("_late")
    files = _land([first, second, first], f"{base}/log")
    src = spark.readStream.schema(LOG_SCHEMA).option("maxFilesPerTrigger", files).parquet(f"{base}/log")
    _run(src, runner.with_hook(sst.state_table_handler(f"{base}/state", f"{base}/out")), base)
    return sst.stream_candidates(spark.read.schema(sst.OUTPUT_SCHEMA).parquet(f"{base}/out"))


def scan_parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(rows, manifests) of all scan attempts, failed ones, and an empty one
    after each watch's last, with the landing (0 to 3) that each comes in: the
    rows of a scan come in three landings, its manifest in one of these."""
    attempts = D.all_attempts(spark, sf_dir)
    late = (F.col("scan_day") > F.col("mid_day")).cast("int")
    number = F.row_number().over(Window.partitionBy("watch").orderBy("scan_ts")).cast("long")
    attempts = attempts.withColumn("attempt", number)
    obs = D.observations(spark, sf_dir)
    per = obs.groupBy("watch", "scan_day").agg(F.count(F.lit(1)).alias("n_rows"))
    manifests = attempts.join(per, ["watch", "scan_day"], "left").withColumn(
        "n_rows", F.when(F.col("status") == "ok", F.coalesce("n_rows", F.lit(0))))
    rows = (obs.join(attempts.filter(F.col("status") == "ok").select("watch", "scan_day", "mid_day", "attempt"), ["watch", "scan_day"])
            .withColumn("landing", late + F.pmod(F.xxhash64("name"), F.lit(3)).cast("int")))
    told = manifests.withColumn("landing", late + F.pmod("attempt", F.lit(3)).cast("int"))
    keep = ["landing"]
    return (rows.select(*keep, *[F.col(c) for c in ("watch", "attempt", "name", "size")]),
            told.select(*keep, "watch", "attempt", "status", "n_rows", "scan_ts", "message"))


def stream_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every scan comes in three batches and counts when its
    manifest is fulfilled; events of all attempts, failed and empty ones
    included. A hook before each batch lands how many rows it has."""
    base = scratch_path(spark, "scans")
    rows, told = scan_parts(spark, sf_dir)
    both = scn.rows_of(rows.drop("landing")).limit(0)
    for i in range(4):
        part = scn.rows_of(rows.filter(F.col("landing") == i)).unionByName(scn.manifests_of(told.filter(F.col("landing") == i)))
        part.coalesce(1).write.mode("append").parquet(f"{base}/in")
    src = spark.readStream.schema(both.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")

    def count_rows(df: DataFrame, batch_id: int) -> None:
        (df.groupBy("watch").agg(F.count(F.lit(1)).alias("n_rows")).write.mode("overwrite").parquet(f"{base}/seen/batch_id={batch_id}"))

    _run(src, runner.with_hook(scn.scan_handler(f"{base}/tables"), count_rows), base)
    events = scn.read_events(BatchTables(spark, f"{base}/tables"))
    seen = spark.read.schema("watch string, n_rows long, batch_id long").parquet(f"{base}/seen")
    landed = seen.groupBy("watch").agg(F.sum("n_rows").alias("n_landed"))
    return events.join(landed, "watch").select("watch", "attempt", "scan_ts", "kind", "scan_no", "n_files", "n_candidates", "n_counts", "message", "n_landed")


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate keys de-duplicated against a ledger whose buckets a batch opens in
    part; it is folded on the way."""
    base = scratch_path(spark, "dedup")
    keys = _content_candidates(spark, sf_dir).select("name", "size", "doc_id")
    files = _land([p.drop("doc_id") for p in _split(keys, F.pmod("doc_id", F.lit(LANDINGS)))], f"{base}/in")
    src = spark.readStream.schema("name string, size long").option("maxFilesPerTrigger", files).parquet(f"{base}/in")
    _run(src, runner.with_hook(led.dedup_handler(f"{base}/ledger", fold_every=2)), base)
    return led.Ledger(BatchTables(spark, f"{base}/ledger")).read()


CANDIDATE_SCHEMA = "name string, size long, watch string, watch_idx long, doc_id long"


def _job_specs(new: DataFrame) -> DataFrame:
    """(hash, json) of new jobs."""
    folder = F.concat(F.lit(D.TMP_ROOT + "/"), F.col("hash"))
    return new.select("hash", jsonfmt.fill_io(F.lit(jsonfmt.JOB_TEMPLATE), F.concat(folder, F.lit("/input")),
                                              F.concat(folder, F.lit("/output"))).alias("json"))


def _job_metadata(new: DataFrame) -> DataFrame:
    """F8: (hash, json) of new jobs."""
    source = F.struct(F.col("name"), F.concat(F.lit(D.INPUT_ROOT + "/"), F.col("watch"), F.lit("/"), F.col("name")).alias("absolute_path"),
                      F.col("size").alias("size_bytes"), F.lit(False).alias("is_dir"))
    return new.select("hash", jsonfmt.metadata_json(F.struct("hash", source.alias("source"))).alias("json"))


def stream_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: directory sizes after three scans, kept up from the changes between
    them; a batch opens the sums of the directories that it touches."""
    base = scratch_path(spark, "rollup")
    D.member_scans(spark, sf_dir).write.partitionBy("scan").parquet(f"{base}/scans")
    seen = spark.read.schema("path string, size long, scan int").parquet(f"{base}/scans")
    handler = runner.with_hook(rollup.rollup_handler(f"{base}/tables"))
    for scan in range(1, 4):
        change = rollup.scan_changes(*[seen.filter(F.col("scan") == s) for s in (scan - 1, scan)])
        change.write.mode("append").parquet(f"{base}/changes")
        _run(spark.readStream.schema(rollup.CHANGE_SCHEMA).parquet(f"{base}/changes"), handler, base)
    return rollup.read_sums(BatchTables(spark, f"{base}/tables"))


def stream_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jobs come into the queue and leave it in three batches; positions are
    read from the order index, which the batches change only where they fall."""
    base = scratch_path(spark, "queue")
    states = jobs_ops.job_state(jobs_ops.parse_markers(D.job_markers(spark, sf_dir))).select("job", "ready_ts", "state")
    landing = F.pmod("job", F.lit(LANDINGS))
    comes = states.select("ready_ts", "job", F.lit(False).alias("leaves"), landing.alias("landing"))
    goes = states.filter("state <> 'ready'").select("ready_ts", "job", F.lit(True).alias("leaves"),
                                                    F.least(landing + F.pmod("job", F.lit(2)), F.lit(LANDINGS - 1)).alias("landing"))
    comes.unionByName(goes).write.partitionBy("landing").parquet(f"{base}/all")
    events = spark.read.schema(f"{queue.EVENT_SCHEMA}, landing long").parquet(f"{base}/all")
    handler = runner.with_hook(queue.queue_handler(f"{base}/tables", RANGE_JOBS))
    for part in _split(events, F.col("landing")):
        part.drop("landing").write.mode("append").parquet(f"{base}/in")
        _run(spark.readStream.schema(queue.EVENT_SCHEMA).parquet(f"{base}/in"), handler, base)
    return queue.positions(BatchTables(spark, f"{base}/tables"))


RANGE_JOBS = 2000
JOBS_A_FILE = 2000


def _growing_files(lines: DataFrame, folder: str, n_files: int, upto: int) -> None:
    """Write files of ``job<TAB>line`` rows with the lines of the first ``upto``
    of ``LANDINGS`` parts; each call makes the files longer. All but the last
    call leave half a line at the end. A task writes one file at a time."""
    os.makedirs(folder, exist_ok=True)

    def write(key, group):
        group = group.sort_values(["part", "job", "seq"])
        text = "".join(f"{j}\t{x}\n" for j, x in zip(group["job"], group["line"])).encode()
        name = f"{folder}/markers-{key[0]}.txt"
        with open(f"{name}.part", "wb") as f:
            f.write(text if upto == LANDINGS else text[:-4])
        os.replace(f"{name}.part", name)
        return pd.DataFrame({"n": [len(group)]})

    part = F.least(F.floor(F.col("seq") / 2), F.lit(LANDINGS - 1)).cast("int")
    (lines.withColumn("part", part).filter(F.col("part") < upto).withColumn("file", F.pmod("job", F.lit(n_files)))
     .groupBy("file").applyInPandas(write, "n long").agg(F.sum("n")).collect())


def stream_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marker files that grow between batches, read from where the last
    batch ended, half lines held back; folded into job states."""
    base = scratch_path(spark, "markers")
    folder = local_path(f"{base}/files")
    spark.dataSource.register(GrowingDataSource)
    lines = D.marker_lines(spark, sf_dir)
    lines.write.parquet(f"{base}/lines")
    lines = spark.read.schema(lines.schema).parquet(f"{base}/lines")
    n_files = 1 + lines.filter("seq = 0").count() // JOBS_A_FILE
    handler = runner.job_state_table_handler(f"{base}/state", f"{base}/out")
    for upto in range(1, LANDINGS + 1):
        _growing_files(lines, folder, n_files, upto)
        rows = spark.readStream.format("intake_growing").option("path", folder).option("suffix", ".txt").load()
        parts = F.split("line", "\t", 2)
        # a job's lines are in order in its file; its first is the ready time
        marked = rows.select(parts[0].cast("long").alias("job"), "pos", parts[1].alias("text"))
        _run(jobs_ops.parse_marker_lines(marked), runner.with_hook(handler), base)
    facts = spark.read.schema(runner.JOB_STATE_SCHEMA).parquet(f"{base}/out")
    return jobs_ops.finalize_state(runner.fold_job_facts(facts))


def stream_intake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates come in three landings, the stream
    starting anew for each; candidates, specs, metadata and ledger lines of a
    batch are committed together and read back."""
    base = scratch_path(spark, "intake")
    cands = _content_candidates(spark, sf_dir).drop("processed")
    handler = led.intake_handler(f"{base}/tables", ["watch_idx", "doc_id"], {"specs": _job_specs, "metadata": _job_metadata}, fold_every=2)
    for part in _split(cands, F.pmod("doc_id", F.lit(LANDINGS))):
        part.select("name", "size", "watch", "watch_idx", "doc_id").write.mode("append").parquet(f"{base}/in")
        _run(spark.readStream.schema(CANDIDATE_SCHEMA).parquet(f"{base}/in"), runner.with_hook(handler), base)
    tables = BatchTables(spark, f"{base}/tables")
    new = tables.read("candidates", f"{CANDIDATE_SCHEMA}, hash string")
    spec = tables.read("specs", "hash string, json string").select("hash", F.get_json_object("json", "$.main_input_folder").alias("input_folder"))
    meta = tables.read("metadata", "hash string, json string").select(
        "hash", F.get_json_object("json", "$.source.absolute_path").alias("source_path"))
    known = led.Ledger(tables).read()
    return (new.join(spec, "hash").join(meta, "hash").join(known, ["name", "size"], "left_semi")
            .select("name", "size", "watch", "doc_id", "hash", "input_folder", "source_path", "batch_id"))


def stream_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job events folded into per-job facts in ``foreachBatch``; final jobs leave the
    state table; all versions of every job are folded and finalised."""
    base = scratch_path(spark, "jobs")
    events = jobs_ops.parse_markers(D.job_markers(spark, sf_dir)).select("job", "seq", "event", "ts", "value")
    # out of order: a job's return code may land before its start and finish
    files = _land(_split(events, F.pmod(F.xxhash64("job", "seq"), F.lit(LANDINGS))), f"{base}/events")
    src = spark.readStream.schema(runner.JOB_EVENT_SCHEMA).option("maxFilesPerTrigger", files).parquet(f"{base}/events")
    _run(src, runner.with_hook(runner.job_state_table_handler(f"{base}/state", f"{base}/out")), base)
    facts = spark.read.schema(runner.JOB_STATE_SCHEMA).parquet(f"{base}/out")
    return jobs_ops.finalize_state(runner.fold_job_facts(facts))
