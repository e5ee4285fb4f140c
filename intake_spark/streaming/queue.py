"""FIFO positions from an order index.

The queue lies in ranges of its order ``(ready_ts, job)``, each with its number
of jobs. A batch of arrivals and departures opens and writes only the ranges it
falls into; the others keep their folder and their count. A range that has grown
beyond ``2 * RANGE_JOBS`` is cut into ranges of ``RANGE_JOBS`` by ranks within it,
so a batch never sorts more than the ranges it touches. The position of a job is
the number of jobs in the ranges before its own, a prefix sum over the index, and
its rank in its range.

The index has one row a range (jobs / ``RANGE_JOBS``); the driver reads it to know
folders, and tasks find a key's range by a binary search in its sorted starts.
Arrivals of jobs that are there, and departures of jobs that aren't, change
nothing; a job that comes and goes in one batch is gone. A job's ready time
doesn't change.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordering import row_number_within
from ..session import delete
from .commits import BatchTables, names

RANGE_JOBS = 100_000
EVENT_SCHEMA = "ready_ts timestamp_ntz, job long, leaves boolean"
JOB_SCHEMA = "ready_ts timestamp_ntz, job long"
INDEX_SCHEMA = "lo_ts timestamp_ntz, lo_job long, n long, folder string"
KEY = ["ready_ts", "job"]


def read_index(tables: BatchTables, batch_id: int) -> list:
    """The ranges in order."""
    return sorted(tables.at("index", batch_id, INDEX_SCHEMA).collect(), key=lambda r: (r["lo_ts"], r["lo_job"]))


def in_range(jobs: DataFrame, index: list) -> DataFrame:
    """``jobs`` with ``at``, the place of their range in the index: the last
    range that begins at or before their key, or the first one."""
    starts = jobs.sparkSession.sparkContext.broadcast([(r["lo_ts"], r["lo_job"]) for r in index])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = [max(0, bisect_right(starts.value, k) - 1) for k in zip(b.column("ready_ts").to_pylist(), b.column("job").to_pylist())]
            yield b.append_column("at", pa.array(at, pa.int32()))

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in jobs.schema.fields)
    return jobs.mapInArrow(run, f"{fields}, at int")


def _open(tables: BatchTables, index: list, places: list[int]) -> DataFrame:
    """Jobs of some ranges, with ``at``."""
    folders = [index[i]["folder"] for i in places]
    if not folders:
        return tables.spark.createDataFrame([], f"{JOB_SCHEMA}, at int")
    place = F.create_map(*[F.lit(x) for i in places for x in (index[i]["folder"].rpartition("/")[2], i)])
    name = F.regexp_extract(F.input_file_name(), "/(range=[^/]+)/", 1)
    return tables.spark.read.schema(JOB_SCHEMA).parquet(*folders).withColumn("at", place[name].cast("int"))


def queue_handler(root: str, range_jobs: int = RANGE_JOBS):
    """``foreachBatch`` handler for a stream of ``EVENT_SCHEMA`` rows."""
    def handle(df: DataFrame, batch_id: int) -> None:
        spark, tables = df.sparkSession, BatchTables(df.sparkSession, root)
        replaced: list[str] = []
        with tables.begin(batch_id) as step:
            if step is not None:
                index = read_index(tables, batch_id - 1)
                events = df.groupBy(*KEY).agg(F.bool_or("leaves").alias("leaves"))
                events = step.write("events", in_range(events, index))
                touched = sorted(r["at"] for r in events.select("at").distinct().collect())  # at most one a range
                stay = [r for i, r in enumerate(index) if i not in set(touched)]
                old = _open(tables, index, [i for i in touched if i < len(index)])
                now = (old.withColumn("leaves", F.lit(False)).unionByName(events.select(*KEY, "at", "leaves"))
                       .groupBy("at", *KEY).agg(F.bool_or("leaves").alias("leaves")).filter(~F.col("leaves")).drop("leaves"))
                ranked = row_number_within(now, ["at"], KEY)
                n = ranked.groupBy("at").agg(F.count(F.lit(1)).alias("n"))
                cut = F.when(F.col("n") > 2 * range_jobs, F.floor((F.col("rn") - 1) / range_jobs)).otherwise(F.lit(0))
                name = F.concat(F.lit(f"{batch_id}-"), "at", F.lit("-"), cut.cast("string"))
                step.write("ranges", ranked.join(n, "at").select(*KEY, name.alias("range")).repartition("range"), ["range"])
                folder = tables.folder("ranges", batch_id, step.attempt)
                made = [f"{folder}/{x}" for x in names(spark, folder) if x.startswith("range=")]
                facts = []
                if made:
                    rows = spark.read.schema(JOB_SCHEMA).parquet(*made)
                    lo = F.min(F.struct(*KEY)).alias("lo")
                    facts = [(r["lo"]["ready_ts"], r["lo"]["job"], r["n"], f"{folder}/{r['range']}") for r in
                             rows.groupBy(F.regexp_extract(F.input_file_name(), "/(range=[^/]+)/", 1).alias("range"))
                             .agg(lo, F.count(F.lit(1)).alias("n")).collect()]
                step.write("index", spark.createDataFrame([tuple(r) for r in stay] + facts, INDEX_SCHEMA).coalesce(1))
                replaced = [index[i]["folder"] for i in touched if i < len(index)]
        tables.sweep(batch_id, ("events", "index"))
        for f in replaced:
            delete(spark, f)
    return handle


def positions(tables: BatchTables, jobs: DataFrame | None = None) -> DataFrame:
    """(ready_ts, job, position) of ``jobs`` (ready_ts, job), or of all jobs in
    the queue. Only the ranges that are asked for are opened."""
    done = tables.records()
    index = read_index(tables, done[-1]["batch_id"]) if done else []
    asked = list(range(len(index)))
    if jobs is not None:
        jobs = in_range(jobs.select(*KEY), index)
        asked = sorted(r["at"] for r in jobs.select("at").distinct().collect() if r["at"] < len(index))
    ahead, before = 0, []
    for i, r in enumerate(index):  # a row a range
        before.append((i, ahead))
        ahead += r["n"]
    offsets = tables.spark.createDataFrame(before, "at int, before long")
    rank = F.row_number().over(Window.partitionBy("at").orderBy(*KEY))  # of at most 2 * RANGE_JOBS jobs
    found = (_open(tables, index, asked).withColumn("rank", rank).join(offsets, "at")
             .select(*KEY, (F.col("before") + F.col("rank")).cast("long").alias("position")))
    return found if jobs is None else found.join(jobs.select(*KEY).distinct(), KEY, "left_semi")
