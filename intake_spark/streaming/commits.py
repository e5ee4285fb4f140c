"""Batches whose tables become visible together (K1-K3 of one step).

A batch writes each of its tables to a folder of its own try,
``<table>/batch_id=<n>/try_id=<id>``, and then one commit record,
``commits/<n>.json``, that names the try. The record appears whole, and only if
there is none for the batch yet, so of two writers of one batch one wins.
Readers take the tries that records name; what a lost run has written before its
record is never read, and ``sweep`` deletes it when the batch is committed. A batch that comes again after
its record does nothing.

    with tables.begin(batch_id) as step:      # None inside: committed already
        new = step.write("candidates", new)   # written, and read back
        step.write("ledger", new.select("name", "size"))

The record is written when the block ends without an exception.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from ..session import delete

RECORD_SCHEMA = "batch_id long, attempt string, tables array<string>"


def _path(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(spark._jsc.hadoopConfiguration())


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Make a small file whole, unless it is there already; whether it was made.
    Works on stores whose rename refuses an existing target (local, HDFS)."""
    jvm, target, fs = spark._jvm, *_path(spark, path)
    spare, _ = _path(spark, f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}")
    out = fs.create(spare, False)
    out.write(bytearray(text.encode()))
    out.close()
    refuse = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    refuse[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(spare, target, refuse)
    except Py4JJavaError as e:
        fs.delete(spare, False)
        if e.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
            raise
        return False
    return True


def exists(spark: SparkSession, path: str) -> bool:
    jpath, fs = _path(spark, path)
    return fs.exists(jpath)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of a folder's entries; none if it isn't there."""
    jpath, fs = _path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(jpath)) if fs.exists(jpath) else []


class Lost(RuntimeError):
    """Another writer has committed this batch."""


class Step:
    """One try of one batch."""

    def __init__(self, tables: "BatchTables", batch_id: int) -> None:
        self.tables, self.batch_id, self.attempt, self.written = tables, batch_id, f"t{uuid.uuid4().hex}", []

    def write(self, name: str, df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
        """Write a table of the batch (also an empty one), and read it back."""
        path = self.tables.folder(name, self.batch_id, self.attempt)
        schema = df.schema
        writer = df.write.partitionBy(*partition_by) if partition_by else df.write
        writer.parquet(path)
        self.written.append(name)
        return df.sparkSession.read.schema(schema).parquet(path)


class BatchTables:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def folder(self, name: str, batch_id: int, attempt: str) -> str:
        return f"{self.root}/{name}/batch_id={batch_id}/try_id={attempt}"

    def record(self, batch_id: int) -> str:
        return f"{self.root}/commits/{batch_id}.json"

    def has(self, batch_id: int) -> bool:
        return exists(self.spark, self.record(batch_id))

    @contextmanager
    def begin(self, batch_id: int) -> Iterator[Step | None]:
        """A try of the batch, committed at the end; None if it is committed already."""
        if self.has(batch_id):
            yield None
            return
        step = Step(self, batch_id)
        yield step
        text = json.dumps({"batch_id": batch_id, "attempt": step.attempt, "tables": step.written})
        if not put_if_absent(self.spark, self.record(batch_id), text):
            raise Lost(f"batch {batch_id} of {self.root} was committed by another writer")

    def records(self) -> list:
        """The committed batches in order: one small row a batch, read in tasks."""
        try:
            rows = self.spark.read.schema(RECORD_SCHEMA).json(f"{self.root}/commits")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":  # nothing committed yet
                raise
            return []
        return sorted(rows.collect(), key=lambda r: r["batch_id"])

    def read(self, name: str, schema: str) -> DataFrame:
        """A table's committed rows, with ``batch_id``."""
        paths = [self.folder(name, r["batch_id"], r["attempt"]) for r in self.records() if name in r["tables"]]
        if not paths:
            return self.spark.createDataFrame([], f"{schema}, batch_id long")
        return (self.spark.read.schema(f"{schema}, batch_id long, try_id string").option("basePath", f"{self.root}/{name}")
                .parquet(*paths).drop("try_id"))

    def winner(self, batch_id: int) -> str:
        """The try that a batch's record names; raises if there is no record."""
        jpath, fs = _path(self.spark, self.record(batch_id))
        stream = fs.open(jpath)
        raw = self.spark._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream)
        stream.close()
        return json.loads(bytes(raw))["attempt"]

    def at(self, name: str, batch_id: int, schema: str) -> DataFrame:
        """A table as one committed batch wrote it; empty before the first."""
        if batch_id < 0:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.folder(name, batch_id, self.winner(batch_id)))

    def sweep(self, batch_id: int, versions: tuple[str, ...] = (), keep: int = 2) -> None:
        """After a batch: delete its tries that lost, and of the state tables
        ``versions`` the batch that nothing reads any more."""
        won = self.winner(batch_id)
        for name in names(self.spark, self.root):
            if name in versions:
                delete(self.spark, f"{self.root}/{name}/batch_id={batch_id - keep}")
            for part in names(self.spark, f"{self.root}/{name}/batch_id={batch_id}"):
                if part != f"try_id={won}":
                    delete(self.spark, f"{self.root}/{name}/batch_id={batch_id}/{part}")
