"""Files in the cluster's shared folder, opened from tasks."""

from __future__ import annotations

import uuid

from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI that executors can reach (file, hdfs, s3, gs)."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def write_file(uri: str, name: str, payload: bytes) -> None:
    """Write whole or not at all: a retried or doubled task replaces the file
    with the same bytes under the same name."""
    fs, root = open_fs(uri)
    tmp = f"{root}/.{name}.{uuid.uuid4().hex}"
    with fs.open_output_stream(tmp) as out:
        out.write(payload)
    fs.move(tmp, f"{root}/{name}")


def read_file(uri: str, name: str) -> bytes:
    fs, root = open_fs(uri)
    with fs.open_input_stream(f"{root}/{name}") as f:
        return f.read()


def make_folder(uri: str) -> None:
    fs, root = open_fs(uri)
    fs.create_dir(root, recursive=True)


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts the
    lineage, and survives lost executors."""
    path = scratch_path(spark, name)
    schema = df.schema
    df.write.parquet(path)
    out = spark.read.schema(schema).parquet(path)
    out.stored_path = path
    return out


def drop_stored(df: DataFrame) -> None:
    """Delete a table of ``stored`` that nothing reads any more."""
    path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.stored_path)
    path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
