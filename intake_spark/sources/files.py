"""File-system sources (S1-S6) built on Spark readers.

S1 inventory: ``binaryFile`` with recursive lookup, selecting only path,
   time and length - the ``content`` column is pruned, no bytes are read.
   Spark's file sources skip names starting with ``.`` or ``_`` and never
   see empty directories; ``sources.listing`` covers those cases.
S2 ignore list: text lines, stripped, comments and blanks dropped.
S3 watch definitions: multi-line JSON with an explicit schema, one row per pair.
S4 job metadata: whole-file text parsed with an explicit schema; missing or
   corrupt -> null fields and ``valid = false``, never an error.
S5 job markers: whole-file text -> job events.
S6 status lines: one message per line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.jsonfmt import METADATA_SCHEMA
from ..functions.paths import parent_dirs
from ..operators.inventory import read_ignore_list  # noqa: F401  (S2 lives with the ignore filter)
from ..operators.jobs import parse_markers, parse_status

DEFINITIONS_SCHEMA = T.StructType([
    T.StructField("interval_minutes", T.StringType()),
    T.StructField("default_pattern", T.StringType()),
    T.StructField("io_pairs", T.ArrayType(T.StructType([
        T.StructField("input", T.StringType()),
        T.StructField("output", T.StringType()),
        T.StructField("pattern", T.StringType()),
    ]))),
])


def inventory_scan(spark: SparkSession, root: str, watch: str, path_glob: str | None = None) -> DataFrame:
    """``(watch, rel, name, abs, is_dir, size, mtime)`` for the files under ``root``.

    Enclosing directories are added from the file paths (sizes summed), which
    gives A1 sizes for every non-empty directory.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    files = reader.load(root).select("path", "modificationTime", "length")
    abs_ = F.regexp_replace("path", "^file:", "")
    rel = F.regexp_replace(F.col("path"), "^" + _rx_escape("file:" + root.rstrip("/")) + "/|^" +
                           _rx_escape(root.rstrip("/")) + "/", "")
    f = files.select(F.lit(watch).alias("watch"), rel.alias("rel"), abs_.alias("abs"),
                     F.col("length").alias("size"), F.col("modificationTime").cast("timestamp_ntz").alias("mtime"))
    dirs = (f.select("watch", "size", "mtime", F.explode(parent_dirs(F.col("rel"))).alias("rel"))
        .groupBy("watch", "rel").agg(F.sum("size").alias("size"), F.max("mtime").alias("mtime"))
        .withColumn("abs", F.concat(F.lit(root.rstrip("/") + "/"), F.col("rel"))))
    out = f.withColumn("is_dir", F.lit(False)).unionByName(dirs.withColumn("is_dir", F.lit(True)))
    return out.withColumn("name", F.regexp_extract("rel", "([^/]*)$", 1)) \
        .select("watch", "rel", "name", "abs", "is_dir", "size", "mtime")


def _rx_escape(s: str) -> str:
    return "".join(ch if ch.isalnum() else "\\" + ch for ch in s)


def read_definitions(spark: SparkSession, path: str) -> DataFrame:
    """S3: one row per watch pair, 1-based ``watch_idx``; fields kept as text for P7."""
    cfg = spark.read.option("multiLine", "true").schema(DEFINITIONS_SCHEMA).json(path)
    rows = cfg.select("interval_minutes", "default_pattern",
                      F.posexplode_outer("io_pairs").alias("pos", "pair"))
    return rows.select(
        (F.col("pos") + 1).cast("bigint").alias("watch_idx"),
        F.col("pair.input").alias("input"), F.col("pair.output").alias("output"),
        F.col("pair.pattern").alias("pattern"), F.col("default_pattern"),
        F.expr("try_cast(interval_minutes AS INT)").alias("interval_minutes"))


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """``(file, valid, meta)`` per metadata file; unreadable JSON -> valid false, meta null."""
    raw = spark.read.text(path, wholetext=True).select(
        F.input_file_name().alias("file"), F.col("value"))
    ok = F.coalesce(F.try_parse_json("value").isNotNull() & F.trim("value").startswith("{"), F.lit(False))
    return raw.select("file", ok.alias("valid"),
                      F.when(ok, F.from_json("value", METADATA_SCHEMA)).alias("meta"))


def read_markers(spark: SparkSession, path: str, job_rx: str = r"/([^/]+)/[^/]+$") -> DataFrame:
    """Marker files (visible names; Spark skips dot-files) -> job events; job = parent folder."""
    raw = spark.read.text(path, wholetext=True).select(
        F.regexp_extract(F.input_file_name(), job_rx, 1).alias("job"), F.col("value").alias("text"))
    return parse_markers(raw)


def read_status(spark: SparkSession, path: str) -> DataFrame:
    """Status lines -> level, job reference, message."""
    return parse_status(spark.read.text(path).withColumnRenamed("value", "message"))
