"""One scan of a watch folder as observations, and the scan-log writer.

``observe`` turns a listing (S1 or the listing source) into the rows one scan
contributes: include patterns (P1 J1 P3), ignore patterns (J2), sizes where a
``.d`` directory counts the files below it (A1, via an equi-join on the files'
enclosing directories), keyed by full path as the watcher keys its history.
``land_scan`` appends them to the scan log under ``scan_no=/watch=`` so a
repeated landing of the same scan replaces itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import parent_dirs
from ..session import delete
from .inventory import ignore_filter, include_filter


def observe(listing: DataFrame, include: dict[str, str], default: str, ignores: DataFrame | None = None,
            recursive: bool = False) -> DataFrame:
    """``(watch, rel, name, abs, is_dir, size)`` -> ``(watch, name, size)`` for one scan."""
    picked = include_filter(listing, include, default, recursive)
    if ignores is not None:
        picked = ignore_filter(picked, ignores)
    files = listing.filter(~F.col("is_dir"))
    wanted = picked.filter(F.col("is_dir")).select("watch", "rel")  # only picked directories need a size
    below = (files.select("watch", "size", F.explode(parent_dirs(F.col("rel"))).alias("rel"))
             .join(wanted, ["watch", "rel"], "left_semi")
             .groupBy("watch", "rel").agg(F.sum("size").cast("bigint").alias("_dsize")))
    sized = picked.join(below, ["watch", "rel"], "left")
    size = F.when(F.col("is_dir"), F.coalesce("_dsize", F.lit(0))).otherwise(F.col("size")).cast("bigint")
    return sized.select("watch", F.col("abs").alias("name"), size.alias("size"))


def land_scan(obs: DataFrame, path: str, scan_no: int, scan_ts: str, watches: list[str] | None = None) -> None:
    """Append one scan's observations to the scan log, and one row a watch to
    the log of scans beside it (``<path>_scans``), empty scans included.

    ``watches``: those that were scanned (default: those with rows). A scan that
    is landed again replaces all it had for them, also where it has no rows now.
    """
    spark = obs.sparkSession
    rows = obs.select("watch", "name", "size").withColumn("scan_ts", F.lit(scan_ts).cast("timestamp_ntz"))
    fixed = f"{path.rstrip('/')}_landing/scan_no={scan_no}"
    rows.write.mode("overwrite").parquet(fixed)  # a listing can't be read twice
    rows = spark.read.schema(rows.schema).parquet(fixed)
    n = rows.groupBy("watch").agg(F.count(F.lit(1)).alias("n_rows"))
    if watches is not None:
        n = spark.createDataFrame([(w,) for w in watches], "watch string").join(n, "watch", "left")
    n = (n.select("watch", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.lit(scan_ts).cast("timestamp_ntz").alias("scan_ts"))
         .withColumn("scan_no", F.lit(scan_no).cast("bigint")))
    for w in watches or []:
        delete(spark, f"{path.rstrip('/')}/scan_no={scan_no}/watch={partition_name(spark, w)}")
    (rows.withColumn("scan_no", F.lit(scan_no).cast("bigint"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("scan_no", "watch").parquet(path))
    (n.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("scan_no", "watch").parquet(f"{path.rstrip('/')}_scans"))
    delete(spark, fixed)


def partition_name(spark: SparkSession, value: str) -> str:
    """A value as Spark writes it in the name of a partition's folder."""
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)
