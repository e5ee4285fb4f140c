"""Session and shared-folder helpers.

Nothing here tunes Spark beyond what a user sets on any batch job: AQE on
(runtime coalescing, skew-join splitting, runtime broadcast decisions), UTC
session time zone (all timestamps in the tables are zone-less), UI off.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of this package uses.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "intake_spark", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the package defaults."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a session with a local master may leave it unset (tests): then a
    folder is made, once a session, and removed with the process. On a cluster
    a missing setting is an error, as its machines share no local folder.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None) \
        or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        d = tempfile.mkdtemp(prefix="intake-ckpt-", dir="/tmp")
        atexit.register(shutil.rmtree, d, ignore_errors=True)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder (never reused)."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/intake-{name}-{uuid.uuid4().hex[:12]}"


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder or file, if it is there (Hadoop file system: any shared store)."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(jpath):
        fs.delete(jpath, True)


def local_path(p: str) -> str:
    """Strip a ``file:`` scheme for the few helpers that list local test folders."""
    if p.startswith("file:"):
        p = p[5:]
        while p.startswith("//"):
            p = p[1:]
    return os.path.abspath(p)
