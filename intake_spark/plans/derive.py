"""Relations of the intake model derived from the driver's test tables.

Every relation is a lazy DataFrame over the parquet tables, so its size grows
with them. The same derivation is restated in SQL in ``plans/oracle.py``.
Column pruning reaches the scans: each reader selects only what it uses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import iso_seconds, parent_dirs
from ..operators.stability import number_scans

# Fixed values of the derivations (FIXTURES.md section 3).
SIZE_DIVISOR = 50
DOC_SUFFIXES = ("_std.raw", ".raw", ".d/analysis.tdf")  # by doc_id % 3
WATCH_ROOT = "/data"
TMP_ROOT = "/srv/intake/tmp"
SHARED_ROOT = "/srv/intake/shared"
FINAL_ROOT = "/srv/intake/out"
WORKING_EVERY = 997  # open jobs with such a key are running
REFERENCE_EPOCH = "2024-01-01"
INPUT_ROOT = "/data/in"
CONFIG_ROOT = "/srv/intake/config"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --------------------------------------------------------------------------- scans

def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(watch, scan_day, name, size): one listing row per watch, user and day."""
    ev = table(spark, sf_dir, "events").select("event_type", "user_id", "ts", "value")
    return (ev.groupBy(F.col("event_type").alias("watch"),
                       F.col("user_id").cast("string").alias("name"),
                       F.to_date("ts").alias("scan_day"))
            .agg(F.floor(F.max("value") / SIZE_DIVISOR).cast("bigint").alias("size")))


def scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(watch, scan_day, scan_ts, status, scan_no): one row per watch and day."""
    # derived from the observation aggregate, so the plan shares its exchange
    s = (observations(spark, sf_dir).select("watch", "scan_day").distinct()
         .withColumn("scan_ts", F.col("scan_day").cast("timestamp_ntz"))
         .withColumn("status", F.lit("ok")))
    return number_scans(s, "scan_ts")


def scan_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(watch, scan_day, scan_ts, status, message): the scans, and a failed
    attempt at noon of every day whose number in the month is a multiple of 5."""
    ok = (observations(spark, sf_dir).select("watch", "scan_day").distinct()
          .withColumn("scan_ts", F.col("scan_day").cast("timestamp_ntz")))
    failed = (ok.filter(F.dayofmonth("scan_day") % 5 == 0)
              .withColumn("scan_ts", F.col("scan_ts") + F.make_dt_interval(hours=F.lit(12)))
              .withColumn("status", F.lit("error")).withColumn("message", F.lit("folder not reachable")))
    return ok.withColumn("status", F.lit("ok")).withColumn("message", F.lit(None).cast("string")).unionByName(failed)


def all_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(watch, scan_day, scan_ts, status, message, mid_day): the attempts, and a
    last one of each watch that finds an empty folder; ``mid_day`` halves them."""
    made = scan_attempts(spark, sf_dir)
    ends = made.groupBy("watch").agg(F.min("scan_day").alias("_a"), F.max("scan_day").alias("_b"))
    empty = ends.select("watch", F.date_add("_b", 1).alias("scan_day"), F.date_add("_b", 1).cast("timestamp_ntz").alias("scan_ts"),
                        F.lit("ok").alias("status"), F.lit(None).cast("string").alias("message"))
    mid = ends.select("watch", F.date_add("_a", F.floor(F.datediff("_b", "_a") / 2).cast("int")).alias("mid_day"))
    return made.unionByName(empty).join(mid, "watch")


def scan_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(watch, scan_no, scan_ts, name, size): the append-only observation log."""
    s = scans(spark, sf_dir).select("watch", "scan_day", "scan_no", "scan_ts")
    return (observations(spark, sf_dir).join(s, ["watch", "scan_day"])
            .select("watch", "scan_no", "scan_ts", "name", "size"))


# --------------------------------------------------------------------------- inventory

def doc_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(watch, doc_id, rel, size): one file per document under ``<lang>/``."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    suffix = (F.when(F.col("doc_id") % 3 == 0, F.lit(DOC_SUFFIXES[0]))
              .when(F.col("doc_id") % 3 == 1, F.lit(DOC_SUFFIXES[1]))
              .otherwise(F.lit(DOC_SUFFIXES[2])))
    return d.select(F.col("source").alias("watch"), "doc_id",
                    F.concat(F.col("lang"), F.lit("/"), F.col("doc_id").cast("string"), suffix).alias("rel"),
                    F.col("n_chars").alias("size"))


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(watch, rel, name, abs, is_dir, size): files plus every enclosing directory.

    Directory rows come from exploding each file's ancestor prefixes and a
    distinct (an aggregation with map-side combine); a directory's size is
    the sum of the files below it (A1 semantics for every directory).
    """
    f = doc_files(spark, sf_dir)
    dirs = (f.select("watch", "size",
                     F.explode(parent_dirs(F.col("rel"))).alias("rel"))
            .groupBy("watch", "rel").agg(F.sum("size").cast("bigint").alias("size"))
            .withColumn("is_dir", F.lit(True)))
    files = f.select("watch", "rel", "size", F.lit(False).alias("is_dir"))
    return (files.unionByName(dirs)
            .withColumn("name", F.regexp_extract("rel", "([^/]*)$", 1))
            .withColumn("abs", F.concat(F.lit(WATCH_ROOT + "/"), F.col("watch"), F.lit("/"), F.col("rel")))
            .select("watch", "rel", "name", "abs", "is_dir", "size"))


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(path, size): files inside ``run<orderkey>.d`` directories."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    sub = F.when(F.col("l_linenumber") % 2 == 0, F.lit("scans/")).otherwise(F.lit(""))
    return li.select(
        F.concat(F.lit("run"), F.col("l_orderkey").cast("string"), F.lit(".d/"), sub,
                 F.lit("f"), F.col("l_linenumber").cast("string"), F.lit(".bin")).alias("path"),
        F.col("l_quantity").cast("bigint").alias("size"))


def member_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(scan, path, size): the members as three scans see them; files come, go
    and grow between them."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    k, n, scan = F.col("l_orderkey"), F.col("l_linenumber"), F.col("scan")
    path = F.concat(F.lit("run"), k.cast("string"), F.lit(".d/f"), n.cast("string"), F.lit(".bin"))
    size = F.col("l_quantity").cast("bigint") + F.when(F.col("l_partkey") % 3 == 0, scan).otherwise(F.lit(0))
    return (li.withColumn("scan", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3)))).filter((k + n + scan) % 5 != 0)
            .groupBy("scan", path.alias("path")).agg(F.sum(size).cast("bigint").alias("size")))


# --------------------------------------------------------------------------- jobs

def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One job per order: ready time, return code, launch facts, source name."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate",
                                              "o_totalprice")
    k = F.col("o_orderkey")
    st = F.col("o_orderstatus")
    return o.select(
        k.alias("job"),
        F.col("o_custkey").alias("cust"),
        st.alias("status"),
        F.when(st != "O", F.lit("done")).when(k % WORKING_EVERY == 0, F.lit("working"))
        .otherwise(F.lit("ready")).alias("state"),
        F.col("o_orderdate").alias("ready_ts"),
        F.when(st == "F", F.lit(0)).when(st == "P", F.lit(1)).cast("bigint").alias("rc"),
        (k % 50 != 0).alias("has_spec"),
        (k % 50 != 1).alias("has_metadata"),
        ((st == "P") & (F.col("o_custkey") % 11 == 0)).alias("launch_error"),
        F.concat(F.lit("S"), F.col("o_custkey").cast("string"), F.lit("_std.raw")).alias("src_name"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("src_size"),
        F.concat(F.lit(TMP_ROOT + "/"), k.cast("string"), F.lit("/spec.json")).alias("own_spec"),
        F.when(k % 50 != 1, F.when(k % 3 == 0, F.concat(F.lit(SHARED_ROOT + "/"), k.cast("string"),
                                                        F.lit(".json")))
               .otherwise(F.concat(F.lit(TMP_ROOT + "/"), k.cast("string"), F.lit("/spec.json"))))
        .alias("meta_spec"),
    )


def spec_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(path): job spec files that exist (own specs, and shared copies for every third job)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    k = F.col("o_orderkey")
    own = F.when(k % 50 != 0, F.concat(F.lit(TMP_ROOT + "/"), k.cast("string"), F.lit("/spec.json")))
    shared = F.when(k % 3 == 0, F.concat(F.lit(SHARED_ROOT + "/"), k.cast("string"), F.lit(".json")))
    return o.select(F.explode(F.filter(F.array(own, shared), lambda x: x.isNotNull())).alias("path"))


def job_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(job, text): the marker file text each job leaves behind (S5 input)."""
    j = jobs(spark, sf_dir)
    k = F.col("job")
    started = F.col("ready_ts") + F.make_dt_interval(hours=(k % 7) + 1)
    finished = started + F.make_dt_interval(hours=(F.col("cust") % 5) + 1)
    launched = F.col("state") == "done"
    no_inputs = launched & ~(F.col("has_spec") | ((k % 3 == 0) & F.col("has_metadata")))
    lines = F.array(
        iso_seconds(F.col("ready_ts")),
        F.when(F.col("state") != "ready", F.concat(F.lit("started: "), iso_seconds(started))),
        F.when(no_inputs, F.lit("error: inputs incomplete")),
        F.when(launched & ~no_inputs, F.concat(F.lit("cmd: run -params-file "), F.lit(TMP_ROOT + "/"),
                                                k.cast("string"), F.lit("/spec.json"))),
        F.when(launched & ~no_inputs & F.col("launch_error"), F.lit("error: could not start")),
        F.when(launched & ~no_inputs & ~F.col("launch_error"),
               F.concat(F.lit("finished: "), iso_seconds(finished))),
        F.when(launched & ~no_inputs & ~F.col("launch_error"),
               F.concat(F.lit("returncode: "), F.col("rc").cast("string"))),
    )
    # lines that don't follow the format, as a crash or an editor leaves them
    odd = F.when(k % 43 == 0, F.lit("started: soon\nreturncode: None\n\nhalf a li"))
    return j.select(k, F.concat_ws("\n", F.array_join(F.filter(lines, lambda x: x.isNotNull()), "\n"), odd).alias("text"))


def job_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(job, template): a job template for every order, of its own size and
    content; every eleventh isn't JSON, every thirteenth is no object."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    k, job = F.col("o_orderkey"), F.col("o_orderkey").cast("string")
    q = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    items = F.transform(F.sequence(F.lit(0), (k % 4).cast("int")),
                        lambda i: F.when(i % 2 == 0, F.lit('"%%%FASTA%%%%"')).otherwise(q(F.concat(job, F.lit("-"), i.cast("string")))))
    text = F.concat(
        F.when(k % 3 == 0, F.lit('{"main_fasta_file": "%%%FASTA%%%", ')).otherwise(F.lit('{"main_fasta_file": ["old"], ')),
        F.lit('"job": '), job, F.lit(', "deep": {"list": ['), F.array_join(items, ", "),
        F.lit('], "inner": {"spike": "%%%SPIKE%%%", "note": '), q(F.concat(F.lit('say \\"%%%FASTA%%%\\" for '), "o_orderpriority")),
        F.lit('}, "size": '), F.col("o_totalprice").cast("string"), F.lit('}, "keys": {"%%%FASTA%%%": '), (k % 5).cast("string"), F.lit("}}"))
    return o.select(k.alias("job"), F.when(k % 11 == 0, F.substr(text, F.lit(1), F.length(text) - 2))
                    .when(k % 13 == 0, F.lit('["%%%FASTA%%%"]')).otherwise(text).alias("template"))


def marker_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(job, seq, line): the lines of every job's marker, in order."""
    return job_markers(spark, sf_dir).select("job", F.posexplode(F.split("text", "\n")).alias("seq", "line"))


def status_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(seq, message): the runner's status lines (S6 input)."""
    j = jobs(spark, sf_dir)
    k = F.col("job").cast("string")
    main = (F.when(F.col("status") == "F", F.concat(F.lit("[OK] "), k, F.lit(" -> .finish (rc=0)")))
            .when(F.col("status") == "P", F.concat(F.lit("[ERR] "), k, F.lit(" -> .error (rc=1)")))
            .when(F.col("state") == "working", F.concat(F.lit("[RUN] "), k, F.lit(": PID "), F.col("cust").cast("string"))))
    warn = F.when((F.col("status") != "O") & ~F.col("has_metadata"),
                  F.concat(F.lit("[WARN] "), k, F.lit(": no usable description, nothing delivered")))
    # free text: the words after the level are no job reference
    lost = F.when(F.col("job") % 37 == 0, F.concat(F.lit("[WARN] Lost the lock of "), k))
    retry = F.when(F.col("job") % 41 == 0, F.concat(F.lit("[ERR] Cleanup after "), k, F.lit(" gave up: disk full")))
    return (j.select(F.col("job"), F.explode(F.filter(F.array(main, warn, lost, retry), lambda x: x.isNotNull()))
                     .alias("message")))


def artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(job, kind, path, mtime, size): outputs ('artifact'), logs ('log') and
    whatever else ('other') lies in a job's folder."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_shipdate", "l_extendedprice")
    flag = F.col("l_returnflag")
    kind = F.when(flag == "R", F.lit("artifact")).when(flag == "A", F.lit("log")).otherwise(F.lit("other"))
    ext = F.when(flag == "R", F.lit(".hdf5")).when(flag == "A", F.lit(".log")).otherwise(F.lit(".tmp"))
    return li.select(
        F.col("l_orderkey").alias("job"), kind.alias("kind"),
        F.concat(F.lit(TMP_ROOT + "/"), F.col("l_orderkey").cast("string"), F.lit("/output/part"),
                 F.col("l_linenumber").cast("string"), ext).alias("path"),
        F.col("l_shipdate").alias("mtime"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("size"))


def reference_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(grp, name, mtime, size): candidate reference files, one group per brand."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    return p.select(F.col("p_brand").alias("grp"), F.col("p_name").alias("name"),
                    F.date_add(F.lit(REFERENCE_EPOCH).cast("date"), F.col("p_size"))
                    .cast("timestamp_ntz").alias("mtime"),
                    F.col("p_partkey").alias("size"))


def pattern_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    return p.select("p_partkey", F.concat(F.lit("*"), "p_type", F.lit(".raw,*"), "p_brand",
                                          F.lit(".d; *"), "p_type", F.lit(".raw")).alias("pattern"))


def definitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Watch definitions (S3 shape): one per supplier."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    return s.select(
        F.col("s_suppkey").alias("watch_idx"),
        F.concat(F.lit("/in/"), F.col("s_name")).alias("input"),
        F.when(F.col("s_nationkey") != 0, F.concat(F.lit("/out/n"), F.col("s_nationkey").cast("string")))
        .alias("output"),
        F.when(F.col("s_suppkey") % 5 == 0, F.lit("")).otherwise(
            F.concat(F.lit("*n"), F.col("s_nationkey").cast("string"), F.lit("std.raw"))).alias("pattern"),
        F.col("s_acctbal").cast("int").alias("interval_minutes"),
    )
