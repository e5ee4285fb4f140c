"""Delivery: newest reference file (A2), best artifact per job (A3), artifact
and log existence (A4), delivery manifest (K4 + F10) and collision-free
target names (W4).

All arg-max steps are ``max_by`` over a struct that orders by the documented
keys and ends with a unique column, so results are deterministic and a job
or group with a very large number of files is combined map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.paths import ERROR_LOG_SUFFIX, target_name
from .intake import ledger_new_rows
from .ordering import row_number_within


def newest_reference(files: DataFrame) -> DataFrame:
    """A2: per group the file with the greatest (mtime, size, lower(name)); none -> no row."""
    order = F.struct("mtime", "size", F.lower("name"), "name")
    best = F.max_by(F.struct("name", "mtime", "size"), order)
    return files.groupBy("grp").agg(best.alias("_b")).select("grp", "_b.name", "_b.mtime", "_b.size")


def reference_file(files: DataFrame, grp: str) -> DataFrame:
    """A2 for one group as exactly one row (``file`` null when the group is empty).

    A global aggregate always yields one row, so joining it is a broadcast of
    a proven size.
    """
    order = F.struct("mtime", "size", F.lower("name"), "name")
    return files.filter(F.col("grp") == grp).agg(F.max_by("name", order).alias("file"))


def job_outputs(artifacts: DataFrame) -> DataFrame:
    """A3 + A4: per job the best artifact by (mtime, size) and the existence flags."""
    is_art, is_log = F.col("kind") == "artifact", F.col("kind") == "log"
    order = F.struct("mtime", "size", "path")
    best = F.max_by(F.when(is_art, F.struct("path", "mtime", "size")), F.when(is_art, order))
    return (artifacts.groupBy("job")
            .agg(best.alias("_b"),
                 F.max_by(F.when(is_log, F.col("path")), F.when(is_log, order)).alias("log"),
                 F.count_if(is_art).alias("n_artifacts"),
                 F.bool_or(is_art).alias("has_artifact"),
                 F.bool_or(is_log).alias("has_log"))
            .select("job", F.col("_b.path").alias("artifact"), F.col("_b.mtime").alias("artifact_mtime"),
                    F.col("_b.size").alias("artifact_size"), "log", "n_artifacts", "has_artifact", "has_log"))


def delivery_manifest(finished: DataFrame, final_root_col: str = "final_root") -> DataFrame:
    """K4 + F10: one row per target file; a later-finishing job overwrites an earlier one.

    ``finished(job, outcome, src_name, artifact, log, finished_ts, final_root)``:
    a delivered job's best artifact goes to ``<stem><artifact suffix>``, the log
    of a job that failed without one to ``<stem>.error.log``; other outcomes
    have no target.
    """
    ok, failed = F.col("outcome") == "delivered", F.col("outcome") == "failed_with_log"
    name = F.when(ok, target_name(F.col("src_name"), F.col("job"))) \
        .when(failed, target_name(F.col("src_name"), F.col("job"), ERROR_LOG_SUFFIX))
    tgt = F.concat(F.col(final_root_col), F.lit("/"), name)
    winner = F.max_by(F.struct("job", "file", "finished_ts"), F.struct("finished_ts", "job"))
    return (finished.withColumn("target", tgt).filter(F.col("target").isNotNull())
            .withColumn("file", F.when(ok, F.col("artifact")).otherwise(F.col("log"))).groupBy("target")
            .agg(winner.alias("_w"), F.count(F.lit(1)).alias("n_writers"))
            .select("target", F.col("_w.job").alias("job"), F.col("_w.file").alias("artifact"),
                    F.col("_w.finished_ts").alias("finished_ts"), "n_writers"))


def delivery_ledger(finished: DataFrame, ledger_lines: DataFrame) -> DataFrame:
    """K2 on delivery: source names of delivered jobs that the ledger doesn't
    hold yet, each once. ``finished(outcome, src_name)``."""
    names = finished.filter(F.col("outcome") == "delivered").select(F.col("src_name").alias("name"))
    return ledger_new_rows(names, ledger_lines)


def unique_names(requests: DataFrame, existing: DataFrame, run_ts_text: str) -> DataFrame:
    """Collision-free names ``base``, ``base-<ts>``, ``base-2``, ``base-3``, ...

    ``requests(base, req_id)`` are served in ``req_id`` order per base;
    ``existing(name)`` are names already taken. The i-th request gets the i-th
    free candidate. Free numeric suffixes are found without listing pairs:
    with the taken suffixes e_1 < e_2 < ... of a base, the j-th free number is
    j + 1 + #{m : e_m - m - 1 < j}; that count is a request's rank in the
    merged order of requests and taken suffixes minus its rank among requests.
    All ranks use ``row_number_within``, so one very common base is spread
    over many tasks.
    """
    req = row_number_within(requests.select("base", "req_id"), ["base"], ["req_id"], "i")
    stamped = F.concat(F.col("base"), F.lit("-" + run_ts_text))
    ex = existing.select("name").distinct()
    bases = requests.select("base").distinct()
    free0 = (bases
             .join(ex.withColumnRenamed("name", "base").withColumn("_b_taken", F.lit(True)), "base", "left")
             .join(ex.select(F.col("name").alias("_st")).withColumn("_s_taken", F.lit(True)),
                   F.concat(F.col("base"), F.lit("-" + run_ts_text)) == F.col("_st"), "left")
             .select("base", F.coalesce("_b_taken", F.lit(False)).alias("b_taken"),
                     F.coalesce("_s_taken", F.lit(False)).alias("s_taken")))
    suffix_rx = "^(.*)-([1-9][0-9]*)$"
    taken = (ex.select(F.regexp_extract("name", suffix_rx, 1).alias("base"),
                       F.regexp_extract("name", suffix_rx, 2).alias("n"))
             .filter(F.col("n") != "").select("base", F.col("n").cast("bigint").alias("e"))
             .filter(F.col("e") >= 2).join(bases, "base", "left_semi"))
    taken = row_number_within(taken, ["base"], ["e"], "m").withColumn("d", F.col("e") - F.col("m") - 1)
    first_two = F.when(~F.col("b_taken") & ~F.col("s_taken"), 2) \
        .when(~F.col("b_taken") | ~F.col("s_taken"), 1).otherwise(0)
    r = req.join(free0, "base").withColumn("j", F.col("i") - first_two)
    # requests sit at position j, taken suffixes at d + 0.5: no ties
    ev = (r.filter(F.col("j") > 0).select("base", "req_id", F.col("j").cast("double").alias("pos"), "j")
          .unionByName(taken.select("base", F.lit(None).cast("bigint").alias("req_id"),
                                    (F.col("d") + F.lit(0.5)).alias("pos"), F.lit(None).cast("bigint").alias("j"))))
    merged = row_number_within(ev, ["base"], ["pos"], "r")
    numbered = (merged.filter(F.col("req_id").isNotNull())
                .select("base", "req_id", (F.col("j") + 1 + (F.col("r") - F.col("j"))).alias("num")))
    named = r.join(numbered, ["base", "req_id"], "left")
    name = (F.when(F.col("j") > 0, F.concat(F.col("base"), F.lit("-"), F.col("num").cast("string")))
            .when((F.col("i") == 1) & ~F.col("b_taken"), F.col("base"))
            .otherwise(stamped))
    return named.select("req_id", "base", name.alias("name"))
