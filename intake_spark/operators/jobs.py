"""Job ledger: marker parsing (S5), status parsing (S6), life-cycle state and
durations (T6), required-input resolution (J7), outcome routing (J6 + P6),
run capacity (A5) and definition validation (P7).

Per-job steps are aggregations keyed by job (map-side combined); joins are on
the job key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.paths import effective_pattern, seconds_between

# Life-cycle marker names, outcome classes (first match wins)
# and status-line levels.
MARKER_READY, MARKER_WORKING, MARKER_FINISH, MARKER_ERROR = ".ready", ".working", ".finish", ".error"
OUTCOMES = ("pending", "missing_inputs", "start_failed", "bad_metadata", "delivered",
            "finished_no_artifact", "failed_with_artifact", "failed_with_log", "failed_no_log")
STATUS_LEVELS = ("RUN", "OK", "ERR", "WARN", "OUT")
LEVEL_RX = r"^\[(\w+)\] "
# a job reference is one word that ": " or " -> " follows; other lines are free text
REF_RX = r"^\[\w+\] ([^ :]+)(?:: | -> )"
ISO_RX = r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d$"
# Keys that a configuration must have (a deployment adds its own,
# such as the workflow's path), and its list of watches.
REQUIRED_KEYS = ("interval_minutes", "default_pattern")
PAIRS_KEY = "io_pairs"
TIMED = ("ready", "started", "finished")
EVENT_RX = r"^(\w+): (.*)$"


def parse_markers(markers: DataFrame) -> DataFrame:
    """``(job, text)`` -> ``job_events(job, seq, event, ts, value)``.

    Line 1 is the ready time; later lines are ``key: value``. A line of
    another form is left out, a value that is no time or number is null
    (``marker_errors`` lists both).
    """
    return _marker_lines(markers).filter(F.col("event") != "").drop("line")


def marker_errors(markers: DataFrame) -> DataFrame:
    """``(job, seq, line, problem)`` of marker lines that can't be read."""
    timed = F.col("event").isin(*TIMED) & F.col("ts").isNull()
    code = (F.col("event") == "returncode") & F.col("value").try_cast("bigint").isNull()
    problem = (F.when(F.col("event") == "", F.lit("not key: value")).when(timed, F.lit("not a time"))
               .when(code, F.lit("not a number")))
    return (_marker_lines(markers).withColumn("problem", problem).filter(F.col("problem").isNotNull())
            .select("job", "seq", "line", "problem"))


def _marker_lines(markers: DataFrame) -> DataFrame:
    lines = markers.select("job", F.posexplode(F.split(F.col("text"), "\n")).alias("seq", "line")) \
        .filter(F.col("line") != "")
    first = F.col("seq") == 0
    event = F.when(first, F.lit("ready")).otherwise(F.regexp_extract("line", EVENT_RX, 1))
    value = F.when(first, F.col("line")).otherwise(F.regexp_extract("line", EVENT_RX, 2))
    ev = lines.select("job", F.col("seq").cast("bigint").alias("seq"), event.alias("event"), value.alias("value"), "line")
    ts = F.when(F.col("event").isin(*TIMED) & F.col("value").rlike(ISO_RX), F.col("value").try_cast("timestamp_ntz"))
    return ev.withColumn("ts", ts)


def parse_marker_lines(lines: DataFrame) -> DataFrame:
    """S5 for markers that are read line by line: ``(job, pos, text)`` ->
    ``job_events``; ``seq`` is the line's position. A line that is a time alone is
    the ready time, as only a marker's first line is."""
    ready = F.col("text").rlike(ISO_RX)
    event = F.when(ready, F.lit("ready")).otherwise(F.regexp_extract("text", EVENT_RX, 1))
    value = F.when(ready, F.col("text")).otherwise(F.regexp_extract("text", EVENT_RX, 2))
    ev = lines.select("job", F.col("pos").alias("seq"), event.alias("event"), value.alias("value")).filter(F.col("event") != "")
    ts = F.when(F.col("event").isin(*TIMED) & F.col("value").rlike(ISO_RX), F.col("value").try_cast("timestamp_ntz"))
    return ev.select("job", "seq", "event", ts.alias("ts"), "value")


def return_code():
    """The return code of an event row; null for other events and for text that
    is no number (the last code that is one counts)."""
    return F.when(F.col("event") == "returncode", F.col("value").try_cast("bigint"))


def job_state(events: DataFrame) -> DataFrame:
    """Per job the state (ready -> working -> finish | error), times and durations."""
    def at(name: str):
        return F.max(F.when(F.col("event") == name, F.col("ts")))

    code = return_code()
    rc = F.max_by(code, F.when(code.isNotNull(), F.col("seq")))
    agg = events.groupBy("job").agg(
        at("ready").alias("ready_ts"), at("started").alias("started_ts"), at("finished").alias("finished_ts"),
        rc.alias("rc"),
        F.max(F.when(F.col("event") == "error", 1).otherwise(0)).alias("n_err"))
    return finalize_state(agg)


def finalize_state(agg: DataFrame) -> DataFrame:
    """T6 from per-job facts ``(job, ready_ts, started_ts, finished_ts, rc, n_err)``."""
    state = (F.when(F.col("n_err") > 0, F.lit("error"))
             .when(F.col("rc") == 0, F.lit("finish"))
             .when(F.col("rc").isNotNull(), F.lit("error"))
             .when(F.col("started_ts").isNotNull(), F.lit("working"))
             .otherwise(F.lit("ready")))
    return agg.select(
        "job", state.alias("state"), "ready_ts", "started_ts", "finished_ts", "rc",
        seconds_between(F.col("ready_ts"), F.col("started_ts")).alias("wait_s"),
        seconds_between(F.col("started_ts"), F.col("finished_ts")).alias("run_s"))


def parse_status(messages: DataFrame, col: str = "message") -> DataFrame:
    """``[LEVEL] <job>: ..`` or ``[LEVEL] <job> -> ..`` -> level and job
    reference; a free-form line keeps its level only."""
    return messages.select(
        F.regexp_extract(F.col(col), LEVEL_RX, 1).alias("level"),
        F.nullif(F.regexp_extract(F.col(col), REF_RX, 1), F.lit("")).alias("job_ref"),
        F.col(col).alias("message"))


def resolve_spec(jobs: DataFrame, spec_files: DataFrame) -> DataFrame:
    """The job's own spec if it exists, else the path recorded in its metadata.

    ``jobs(job, own_spec, meta_spec)``, ``spec_files(path)``; adds ``spec_path``
    (null = missing inputs).
    """
    files = spec_files.select("path").distinct()
    own = files.select(F.col("path").alias("own_spec"), F.col("path").alias("_own"))
    meta = files.select(F.col("path").alias("_mkey"), F.col("path").alias("_meta"))
    # jobs without a recorded path are spread by job: one null key would be one task's
    key = F.coalesce("meta_spec", F.concat(F.lit("\0"), F.col("job").cast("string")))
    return (jobs.join(own, "own_spec", "left").withColumn("_mkey", key).join(meta, "_mkey", "left")
            .withColumn("spec_path", F.coalesce("_own", "_meta")).drop("_own", "_meta", "_mkey"))


def classify(jobs: DataFrame) -> DataFrame:
    """Outcome class, final marker and whether the processed ledger is updated.

    Expects ``state, spec_path, launch_error, has_metadata, rc, has_artifact,
    has_log``; a job that never launched has no return code, whatever ``rc`` says.
    """
    rc = F.col("rc")
    art = F.coalesce("has_artifact", F.lit(False))
    log = F.coalesce("has_log", F.lit(False))
    outcome = (F.when(F.col("state").isin("ready", "working"), F.lit("pending"))
               .when(F.col("spec_path").isNull(), F.lit("missing_inputs"))
               .when(F.col("launch_error"), F.lit("start_failed"))
               .when(~F.col("has_metadata"), F.lit("bad_metadata"))
               .when((rc == 0) & art, F.lit("delivered"))
               .when(rc == 0, F.lit("finished_no_artifact"))
               .when(art, F.lit("failed_with_artifact"))
               .when(log, F.lit("failed_with_log"))
               .otherwise(F.lit("failed_no_log")))
    marker = (F.when(F.col("state") == "working", F.lit(MARKER_WORKING))
              .when(F.col("outcome") == "pending", F.lit(MARKER_READY))
              .when(F.col("outcome").isin("missing_inputs", "start_failed"), F.lit(MARKER_ERROR))
              .when(rc == 0, F.lit(MARKER_FINISH))
              .otherwise(F.lit(MARKER_ERROR)))
    launched = ~F.col("outcome").isin("pending", "missing_inputs", "start_failed")
    return (jobs.withColumn("outcome", outcome).withColumn("marker", marker)
            .withColumn("rc", F.when(launched, rc))
            .withColumn("ledger_updated", F.col("outcome") == "delivered"))


def free_capacity(states: DataFrame, max_parallel: int) -> DataFrame:
    """A5: one row ``(running, capacity)`` with capacity = max(0, max_parallel - running)."""
    return states.agg(F.count_if(F.col("state") == "working").alias("running")) \
        .select("running", F.greatest(F.lit(0), F.lit(max_parallel) - F.col("running")).alias("capacity"))


def validate_config(config: dict, required: tuple[str, ...] = REQUIRED_KEYS) -> list[str]:
    """P7 for the configuration itself (driver-side, before any definition is
    read): required keys and a non-empty list of watches."""
    problems = [f"missing_{k}" for k in required
                if config.get(k) is None or not str(config[k]).strip()]
    pairs = config.get(PAIRS_KEY)
    if not isinstance(pairs, list) or not pairs:
        problems.append("no_watches")
    return problems


def validate_definitions(defs: DataFrame, default_pattern: str) -> DataFrame:
    """P7 + F10: per definition the problems found and the effective settings."""
    checks = F.array(
        F.when(F.col("input").isNull() | (F.col("input") == ""), F.lit("missing_input")),
        F.when(F.col("output").isNull() | (F.col("output") == ""), F.lit("missing_output")),
        F.when(F.col("interval_minutes").isNull(), F.lit("interval_not_integer")),
        F.when(F.col("interval_minutes") < 0, F.lit("negative_interval")),
        F.when(F.lit(default_pattern.strip() == ""), F.lit("empty_default_pattern")),
    )
    errors = F.array_compact(checks)
    secs = F.col("interval_minutes").cast("bigint") * 60
    return defs.select(
        "watch_idx", "input", "output",
        effective_pattern(F.col("pattern"), F.lit(default_pattern)).alias("pattern"),
        secs.alias("interval_s"),
        F.greatest(F.lit(1), secs).alias("trigger_s"),
        F.array_join(errors, ",").alias("errors"),
        (F.size(errors) == 0).alias("is_valid"))
