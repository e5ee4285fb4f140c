"""Registered queries: test tables -> derivation -> operator(s).

Each function takes ``(spark, sf_dir)`` and returns a lazy DataFrame whose
column names match the SQL of the same key in ``plans/oracle.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.patterns import normalize_patterns
from ..functions import jsonfmt
from ..functions import paths as P
from ..operators import delivery, intake, ordering
from ..operators import jobs as jobs_ops
from ..operators import inventory as inv_ops
from ..operators import prefix
from ..operators import stability as st
from ..session import scratch_path
from . import derive as D


# --------------------------------------------------------------------------- stability

def stable_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (watch, scan, name) that is a candidate, with its count and key."""
    counted = st.stability_counts(D.scan_log(spark, sf_dir))
    return st.stable_candidates(counted).select("watch", "scan_no", "name", "size", "hash", "count")


def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each watch's snapshot at its latest scan, presented by name."""
    counted = st.stability_counts(D.scan_log(spark, sf_dir))
    cands = st.stable_candidates(counted)
    latest = st.latest_scans(D.scans(spark, sf_dir))
    snap = st.snapshot_at(cands, latest)
    # counts come from their own aggregate: a window would gather a watch's
    # whole scan in one task
    n = snap.groupBy("watch").agg(F.count(F.lit(1)).alias("n_in_snapshot"))
    return (snap.join(n, "watch").select("watch", "scan_no", "name", "size", "hash", "count", "n_in_snapshot")
            .orderBy("watch", F.lower("name"), "name"))


def scan_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: files and candidates per scan, scans without candidates kept."""
    counted = st.stability_counts(D.scan_log(spark, sf_dir))
    return st.scan_counts(D.scans(spark, sf_dir), counted)


def scan_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 T4: snapshot, empty and error events of every scan attempt."""
    cands = st.stable_candidates(st.stability_counts(D.scan_log(spark, sf_dir)))
    return st.scan_events(D.scan_attempts(spark, sf_dir), cands)


# --------------------------------------------------------------------------- inventory

# The include configuration of the test watches (per-watch
# pattern strings, the default for all others) and the user-written ignore list.
INCLUDE_DEFAULT = "*_std.raw"
INCLUDE_CONFIG = {
    "src1": "*.d, de/*.raw",
    "src2": "*/1?.raw | es ; *.tdf",
    "src3": "[!e]*/*[05].raw",
    "src4": "**/analysis.tdf",
    "src5": "",
}  # src6 and later aren't listed: the default holds
IGNORE_TEXT = [
    "# ignore list for all watches",
    "",
    "*.tdf",
    "fr/*",
    "   # indented comment",
    "*1_std.raw",
    "en/4?.raw",
    "/data/src3/*",
    "[!a-z]*9.d",
    "de/1[0-5]*",
    "  en/7.raw  ",
    "/data/src5/es",
    "zz_unused.raw",
    "*.tdf",
    "[z-a]*",
]


def include_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries matching their watch's include patterns (recursive)."""
    inv = D.inventory(spark, sf_dir)
    return inv_ops.include_filter(inv, INCLUDE_CONFIG, INCLUDE_DEFAULT, recursive=True) \
        .select("watch", "rel", "name", "is_dir")


def processed_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger lines: the source name of every labelled (already processed) document."""
    f = D.doc_files(spark, sf_dir)
    lab = D.table(spark, sf_dir, "labels").select("doc_id")
    src = F.when(F.col("doc_id") % 3 == 2, F.concat(F.col("doc_id").cast("string"), F.lit(".d"))) \
        .otherwise(F.regexp_extract("rel", "([^/]*)$", 1))
    # names with wildcard characters: a ledger is no pattern list
    odd = F.concat(F.lit("["), F.substring(src, 1, 1), F.lit("]*"))
    return (f.join(lab, "doc_id", "left_semi")
            .select(F.explode(F.array(src, odd)).alias("pattern")))


def ignore_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inventory minus everything an ignore pattern matches."""
    user = inv_ops.clean_ignore_lines(spark.createDataFrame([(x,) for x in IGNORE_TEXT], "value string"))
    return inv_ops.ignore_filter(D.inventory(spark, sf_dir), user, processed_names(spark, sf_dir)).select("watch", "rel", "name", "is_dir")


def dir_size_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: every run directory with the total size of the files below it (empty -> 0)."""
    o = D.table(spark, sf_dir, "orders").select(
        F.concat(F.lit("run"), F.col("o_orderkey").cast("string"), F.lit(".d")).alias("dir"))
    return inv_ops.dir_size_rollup(D.members(spark, sf_dir), o)


def last_wins_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Basename-keyed listing where the last path in lower-case order wins."""
    li = D.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    name = F.concat(F.lit("p"), F.col("l_partkey").cast("string"), F.lit(".raw"))
    run = F.when(F.col("l_orderkey") % 2 == 0, F.lit("Run")).otherwise(F.lit("run"))
    listing = li.select(name.alias("name"),
                        F.concat(run, F.col("l_orderkey").cast("string"), F.lit("/"), name).alias("rel"),
                        F.col("l_quantity").cast("bigint").alias("size"))
    return inv_ops.listing_order(inv_ops.last_wins(listing))


def pattern_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pattern strings -> one row per normalised pattern with its position."""
    p = D.pattern_strings(spark, sf_dir)
    return p.select("p_partkey", F.posexplode(normalize_patterns(F.col("pattern"))).alias("pos", "pattern")) \
        .select("p_partkey", F.col("pos").cast("bigint").alias("pos"), "pattern")


# --------------------------------------------------------------------------- intake

def row_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row key, resolved path, basename, stem and slug per source."""
    f = D.doc_files(spark, sf_dir)
    folder = F.concat(F.lit(D.WATCH_ROOT + "/"), F.col("watch"))
    src_rel = F.regexp_replace("rel", "/analysis\\.tdf$", "")
    name = F.when(F.col("doc_id") % 2 == 0, src_rel).otherwise(F.concat(folder, F.lit("/"), src_rel))
    t = f.select("doc_id", "size", folder.alias("folder"), name.alias("name"))
    abs_ = P.resolve(F.col("name"), F.col("folder"))
    return t.select("doc_id", "name", "size",
                    P.row_key(F.col("name"), F.col("size")).alias("key"),
                    abs_.alias("abs"),
                    P.basename(abs_).alias("base"),
                    P.stem(P.basename(abs_)).alias("stem"),
                    P.slug(F.col("name")).alias("slug"))


def _content_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates keyed by content: ``(name, size, watch, watch_idx, doc_id, processed)``.

    ``processed`` marks documents already in the ledger (ids in ``labels``).
    """
    d = D.table(spark, sf_dir, "documents").select("doc_id", "source", "text", "n_chars")
    lab = D.table(spark, sf_dir, "labels").select("doc_id").distinct().withColumn("processed", F.lit(True))
    c = d.select(F.concat(F.md5("text"), F.lit(".raw")).alias("name"),
                 F.col("n_chars").alias("size"), F.col("source").alias("watch"),
                 F.regexp_extract("source", "([0-9]+)$", 1).cast("bigint").alias("watch_idx"), "doc_id")
    return (c.join(lab, "doc_id", "left")
            .select("name", "size", "watch", "watch_idx", "doc_id",
                    F.coalesce("processed", F.lit(False)).alias("processed")))


def unprocessed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One candidate per (name, size) - first watch wins - minus the processed ledger.

    The ledger here is derived from the same documents, so the anti-join is
    fused into the first-per-key aggregate: the text is read and hashed once.
    """
    cands = _content_candidates(spark, sf_dir)
    first = intake.first_unprocessed(cands, ["name", "size"], ["watch_idx", "doc_id"], "processed")
    return first.select("name", "size", "watch", "doc_id")


def still_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jobs whose source directory is still in the inventory."""
    o = D.table(spark, sf_dir, "orders").select("o_orderkey")
    jobs = o.select(F.col("o_orderkey").alias("job"),
                    F.concat(F.lit(D.WATCH_ROOT + "/run"), F.col("o_orderkey").cast("string"), F.lit(".d"))
                    .alias("abs"))
    li = D.table(spark, sf_dir, "lineitem").select("l_orderkey")
    inv = li.select(F.concat(F.lit(D.WATCH_ROOT + "/run"), F.col("l_orderkey").cast("string"), F.lit(".d"))
                    .alias("abs"))
    return intake.still_exists(jobs, inv)


LEDGER_HEADER = ["# processed files", ""]


def ledger_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: names of this batch that the ledger does not hold yet (each once)."""
    cands = _content_candidates(spark, sf_dir)
    # the ledger here comes from the same documents, so both sides are one
    # aggregate: a name is new if none of its rows is processed
    old = F.bool_or(F.col("processed"))
    names = cands.groupBy("name").agg(old.alias("_old")).filter(~F.col("_old")).select("name")
    return intake.ledger_new_rows(names, spark.createDataFrame([(x,) for x in LEDGER_HEADER], "value string"))


# Mount roots of the test deployment (host and host/language prefixes).
ROOTS = [
    "blog.tionsh.example.com",
    "blog.tionsh.example.com/en",
    "tionble.example.org/",
    "m.ththth.example.net/en",
    "m.ththth.example.net/fr/",
    "www.ththon.example.org/de",
    "ththan.example.com",
    "nothing.example.com",
    "blog.tionsh.example.net",
    "blog.tionsh.example.net/en",
    "blog.tiontion.example.com/en/",
    "thther.example.org",
    "www.ththhe.example.com/en",
    "m.tionsh.example.net",
    "thther.example.com",
]


def prefix_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page path paired with every root that contains it."""
    pages = D.table(spark, sf_dir, "pages").select("page_id", "url")
    paths = pages.select("page_id", F.regexp_extract("url", "^[a-z]+://([^?#]*)", 1).alias("path"))
    roots = spark.createDataFrame([(r,) for r in ROOTS], "root string")
    return prefix.enclosing_roots(paths, roots).select("page_id", "path", "root")


# --------------------------------------------------------------------------- jobs

MAX_PARALLEL = 25
DEFAULT_PATTERN = "*std.raw"


def _job_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = jobs_ops.resolve_spec(D.jobs(spark, sf_dir), D.spec_files(spark, sf_dir))
    outs = delivery.job_outputs(D.artifacts(spark, sf_dir))
    return j.join(outs, "job", "left")


def job_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome class, marker and ledger flag per job."""
    c = jobs_ops.classify(_job_facts(spark, sf_dir))
    return c.select("job", "outcome", "marker", "ledger_updated", "rc", "spec_path")


def job_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marker text -> events -> state, times, wait and run seconds per job."""
    ev = jobs_ops.parse_markers(D.job_markers(spark, sf_dir))
    return jobs_ops.job_state(ev)


def _ready_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    st_ = jobs_ops.job_state(jobs_ops.parse_markers(D.job_markers(spark, sf_dir)))
    return st_.filter(F.col("state") == "ready").select("job", "ready_ts")


def queue_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FIFO position of every ready job by (ready time, job). The ready jobs
    are written once: the ranges are sampled and sorted from there."""
    ready, path = _ready_jobs(spark, sf_dir), scratch_path(spark, "ready")
    ready.write.parquet(path)
    return ordering.global_row_number(spark.read.schema(ready.schema).parquet(path), ["ready_ts", "job"])


def dispatch_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O3 A5: the oldest ready jobs, as many as there is free capacity."""
    states = jobs_ops.job_state(jobs_ops.parse_markers(D.job_markers(spark, sf_dir)))
    ready = states.filter(F.col("state") == "ready").select("job", "ready_ts")
    oldest = ordering.top_k(ready, ["ready_ts", "job"], MAX_PARALLEL)
    return oldest.filter(F.col("position") <= jobs_ops.free_capacity(states, MAX_PARALLEL).select("capacity").scalar())


def status_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Level and job reference of every status line."""
    return jobs_ops.parse_status(D.status_messages(spark, sf_dir))


def definition_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validation problems and effective settings per watch definition."""
    return jobs_ops.validate_definitions(D.definitions(spark, sf_dir), DEFAULT_PATTERN)


# --------------------------------------------------------------------------- delivery

def newest_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: newest reference file per group."""
    return delivery.newest_reference(D.reference_files(spark, sf_dir))


def best_artifact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3 A4: best artifact (by mtime, size) and artifact/log presence per job."""
    return delivery.job_outputs(D.artifacts(spark, sf_dir))


def delivery_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target file per delivered or failed job; later finishers overwrite earlier ones."""
    facts = jobs_ops.classify(_job_facts(spark, sf_dir))
    times = job_timeline(spark, sf_dir).select("job", "finished_ts")
    root = F.concat(F.lit(D.FINAL_ROOT + "/c"), (F.col("cust") % 10).cast("string"))
    d = facts.join(times, "job").select("job", "outcome", "src_name", "artifact", "log", "finished_ts",
                                        root.alias("final_root"))
    return delivery.delivery_manifest(d)


def delivery_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger rows for delivered jobs; every ninth job's source is in the ledger already."""
    facts = jobs_ops.classify(_job_facts(spark, sf_dir))
    done = D.jobs(spark, sf_dir).filter(F.col("job") % 9 == 0).select(F.col("src_name").alias("value"))
    header = spark.createDataFrame([(x,) for x in LEDGER_HEADER], "value string")
    return delivery.delivery_ledger(facts, header.unionByName(done))


# --------------------------------------------------------------------------- job spec / metadata

FASTA_GROUP, SPIKE_GROUP = "Brand#1", "Brand#2"
WATCH_INTERVAL_S = 600
RUN_STAMP = "20240101-000000"


def _reference_paths(spark: SparkSession, sf_dir: str):
    """Scalar sub-queries: newest FASTA and spike-in files (one value each, or null)."""
    refs = D.reference_files(spark, sf_dir)
    fasta = delivery.reference_file(refs, FASTA_GROUP).select(
        F.concat(F.lit(D.CONFIG_ROOT + "/fasta/"), F.col("file"), F.lit(".fasta")).alias("f"))
    spike = delivery.reference_file(refs, SPIKE_GROUP).select(
        F.concat(F.lit(D.CONFIG_ROOT + "/spike/"), F.col("file"), F.lit(".csv")).alias("f"))
    return fasta.scalar(), spike.scalar()


SPEC_FIELDS = ("main_input_folder string, main_outdir string, main_fasta_file string, main_spike_file string, "
               "lookup struct<table: string, hint: string, main_fasta_file: string>, "
               "labels struct<tags: array<string>>, retry struct<attempts: bigint>")


def job_spec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job spec JSON per job; fields read back from the written text.

    F7 depends only on per-run values (the newest reference files), so it is
    applied once to the template - a one-row scalar sub-query - and each job
    row only fills its own input/output placeholders (F6).
    """
    fasta, spike = _reference_paths(spark, sf_dir)
    tmpl = spark.range(1).select(F.lit(jsonfmt.JOB_TEMPLATE).alias("spec"), fasta.alias("_fasta"),
                                 spike.alias("_spike"))
    tmpl = jsonfmt.fill_reference(tmpl, "spec", F.col("_fasta"), jsonfmt.FASTA_PHS, "main_fasta_file")
    tmpl = jsonfmt.fill_reference(tmpl, "spec", F.col("_spike"), jsonfmt.SPIKE_PHS, "main_spike_file")
    j = D.jobs(spark, sf_dir).select("job")
    base = F.concat(F.lit(D.TMP_ROOT + "/"), F.col("job").cast("string"))
    spec = jsonfmt.fill_io(tmpl.select("spec").scalar(), F.concat(base, F.lit("/input")),
                           F.concat(base, F.lit("/output")))
    s = j.select("job", F.from_json(spec, SPEC_FIELDS).alias("s"))
    return s.select("job", "s.main_input_folder", "s.main_outdir", "s.main_fasta_file", "s.main_spike_file",
                    F.col("s.lookup.table").alias("spike_table"),
                    F.col("s.lookup.hint").alias("hint"),
                    F.col("s.lookup.main_fasta_file").alias("nested_fasta"),
                    F.array_join("s.labels.tags", "|").alias("tags"),
                    F.col("s.retry.attempts").alias("attempts"))


TEMPLATE_FIELDS = ("main_fasta_file string, main_spike_file string, job bigint, deep struct<list: array<string>, "
                   "inner: struct<spike: string, note: string>, size: double>")


def job_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every job has a nested template of its own, some no JSON; fields
    read back from the filled text."""
    fasta, spike = _reference_paths(spark, sf_dir)
    j = D.job_templates(spark, sf_dir).select("job", "template", fasta.alias("_fasta"), spike.alias("_spike"))
    spec = jsonfmt.set_reference(F.col("template"), F.col("_fasta"), jsonfmt.FASTA_PHS, jsonfmt.FASTA_KEY)
    j = j.withColumn("spec", spec)
    j = j.withColumn("spec", jsonfmt.set_reference(F.col("spec"), F.col("_spike"), jsonfmt.SPIKE_PHS, jsonfmt.SPIKE_KEY))
    s = j.select("job", (F.col("spec") == F.col("template")).alias("unchanged"), F.from_json("spec", TEMPLATE_FIELDS).alias("s"),
                 F.get_json_object("spec", "$.keys").alias("keys"))
    return s.select("job", "unchanged", "s.main_fasta_file", "s.main_spike_file", F.col("s.job").alias("own_job"),
                    F.array_join("s.deep.list", "|").alias("list"), F.col("s.deep.inner.spike").alias("spike"),
                    F.col("s.deep.inner.note").alias("note"), F.col("s.deep.size").alias("size"), "keys")


def job_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata JSON for every new job hash (existing ones kept); fields read back."""
    fasta, spike = _reference_paths(spark, sf_dir)
    j = D.jobs(spark, sf_dir)
    src_abs = F.concat(F.lit(D.INPUT_ROOT + "/"), F.col("src_name"))
    j = j.withColumn("hash", P.row_key(src_abs, F.col("src_size")))
    hdir = F.concat(F.lit(D.TMP_ROOT + "/"), F.col("hash"))
    final_root = F.concat(F.lit(D.FINAL_ROOT + "/c"), (F.col("cust") % 10).cast("string"))
    thread_ignore = F.concat(F.lit(D.TMP_ROOT + "/ignore-"), P.slug(F.lit(D.INPUT_ROOT)), F.lit("-"),
                             P.slug(F.lit(DEFAULT_PATTERN)), F.lit(".txt"))
    watch = F.when(F.col("job") % 4 != 0, F.struct(
        F.lit(D.INPUT_ROOT).alias("input_root"), final_root.alias("final_output_root"),
        F.lit(DEFAULT_PATTERN).alias("pattern"), F.lit(WATCH_INTERVAL_S).alias("interval_seconds"),
        F.array(thread_ignore, F.concat(final_root, F.lit("/ignore.txt"))).alias("ignore_files")))
    meta = F.struct(
        F.col("hash"), P.iso_seconds(F.col("ready_ts")).alias("created_at"),
        F.struct(hdir.alias("hash_dir"), F.concat(hdir, F.lit("/input")).alias("tmp_input_dir"),
                 F.concat(hdir, F.lit("/output")).alias("tmp_output_dir"),
                 F.concat(hdir, F.lit("/spec.json")).alias("spec_json"), src_abs.alias("source_file"))
        .alias("paths"),
        F.struct(F.col("src_name").alias("name"), src_abs.alias("absolute_path"),
                 F.col("src_size").alias("size_bytes"), F.lower("src_name").endswith(".d").alias("is_dir"))
        .alias("source"),
        F.struct(F.lit(D.CONFIG_ROOT + "/fasta").alias("dir"), fasta.alias("file")).alias("fasta"),
        F.struct(F.lit(D.CONFIG_ROOT + "/spike").alias("dir"), spike.alias("file")).alias("spike"),
        watch.alias("watch"))
    docs = j.select("job", "hash", "status", jsonfmt.metadata_json(meta).alias("json"))
    existing = docs.filter(F.col("status") == "F").select("hash")
    new = intake.keep_new(intake.first_per_key(docs.drop("status"), ["hash"], ["job"]), existing)
    m = new.select("job", F.from_json("json", jsonfmt.METADATA_SCHEMA).alias("m"))
    ign = F.col("m.watch.ignore_files")
    ledger = F.element_at(F.filter(ign, lambda x: x.endswith("ignore.txt")), -1)
    return m.select(
        F.col("m.hash").alias("hash"), "job", F.col("m.created_at").alias("created_at"),
        F.col("m.source.name").alias("source_name"), F.col("m.source.size_bytes").alias("size_bytes"),
        F.col("m.watch").isNotNull().alias("has_watch"),
        F.col("m.watch.final_output_root").alias("final_root"), F.col("m.fasta.file").alias("fasta_file"),
        F.when(ign.isNotNull(), F.size(ign)).otherwise(F.lit(0)).cast("bigint").alias("n_ignore_files"),
        F.when(F.col("m.watch").isNotNull(),
               F.coalesce(ledger, F.concat(F.col("m.watch.final_output_root"), F.lit("/ignore.txt"))))
        .alias("ledger_file"))


def unique_target_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collision-free output names for every part, given the names already taken."""
    p = D.table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    req = p.select(F.col("p_name").alias("base"), F.col("p_partkey").alias("req_id"))
    existing = (p.filter(F.col("p_size") % 10 == 3)
                .select(F.concat("p_name", F.lit("-"), F.col("p_size").cast("string")).alias("name"))
                .unionByName(p.filter(F.col("p_size") == 50).select(F.col("p_name").alias("name")))
                .unionByName(p.filter(F.col("p_size") == 49)
                             .select(F.concat("p_name", F.lit("-" + RUN_STAMP)).alias("name"))))
    return delivery.unique_names(req, existing, RUN_STAMP)


def stable_candidates_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 P4 incrementally: history up to each watch's middle scan, then the rest advanced
    from the per-file state table (the daily-job form: old scans are never re-read)."""
    from ..streaming.stability import advance_counts
    log = D.scan_log(spark, sf_dir).select("watch", "scan_no", "name", "size")
    cut = D.scans(spark, sf_dir).groupBy("watch").agg(F.floor(F.max("scan_no") / 2).cast("bigint").alias("_cut"))
    tagged = log.join(cut, "watch")
    older = tagged.filter(F.col("scan_no") <= F.col("_cut")).drop("_cut")
    newer = tagged.filter(F.col("scan_no") > F.col("_cut")).drop("_cut")
    first = st.stability_counts(older)
    state = (first.join(cut, "watch").filter(F.col("scan_no") == F.col("_cut"))
             .select("watch", "name", "scan_no", "size", F.col("count").alias("cnt")))
    rest = advance_counts(newer, state)
    both = first.select("watch", "scan_no", "name", "size", "count").unionByName(
        rest.filter(~F.col("late")).select("watch", "scan_no", "name", "size", "count"))
    return st.stable_candidates(both).select("watch", "scan_no", "name", "size", "hash", "count")
