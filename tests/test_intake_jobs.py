"""Intake, job ledger and delivery operators on hand-written rows and brute force."""
import random

from pyspark.sql import functions as F  # noqa: F811

from pyspark.sql import functions as F

from intake_spark.operators import delivery, intake, jobs, ordering


def test_ledger_append_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "ledger")
    batch = spark.createDataFrame([(" a.raw",), ("b.raw",), ("b.raw",), ("",)], "name string")
    header = spark.createDataFrame([("# processed",), ("",), ("c.raw",)], "value string")
    new = intake.ledger_new_rows(batch, header)
    assert sorted(r.name for r in new.collect()) == ["a.raw", "b.raw"]
    intake.append_ledger(new, path, 0)
    intake.append_ledger(new, path, 0)  # a retried batch replaces itself
    assert spark.read.parquet(path).count() == 2
    lines = spark.read.parquet(path).select(F.col("name").alias("value")).unionByName(header)
    assert intake.ledger_new_rows(batch, lines).count() == 0  # second run adds nothing


def test_first_per_key_is_order_exact(spark):
    rows = [("n", 1, "w2", 2, 10), ("n", 1, "w1", 1, 11), ("n", 1, "w1", 1, 9), ("m", 2, "w3", 3, 1)]
    df = spark.createDataFrame(rows, "name string, size long, watch string, watch_idx long, doc_id long")
    got = {(r.name, r.size): (r.watch, r.doc_id)
           for r in intake.first_per_key(df, ["name", "size"], ["watch_idx", "doc_id"]).collect()}
    assert got == {("n", 1): ("w1", 9), ("m", 2): ("w3", 1)}


def test_global_row_number_equals_window(spark):
    rnd = random.Random(5)
    rows = [(i, rnd.randint(0, 50)) for i in range(3000)]
    df = spark.createDataFrame(rows, "job long, t long")
    got = {r.job: r.position for r in ordering.global_row_number(df, ["t", "job"], num_partitions=7).collect()}
    want = {job: i + 1 for i, (job, _) in enumerate(sorted(rows, key=lambda r: (r[1], r[0])))}
    assert got == want


def _unique_names_model(requests, existing, stamp):
    taken, out = set(existing), {}
    for base, rid in sorted(requests, key=lambda r: r[1]):
        cands = [base, f"{base}-{stamp}"]
        name = next((c for c in cands if c not in taken), None)
        i = 2
        while name is None:
            if f"{base}-{i}" not in taken:
                name = f"{base}-{i}"
            i += 1
        taken.add(name)
        out[rid] = name
    return out


def test_unique_names_equals_sequential_model(spark):
    rnd = random.Random(7)
    bases = ["x", "y", "z"]
    requests = [(rnd.choice(bases), i) for i in range(60)]
    existing = ["x", "x-3", "x-4", "x-7", "y-TS", "y-2", "z-02", "z-5"]
    got = {r.req_id: r.name for r in delivery.unique_names(
        spark.createDataFrame(requests, "base string, req_id long"),
        spark.createDataFrame([(e,) for e in existing], "name string"), "TS").collect()}
    assert got == _unique_names_model(requests, existing, "TS")


def test_every_outcome_class(spark):
    cols = "job long, state string, spec_path string, launch_error boolean, has_metadata boolean, " \
           "rc long, has_artifact boolean, has_log boolean"
    rows = [
        (1, "ready", "s", False, True, None, None, None),
        (2, "done", None, False, True, 0, True, True),
        (3, "done", "s", True, True, 1, None, None),
        (4, "done", "s", False, False, 0, True, False),
        (5, "done", "s", False, True, 0, True, False),
        (6, "done", "s", False, True, 0, False, False),
        (7, "done", "s", False, True, 1, True, True),
        (8, "done", "s", False, True, 1, False, True),
        (9, "done", "s", False, True, 1, None, None),
        (10, "working", "s", False, True, None, None, None),
    ]
    got = {r.job: (r.outcome, r.marker, r.ledger_updated)
           for r in jobs.classify(spark.createDataFrame(rows, cols)).collect()}
    assert got == {
        1: ("pending", ".ready", False), 2: ("missing_inputs", ".error", False),
        3: ("start_failed", ".error", False), 4: ("bad_metadata", ".finish", False),
        5: ("delivered", ".finish", True), 6: ("finished_no_artifact", ".finish", False),
        7: ("failed_with_artifact", ".error", False), 8: ("failed_with_log", ".error", False),
        9: ("failed_no_log", ".error", False), 10: ("pending", ".working", False)}


def test_marker_parse_and_state(spark):
    text = "2024-01-01T00:00:00\nstarted: 2024-01-01T01:00:00\ncmd: run x\nfinished: 2024-01-01T03:30:00\nreturncode: 0"
    ev = jobs.parse_markers(spark.createDataFrame([(1, text), (2, "2024-01-02T00:00:00")], "job long, text string"))
    st = {r.job: r for r in jobs.job_state(ev).collect()}
    assert (st[1].state, st[1].wait_s, st[1].run_s, st[1].rc) == ("finish", 3600, 9000, 0)
    assert (st[2].state, st[2].started_ts) == ("ready", None)


def test_malformed_marker_lines_are_reported(spark):
    text = ("2024-01-01T00:00:00\nstarted: garbage\nreturncode: None\nhalf a li\nfinished: 2024-13-01T00:00:00\n"
            "started: 2024-01-01T01:00:00")
    m = spark.createDataFrame([(1, text), (2, "not a time"), (3, "")], "job long, text string")
    st = {r.job: r for r in jobs.job_state(jobs.parse_markers(m)).collect()}
    assert (st[1].state, st[1].rc, st[1].wait_s, st[1].finished_ts) == ("working", None, 3600, None)
    assert (st[2].state, st[2].ready_ts) == ("ready", None) and 3 not in st
    bad = sorted((r.job, r.seq, r.problem) for r in jobs.marker_errors(m).collect())
    assert bad == [(1, 1, "not a time"), (1, 2, "not a number"), (1, 3, "not key: value"), (1, 4, "not a time"),
                   (2, 0, "not a time")]


def test_status_parse_levels(spark):
    msgs = ["[OK] abc -> .finish (rc=0)", "[ERR] abc: job spec missing", "[WARN] Finalization for x failed: y",
            "[RUN] h1: PID 7", "[OUT] h2: a.hdf5 -> /o/a.hdf5", "[WARN] Lost .ready of abc", "no level"]
    got = [(r.level, r.job_ref) for r in jobs.parse_status(
        spark.createDataFrame([(m,) for m in msgs], "message string")).collect()]
    assert got == [("OK", "abc"), ("ERR", "abc"), ("WARN", None), ("RUN", "h1"), ("OUT", "h2"),
                   ("WARN", None), ("", None)]


def test_keep_if_exists_writer(spark, tmp_path):
    from pyspark.sql import functions as F
    path = str(tmp_path / "specs")
    docs = spark.createDataFrame([("h1", 1), ("h2", 2), ("h1", 3)], "hash string, v long")
    docs = docs.withColumn("json", F.to_json(F.struct("hash", "v")))
    assert intake.write_keep_if_exists(docs, path) == 2
    assert intake.write_keep_if_exists(docs, path) == 0
    more = spark.createDataFrame([("h3", 9)], "hash string, v long").withColumn("json", F.to_json(F.struct("hash", "v")))
    assert intake.write_keep_if_exists(more, path) == 1
    assert sorted(r.hash for r in spark.read.json(path).collect()) == ["h1", "h2", "h3"]


def test_subpath_predicate_equals_prefix_join(spark):
    from intake_spark.functions.paths import is_subpath
    from intake_spark.operators.prefix import enclosing_roots
    paths = spark.createDataFrame([(1, "a/b/c"), (2, "a/bc"), (3, "a"), (4, "x/a/b"), (5, "a/b/")],
                                  "id long, path string")
    roots = spark.createDataFrame([("a/b",), ("a",), ("a/b/",), ("x",), ("zz",)], "root string")
    via_join = {(r.id, r.root) for r in enclosing_roots(paths, roots).collect()}
    via_pred = {(r.id, r.root) for r in paths.crossJoin(roots)
                .filter(is_subpath(F.col("path"), F.col("root"))).collect()}
    assert via_join == via_pred


def test_not_processed_anti_join_and_fused_form_agree(spark):
    rows = [("a", 1, "w1", 1, 10, False), ("a", 1, "w2", 2, 11, True), ("b", 2, "w2", 2, 12, False),
            ("b", 2, "w1", 1, 13, False), ("c", 3, "w3", 3, 14, False), ("a", 2, "w3", 3, 15, False)]
    df = spark.createDataFrame(rows, "name string, size long, watch string, watch_idx long, doc_id long, "
                                     "processed boolean")
    fused = {(r.name, r.size, r.watch, r.doc_id)
             for r in intake.first_unprocessed(df, ["name", "size"], ["watch_idx", "doc_id"], "processed").collect()}
    first = intake.first_per_key(df.drop("processed"), ["name", "size"], ["watch_idx", "doc_id"])
    ledger = df.filter("processed").select("name", "size")
    anti = {(r.name, r.size, r.watch, r.doc_id) for r in intake.not_processed(first, ledger).collect()}
    assert fused == anti == {("b", 2, "w1", 13), ("c", 3, "w3", 14), ("a", 2, "w3", 15)}


def test_config_level_problems():
    good = {k: "x" for k in jobs.REQUIRED_KEYS} | {jobs.PAIRS_KEY: [{"input": "/a"}]}
    assert jobs.validate_config(good) == []
    assert jobs.validate_config({}) == [f"missing_{k}" for k in jobs.REQUIRED_KEYS] + ["no_watches"]
    assert jobs.validate_config(good | {jobs.REQUIRED_KEYS[0]: " ", jobs.PAIRS_KEY: []}) == [
        f"missing_{jobs.REQUIRED_KEYS[0]}", "no_watches"]


def test_delivering_twice_adds_no_ledger_rows(spark):
    done = spark.createDataFrame([("delivered", "a.raw"), ("delivered", "a.raw"), ("pending", "b.raw"), ("delivered", "c.raw")],
                                 "outcome string, src_name string")
    ledger = spark.createDataFrame([("# head",), ("c.raw",)], "value string")
    new = delivery.delivery_ledger(done, ledger)
    assert [r.name for r in new.collect()] == ["a.raw"]
    assert delivery.delivery_ledger(done, ledger.unionByName(new.select(F.col("name").alias("value")))).count() == 0
