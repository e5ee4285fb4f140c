"""Scan numbering with failed scans (T4), snapshot sink (K1), trigger (T1), hook."""
from pyspark.sql import functions as F

from intake_spark.operators.stability import (number_scans, stability_counts, stable_candidates,
                                              write_snapshots)
from intake_spark.streaming.runner import (JOB_EVENT_SCHEMA, JOB_STATE_SCHEMA, interval_trigger,
                                           job_state_table_handler, with_hook)


def test_failed_scans_take_no_number_and_runs_continue(spark):
    scans = spark.createDataFrame(
        [("w", 1, "ok"), ("w", 2, "error"), ("w", 3, "ok"), ("w", 4, "ok")], "watch string, t long, status string")
    numbered = {r.t: r.scan_no for r in number_scans(scans, "t").collect()}
    assert numbered == {1: 1, 3: 2, 4: 3}
    obs = spark.createDataFrame([("w", t, "a", 5) for t in (1, 3, 4)], "watch string, t long, name string, size long")
    log = obs.join(number_scans(scans, "t").select("watch", "t", "scan_no"), ["watch", "t"])
    got = sorted((r.scan_no, r["count"]) for r in stability_counts(log).collect())
    assert got == [(1, 1), (2, 2), (3, 3)]  # the error scan did not break the run


def test_snapshot_sink_keeps_empty_scans(spark, tmp_path):
    scans = spark.createDataFrame([("w", 1, None), ("w", 2, None), ("w", 3, None)],
                                  "watch string, scan_no long, scan_ts timestamp_ntz")
    log = spark.createDataFrame([("w", 1, "a", 5), ("w", 2, "a", 5)], "watch string, scan_no long, name string, size long")
    cands = stable_candidates(stability_counts(log))
    path = str(tmp_path / "snap")
    write_snapshots(cands, scans, path)
    write_snapshots(cands, scans, path)  # idempotent rewrite
    ev = {r.scan_no: r.n_candidates for r in spark.read.parquet(path + "/_events").collect()}
    assert ev == {1: 0, 2: 1, 3: 0}
    assert spark.read.parquet(path).count() == 1


def test_interval_trigger_has_one_second_floor():
    assert interval_trigger(600) == {"processingTime": "600 seconds"}
    assert interval_trigger(0) == {"processingTime": "1 seconds"}
    assert interval_trigger(None) == {"processingTime": "1 seconds"}


def test_hook_failures_are_swallowed(spark):
    seen = []

    def bad_hook(df, batch_id):
        raise RuntimeError("mount check failed")

    def handler(df, batch_id):
        seen.append((batch_id, df.count()))

    with_hook(handler, bad_hook)(spark.range(3), 7)
    assert seen == [(7, 3)]


def test_job_state_table_evicts_final_jobs(spark, tmp_path):
    import os
    from intake_spark.operators.jobs import finalize_state, parse_markers
    from intake_spark.streaming.runner import JOB_EVENT_SCHEMA, fold_job_facts, job_state_table_handler
    src, st, out = (str(tmp_path / x) for x in ("src", "state", "out"))
    batches = [
        [(1, "2024-01-01T00:00:00\nstarted: 2024-01-01T01:00:00"), (2, "2024-01-01T00:00:00")],
        [(1, "2024-01-01T00:00:00\nstarted: 2024-01-01T01:00:00\nfinished: 2024-01-01T03:00:00\nreturncode: 0")],
    ]
    for rows in batches:
        parse_markers(spark.createDataFrame(rows, "job long, text string")).write.mode("append").parquet(src)
        q = (spark.readStream.schema(JOB_EVENT_SCHEMA).parquet(src).writeStream
             .foreachBatch(job_state_table_handler(st, out))
             .option("checkpointLocation", os.path.join(str(tmp_path), "ck")).trigger(availableNow=True).start())
        q.awaitTermination()
    res = {r.job: (r.state, r.run_s) for r in finalize_state(
        fold_job_facts(spark.read.parquet(out))).collect()}
    assert res == {1: ("finish", 7200), 2: ("ready", None)}
    last_state = sorted(os.listdir(st))[-1]
    assert [r.job for r in spark.read.parquet(os.path.join(st, last_state)).collect()] == [2]  # job 1 evicted


def test_late_event_adds_to_a_finished_job(spark, tmp_path):
    import datetime as dt
    from intake_spark.operators.jobs import finalize_state
    from intake_spark.streaming.runner import JOB_EVENT_SCHEMA, fold_job_facts, job_state_table_handler
    handle = job_state_table_handler(str(tmp_path / "state"), str(tmp_path / "out"))
    t = lambda h: dt.datetime(2024, 1, 1, h)
    batches = [[(1, 0, "ready", t(1), None), (1, 4, "returncode", None, "0"), (2, 0, "ready", t(2), None)],
               [(1, 3, "finished", t(5), None), (1, 5, "returncode", None, "None")], [(1, 1, "started", t(3), None)]]
    for i, rows in enumerate(batches):
        handle(spark.createDataFrame(rows, JOB_EVENT_SCHEMA), i)
    got = {r.job: r for r in finalize_state(fold_job_facts(spark.read.parquet(str(tmp_path / "out")))).collect()}
    assert (got[1].state, got[1].rc, got[1].ready_ts, got[1].run_s) == ("finish", 0, t(1), 7200)
    assert got[2].state == "ready"


def test_replayed_scans_count_nothing_and_lost_state_stops(spark, tmp_path):
    import pytest
    from intake_spark.streaming.stability import OUTPUT_SCHEMA, state_table_handler, stream_candidates
    out = str(tmp_path / "out")
    handle = state_table_handler(str(tmp_path / "state"), out)
    scans = {1: ["a", "b"], 2: ["a", "b"], 3: ["b"]}
    rows = lambda ns: spark.createDataFrame([("w", n, f, 5) for n in ns for f in scans[n]],
                                            "watch string, scan_no long, name string, size long")
    for i, ns in enumerate([(1,), (2, 3), (1, 2), (3,)]):
        handle(rows(ns), i)
    got = sorted((r.scan_no, r.name, r["count"]) for r in stream_candidates(spark.read.schema(OUTPUT_SCHEMA).parquet(out), 2).collect())
    assert got == [(2, "a", 2), (2, "b", 2), (3, "b", 3)]
    with pytest.raises(Exception):
        handle(rows((3,)), 9)  # the state of batch 8 isn't there


def test_registered_streams_run_several_batches(spark, monkeypatch, tmp_path):
    import os
    from intake_spark.plans import streams
    from conftest import SF
    for key in ("stream_stability", "stream_dedup", "stream_jobs"):
        base = str(tmp_path / key)
        monkeypatch.setattr(streams, "scratch_path", lambda s, n, base=base: base)
        assert getattr(streams, key)(spark, SF["0.001"]).count() > 0
        assert len([f for f in os.listdir(f"{base}/ckpt/commits") if not f.startswith(".")]) == streams.LANDINGS


def test_empty_batches_and_scans_split_over_batches(spark, tmp_path):
    from intake_spark.streaming.stability import OUTPUT_SCHEMA, state_table_handler, stream_candidates
    out = str(tmp_path / "out")
    handle = state_table_handler(str(tmp_path / "state"), out)
    batches = [[], [(1, "a")], [(1, "b")], [], [(2, "b")], [(2, "a"), (1, "b")], [(3, "a"), (3, "b"), (2, "c")], []]
    for i, rows in enumerate(batches):
        handle(spark.createDataFrame([("w", s, n, 5) for s, n in rows], "watch string, scan_no long, name string, size long"), i)
    res = spark.read.schema(OUTPUT_SCHEMA).parquet(out)
    got = sorted((r.scan_no, r.name, r["count"]) for r in stream_candidates(res, 2).collect())
    assert got == [(2, "a", 2), (2, "b", 2), (3, "a", 3), (3, "b", 3)]
    assert [(r.scan_no, r.name) for r in res.filter("late").collect() if r.name != "c"] == [(1, "b")]


def test_job_state_takes_empty_batches(spark, tmp_path):
    import datetime as dt
    from intake_spark.operators.jobs import finalize_state
    from intake_spark.streaming.runner import JOB_EVENT_SCHEMA, JOB_STATE_SCHEMA, fold_job_facts, job_state_table_handler
    handle = job_state_table_handler(str(tmp_path / "state"), str(tmp_path / "out"))
    t = dt.datetime(2024, 1, 1)
    for i, rows in enumerate([[], [(1, 0, "ready", t, None)], [], [(1, 4, "returncode", None, "0")], []]):
        handle(spark.createDataFrame(rows, JOB_EVENT_SCHEMA), i)
    facts = spark.read.schema(JOB_STATE_SCHEMA).parquet(str(tmp_path / "out"))
    assert [(r.job, r.state) for r in finalize_state(fold_job_facts(facts)).collect()] == [(1, "finish")]


def test_a_batch_of_job_events_is_read_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = [(1, 1, "ready", None, None), (2, 5, "returncode", None, "0"), (None, 2, "started", None, None)]
    handle = job_state_table_handler(str(tmp_path / "state"), str(tmp_path / "out"))
    for batch_id in range(3):
        events = spark.createDataFrame(rows, JOB_EVENT_SCHEMA).coalesce(1)
        handle(events.mapInArrow(count, JOB_EVENT_SCHEMA), batch_id)
    assert seen.value == 9
    got = spark.read.schema(JOB_STATE_SCHEMA).parquet(str(tmp_path / "out"))
    assert sorted((r.job or 0, r.rc or 0) for r in got.collect()) == [(0, 0)] * 3 + [(1, 0)] * 3 + [(2, 0)] * 3
    left = spark.read.schema(JOB_STATE_SCHEMA).parquet(str(tmp_path / "state/batch_id=2"))
    assert {r.job for r in left.collect()} == {1, None}
