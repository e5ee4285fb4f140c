"""Scan completeness: any cut of rows and manifests into batches equals the batch form."""
import random

import pytest
from pyspark.sql import functions as F

from intake_spark.streaming import commits
from intake_spark.streaming.commits import BatchTables, Lost
from intake_spark.streaming.scans import (INPUT_SCHEMA, OverfullScan, read_counts, read_events, scan_handler)


def history(seed, n_attempts=8):
    """attempts: (watch, attempt, status, {name: size}); the plain model of counts."""
    rnd = random.Random(seed)
    attempts, counts = [], {}
    for w in ("w1", "w2", "idle"):
        last, scan = {}, 0
        for a in range(1, n_attempts + 1):
            if rnd.random() < 0.25:
                attempts.append((w, a, "error", {}))
                continue
            scan += 1
            names = [] if w == "idle" or rnd.random() < 0.15 else [f"f{i}" for i in range(5) if rnd.random() < 0.85]
            listing = {n: rnd.choice([1, 1, 1, 2, None]) for n in names}
            attempts.append((w, a, "ok", listing))
            now = {n: (z, last[n][1] + 1 if n in last and last[n][0] == z else 1) for n, z in listing.items()}
            counts |= {(w, a, n): (scan, z, c) for n, (z, c) in now.items()}
            last = now
    return attempts, counts


def row(w, a, n, z):
    return (w, a, n, z, None, None, None, None)


def manifest(w, a, status, n):
    return (w, a, None, None, status, n, None, "no folder" if status == "error" else None)


def stream_rows(attempts):
    return ([row(w, a, n, z) for w, a, _, files in attempts for n, z in files.items()],
            [manifest(w, a, s, len(f) if s == "ok" else None) for w, a, s, f in attempts])


def run(spark, root, batches):
    handle = scan_handler(root)
    for i, b in enumerate(batches):
        handle(spark.createDataFrame(b, INPUT_SCHEMA), i)
    return BatchTables(spark, root)


def result(tables):
    return {(r.watch, r.attempt, r.name): (r.scan_no, r.size, r["count"])
            for r in read_counts(tables).filter(~F.col("late")).collect()}


@pytest.mark.parametrize("seed", [2])
def test_each_scan_cut_into_three_batches_equals_the_model(spark, tmp_path, seed):
    attempts, want = history(seed)
    rnd = random.Random(seed + 100)
    rows, told = stream_rows(attempts)
    batches = [[] for _ in range(6)]
    for r in rows:
        batches[min(r[1] // 3 + rnd.randrange(3), 5)].append(r)
    for m in told:
        batches[min(m[1] // 3 + rnd.randrange(3), 5)].append(m)
    order = [[], *batches[:3], [], *batches[3:], []]  # empty batches first, in the middle and last
    tables = run(spark, str(tmp_path), order)
    assert result(tables) == want
    events = {(r.watch, r.attempt): r for r in read_events(tables).collect()}
    assert set(events) == {(w, a) for w, a, _, _ in attempts}
    for w, a, status, files in attempts:
        e = events[w, a]
        n = sum(want[w, a, f][2] >= 2 for f in files)
        assert (e.kind, e.n_files, e.n_candidates) == (
            ("error", 0, 0) if status == "error" else ("snapshot" if n else "empty", len(files), n))


def test_nothing_counts_before_its_scan_and_those_before_are_complete(spark, tmp_path):
    batches = [[row("w", 2, "a", 5), manifest("w", 2, "ok", 1), row("w", 1, "a", 5)],
               [row("w", 1, "b", 5), row("w", 1, "b", 5)],       # repeated: one name
               [manifest("w", 1, "ok", 2)],
               [row("w", 1, "a", 9), row("w", 3, "a", 5), manifest("w", 1, "ok", 2)],  # a replay
               [manifest("w", 3, "ok", 1)]]
    handle, seen = scan_handler(str(tmp_path)), []
    for i, b in enumerate(batches):
        handle(spark.createDataFrame(b, INPUT_SCHEMA), i)
        seen.append(len(result(BatchTables(spark, str(tmp_path)))))
    assert seen == [0, 0, 3, 3, 4]
    tables = BatchTables(spark, str(tmp_path))
    assert result(tables)["w", 3, "a"] == (3, 5, 3)
    assert [(r.name, r.size) for r in read_counts(tables).filter("late").collect()] == [("a", 9)]


def test_too_many_rows_stop_the_batch(spark, tmp_path):
    with pytest.raises(OverfullScan):
        run(spark, str(tmp_path), [[row("w", 1, "a", 1), row("w", 1, "b", 1), manifest("w", 1, "ok", 1)]])
    assert BatchTables(spark, str(tmp_path)).records() == []


class Killed(Exception):
    pass


@pytest.mark.parametrize("at", [1, 3, 5])
def test_a_run_killed_between_any_two_writes_gives_the_same_tables(spark, tmp_path, monkeypatch, at):
    attempts, want = history(5, 4)
    rows, told = stream_rows(attempts)
    batches = [rows[::2] + told, rows[1::2]]
    write, made = commits.Step.write, []

    def dying(self, name, df, partition_by=None):
        out = write(self, name, df, partition_by)
        made.append(name)
        if len(made) == at + (5 if at > 3 else 0):
            raise Killed
        return out

    handle = scan_handler(str(tmp_path))
    with monkeypatch.context() as m:
        m.setattr(commits.Step, "write", dying)
        with pytest.raises(Killed):
            for i, b in enumerate(batches):
                handle(spark.createDataFrame(b, INPUT_SCHEMA), i)
    for i, b in enumerate(batches):  # the stream starts again from its last batch; earlier ones change nothing
        handle(spark.createDataFrame(b, INPUT_SCHEMA), i)
    tables = BatchTables(spark, str(tmp_path))
    assert result(tables) == want
    assert len(commits.names(spark, f"{tmp_path}/counts/batch_id=1")) == 1  # the lost try is swept


def test_of_two_writers_of_a_batch_one_wins(spark, tmp_path):
    one, two = BatchTables(spark, str(tmp_path)), BatchTables(spark, str(tmp_path))
    with pytest.raises(Lost):
        with one.begin(0) as a:
            a.write("t", spark.range(3))
            with two.begin(0) as b:
                b.write("t", spark.range(5))
    assert one.read("t", "id long").count() == 5
    with one.begin(0) as again:
        assert again is None
