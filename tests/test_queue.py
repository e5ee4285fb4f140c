"""Positions from the order index equal a sort of the whole queue after every batch."""
import datetime as dt
import os
import random

from intake_spark.streaming import queue
from intake_spark.streaming.commits import BatchTables


def test_positions_equal_a_sort_after_every_batch(spark, tmp_path):
    rnd = random.Random(9)
    handle, tables, now = queue.queue_handler(str(tmp_path), range_jobs=5), BatchTables(spark, str(tmp_path)), set()
    t = lambda m: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m)
    for i in range(5):
        comes = [] if i == 3 else [(t(rnd.choice([7, rnd.randrange(60)])), 100 * i + k) for k in range(rnd.randrange(10, 30))]
        goes = rnd.sample(sorted(now), len(now) // 3) + comes[:2] + [(t(1), 9999)] if i != 3 else sorted(now)
        rows = [(*k, False) for k in comes] + [(*k, True) for k in goes]
        rows += rows[:3]  # repeated
        handle(spark.createDataFrame(rows, queue.EVENT_SCHEMA), i)
        handle(spark.createDataFrame(rows, queue.EVENT_SCHEMA), i)  # comes again after its commit
        now = (now | set(comes)) - set(goes)
        want = {k: n for n, k in enumerate(sorted(now), 1)}
        got = {(r.ready_ts, r.job): r.position for r in queue.positions(tables).collect()}
        assert got == want
        if i == 2:
            some = rnd.sample(sorted(now), 4) + [(t(2), 12345)]
            asked = queue.positions(tables, spark.createDataFrame(some, queue.JOB_SCHEMA))
            assert {(r.ready_ts, r.job): r.position for r in asked.collect()} == {k: want[k] for k in some if k in want}


def test_a_batch_writes_only_the_ranges_it_falls_into(spark, tmp_path):
    handle = queue.queue_handler(str(tmp_path), range_jobs=10)
    t = lambda m: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m)
    handle(spark.createDataFrame([(t(m), m, False) for m in range(200)], queue.EVENT_SCHEMA), 0)
    handle(spark.createDataFrame([(t(55), 1000, False), (t(57), 57, True)], queue.EVENT_SCHEMA), 1)
    made = [len([n for _, d, _ in os.walk(tmp_path / f"ranges/batch_id={b}") for n in d if n.startswith("range=")]) for b in (0, 1)]
    assert made == [19, 1]
    got = {r.job: r.position for r in queue.positions(BatchTables(spark, str(tmp_path))).collect()}
    assert got[1000] == 57 and 57 not in got and got[58] == 59 and got[199] == 200
