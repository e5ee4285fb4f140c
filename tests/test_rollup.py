"""Directory sums kept up from changes equal a full roll-up after every scan."""
import os
import random

from intake_spark.operators.inventory import dir_size_rollup
from intake_spark.streaming import rollup
from intake_spark.streaming.commits import BatchTables


def test_sums_after_every_scan_equal_the_full_rollup(spark, tmp_path):
    rnd = random.Random(3)
    handle, tables = rollup.rollup_handler(str(tmp_path), buckets=4), BatchTables(spark, str(tmp_path))
    last = {}
    for i in range(4):
        now = {p: rnd.randrange(9) for p in (f"r{d}.d/{'s/' * (f % 2)}f{f}" for d in range(7) for f in range(4)) if rnd.random() < .6}
        now |= {p: z for p, z in last.items() if rnd.random() < .5} | {"plain.txt": i}
        if i == 2:
            now = {"r0.d/only": 4}  # nearly all goes
        frames = [spark.createDataFrame(list(x.items()), "path string, size long") for x in (last, now)]
        changes = rollup.scan_changes(*frames)
        want = {p: z for p, z in now.items() if last.get(p, -1) != z}
        assert {r.path for r in changes.collect()} == set(want) | (set(last) - set(now))
        handle(changes, i)
        handle(changes, i)  # a batch that comes again adds nothing
        assert sorted(map(tuple, rollup.read_sums(tables).collect())) == sorted(map(tuple, dir_size_rollup(frames[1]).collect()))
        last = now


def test_a_batch_touches_the_buckets_of_its_directories(spark, tmp_path):
    handle = rollup.rollup_handler(str(tmp_path), buckets=32)
    frame = lambda rows: spark.createDataFrame(rows, rollup.CHANGE_SCHEMA)
    handle(frame([(f"r{i}.d/f", None, 1) for i in range(200)]), 0)
    handle(frame([("r7.d/f", 1, 5), ("r7.d/g", None, 2)]), 1)
    made = {b: len([n for _, d, _ in os.walk(tmp_path / f"sums/batch_id={b}") for n in d if n.startswith("bucket=")]) for b in (0, 1)}
    assert made[1] == 1 and made[0] == 31  # one bucket was replaced
    got = {r.dir: (r["size"], r.n_files) for r in rollup.read_sums(BatchTables(spark, str(tmp_path))).collect()}
    assert len(got) == 200 and got["r7.d"] == (7, 2)
