"""The ledger that is opened in part, and the step from candidates to jobs."""
import os
import random

import pytest
from pyspark.sql import functions as F

from intake_spark.streaming import commits, ledger
from intake_spark.streaming.commits import BatchTables
from intake_spark.streaming.ledger import KEY_SCHEMA, Ledger, dedup_handler, intake_handler


def test_batches_and_folds_equal_a_set(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ledger, "BUCKET_KEYS", 8)
    rnd = random.Random(1)
    handle, seen = dedup_handler(str(tmp_path), fold_every=3), set()
    book = Ledger(BatchTables(spark, str(tmp_path)))
    for i in range(5):
        rows = [(f"f{rnd.randrange(60)}", rnd.choice([1, 2, None])) for _ in range(0 if i == 2 else 40)]
        asked = spark.createDataFrame(rows, KEY_SCHEMA)
        if i:
            got = {tuple(r) for r in book.known(asked).collect()}
            assert got == {(n, z) for n, z in rows if z is not None} & seen
        handle(asked, i)
        handle(asked, i)  # comes again after its commit: nothing changes
        seen |= {(n, z) for n, z in rows if z is not None}
        whole = [tuple(r) for r in book.read().collect() if r["size"] is not None]
        assert len(whole) == len(set(whole)) and set(whole) == seen
    assert book.last_fold()["fold"] >= 0 and book.last_fold()["upto"] >= 2


def test_bytes_read_do_not_grow_with_the_ledger(spark, tmp_path):
    def opened(n):
        tables = BatchTables(spark, str(tmp_path / str(n)))
        book = Ledger(tables)
        with tables.begin(0) as step:
            book.add(step, spark.range(n).select(F.concat(F.lit("file"), "id").alias("name"), F.col("id").alias("size")))
        assert book.fold(every=1, bucket_keys=200)
        asked = spark.range(6).select(F.concat(F.lit("file"), F.col("id") + 50).alias("name"), (F.col("id") + 50 + F.col("id") % 2).alias("size"))
        found = book.known(asked)
        assert found.count() == 3  # every other one is there
        files = [f.removeprefix("file://") for f in found.inputFiles()]
        return sum(os.path.getsize(f) for f in files), len(files), book.last_fold()["bits"]

    small, large = opened(2000), opened(16_000)
    assert large[2] == small[2] + 3  # eight times the buckets
    assert large[0] < 1.5 * small[0] and large[1] <= small[1] + 2


class Killed(Exception):
    pass


@pytest.mark.parametrize("at", [2, 3, 5])
def test_intake_killed_between_two_writes_gives_the_same_tables(spark, tmp_path, monkeypatch, at):
    schema = "name string, size long, watch string, seq long"
    batches = [[("a", 1, "w1", 1), ("a", 1, "w0", 2), ("b", 1, "w1", 3)], [("b", 1, "w2", 4), ("c", 5, "w1", 5)]]
    specs = {"specs": lambda new: new.select("hash", F.concat(F.lit("spec of "), "name").alias("json"))}
    handle = intake_handler(str(tmp_path), ["watch", "seq"], specs)
    write, made = commits.Step.write, []

    def dying(self, *a, **k):
        out = write(self, *a, **k)
        if self.batch_id == 1:
            made.append(a[0])
            if len(made) == at:
                raise Killed
        return out

    handle(spark.createDataFrame(batches[0], schema), 0)
    with monkeypatch.context() as m:
        m.setattr(commits.Step, "write", dying)
        with pytest.raises(Killed):
            handle(spark.createDataFrame(batches[1], schema), 1)
    tables = BatchTables(spark, str(tmp_path))
    assert tables.read("candidates", "name string").count() == 2  # nothing of the lost try is seen
    for i, b in enumerate(batches):
        handle(spark.createDataFrame(b, schema), i)
    got = sorted((r.name, r.watch, r.batch_id) for r in tables.read("candidates", "name string, watch string").collect())
    assert got == [("a", "w0", 0), ("b", "w1", 0), ("c", "w1", 1)]
    assert sorted(r.json for r in tables.read("specs", "hash string, json string").collect()) == ["spec of a", "spec of b", "spec of c"]
    assert sorted(tuple(r) for r in Ledger(tables).read().collect()) == [("a", 1), ("b", 1), ("c", 5)]
