"""Streams that start at folders: scans of a live folder, and lines of growing files."""
import os

from pyspark.sql import functions as F

from intake_spark.operators.scan import land_scan
from intake_spark.operators.stability import stability_counts
from intake_spark.sources import growing
from intake_spark.sources.growing import GrowingDataSource
from intake_spark.sources.listing import ScanDataSource
from intake_spark.streaming.commits import BatchTables
from intake_spark.streaming.landing import landing_handler, scan_log, scans


def write(path, n):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as fh:
        fh.write(b"x" * n)


def test_a_live_folder_is_scanned_once_a_trigger_and_after_restarts(spark, tmp_path):
    root, gone = str(tmp_path / "in"), str(tmp_path / "later")
    spark.dataSource.register(ScanDataSource)
    ignores = spark.createDataFrame([("skip_std.raw",), ("*.tmp",)], "pattern string")
    handle = landing_handler(str(tmp_path / "lake"), {}, "*std.raw", ignores, recursive=False)
    os.makedirs(root)
    changes = [  # before each trigger: files written; the first finds an empty folder
        {}, {"a_std.raw": 5, "b_std.raw": 1, "run_std.d/x": 2, "skip_std.raw": 3, "c.raw": 4},
        {"b_std.raw": 2}, {"run_std.d/y": 1}]
    for i, files in enumerate(changes):
        for rel, n in files.items():
            write(f"{root}/{rel}", n)
        if i == 2:
            write(f"{gone}/d_std.raw", 9)  # this root can be read from now on
        q = (spark.readStream.format("intake_scans").option("roots", f"{root},{gone}").option("slices", 2).load().writeStream
             .foreachBatch(handle).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
        q.awaitTermination()  # each start goes on from the checkpoint
        assert q.exception() is None
    tables = BatchTables(spark, str(tmp_path / "lake"))
    got = {(os.path.basename(r.watch), r.attempt): (r.status, r.n_rows) for r in scans(tables).collect()}
    assert got == {("in", 1): ("ok", 0), ("in", 2): ("ok", 3), ("in", 3): ("ok", 3), ("in", 4): ("ok", 3),
                   ("later", 1): ("error", None), ("later", 2): ("error", None), ("later", 3): ("ok", 1), ("later", 4): ("ok", 1)}
    counted = {(os.path.basename(r.name), r.scan_no): (r.size, r["count"]) for r in stability_counts(scan_log(tables)).collect()}
    assert counted[("a_std.raw", 4)] == (5, 3) and counted[("b_std.raw", 4)] == (2, 2)
    assert counted[("run_std.d", 3)] == (2, 2) and counted[("run_std.d", 4)] == (3, 1)
    assert counted[("d_std.raw", 2)] == (9, 2) and len(counted) == 11


def test_lines_of_growing_files(spark, tmp_path):
    spark.dataSource.register(GrowingDataSource)
    folder, out = tmp_path / "jobs", str(tmp_path / "out")
    folder.mkdir()
    steps = [{"a.txt": b"one\ntwo\nhal"}, {"a.txt": b"one\ntwo\nhalf line\nfour\n", "b.txt": "é\r\nx\n".encode()}, {},
             {"a.txt": b"new\n"}, {"a.txt": b"new\nnewer\n", "c.log": b"other\n"}]
    seen = []
    for i, files in enumerate(steps):
        for name, text in files.items():
            (folder / name).write_bytes(text)
        q = (spark.readStream.format("intake_growing").option("path", str(folder)).option("suffix", ".txt").load()
             .writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "ck"))
             .trigger(availableNow=True).start())
        q.awaitTermination()
        rows = spark.read.schema(growing.SCHEMA).parquet(out).collect()
        seen.append(len(rows))
    assert seen == [2, 6, 6, 7, 8]
    assert sorted((r.file, r.pos, r.line, r.restarted) for r in rows) == [
        ("a.txt", 0, "new", True), ("a.txt", 0, "one", False), ("a.txt", 4, "newer", False), ("a.txt", 4, "two", False),
        ("a.txt", 8, "half line", False), ("a.txt", 18, "four", False), ("b.txt", 0, "é", False), ("b.txt", 4, "x", False)]


def test_any_cut_of_a_file_gives_each_line_once(tmp_path, monkeypatch):
    monkeypatch.setattr(growing, "BACK", 3)
    text = b"first\n\nthird is longer\nx\nlast\n half"
    path = tmp_path / "f"
    path.write_bytes(text)
    want = [(0, "first"), (6, ""), (7, "third is longer"), (23, "x"), (25, "last")]
    for step in range(1, len(text) + 1):
        cuts = [*range(0, len(text), step), len(text)]
        assert [x for a, b in zip(cuts, cuts[1:]) for x in growing.lines(str(path), a, b)] == want


def test_short_files_share_a_task(tmp_path, monkeypatch):
    monkeypatch.setattr(growing, "TASK_BYTES", 20)
    monkeypatch.setattr(growing, "PIECE", 50)
    monkeypatch.setattr(growing, "BATCH_ROWS", 3)
    want, sizes = [], {}
    for i in range(12):
        text = f"{i} a\n{i} b\n" if i != 5 else "a longer line\n" * 10
        (tmp_path / f"{i:02}.txt").write_bytes(text.encode())
        sizes[f"{i:02}.txt"] = len(text)
        want += [(f"{i:02}.txt", x) for x in text.splitlines()]
    reader = growing.GrowingReader({"path": str(tmp_path)})
    parts = reader.partitions({}, {**sizes, "gone.txt": 5})
    assert len(parts) < 12 and all(len(p.pieces) == 1 or sum(b - a for _, a, b, _ in p.pieces) <= 20 for p in parts)
    batches = [b for p in parts for b in reader.read(p)]
    assert max(b.num_rows for b in batches) == 3
    assert [(r["file"], r["line"]) for b in batches for r in b.to_pylist()] == want
    assert [list(reader.read(p)) for p in reader.partitions(sizes, sizes)] == [[]]


def test_landing_a_scan_again_replaces_it_and_empty_scans_stay(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = lambda *r: spark.createDataFrame(list(r), "watch string, name string, size long")
    land_scan(rows(("w/1", "a", 1), ("v", "b", 2)), path, 7, "2024-01-01 00:00:00", ["w/1", "v"])
    land_scan(rows(("v", "c", 3)), path, 7, "2024-01-01 00:00:00", ["w/1", "v", "empty"])
    assert [(r.watch, r.name, r.scan_no) for r in spark.read.parquet(path).collect()] == [("v", "c", 7)]
    got = {(r.watch, r.n_rows) for r in spark.read.parquet(path + "_scans").collect()}
    assert got == {("w/1", 0), ("v", 1), ("empty", 0)}
    assert spark.read.parquet(path).filter(F.col("watch") == "w/1").isEmpty()
