"""File-system sources on small folders made by the test."""
import json
import os

from pyspark.sql import functions as F

from intake_spark.operators.inventory import dir_size_rollup, read_ignore_list
from intake_spark.sources.files import inventory_scan, read_definitions, read_metadata, read_markers
from intake_spark.sources.listing import ListingDataSource


def _tree(root):
    files = {"a_std.raw": 5, ".hidden_std.raw": 3, "_under_std.raw": 4, "x.d/f1": 2, "x.d/sub/f2": 6,
             "y.raw/inner": 1, "b.raw": 7}
    for rel, size in files.items():
        p = os.path.join(root, rel)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "wb") as fh:
            fh.write(b"x" * size)
    os.makedirs(os.path.join(root, "empty.d"))
    return files


def test_binaryfile_inventory_prunes_content_and_skips_hidden(spark, tmp_path):
    root = str(tmp_path / "w")
    _tree(root)
    inv = inventory_scan(spark, root, "w")
    rows = {r.rel: (r.is_dir, r.size) for r in inv.collect()}
    assert rows["a_std.raw"] == (False, 5)
    assert rows["x.d"] == (True, 8)            # A1: nested files summed
    assert ".hidden_std.raw" not in rows       # Spark file sources skip dot/underscore names
    assert "empty.d" not in rows               # and never see empty directories
    assert "content" not in inv._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]


def test_listing_source_sees_hidden_files_and_empty_dirs(spark, tmp_path):
    root = str(tmp_path / "w")
    _tree(root)
    spark.dataSource.register(ListingDataSource)
    lst = spark.read.format("intake_listing").option("roots", root).load()
    rows = {r.rel: (r.is_dir, r.size) for r in lst.collect()}
    assert rows[".hidden_std.raw"] == (False, 3)
    assert rows["_under_std.raw"] == (False, 4)
    assert rows["empty.d"] == (True, 0)
    assert rows["x.d/sub/f2"] == (False, 6)
    members = lst.filter(~F.col("is_dir")).select(F.col("rel").alias("path"), "size")
    dirs = spark.createDataFrame([("x.d",), ("empty.d",)], "dir string")
    sizes = {r.dir: r.size for r in dir_size_rollup(members, dirs).collect()}
    assert sizes == {"x.d": 8, "empty.d": 0}


def test_ignore_list_read(spark, tmp_path):
    p = tmp_path / "ignore.txt"
    p.write_bytes(b"# c\n\n  *.tmp  \n   # indented\nfoo\xff.raw\nbar.raw\n")
    got = sorted(r.pattern for r in read_ignore_list(spark, str(p)).collect())
    assert got == ["*.tmp", "bar.raw", "foo.raw"]


def test_definitions_json(spark, tmp_path):
    p = tmp_path / "app.json"
    p.write_text(json.dumps({"interval_minutes": 6, "default_pattern": "*std.raw",
                             "io_pairs": [{"input": "/i1", "output": "/o1", "pattern": "*.d"},
                                          {"input": "/i2", "output": "/o2"}]}, indent=2))
    rows = [(r.watch_idx, r.input, r.pattern, r.interval_minutes) for r in read_definitions(spark, str(p)).collect()]
    assert rows == [(1, "/i1", "*.d", 6), (2, "/i2", None, 6)]


def test_metadata_missing_or_corrupt_is_null(spark, tmp_path):
    good = tmp_path / "m" / "h1"
    bad = tmp_path / "m" / "h2"
    good.mkdir(parents=True)
    bad.mkdir(parents=True)
    (good / "info.json").write_text(json.dumps({"hash": "h1", "source": {"name": "a.raw", "size_bytes": 3}}))
    (bad / "info.json").write_text("{not json")
    got = {os.path.basename(os.path.dirname(r.file)): (r.valid, r.meta.hash if r.meta else None)
           for r in read_metadata(spark, str(tmp_path / "m" / "*" / "info.json")).collect()}
    assert got == {"h1": (True, "h1"), "h2": (False, None)}


def test_markers_from_files(spark, tmp_path):
    d = tmp_path / "jobs" / "h9"
    d.mkdir(parents=True)
    (d / "finish.marker").write_text("2024-01-01T00:00:00\nstarted: 2024-01-01T00:10:00\nreturncode: 0\n")
    ev = read_markers(spark, str(tmp_path / "jobs" / "*" / "*.marker"))
    assert sorted((r.job, r.event) for r in ev.collect()) == [("h9", "ready"), ("h9", "returncode"),
                                                              ("h9", "started")]


def test_listing_follows_links_and_raises_for_a_lost_root(spark, tmp_path, monkeypatch):
    import os
    import pytest
    from intake_spark.sources import listing
    spark.dataSource.register(listing.ListingDataSource)
    root, other = tmp_path / "root", tmp_path / "other"
    (other / "run.d").mkdir(parents=True)
    (other / "big.raw").write_bytes(b"x" * 1000)
    (other / "run.d" / "f").write_bytes(b"yy")
    root.mkdir()
    os.symlink(other / "big.raw", root / "link.raw")
    os.symlink(other / "run.d", root / "linked.d")
    os.symlink(root, root / "loop")
    os.symlink(other / "gone", root / "dangling")
    for i in range(25):
        (root / f"flat{i}").write_bytes(b"z")
    monkeypatch.setattr(listing, "SLICES", 3)
    read = lambda r: spark.read.format("intake_listing").option("roots", str(r)).load()
    got = {r.rel: (r.is_dir, r.size) for r in read(root).collect()}
    assert got["link.raw"] == (False, 1000) and got["linked.d"] == (True, 0) and got["linked.d/f"] == (False, 2)
    assert got["loop"] == (True, 0) and not any(r.startswith("loop/") for r in got) and "dangling" not in got
    assert sum(r.startswith("flat") for r in got) == 25
    with pytest.raises(Exception):
        read(tmp_path / "nowhere").collect()
    (tmp_path / "empty").mkdir()
    assert read(tmp_path / "empty").count() == 0
