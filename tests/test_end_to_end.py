"""Drop files, scan the folder three times while they grow, detect the stable ones."""
import os

from pyspark.sql import functions as F

from intake_spark.operators.scan import land_scan, observe
from intake_spark.operators.stability import stability_counts, stable_candidates
from intake_spark.sources.listing import ListingDataSource


def _write(path, n):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as fh:
        fh.write(b"x" * n)


def test_files_become_candidates_once_sizes_settle(spark, tmp_path):
    root = str(tmp_path / "in")
    log = str(tmp_path / "log")
    spark.dataSource.register(ListingDataSource)
    ignores = spark.createDataFrame([("skip_std.raw",), ("*.tmp",)], "pattern string")
    sizes = [  # per scan: file -> size (None = absent)
        {"a_std.raw": 5, "b_std.raw": 1, "run_std.d/x": 2, "skip_std.raw": 3, "c.raw": 4},
        {"a_std.raw": 5, "b_std.raw": 2, "run_std.d/x": 2, "skip_std.raw": 3, "c.raw": 4},
        {"a_std.raw": 5, "b_std.raw": 2, "run_std.d/x": 2, "run_std.d/y": 1, "skip_std.raw": 3},
    ]
    for scan_no, files in enumerate(sizes, start=1):
        for rel, n in files.items():
            _write(os.path.join(root, rel), n)
        listing = spark.read.format("intake_listing").option("roots", root).option("recursive", "true").load()
        obs = observe(listing, {}, "*std.raw", ignores)
        land_scan(obs, log, scan_no, f"2024-01-0{scan_no} 00:00:00")
        land_scan(obs, log, scan_no, f"2024-01-0{scan_no} 00:00:00")  # a retried landing replaces itself
    scan_log = spark.read.parquet(log)
    assert scan_log.count() == 9  # three entries per scan; the ignored and non-matching files never land
    counted = {(os.path.basename(r.name), r.scan_no): (r.size, r["count"])
               for r in stability_counts(scan_log).collect()}
    assert counted[("a_std.raw", 3)] == (5, 3)
    assert counted[("b_std.raw", 3)] == (2, 2)        # grew once, then stable
    assert counted[("run_std.d", 2)] == (2, 2)        # the .d twin of the default pattern, sized by its files
    assert counted[("run_std.d", 3)] == (3, 1)        # a new file inside restarts the run
    cands = sorted((os.path.basename(r.name), r.scan_no) for r in
                   stable_candidates(stability_counts(scan_log)).filter(F.col("scan_no") == 3).collect())
    assert cands == [("a_std.raw", 3), ("b_std.raw", 3)]
