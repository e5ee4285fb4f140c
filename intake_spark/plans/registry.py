"""Query registry: key -> (spark, sf_dir) -> DataFrame, and key -> SQL."""

from __future__ import annotations

from . import queries as Q
from . import streams as S
from .oracle import SQL

QUERIES = {
    "stable_candidates": Q.stable_candidates,
    "stable_candidates_incremental": Q.stable_candidates_incremental,
    "latest_snapshot": Q.latest_snapshot,
    "scan_counts": Q.scan_counts,
    "scan_events": Q.scan_events,
    "include_match": Q.include_match,
    "ignore_filter": Q.ignore_filter,
    "dir_size_rollup": Q.dir_size_rollup,
    "last_wins_listing": Q.last_wins_listing,
    "pattern_normalize": Q.pattern_normalize,
    "row_key": Q.row_key,
    "unprocessed": Q.unprocessed,
    "still_exists": Q.still_exists,
    "ledger_append": Q.ledger_append,
    "prefix_match": Q.prefix_match,
    "job_outcomes": Q.job_outcomes,
    "job_timeline": Q.job_timeline,
    "queue_position": Q.queue_position,
    "dispatch_top_k": Q.dispatch_top_k,
    "status_levels": Q.status_levels,
    "definition_errors": Q.definition_errors,
    "newest_reference": Q.newest_reference,
    "best_artifact": Q.best_artifact,
    "delivery_manifest": Q.delivery_manifest,
    "delivery_ledger": Q.delivery_ledger,
    "job_spec": Q.job_spec,
    "job_templates": Q.job_templates,
    "job_metadata": Q.job_metadata,
    "unique_target_names": Q.unique_target_names,
    "stream_stability": S.stream_stability,
    "stream_scans": S.stream_scans,
    "stream_dedup": S.stream_dedup,
    "stream_intake": S.stream_intake,
    "stream_rollup": S.stream_rollup,
    "stream_queue": S.stream_queue,
    "stream_markers": S.stream_markers,
    "stream_jobs": S.stream_jobs,
}

# Streams equal their batch counterparts.
SQL = dict(SQL)
SQL["stream_stability"] = SQL["stable_candidates"]
SQL["stable_candidates_incremental"] = SQL["stable_candidates"]
SQL["stream_queue"] = SQL["queue_position"]
SQL["stream_jobs"] = SQL["stream_markers"] = SQL["job_timeline"]

ORACLE = {k: v for k, v in SQL.items() if k in QUERIES}
