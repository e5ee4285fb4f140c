"""Scalar path/name functions (F2-F5, F9, F10, P3, P5) as Spark Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .patterns import strip_ws

# Output and log suffixes, marker time formats, slug alphabet.
ARTIFACT_SUFFIX = ".hdf5"
ERROR_LOG_SUFFIX = ".error.log"
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"
COMPACT_TS = "yyyyMMdd-HHmmss"
SLUG_DISALLOWED = "[^A-Za-z0-9._-]+"
MAX_STABLE_COUNT = 1_000_000


def row_key(name: Column, size: Column) -> Column:
    """SHA-1 hex of the name followed by the decimal size (no delimiter)."""
    return F.sha1(F.concat(name, size.cast("string")))


def basename(p: Column) -> Column:
    """last path component (trailing slashes ignored)."""
    return F.regexp_extract(p, "(?s)([^/]*)/*\\z", 1)


def stem(name: Column) -> Column:
    """file name without its last suffix; a leading dot is not a suffix."""
    return F.regexp_replace(name, "(?s)^(.+)\\.[^.]+\\z", "$1")


def resolve(name: Column, folder: Column) -> Column:
    """absolute names stay, relative ones are placed under ``folder``."""
    return F.when(name.startswith("/"), name).otherwise(
        F.concat(F.regexp_replace(folder, "/+$", ""), F.lit("/"), name))


def slug(s: Column) -> Column:
    """strip, runs outside [A-Za-z0-9._-] become ``_``, empty -> ``x``."""
    return F.coalesce(F.nullif(F.regexp_replace(strip_ws(s), SLUG_DISALLOWED, "_"), F.lit("")),
                      F.lit("x"))


def _seconds_text(ts: Column) -> Column:
    # ``yyyy-MM-dd HH:mm:ss`` from the cast to string: for TIMESTAMP_NTZ this is
    # zone-free (``date_format`` would pass through the session zone and shift
    # wall times that fall in a daylight-saving gap).
    return F.substring(ts.cast("string"), 1, 19)


def iso_seconds(ts: Column) -> Column:
    """ISO-8601 text at second precision (``yyyy-MM-dd'T'HH:mm:ss``)."""
    return F.regexp_replace(_seconds_text(ts), " ", "T")


def compact_ts(ts: Column) -> Column:
    """``yyyyMMdd-HHmmss`` text used in collision-free names."""
    return F.regexp_replace(F.regexp_replace(_seconds_text(ts), "[-:]", ""), " ", "-")


def target_name(src_name: Column, job: Column, suffix: str = ARTIFACT_SUFFIX) -> Column:
    """``<stem><suffix>``; a missing source name falls back to the job id."""
    st = F.when(F.coalesce(src_name, F.lit("")) != "", stem(src_name))
    return F.concat(F.coalesce(st, job.cast("string")), F.lit(suffix))


def effective_pattern(pattern: Column, default: Column) -> Column:
    """a watch without its own (non-empty) pattern uses the default."""
    return F.coalesce(F.nullif(pattern, F.lit("")), default)


def entry_kind_ok(is_dir: Column, name: Column) -> Column:
    """Any regular file, or a directory whose lower-case name ends ``.d``."""
    return (~is_dir) | F.lower(name).endswith(".d")


def is_subpath(child: Column, parent: Column) -> Column:
    """P5: ``child`` equals ``parent`` or lies below it."""
    p = F.regexp_replace(parent, "/+$", "")
    return (child == p) | child.startswith(F.concat(p, F.lit("/")))


def ancestors(path: Column) -> Column:
    """Every enclosing prefix of a '/'-separated path, the path itself included."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.lit(1), F.size(parts)),
                       lambda i: F.array_join(F.slice(parts, 1, i), "/"))


def parent_dirs(rel: Column) -> Column:
    """Enclosing directories of a relative path, outermost first (empty at top level)."""
    parts = F.split(rel, "/")
    n = F.size(parts) - 1
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), n),
                                     lambda i: F.array_join(F.slice(parts, 1, i), "/"))) \
        .otherwise(F.array().cast("array<string>"))


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from ``start`` to ``end`` on wall-clock fields (zone-free for TIMESTAMP_NTZ).

    ``timestamp_diff`` passes NTZ values through the session zone, so a time
    inside a daylight-saving gap would be shifted by an hour.
    """
    def sod(t: Column) -> Column:
        return F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)
    return (F.datediff(F.to_date(end), F.to_date(start)).cast("bigint") * 86400
            + (sod(end) - sod(start)).cast("bigint"))
