"""Pattern functions: list normalisation (F1) and the two glob dialects.

Include patterns follow path-glob rules: ``*`` and ``?`` stay inside one path
segment, ``**`` spans directories, dot-files are matched. Ignore patterns
follow shell-name rules: ``*`` crosses ``/``. Both are compiled to Java
regular expressions so the test runs inside ``rlike`` (JVM, codegen), never in
a Python UDF on the data path. Compilation is a few characters of string work
per *pattern*; patterns come from configuration, not from the data volume.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters a pattern list string is split on, the suffix that
# gets a directory twin, and that twin's suffix.
PATTERN_SEPARATORS = "[,;|]"
RAW_SUFFIX = ".raw"
DIR_SUFFIX = ".d"
GLOB_META = "*?["

# Everything Python's str.strip() removes, as a Java character class.
WS_CLASS = "[\\s\\x1c-\\x1f\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]"


def strip_ws(c: Column) -> Column:
    """Python ``str.strip()`` on a string column."""
    return F.regexp_replace(c, f"^{WS_CLASS}+|{WS_CLASS}+$", "")


def normalize_patterns(c: Column) -> Column:
    """pattern string -> ordered, de-duplicated array of globs.

    Split on , ; |, strip, drop empties; every pattern ending in ``.raw`` is
    followed by its ``.d`` twin; the first occurrence of a duplicate wins.
    """
    parts = F.filter(F.transform(F.split(c, PATTERN_SEPARATORS), strip_ws), lambda x: x != "")
    with_twins = F.transform(
        parts,
        lambda x: F.when(x.endswith(RAW_SUFFIX),
                         F.array(x, F.regexp_replace(x, "\\.raw$", DIR_SUFFIX)))
        .otherwise(F.array(x)),
    )
    return F.array_distinct(F.flatten(with_twins))


def is_glob(c: Column) -> Column:
    """True when a pattern has a wildcard; the rest compare as plain strings."""
    return c.rlike("[*?\\[]")


def _lit_char(ch: str) -> str:
    return ch if ch.isalnum() or ch == "_" else "\\" + ch


def _class(body: str, no_slash: bool) -> str:
    """A bracket expression. A reversed range holds nothing; an expression
    that holds nothing matches no character, its negation any."""
    neg = body.startswith("!")
    body = body[neg:]
    items, i = [], 0
    while i < len(body):
        if body[i + 1: i + 2] == "-" and i + 2 < len(body):
            if body[i] <= body[i + 2]:
                items.append(_member(body[i]) + "-" + _member(body[i + 2]))
            i += 3
        else:
            items.append(_member(body[i]))
            i += 1
    if not items:
        return ("[^/]" if no_slash else ".") if neg else "(?!)"
    return "[" + ("^" if neg else "") + "".join(items) + ("/" if neg and no_slash else "") + "]"


def _member(ch: str) -> str:
    return "\\" + ch if ch in "\\[]&^-" else ch


def _translate(pat: str, star: str, one: str) -> str:
    out: list[str] = []
    i, n = 0, len(pat)
    while i < n:
        ch = pat[i]
        i += 1
        if ch == "*":
            while i < n and pat[i] == "*":
                i += 1
            out.append(star)
        elif ch == "?":
            out.append(one)
        elif ch == "[":
            j = i
            if j < n and pat[j] == "!":
                j += 1
            if j < n and pat[j] == "]":
                j += 1
            while j < n and pat[j] != "]":
                j += 1
            if j >= n:
                out.append("\\[")
            else:
                out.append(_class(pat[i:j], one != "."))
                i = j + 1
        else:
            out.append(_lit_char(ch))
    return "".join(out)


def fnmatch_regex(pat: str) -> str:
    """Shell-name pattern -> anchored Java regex (``*`` crosses ``/``)."""
    return "(?s)\\A" + _translate(pat, ".*", ".") + "\\z"


def path_glob_regex(pat: str, recursive: bool = False) -> str:
    """Path glob -> anchored Java regex over a path relative to the root.

    ``*``/``?`` do not cross ``/``; a ``**`` segment spans any number of
    directories; ``recursive`` matches the pattern at any depth.
    """
    segs = []
    for seg in pat.strip("/").split("/"):
        if seg == "**":
            segs.append(None)
        elif seg not in ("", "."):
            segs.append(_translate(seg, "[^/]*", "[^/]"))
    body = ""
    for k, s in enumerate(segs):
        last = k == len(segs) - 1
        if s is None:
            body += ".*" if last else "(?:.*/)?"
        else:
            body += s + ("" if last else "/")
    prefix = "(?:.*/)?" if recursive else ""
    return "(?s)\\A" + prefix + body + "\\z"


def combined_regex(regexes: list[str]) -> str | None:
    """One alternation for a bounded list of compiled patterns."""
    if not regexes:
        return None
    return "|".join(f"(?:{r})" for r in regexes)
