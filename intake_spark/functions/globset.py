"""Many globs at once: an automaton over their required literals.

Every string that a glob matches contains the glob's literal runs, so its
longest one decides whether the glob has to be tried at all. All these literals
go into one Aho-Corasick automaton; a string is scanned once, and only the globs
whose literal it contains are tried, each compiled once a worker. Globs without
a literal of two characters are joined into a few expressions that are always
tried. The cost of a string grows with the globs that it hits, not with their
number.

A glob may carry an owner (a watch); then it is tried for strings of this owner only.
"""

from __future__ import annotations

import functools
import re
from collections import defaultdict

from .patterns import fnmatch_regex, path_glob_regex

SHORTEST = 2      # characters of a literal worth looking for
JOINED = 200      # globs without a literal in one expression


def required_literal(glob: str, path_rules: bool) -> str:
    """The longest run of characters that every match of ``glob`` contains.
    Under path rules a run ends at ``/`` beside ``**`` (it may match nothing) and
    surplus slashes are no characters."""
    runs, run, i = [], "", 0
    if path_rules:
        glob = "/".join(s for s in glob.strip("/").split("/") if s not in ("", "."))
    while i < len(glob):
        ch = glob[i]
        if ch == "[":
            end = i + 2 if glob[i + 1: i + 2] == "!" else i + 1
            end = glob.find("]", end + 1)
            if end < 0:
                run += ch
                i += 1
                continue
            runs.append(run)
            run, i = "", end + 1
        elif ch in "*?":
            if path_rules and ch == "*" and glob[i: i + 2] == "**" and glob[i + 2: i + 3] in ("", "/") and (i == 0 or glob[i - 1] == "/"):
                run = run.rstrip("/")  # the segment and its slash may be nothing
                i += 1 + (glob[i + 2: i + 3] == "/")
            runs.append(run)
            run, i = "", i + 1
        else:
            run += ch
            i += 1
    return max([*runs, run], key=len)


def _for_python(regex: str) -> str:
    """The same expression in Python's dialect, for ``match`` with ``DOTALL``."""
    return regex.removeprefix("(?s)\\A").removesuffix("\\z") + "\\Z"


class GlobSet:
    """``globs``: (owner or None, glob). ``recursive`` only holds for path rules."""

    def __init__(self, globs: list[tuple[str | None, str]], path_rules: bool = False, recursive: bool = False) -> None:
        import ahocorasick

        self._regex = [_for_python(path_glob_regex(g, recursive) if path_rules else fnmatch_regex(g)) for _, g in globs]
        self._tried: dict[int, re.Pattern] = {}
        by_literal, plain = defaultdict(list), defaultdict(list)
        for i, (owner, g) in enumerate(globs):
            literal = required_literal(g, path_rules)
            if len(literal) >= SHORTEST:
                by_literal[literal].append((owner, i))
            else:
                plain[owner].append(i)
        self._hits = ahocorasick.Automaton()
        for literal, owned in by_literal.items():
            of = defaultdict(list)
            for owner, i in owned:
                of[owner].append(i)
            self._hits.add_word(literal, dict(of))
        self._any = bool(by_literal)
        if self._any:
            self._hits.make_automaton()
        self._always = {o: [re.compile("|".join(f"(?:{self._regex[i]})" for i in ids[a: a + JOINED]), re.S)
                            for a in range(0, len(ids), JOINED)] for o, ids in plain.items()}
        self.owners = {o for o, _ in globs}

    def _matches(self, i: int, text: str) -> bool:
        rx = self._tried.get(i)
        if rx is None:
            rx = self._tried[i] = re.compile(self._regex[i], re.S)
        return rx.match(text) is not None

    def match(self, text: str, owner: str | None = None) -> bool:
        """Whether a glob of the owner matches the whole text."""
        if any(rx.match(text) for rx in self._always.get(owner, ())):
            return True
        if not self._any:
            return False
        seen = set()
        for _, owned in self._hits.iter(text):
            for i in owned.get(owner, ()):
                if i not in seen:
                    if self._matches(i, text):
                        return True
                    seen.add(i)
        return False


@functools.lru_cache(maxsize=8)
def glob_set(globs: tuple[tuple[str | None, str], ...], path_rules: bool = False, recursive: bool = False) -> GlobSet:
    """One automaton a worker for equal lists."""
    return GlobSet(list(globs), path_rules, recursive)
