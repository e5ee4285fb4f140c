"""Tables that a Python worker keeps from task to task: tokenizers, parts of a model.

Spark gives its workers to one stage after another, so what one operator keeps
would fill memory while the next one runs. A task says at its start for which
operator it runs, and the tables of the others are let go.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa

_CLEAR: dict[str, Callable[[], object]] = {}
_LAST: list[str] = []


def keeps(name: str, clear: Callable[[], object]) -> None:
    """Name an operator's tables, and what empties them."""
    _CLEAR[name] = clear


def begin(name: str) -> None:
    """A task of the operator ``name`` starts in this worker."""
    if _LAST == [name]:
        return
    _LAST[:] = [name]
    for other, clear in _CLEAR.items():
        if other != name:
            clear()
    pa.default_memory_pool().release_unused()
