"""Names for helper columns beside columns of unknown names."""

from __future__ import annotations

from collections.abc import Iterable


def free_name(name: str, taken: Iterable[str]) -> str:
    """name, or the first of name_1, name_2, ... that no column has, whatever its case."""
    lower, k, now = {t.lower() for t in taken}, 0, name
    while now.lower() in lower:
        k += 1
        now = f"{name}_{k}"
    return now
