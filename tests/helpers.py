from __future__ import annotations

from collections import Counter


def rows(frame) -> list[tuple]:
    return [tuple(row) for row in frame.collect()]


def bag(frame) -> Counter:
    """Rows as a multiset, for frames without an order."""
    return Counter(rows(frame))


def plan(frame) -> str:
    return frame._jdf.queryExecution().toString()
