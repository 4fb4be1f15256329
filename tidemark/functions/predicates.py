"""A typed filter tree compiled to a Column.

Nodes are dicts: {"op": "compare", "column", "cmp", "value"}, {"op": "in", "column", "values",
"negated"}, {"op": "is_null" | "is_not_null", "column"}, {"op": "between", "column", "low",
"high"}, {"op": "and" | "or", "children"}, {"op": "not", "child"}.  No SQL text is ever taken.
"""

from __future__ import annotations

import math
import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_DEPTH = 32
MAX_PROJECTION = 64
MAX_K = 10_000
_IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]*\Z")
_SEGMENT = re.compile(r"[A-Za-z0-9_-]{1,128}\Z")
_COMPARE = {
    "eq": lambda a, b: a == b,
    "ne": lambda a, b: a != b,
    "lt": lambda a, b: a < b,
    "le": lambda a, b: a <= b,
    "gt": lambda a, b: a > b,
    "ge": lambda a, b: a >= b,
}


class FilterError(ValueError):
    """A filter, projection or limit that is not allowed."""


def literal(value) -> Column:
    if isinstance(value, bool) or isinstance(value, str):
        return F.lit(value)
    if isinstance(value, int):
        if not -(1 << 63) <= value < 1 << 63:
            raise FilterError("integer beyond 64 bits")
        return F.lit(value)
    if isinstance(value, float) and math.isfinite(value):
        return F.lit(value)
    raise FilterError(f"not a filter literal: {value!r}")


def _column(name, allowed: set[str]) -> Column:
    if not isinstance(name, str) or not _IDENTIFIER.match(name) or name not in allowed:
        raise FilterError(f"unknown column {name!r}")
    return F.col(name)


def compile_filter(node: dict, allowed, depth: int = 0) -> Column:
    """The Column of a filter tree over the columns ``allowed``; comparisons with null are null, as in SQL."""
    allowed = set(allowed)
    if depth > MAX_DEPTH:
        raise FilterError(f"filter deeper than {MAX_DEPTH}")
    op = node.get("op")
    if op == "compare":
        if node.get("cmp") not in _COMPARE:
            raise FilterError(f"unknown comparison {node.get('cmp')!r}")
        return _COMPARE[node["cmp"]](_column(node.get("column"), allowed), literal(node["value"]))
    if op == "in":
        if not node.get("values"):
            raise FilterError("an empty list")
        found = _column(node.get("column"), allowed).isin([literal(v) for v in node["values"]])
        return ~found if node.get("negated") else found
    if op in ("is_null", "is_not_null"):
        c = _column(node.get("column"), allowed)
        return c.isNull() if op == "is_null" else c.isNotNull()
    if op == "between":
        return _column(node.get("column"), allowed).between(literal(node["low"]), literal(node["high"]))
    if op in ("and", "or"):
        if not node.get("children"):
            raise FilterError("no children")
        parts = [compile_filter(c, allowed, depth + 1) for c in node["children"]]
        return reduce((lambda a, b: a & b) if op == "and" else (lambda a, b: a | b), parts)
    if op == "not":
        return ~compile_filter(node["child"], allowed, depth + 1)
    raise FilterError(f"unknown node {op!r}")


def time_window(micros: Column, start_ms: int | None, end_ms: int | None, seconds: bool = False) -> Column:
    """Half-open [start, end) in epoch milliseconds over a column of epoch microseconds, or of whole
    seconds, for which both bounds round up."""
    out = F.lit(True)
    for bound, keep in ((start_ms, lambda c, b: c >= b), (end_ms, lambda c, b: c < b)):
        if bound is None:
            continue
        value = -(-bound // 1000) if seconds else bound * 1000
        if not -(1 << 63) <= value < 1 << 63:
            raise FilterError("time bound beyond 64 bits")
        out = out & keep(micros, F.lit(value))
    return out


def projection(columns: list[str], requested: list[str], key: str, tombstone: str, vectors: set[str]) -> list[str]:
    """Output columns: all but vectors, key and tombstone when none are named."""
    hidden = {key, tombstone}
    if not requested:
        return [c for c in columns if c not in hidden and c not in vectors]
    if len(requested) > MAX_PROJECTION or len(set(requested)) != len(requested):
        raise FilterError("too many columns, or one twice")
    for c in requested:
        if c in hidden or c not in columns:
            raise FilterError(f"column {c!r} can't be asked for")
    return list(requested)


def check_k(k: int) -> int:
    if not 1 <= k <= MAX_K:
        raise FilterError(f"k must be 1 to {MAX_K}")
    return k


def check_segment(value: str) -> str:
    if not _SEGMENT.match(value or ""):
        raise FilterError(f"bad route segment {value!r}")
    return value


def valid_segment(value: Column) -> Column:
    """Whether a route segment may be one; null may not."""
    return F.coalesce(value.rlike("^[A-Za-z0-9_-]{1,128}$") & ~value.endswith("\n"), F.lit(False))


def serving_predicate(filter_node: dict | None, allowed, window: Column | None = None, tombstone: str = "is_deleted") -> Column:
    """The live-row guard, always, with the filter and the time window; ranked rows come after it."""
    out = ~F.col(tombstone)
    if filter_node is not None:
        out = out & compile_filter(filter_node, allowed)
    return out if window is None else out & window
