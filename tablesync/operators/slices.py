"""Slices of about equal size along a time column and a key, for parallel reads.

Edges come from the rows with the smallest hashes of their key: a sample that merges (the smallest of two are the smallest of the union), is the
same on every run, and takes one pass with a bounded result. They lie on (time, key), so one time that a bulk
update gave to many rows is cut by its keys.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

__all__ = ["PER_SLICE", "Edge", "key_edges", "literal", "slice_edges", "slice_predicates"]

PER_SLICE = 256  # sampled rows a slice: sizes then differ by some 6 %
MOST_SAMPLED = 65_536  # keys the driver gets at once
Edge = tuple[datetime, "int | str"]


def literal(v) -> str:
    """A key or time as SQL."""
    if isinstance(v, datetime):
        return f"'{v:%Y-%m-%d %H:%M:%S.%f}'"
    if isinstance(v, bool) or not isinstance(v, (int, str)):
        raise TypeError(f"a key of type {type(v).__name__}")
    return str(v) if isinstance(v, int) else "'" + v.replace("\\", "\\\\").replace("'", "''") + "'"


def _cut(sample: list, slices: int) -> list:
    sample = sorted(sample)
    return sorted({sample[i * len(sample) // slices] for i in range(1, slices)}) if len(sample) > 1 else []


def slice_edges(df: DataFrame, column: str, key: str, slices: int, per_slice: int = PER_SLICE) -> list[Edge]:
    """At most ``slices - 1`` edges between slices of about equal numbers of rows; two columns are read."""
    c, k = F.col(f"`{column}`").alias("c"), F.col(f"`{key}`").alias("k")
    rows = df.select(c, k).where("c is not null and k is not null").orderBy(F.xxhash64("k", "c")).limit(slices * per_slice).collect()
    return _cut([(r["c"], r["k"]) for r in rows], slices)


def key_edges(df: DataFrame, key: str, ranges: int, per_range: int = PER_SLICE) -> list:
    """The same along a key alone (NULLs aside); a key counts once. Many ranges share ``MOST_SAMPLED`` keys, so theirs are less even."""
    per_range = max(1, min(per_range, MOST_SAMPLED // max(ranges, 1)))
    rows = df.select(F.col(f"`{key}`").alias("k")).where("k is not null").distinct().orderBy(F.xxhash64("k")).limit(ranges * per_range).collect()
    return _cut([r["k"] for r in rows], ranges)


def slice_predicates(edges: list[Edge], column: str, key: str) -> list[str]:
    """SQL conditions that hold every row exactly once: open at both ends, the rows without a time on their own.

    Each has a range on the bare column, which an index serves. Rows without a key come first among those of their time's last slice.
    """
    def lower(e: Edge) -> str:
        t, k = literal(e[0]), literal(e[1])
        return f"{column} >= {t} AND ({column} > {t} OR {key} >= {k} OR {key} IS NULL)"

    def upper(e: Edge) -> str:
        t, k = literal(e[0]), literal(e[1])
        return f"{column} <= {t} AND ({column} < {t} OR {key} < {k})"

    if not edges:
        return ["1 = 1"]
    # a row without a key lies in the last slice that begins at its time: earlier ones of that time end before it
    inner = [f"{lower(a)} AND {upper(b)}" for a, b in zip(edges, edges[1:])]
    return [upper(edges[0]), *inner, lower(edges[-1]), f"{column} IS NULL"]
