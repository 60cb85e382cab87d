"""Where a published table and its source differ, by fingerprints of key ranges.

A change window only sees rows whose change time moved: deletes and late writes escape it. Here both sides are cut into key ranges
of about equal size, each range gets an order-free fingerprint on either side (``fingerprints``), and only ranges that differ are cut
again, until they are small. A range is a filter on the bare key, so equal ranges are not read again where the scan can skip
them. Within the last ranges the rows are compared key by key.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .fingerprints import PARTS, fingerprint
from .slices import key_edges

__all__ = ["KeyRange", "differing_keys", "differing_ranges"]

FEW = 64  # ranges or edges that are spelt out in an expression
MAX_RANGES = 1000  # differing ranges that are still cut; more of them are compared as they are


@dataclass(frozen=True)
class KeyRange:
    """Keys from ``low`` up to but not ``high``; None is open. ``blank``: the rows without a key instead."""

    low: object = None
    high: object = None
    blank: bool = False
    rows: int = 0  # of the larger side

    def holds(self, c: Column) -> Column:
        if self.blank:
            return c.isNull()
        bounds = [c.isNotNull(), *([c >= F.lit(self.low)] if self.low is not None else []), *([c < F.lit(self.high)] if self.high is not None else [])]
        return reduce(Column.__and__, bounds)


def _halved(c: Column, edges: list, first: int = 0) -> Column:
    """The number of edges up to a key, by halving."""
    if not edges:
        return F.lit(first)
    mid = len(edges) // 2
    return F.when(c < F.lit(edges[mid]), _halved(c, edges[:mid], first)).otherwise(_halved(c, edges[mid + 1:], first + mid + 1))


def _number(df: DataFrame, key: str, edges: list) -> Column:
    """The number of edges up to a key. Many edges are searched in one literal: the expression, its code and its depth do not grow with them."""
    c = F.col(f"`{key}`")
    if len(edges) <= FEW:
        return _halved(c, edges)
    listed = F.array(*[F.lit(e) for e in edges]).cast(T.ArrayType(df.schema[key].dataType))
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(len(edges).bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda n, step: F.when((n + step <= len(edges)) & (F.get(listed, n + step - 1) <= c), n + step).otherwise(n))


def _any_of(conditions: list[Column]) -> Column:
    """Their OR, as deep as the logarithm of their number: one after the other, a few hundred overflow the planner's stack."""
    while len(conditions) > 1:
        conditions = [reduce(Column.__or__, conditions[i:i + 2]) for i in range(0, len(conditions), 2)]
    return conditions[0]


def _joined(ranges: list[KeyRange]) -> list[KeyRange]:
    """The same keys in fewer ranges: those that touch are one. Ranges come in order, without blank ones."""
    out: list[KeyRange] = []
    for r in ranges:
        if out and out[-1].high is not None and out[-1].high == r.low:
            out[-1] = KeyRange(out[-1].low, r.high)
        else:
            out.append(r)
    return out


def _within(df: DataFrame, key: str, ranges: list[KeyRange]) -> DataFrame:
    c = F.col(f"`{key}`")
    spans = _joined([r for r in ranges if not r.blank])
    # hulls reach the scan; many spans are told apart by the parity of the bounds up to a key
    size = -(-len(spans) // FEW) or 1
    hulls = [KeyRange(spans[i].low, spans[min(i + size, len(spans)) - 1].high) for i in range(0, len(spans), size)]
    held = [h.holds(c) for h in hulls]
    if size > 1:
        bounds = [b for r in spans for b in (r.low, r.high) if b is not None]
        inside = _number(df, key, bounds) % 2 == F.lit(0 if spans[0].low is None else 1)
        held = [_any_of(held) & inside]
    blank = [r.holds(c) for r in ranges if r.blank]
    return df.where(_any_of([*held, *blank])) if ranges else df


def _differing(source: DataFrame, target: DataFrame, key: str, columns: list[str], edges: list) -> list[KeyRange]:
    c = F.col(f"`{key}`")

    def told(df: DataFrame) -> DataFrame:
        place = F.when(c.isNull(), -1).otherwise(_number(df, key, edges)).alias("_range")
        return df.select(place, "*").groupBy("_range").agg(*fingerprint(df, columns))

    mine, theirs = told(source), told(target)
    both = mine.join(theirs.withColumnsRenamed({p: f"{p}t" for p in PARTS}), "_range", "full")
    differs = reduce(Column.__or__, [~F.col(p).eqNullSafe(F.col(f"{p}t")) for p in PARTS])
    found = both.where(differs).select("_range", F.greatest("_rows", "_rowst").alias("rows")).collect()  # a row per range
    ends = [None, *edges, None]
    return [KeyRange(blank=True, rows=r["rows"]) if r["_range"] < 0 else KeyRange(ends[r["_range"]], ends[r["_range"] + 1], rows=r["rows"])
            for r in sorted(found, key=lambda r: r["_range"])]


def _in_order(ranges: list[KeyRange]) -> list[KeyRange]:
    """By key, blank and open ones first."""
    first = [r for r in ranges if r.blank or r.low is None]
    return sorted(first, key=lambda r: not r.blank) + sorted((r for r in ranges if not r.blank and r.low is not None), key=lambda r: r.low)


def differing_ranges(
    source: DataFrame, target: DataFrame, key: str, columns: Iterable[str] | None = None, fan_out: int = 64, small: int = 10_000, levels: int = 6,
) -> list[KeyRange]:
    """The key ranges in which the two hold different bags of rows (over ``columns``; all of the source's otherwise), of about ``small`` rows each."""
    columns = sorted(columns or source.columns)
    found = _differing(source, target, key, columns, key_edges(source.select(key).unionByName(target.select(key)), key, fan_out))
    for _ in range(levels):
        large = [r for r in found if r.rows > small and not r.blank]
        if not large or len(found) > MAX_RANGES:
            break
        mine, theirs = _within(source, key, large), _within(target, key, large)
        edges = key_edges(mine.select(key).unionByName(theirs.select(key)), key, min(fan_out * len(large), 4 * MAX_RANGES))
        ends = [v for r in large for v in (r.low, r.high) if v is not None]
        cut = sorted({*edges, *ends})
        if set(cut) == set(ends):
            break  # one key holds a range
        kept = [r for r in found if r.rows <= small or r.blank]
        found = _in_order([*kept, *_differing(mine, theirs, key, columns, cut)])
    return found


def differing_keys(
    source: DataFrame, target: DataFrame, key: str, columns: Iterable[str] | None = None, fan_out: int = 64, small: int = 10_000,
) -> DataFrame:
    """(key, status): ``missing`` from the target, ``extra`` there, or ``changed``, for every key whose rows differ; a NULL key is a key."""
    columns = sorted(columns or source.columns)
    found = differing_ranges(source, target, key, columns, fan_out, small)
    c = F.col(f"`{key}`")

    def told(df: DataFrame) -> DataFrame:
        rows = _within(df, key, found) if found else df.limit(0)
        return rows.groupBy(c.alias("_key")).agg(*fingerprint(rows, columns))

    mine, theirs = told(source), told(target).withColumnsRenamed({**{p: f"{p}t" for p in PARTS}, "_key": "_keyt"})
    both = mine.join(theirs, F.col("_key").eqNullSafe(F.col("_keyt")), "full")
    differs = reduce(Column.__or__, [~F.col(p).eqNullSafe(F.col(f"{p}t")) for p in PARTS])
    status = F.when(F.col("_rowst").isNull(), "missing").when(F.col("_rows").isNull(), "extra").otherwise("changed")
    return both.where(differs).select(F.coalesce("_key", "_keyt").alias(key), status.alias("status"))
