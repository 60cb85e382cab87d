"""Keys that hold many rows, found in one pass by a summary of bounded size.

The summary is the frequent-items sketch behind ``approx_top_k``, of the Misra-Gries kind: tasks keep at most ``tracked``
counters each and merge them, and no count is off by more than ``3.5 / tracked`` of all rows. It lists only keys that do occur, and all
that hold twice that share. Because it is an aggregate, it can be observed while a table is written.

Only types with one text for each value are summed up so (whole numbers, texts, booleans, days, times, decimals): the text of
a key stands for it. Rows with a NULL among their keys match nothing and are not counted.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

__all__ = ["TRACKED", "has_key_text", "heavy_keys", "key_text", "observe_keys"]

TRACKED = 8192  # counters of a summary
_ERROR = 3.5
_EXACT = (T.IntegralType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType)


def has_key_text(df: DataFrame, keys: Sequence[str]) -> bool:
    """Can the text of these columns stand for their values?"""
    return all(isinstance(df.schema[k].dataType, _EXACT) for k in keys)


def key_text(keys: Sequence[Column]) -> Column:
    """One text for each value of a key, NULL where a part of it is NULL."""
    if len(keys) == 1:
        return keys[0].cast("string")
    known = keys[0].isNotNull()
    for k in keys[1:]:
        known = known & k.isNotNull()
    return F.when(known, F.to_json(F.struct(*[k.cast("string").alias(f"k{i}") for i, k in enumerate(keys)])))


def _summary(keys: Sequence[Column], tracked: int) -> list[Column]:
    return [F.count(F.lit(1)).alias("rows"), F.call_function("approx_top_k", key_text(keys), F.lit(tracked), F.lit(tracked)).alias("top")]


def observe_keys(df: DataFrame, keys: Sequence[str], tracked: int = TRACKED) -> tuple[DataFrame, Callable[[int], list[tuple[str, int]]]]:
    """The frame with its keys observed, and a function to call once it has been written.

    That gives (text of the key, rows at most) of every key with at least ``least`` rows; where that is under
    ``7 / tracked`` of all rows, of every key with that many. It waits for the write.
    """
    seen = Observation()
    watched = df.observe(seen, *_summary([F.col(f"`{k}`") for k in keys], tracked))

    def heavy(least: int) -> list[tuple[str, int]]:
        found = seen.get
        least = max(least, 2 * _ERROR / tracked * (found.get("rows") or 0))
        return [(r["item"], r["count"]) for r in found.get("top") or [] if r["item"] is not None and r["count"] >= least]

    return watched, heavy


def heavy_keys(df: DataFrame, keys: Sequence[str], share: float) -> DataFrame:
    """(keys, ``rows``) of every key that holds at least ``share`` of all rows, counted exactly.

    One pass finds the candidates, at most ``2 / share`` of them or so; a second counts those alone, combined map-side, so no hot key
    is shuffled. NULL keys count as rows, but are not listed; an empty table has no heavy key.
    """
    if not 0 < share <= 1:
        raise ValueError("a share is above 0 and at most 1")
    if not has_key_text(df, keys):
        raise TypeError("keys must have one text for each value")
    columns = [F.col(f"`{k}`") for k in keys]
    tracked = 1 << max(6, math.ceil(math.log2(2 * _ERROR / share)))
    found = df.agg(*_summary(columns, tracked)).first()
    least = math.ceil(share * found["rows"] * (1 - 1e-12))  # a product just over a whole number is that number
    named = [r["item"] for r in found["top"] or [] if r["item"] is not None and r["count"] >= least]
    candidates = df.sparkSession.createDataFrame([(t,) for t in named], "_heavy string")
    counted = df.select(*columns).join(F.broadcast(candidates), key_text(columns) == F.col("_heavy"), "left_semi")  # bounded by tracked
    return counted.groupBy(*columns).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") >= least)
