"""Key sets, and joining on them without losing the handling of hot keys.

The adaptive planner splits a hot key only where a shuffle stands directly under the
join. A distinct or a sum on the join key leaves its own partitioning there instead,
and the join reuses it: one task then gets a hot key whole. ``match(..., spread=True)``
adds a hash of the key to the join condition, so the reuse does not apply; the price is
a second shuffle of the aggregated side, which is narrow and has one row per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

__all__ = ["estimated_bytes", "fits_broadcast", "match", "key_set", "with_keys", "without_keys"]


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's own size estimate of a plan."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits_broadcast(df: DataFrame, times: int = 1) -> bool:
    """Would Catalyst itself broadcast this side, if it were ``times`` as large as estimated?"""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return 0 < estimated_bytes(df) * times <= limit


def match(left: Sequence[Column], right: Sequence[Column], spread: bool = False) -> Column:
    """Equality of all key columns."""
    condition = left[0] == right[0]
    for a, b in zip(left[1:], right[1:]):
        condition = condition & (a == b)
    return (F.xxhash64(*left) == F.xxhash64(*right)) & condition if spread else condition


def key_set(rows: DataFrame, key: str) -> DataFrame:
    """The distinct non-NULL keys of some rows, in column ``_key``; nothing else is read."""
    return rows.select(F.col(f"`{key}`").alias("_key")).filter(F.col("_key").isNotNull()).distinct()


def _join(df: DataFrame, keys: DataFrame, key: str, how: str, placed: bool) -> DataFrame:
    # the hash of the spread form needs equal types; unequal ones are cast, which spreads as well
    same = df.schema[key].dataType == keys.schema["_key"].dataType
    spread = same and not placed and not fits_broadcast(keys)
    return df.join(keys, match([F.col(f"`{key}`")], [F.col("_key")], spread), how)


def with_keys(df: DataFrame, keys: DataFrame, key: str, placed: bool = False) -> DataFrame:
    """Rows whose key is in the key set. ``placed``: the rows are laid out by the key already."""
    return _join(df, keys, key, "left_semi", placed)


def without_keys(df: DataFrame, keys: DataFrame, key: str, placed: bool = False) -> DataFrame:
    """Rows whose key is not in the key set, among them those with a NULL key."""
    return _join(df, keys, key, "left_anti", placed)
