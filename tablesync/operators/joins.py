"""Left joins that survive skew and large right sides.

No join of tables here carries a broadcast hint (the list of hot keys, which is bounded, does): Catalyst
broadcasts a side only when its size estimate is under ``spark.sql.autoBroadcastJoinThreshold``, and the adaptive
planner does so again from measured sizes. Past that bound the joins shuffle, and a hot key is
split by the adaptive skew join. That rule can split the left side of a left join but
never its right side, hence the two shapes below:

* ``lookup``: many rows to one. A hot (or NULL) key sits on the left, which can be split.
* ``fan_out``: one row to many, a plain left join, which reads each side once. A hot key sits on the
  right. Given ``staging``, the sides are written first, the right one cut to the base keys. The pass that writes it also
  finds the hot keys (``heavy``), and those alone take a salted inner join, which the adaptive planner can split further.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .heavy import has_key_text, key_text, observe_keys
from .keys import fits_broadcast, match

__all__ = ["lookup", "fan_out", "staged_fan_out", "replace_by_lookup", "preagg_join", "only_keys_of"]


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def _right_side(
    right: DataFrame, on: Mapping[str, str], take: Mapping[str, Column | str]
) -> tuple[DataFrame, list[str]]:
    """The right side cut to keys and taken columns, the keys under names of their own."""
    keys = [f"_key{i}" for i in range(len(on))]
    named = [_q(r).alias(k) for r, k in zip(on.values(), keys)]
    return right.select(*named, *[(_q(c) if isinstance(c, str) else c).alias(out) for out, c in take.items()]), keys


def _condition(base: DataFrame, side: DataFrame, on: Mapping[str, str], keys: list[str], spread: bool = False) -> Column:
    # the hash of the spread form needs equal types; unequal ones are cast, which spreads as well
    same = all(base.schema[left].dataType == side.schema[key].dataType for left, key in zip(on, keys))
    return match([_q(left) for left in on], [F.col(k) for k in keys], spread and same)


def _check_names(base: DataFrame, take: Mapping[str, str]) -> None:
    have = {c.lower() for c in base.columns}
    clash = [c for c in take if c.lower() in have]
    if clash:
        raise ValueError(f"joined columns already exist in the base table: {clash}")


def only_keys_of(right: DataFrame, keys: list[str], base: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Reduce a large right side to the keys of a small base before it is shuffled.

    Done only where the base keys are small enough for Catalyst to broadcast and the
    right side is not; then the reduction is a filter inside the scan stage.
    """
    if fits_broadcast(right):
        return right
    wanted = base.select(*[_q(left).alias(f"_w{i}") for i, left in enumerate(on)]).distinct()
    if not fits_broadcast(wanted):
        return right
    condition = match([F.col(k) for k in keys], [F.col(c) for c in wanted.columns])
    return right.join(wanted, condition, "left_semi")


def lookup(base: DataFrame, right: DataFrame, on: Mapping[str, str], take: Mapping[str, str]) -> DataFrame:
    """Add columns of a lookup table; unmatched rows get NULL.

    ``on`` maps base column to lookup column, ``take`` output name to lookup column.
    """
    _check_names(base, take)
    side, keys = _right_side(right, on, take)
    side = only_keys_of(side, keys, base, on)
    return base.join(side, _condition(base, side, on, keys), "left").drop(*keys)


HOT_ROWS = 1_000_000  # rows of one key from which a task of its own is too much


def fan_out(
    base: DataFrame, right: DataFrame, on: Mapping[str, str], take: Mapping[str, str],
    staging: Callable[[DataFrame, str], DataFrame] | None = None, hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """One base row per match; unmatched base rows stay once, with NULL.

    ``staging`` writes a frame and gives it back as read from there. ``hot_rows``: what a task should get of one key; a key is hot from
    there on, or from ``7 / TRACKED`` of all rows where that is more.
    """
    _check_names(base, take)
    side, keys = _right_side(right, on, take)
    if staging is None or fits_broadcast(side):
        return base.join(side, _condition(base, side, on, keys), "left").drop(*keys)
    return staged_fan_out(base, right, on, take, staging, hot_rows)


def staged_fan_out(
    base: DataFrame, right: DataFrame, on: Mapping[str, str], take: Mapping[str, str],
    staging: Callable[[DataFrame, str], DataFrame], hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``fan_out`` for a right side of any size: both sides are written, keys hot on the right are salted."""
    _check_names(base, take)
    side, keys = _right_side(right, on, take)
    base = staging(base, "base")
    side = only_keys_of(side, keys, base, on)
    same = all(base.schema[left].dataType == side.schema[key].dataType for left, key in zip(on, keys))
    if not (same and has_key_text(side, keys)):
        return _fan_out_counted(base, staging(side, "right"), on, take, keys, hot_rows)
    watched, heavy = observe_keys(side, keys)
    side = staging(watched, "right")
    hot = [(text, math.ceil(rows / hot_rows)) for text, rows in heavy(hot_rows)]
    if not hot:
        return base.join(side, _condition(base, side, on, keys), "left").drop(*keys)
    return _fan_out_salted(base, side, on, keys, hot)


def _fan_out_salted(base: DataFrame, side: DataFrame, on: Mapping[str, str], keys: list[str], hot: list[tuple[str, int]]) -> DataFrame:
    """Rows of hot keys and all others apart, over the written tables.

    A hot key does occur on the right, so its rows are an inner join, in which both sides can be split: the right one is dealt over
    salts, a base row is there once for each salt of its key.
    """
    listed = F.broadcast(base.sparkSession.createDataFrame(hot, "_hot string, _salts int"))  # at most TRACKED keys
    texts = key_text([_q(c) for c in on]), key_text([F.col(k) for k in keys])
    calm = [df.join(listed, text == F.col("_hot"), "left_anti") for df, text in zip((base, side), texts)]
    others = calm[0].join(calm[1], _condition(base, side, on, keys), "left").drop(*keys)
    left = base.join(listed, texts[0] == F.col("_hot")).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)))
    # the number of a row of a written table is the same however often a task runs
    right = side.withColumn("_id", F.monotonically_increasing_id()).join(listed, texts[1] == F.col("_hot"))
    right = right.withColumn("_slot", F.pmod("_id", F.col("_salts")).cast("int")).drop("_id", "_hot", "_salts")
    dealt = left.drop("_hot", "_salts").join(right, _condition(base, side, on, keys) & (F.col("_salt") == F.col("_slot")), "inner")
    return others.unionByName(dealt.drop("_salt", "_slot", *keys))


def _fan_out_counted(
    base: DataFrame, side: DataFrame, on: Mapping[str, str], take: Mapping[str, str], keys: list[str], hot_rows: int
) -> DataFrame:
    """For keys whose text is no stand-in: counted, and where one is hot an inner join plus the unmatched rows."""
    counts = side.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))  # partial map-side: a hot key moves once a task
    if (counts.agg(F.max("_rows")).first()[0] or 0) < hot_rows:
        return base.join(side, _condition(base, side, on, keys), "left").drop(*keys)
    matched = base.join(side, _condition(base, side, on, keys), "inner").drop(*keys)
    unmatched = base.join(side.select(*keys).distinct(), _condition(base, side, on, keys, spread=True), "left_anti")
    missing = [F.lit(None).cast(side.schema[out].dataType).alias(out) for out in take]
    return matched.unionByName(unmatched.select("*", *missing))


def replace_by_lookup(base: DataFrame, right: DataFrame, column: str, key: str, value: str) -> DataFrame:
    """Overwrite a foreign key by the looked-up value (NULL without a match); it moves to the end."""
    found = lookup(base, right, {column: key}, {"_found": value})
    return found.drop(column).withColumnRenamed("_found", column)


def preagg_join(
    base: DataFrame, detail: DataFrame, on: Mapping[str, str], sums: Mapping[str, Column | str]
) -> DataFrame:
    """Sum details per key, then left join; a base row without details gets NULL, not 0.

    Sums are partial map-side, so a hot key is collapsed before the shuffle. A small
    base reduces the details to its keys first.
    """
    _check_names(base, sums)
    side, keys = _right_side(detail, on, sums)
    side = only_keys_of(side, keys, base, on)
    side = side.groupBy(*keys).agg(*[F.sum(_q(out)).alias(out) for out in sums])
    return base.join(side, _condition(base, side, on, keys, spread=not fits_broadcast(side)), "left").drop(*keys)
