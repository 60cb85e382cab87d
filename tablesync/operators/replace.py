"""Table maintenance: delete by keys, group replace, full refresh, append, purge."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .keys import key_set, without_keys

__all__ = ["delete_by_keys", "keyed_replace", "full_refresh", "append_rows", "purge_trailing_days"]


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def delete_by_keys(
    target: DataFrame, delta: DataFrame, key: str, delta_key: str | None = None, placed: bool = False
) -> DataFrame:
    """Rows of the target whose key is not in the delta; rows with a NULL key survive.

    A left anti join: with few keys Catalyst broadcasts them and the target is only
    streamed; past the broadcast bound both sides shuffle, and the adaptive planner
    splits a hot (or NULL) target key, which a left anti join allows. A target laid out
    by the key (``placed``) is not shuffled.
    """
    return without_keys(target, key_set(delta, delta_key or key), key, placed)


def keyed_replace(
    target: DataFrame | None, delta: DataFrame, key: str, keys: DataFrame | None = None, placed: bool = False
) -> DataFrame:
    """Remove all target rows of the delta's keys, then add all delta rows.

    A group replace, not a merge: a key may have several rows on either side. ``keys``
    overrides the key source (column ``key``), e.g. a narrow table already written.
    """
    if target is None:
        return delta
    kept = delete_by_keys(target, delta if keys is None else keys, key, placed=placed)
    return kept.unionByName(delta, allowMissingColumns=True)


def full_refresh(target: DataFrame | None, delta: DataFrame) -> DataFrame:
    """The delta replaces the target."""
    return delta


def append_rows(target: DataFrame | None, delta: DataFrame) -> DataFrame:
    """Bag union by name: no dedupe, no key check."""
    return delta if target is None else target.unionByName(delta, allowMissingColumns=True)


def purge_trailing_days(target: DataFrame, ymd: str, as_of: date, days: int = 4) -> DataFrame:
    """Drop rows of the last ``days`` days up to ``as_of`` and later; NULL days stay.

    ``ymd`` is ``yyyymmdd`` text, which sorts like its date, so the bound is a text
    comparison on the bare column and reaches the scan.
    """
    last_kept = (as_of - timedelta(days=days)).strftime("%Y%m%d")
    return target.filter(_q(ymd).isNull() | (_q(ymd) <= F.lit(last_kept)))
