"""Change windows: the rows touched since the start of yesterday.

The bounds come from an explicit ``run_ts``; the predicate is a range on the bare
column, so it reaches the scan (file and row-group pruning, or the WHERE of a
database read).
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.times import at
from .keys import key_set, with_keys

__all__ = ["Window", "daily_window", "contiguous_window", "change_window", "change_window_raw", "changed_groups"]


@dataclass(frozen=True)
class Window:
    """Half-open time range ``[lower, upper)``."""

    lower: datetime
    upper: datetime

    def holds(self, c: Column | str) -> Column:
        c = F.col(c) if isinstance(c, str) else c
        return (c >= at(self.lower)) & (c < at(self.upper))

    def slices(self, n: int) -> list["Window"]:
        """``n`` touching windows that cover this one, for parallel reads of a database."""
        step = (self.upper - self.lower) / n
        edges = [self.lower + step * i for i in range(n)] + [self.upper]
        return [Window(a, b) for a, b in zip(edges, edges[1:])]


def daily_window(run_ts: datetime, days: int = 1) -> Window:
    """From midnight ``days`` days before ``run_ts`` up to ``run_ts`` (whole seconds)."""
    first = (run_ts - timedelta(days=days)).replace(hour=0, minute=0, second=0, microsecond=0)
    return Window(first, run_ts.replace(microsecond=0))


def contiguous_window(previous_upper: datetime, run_ts: datetime) -> Window:
    """From the end of the previous run: no gap and no overlap between runs."""
    if run_ts < previous_upper:
        raise ValueError("a run cannot end before the previous one")
    return Window(previous_upper, run_ts)


def change_window(df: DataFrame, c: str, run_ts: datetime | Window) -> DataFrame:
    """Rows changed in the daily window; a NULL change time drops out."""
    window = run_ts if isinstance(run_ts, Window) else daily_window(run_ts)
    return df.filter(window.holds(F.col(f"`{c}`")))


# The form without the calendar-day function selects the same rows.
change_window_raw = change_window


def changed_groups(
    df: DataFrame, c: str, run_ts: datetime | Window, group: str, changed: DataFrame | None = None
) -> DataFrame:
    """All rows of every group that has a row in the window (for keys coarser than a row).

    ``changed`` gives the rows of the window where they can be had without reading ``df``.
    """
    changed = change_window(df if changed is None else changed, c, run_ts)
    return with_keys(df, key_set(changed, group), group)
