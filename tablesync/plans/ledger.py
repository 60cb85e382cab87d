"""Which change windows have been published: a durable set of covered intervals.

A run asks for what is not covered yet up to its time, so a skipped run is made up by the next one, and a repeated run finds nothing to do.
The set is kept as versions beside the published tables; a version's commit marker is the switch. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import datetime

from pyspark.sql import SparkSession

from ..operators.window import Window
from ..sources.published import next_version
from ..sources.storage import delete_dir, exists, list_dirs

__all__ = ["RunLedger", "gaps", "merged", "overlaps"]


def merged(windows: Iterable[Window]) -> list[Window]:
    """The union as windows that neither touch nor overlap, in order."""
    out: list[Window] = []
    for w in sorted(windows, key=lambda w: (w.lower, w.upper)):
        if w.upper <= w.lower:
            continue
        if out and w.lower <= out[-1].upper:
            out[-1] = Window(out[-1].lower, max(out[-1].upper, w.upper))
        else:
            out.append(w)
    return out


def gaps(covered: Iterable[Window], within: Window) -> list[Window]:
    """What of a window no covered one holds."""
    out, at = [], within.lower
    for w in merged(covered):
        if w.upper <= at:
            continue
        if w.lower >= within.upper:
            break
        if w.lower > at:
            out.append(Window(at, w.lower))
        at = max(at, w.upper)
    return out + ([Window(at, within.upper)] if at < within.upper else [])


def overlaps(windows: Iterable[Window]) -> list[Window]:
    """What more than one of the windows holds."""
    out, end = [], None
    for w in sorted(windows, key=lambda w: (w.lower, w.upper)):
        if end is not None and w.lower < end:
            out.append(Window(w.lower, min(w.upper, end)))
        end = w.upper if end is None else max(end, w.upper)
    return merged(out)


class RunLedger:
    """The covered windows of one table."""

    def __init__(self, spark: SparkSession, root: str, dataset: str, name: str):
        self.spark, self.path = spark, f"{root.rstrip('/')}/_ledger/{dataset}/{name}"

    def _versions(self) -> list[str]:
        return [v for v in list_dirs(self.spark, self.path) if exists(self.spark, f"{self.path}/{v}/_SUCCESS")]

    def covered(self) -> list[Window]:
        """What has been recorded, merged."""
        newest = next(iter(self._versions()[::-1]), None)
        if newest is None:
            return []
        rows = self.spark.read.parquet(f"{self.path}/{newest}").collect()  # merged windows: a row per gap
        return merged(Window(r["lower"], r["upper"]) for r in rows)

    def record(self, window: Window) -> bool:
        """Add a window; False if all of it was covered, and then nothing is written."""
        held = self.covered()
        if not gaps(held, window):
            return False
        version = next_version(list_dirs(self.spark, self.path), window.upper)
        rows = [(w.lower, w.upper) for w in merged([*held, window])]
        self.spark.createDataFrame(rows, "lower timestamp_ntz, upper timestamp_ntz").coalesce(1).write.parquet(f"{self.path}/{version}")
        for old in self._versions()[:-2]:
            delete_dir(self.spark, f"{self.path}/{old}")
        return True

    def due(self, run_ts: datetime, start: datetime | None = None) -> list[Window]:
        """The windows a run at ``run_ts`` has to make up: what is not covered since ``start`` (the first recorded time otherwise)."""
        held = self.covered()
        start = start or (held[0].lower if held else None)
        if start is None:
            raise ValueError("nothing is recorded: say where to start")
        return gaps(held, Window(start, run_ts)) if start < run_ts else []

    def run(self, run_ts: datetime, work: Callable[[Window], object], start: datetime | None = None) -> list[Window]:
        """Do the due windows, oldest first, recording each after its work is done; gives them."""
        due = self.due(run_ts, start)
        for window in due:
            work(window)
            self.record(window)
        return due
