"""Published tables: versioned folders that switch by commit.

A publish writes a fresh version folder and never touches the one being read, so the
plan may read the current version and a failed write leaves it in place. The commit
marker, written last, is the switch: readers take the newest committed version.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from ..operators.replace import append_rows, keyed_replace
from .storage import delete_dir, exists, list_dirs

__all__ = ["PublishedTable", "next_version", "scan_published"]


def next_version(taken: list[str], run_ts: datetime) -> str:
    """The name of the next version: the newest, also for a late rerun. A rerun of the same ``run_ts`` gets its own."""
    taken = [v for v in taken if v.startswith("version-")]
    newest = max([f"version-{run_ts:%Y%m%dT%H%M%S}", *[v.rsplit("-", 1)[0] for v in taken]])
    number = 1 + max([int(v.rsplit("-", 1)[1]) for v in taken if v.startswith(newest)], default=-1)
    return f"{newest}-{number:06d}"


class PublishedTable:
    """One table of a dataset under a root path."""

    def __init__(self, spark: SparkSession, root: str, dataset: str, name: str):
        self.spark = spark
        self.path = f"{root.rstrip('/')}/{dataset}/{name}"

    def versions(self) -> list[str]:
        """Committed versions, oldest first."""
        return [
            v for v in list_dirs(self.spark, self.path)
            if v.startswith("version-") and exists(self.spark, f"{self.path}/{v}/_SUCCESS")
        ]

    def exists(self) -> bool:
        return bool(self.versions())

    def read(self, version: str | None = None) -> DataFrame | None:
        """The newest committed version (or a named one); None before the first publish."""
        version = version or next(iter(self.versions()[::-1]), None)
        return self.spark.read.parquet(f"{self.path}/{version}") if version else None

    def write(self, df: DataFrame, run_ts: datetime) -> str:
        """Write the next version."""
        version = next_version(list_dirs(self.spark, self.path), run_ts)
        self._save(df, version)
        return version

    def _save(self, df: DataFrame, version: str) -> None:
        df.write.mode("errorifexists").parquet(f"{self.path}/{version}")

    def replace(self, df: DataFrame, run_ts: datetime) -> str:
        return self.write(df, run_ts)

    def append(self, df: DataFrame, run_ts: datetime) -> str:
        return self.write(append_rows(self.read(), df), run_ts)

    def keyed_replace(self, delta: DataFrame, key: str, run_ts: datetime, keys: DataFrame | None = None) -> str:
        """Group replace by key; ``keys`` overrides the key source."""
        return self.write(keyed_replace(self.read(), delta, key, keys=keys), run_ts)

    def expire(self, keep: int = 2) -> list[str]:
        """Delete all but the newest ``keep`` committed versions, and what failed runs left before the newest; gives the former."""
        good = self.versions()
        old = good[: -max(keep, 1)]
        failed = [v for v in list_dirs(self.spark, self.path) if v.startswith("version-") and v not in good and good and v < good[-1]]
        for version in (*old, *failed):
            delete_dir(self.spark, f"{self.path}/{version}")
        return old


def scan_published(spark: SparkSession, sql: str, tables: Mapping[str, "PublishedTable"]) -> DataFrame:
    """Read published tables by SQL; ``{name}`` in the text stands for the table of that name."""
    return spark.sql(sql, **{name: table.read() for name, table in tables.items()})
