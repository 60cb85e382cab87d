"""Session settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

__all__ = ["SETTINGS", "local_session"]

SETTINGS = {
    # adaptive planning: broadcast by measured size, split hot keys, merge small partitions
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # a value that does not fit its type is an error, not NULL or another number
    "spark.sql.ansi.enabled": "true",
    # zone-less timestamps mean the same everywhere
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = "*", memory: str = "8g", **extra: str) -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("tablesync").config("spark.driver.memory", memory)
    settings = {
        **SETTINGS, "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        # call-site records for every column expression cost more than planning itself
        "spark.python.sql.dataFrameDebugging.enabled": "false", **extra,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
