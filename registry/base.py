"""Registration, and table access for the queries."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from tablesync.operators.window import daily_window

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

RUN_TS = datetime(2024, 1, 6, 2, 0, 0)
WINDOW = daily_window(RUN_TS)
LOWER, UPPER = "timestamp '2024-01-05 00:00:00'", "timestamp '2024-01-06 02:00:00'"


class Tables:
    """The test tables of one scale folder, as attributes."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        frame = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        setattr(self, name, frame)  # the folder is listed once per query
        return frame

    def sql(self, text: str) -> DataFrame:
        """Run portable SQL whose table names stand in braces."""
        names = {n for n in TABLES if "{" + n + "}" in text}
        return self.spark.sql(text.replace("{ts}", "timestamp_ntz"), **{n: getattr(self, n) for n in names})


TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)


def oracle_text(text: str) -> str:
    """The same portable SQL for DuckDB, where the tables are views."""
    for name in TABLES:
        text = text.replace("{" + name + "}", name)
    return text.replace("{ts}", "timestamp")


def query(name: str, sql: str | None = None):
    """Register a function of ``Tables`` as a query, with its SQL if there is one."""

    def register(build: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: build(Tables(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = oracle_text(sql)
        return build

    return register
