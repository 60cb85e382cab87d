"""The order in which rows arrive, as a column: independent of partitions, tasks and retries.

A Parquet scan knows it from the file and the row's place in it. Other sources (a database's slices, a query) have no order of their own:
they are numbered as they are read, slice by slice, and written once, so that every later reading sees the same numbers.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .aggregates import dedupe_keep_first

__all__ = ["ARRIVAL", "keep_first_arrived", "with_arrival"]

ARRIVAL = "_arrival"


def with_arrival(df: DataFrame, staging: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """Rows with their place of arrival. ``staging`` writes and rereads frames that have to be numbered; without it they must be read once only."""
    try:
        place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
        return df.withColumn(ARRIVAL, place)
    except AnalysisException:  # no scan of files that count their rows
        numbered = df.withColumn(ARRIVAL, F.monotonically_increasing_id())
        return staging(numbered, "arrival") if staging else numbered


def keep_first_arrived(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """The first row of each key in order of arrival, without that column; rows a join made of one row go by their columns."""
    return dedupe_keep_first(df, key, [ARRIVAL]).drop(ARRIVAL)
