"""Order-free fingerprints of bags of rows: what did not change, and where two tables differ.

A bag's fingerprint is its number of rows and two sums of row hashes of different seeds: equal bags have equal ones whatever
their order, they merge by adding, and repeated rows count. They are sums, so they combine on the map side and a hot key or range is never one task's.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

__all__ = ["fingerprint", "row_hash", "unchanged_keys"]

PARTS = ("_rows", "_sum1", "_sum2")


def row_hash(df: DataFrame, columns: Iterable[str], seed: int = 0) -> Column:
    """A 64-bit hash of some columns in order; NULL differs from every value, and where it stands counts."""
    def told(c: str) -> list[Column]:
        value = F.col(f"`{c}`")
        if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
            value = value + F.lit(0.0)  # -0.0 is 0.0
        return [value.isNull(), value]

    return F.xxhash64(F.lit(seed), *[part for c in columns for part in told(c)])


def fingerprint(df: DataFrame, columns: Iterable[str]) -> list[Column]:
    """The aggregates that make up the fingerprint of a group's rows."""
    columns = list(columns)
    sums = [F.sum(row_hash(df, columns, seed).cast("decimal(20,0)")).alias(name) for seed, name in enumerate(PARTS[1:], 1)]
    return [F.count(F.lit(1)).alias(PARTS[0]), *sums]


def unchanged_keys(before: DataFrame, after: DataFrame, key: str, ignore: Iterable[str] = ()) -> DataFrame:
    """The keys (column ``_key``) whose rows are the same bag in two frames of equal columns; NULL keys are not among them."""
    left_out = {c.lower() for c in ignore}
    columns = sorted(c for c in after.columns if c.lower() not in left_out)

    def told(df: DataFrame) -> DataFrame:
        rows = df.where(F.col(f"`{key}`").isNotNull())
        return rows.groupBy(F.col(f"`{key}`").alias("_key")).agg(*fingerprint(rows, columns))

    return told(before).join(told(after), ["_key", *PARTS]).select("_key")
