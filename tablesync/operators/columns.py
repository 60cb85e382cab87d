"""Projections by column name. All of them are narrow."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.times import shift_hours

__all__ = [
    "all_non_zero", "rename", "rename_swap", "drop_columns", "drop_and_sort_columns", "shift_and_replace",
    "copy_column", "overwrite_from", "project",
]


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def all_non_zero(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Rows where every column is non-zero; a NULL in any drops the row."""
    for c in cols:
        df = df.filter(_q(c) != 0)
    return df


def project(df: DataFrame, columns: Mapping[str, str] | Iterable[str]) -> DataFrame:
    """Explicit projection; a mapping gives output name -> input name."""
    pairs = columns.items() if isinstance(columns, Mapping) else [(c, c) for c in columns]
    return df.select(*[_q(src).alias(out) for out, src in pairs])


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename; absent names are ignored."""
    return df.withColumnsRenamed(dict(names))


def rename_swap(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename all at once, so that one column can take the name another gives up."""
    return df.select(*[_q(c).alias(names.get(c, c)) for c in df.columns])


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.drop(*names)


def drop_and_sort_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Remaining columns in name order (capitals first)."""
    gone = set(names)
    return df.select(*[_q(c) for c in sorted(c for c in df.columns if c not in gone)])


def shift_and_replace(df: DataFrame, cols: Iterable[str], hours: int, move_to_end: bool = True) -> DataFrame:
    """Replace time columns by their shifted values; by default they move to the end."""
    cols = list(cols)
    shifted = [shift_hours(_q(c), hours).alias(c) for c in cols]
    if move_to_end:
        return df.select(*[_q(c) for c in df.columns if c not in cols], *shifted)
    return df.withColumns(dict(zip(cols, shifted)))


def copy_column(df: DataFrame, source: str, name: str) -> DataFrame:
    return df.withColumn(name, _q(source))


def overwrite_from(df: DataFrame, targets: Iterable[str], source: str) -> DataFrame:
    """Set columns from another one."""
    return df.withColumns({t: _q(source) for t in targets})
