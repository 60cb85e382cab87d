"""Dated CSV snapshots of a delta, and reading them (or foreign CSV) back."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import na_normalise

__all__ = ["snapshot_csv", "read_snapshot", "read_csv_lenient"]

# Quotes are doubled inside a quoted field, spaces are content, NULL and empty text are
# both an empty field.
_DIALECT = {
    "header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}


def snapshot_path(root: str, table: str, run_date: date) -> str:
    return f"{root.rstrip('/')}/{table}/run_date={run_date:%Y-%m-%d}"


def snapshot_csv(df: DataFrame, root: str, table: str, run_date: date) -> str:
    """Write with header; a rerun of the same day overwrites that day only."""
    times = {
        f.name: F.col(f"`{f.name}`").cast("string")
        for f in df.schema
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))
    }
    path = snapshot_path(root, table, run_date)
    df = df.withColumns(times) if times else df  # full microseconds, "yyyy-MM-dd HH:mm:ss"
    df.write.mode("overwrite").options(emptyValue="", **_DIALECT).csv(path)
    return path


def read_snapshot(
    spark: SparkSession, root: str, table: str, run_date: date, schema: T.StructType, multiline: bool = False
) -> DataFrame:
    """Read one day back with a known schema.

    ``multiline`` is needed only where text holds line breaks: such files cannot be
    split, so they are read one file per task.
    """
    times = {f.name: f.dataType for f in schema if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))}
    raw = T.StructType([T.StructField(f.name, T.StringType() if f.name in times else f.dataType) for f in schema])
    df = (
        spark.read.schema(raw).options(multiLine=multiline, mode="FAILFAST", **_DIALECT)
        .csv(snapshot_path(root, table, run_date))
    )
    return df.withColumns({n: F.col(f"`{n}`").cast(t) for n, t in times.items()}) if times else df


def read_csv_lenient(
    spark: SparkSession, path: str, schema: T.StructType, multiline: bool = False, header: bool = True
) -> DataFrame:
    """Read CSV that may hold broken lines.

    Lines with too many fields are skipped, short ones are filled with NULL, spaces after
    a delimiter are dropped and the missing-value tokens become NULL in every column. A
    value that is not of its column's type becomes NULL.
    """
    line = "_odd_line"  # filled where the number of fields is not the schema's
    raw = T.StructType([*[T.StructField(f.name, T.StringType()) for f in schema], T.StructField(line, T.StringType())])
    options = {
        **_DIALECT, "header": header, "ignoreLeadingWhiteSpace": True, "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": line, "columnPruning": False,
    }
    lines = spark.read.schema(raw).options(multiLine=multiline, **options).csv(path)
    # the empty piece of a data column is there because Spark reads the line column only with others
    shown = F.concat_ws("", F.col(line), F.substring(F.col(f"`{schema[0].name}`"), 1, 0))
    # a doubled quote is two quoted pieces side by side; the pattern has no repeated group, so it needs no stack
    fields = F.regexp_count(F.regexp_replace(shown, r'"[^"]*"', ""), F.lit(",")) + 1
    rows = na_normalise(lines.filter(fields <= len(schema)).drop(line))
    return rows.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema])
