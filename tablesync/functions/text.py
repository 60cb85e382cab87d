"""Text functions: prefix, missing-value tokens, text forms of other types."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

__all__ = ["NA_TOKENS", "text_before", "na_text", "na_normalise", "float_text", "to_text", "stringify_objects"]

# The texts that a reloaded snapshot shows as missing.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "n/a", "nan", "null",
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_before(c: Column | str, mark: str = "#") -> Column:
    """Text before the first ``mark``, or all of it."""
    return F.substring_index(_col(c), mark, 1)


def na_text(c: Column | str, lenient: bool = False, tokens: Iterable[Column | str] = NA_TOKENS) -> Column:
    """NULL for the missing-value tokens.

    ``lenient`` first drops leading spaces, except from text that a CSV writer would
    have quoted (comma, quote or line break inside): there the spaces are content.
    """
    c = _col(c)
    if lenient:
        c = F.when(c.rlike('[,"\n\r]'), c).otherwise(F.ltrim(c))
    return F.when(~c.isin(*tokens), c)


def na_normalise(df: DataFrame, lenient: bool = False) -> DataFrame:
    """What a table looks like after a trip through its snapshot, without the trip.

    Text tokens for "missing" and floating NaN become NULL. Leading zeros of digit
    text are kept (the trip through an untyped file would lose them).
    """
    fixed, tokens = {}, [F.lit(t) for t in NA_TOKENS]
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.VarcharType, T.CharType)):
            fixed[f.name] = na_text(c, lenient, tokens)
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            fixed[f.name] = F.when(~F.isnan(c), c)
    return df.withColumns(fixed) if fixed else df


def float_text(c: Column | str) -> Column:
    """Shortest decimal text of a double in Python's form: ``12345678.0``, ``1e-05``.

    Spark's own text switches to an exponent at 1e7 and below 1e-3; Python's at 1e16
    and below 1e-4. The digits are the Java runtime's: before Java 19 a few values get
    one more than needed.
    """
    c = _col(c).cast("double")
    plain = c.cast("string")
    size = F.abs(c)
    in_full = F.regexp_replace(c.cast("decimal(38,22)").cast("string"), r"(\.\d+?)0+$", "$1")
    power = F.split_part(plain, F.lit("E"), F.lit(2))
    scientific = F.concat(
        F.regexp_replace(F.split_part(plain, F.lit("E"), F.lit(1)), r"\.0$", ""),
        F.when(power.startswith("-"), F.lit("e-")).otherwise(F.lit("e+")),
        F.regexp_replace(F.ltrim(power, F.lit("-")), r"^(\d)$", "0$1"),
    )
    return (
        F.when(F.isnan(c), F.lit("nan"))
        .when(size == float("inf"), F.when(c > 0, F.lit("inf")).otherwise(F.lit("-inf")))
        .when(((size >= 1e7) & (size < 1e16)) | ((size >= 1e-4) & (size < 1e-3)), in_full)
        .when(plain.contains("E"), scientific)
        .otherwise(plain)
    )


def to_text(c: Column | str, dtype: T.DataType | None = None, null_text: str | None = None) -> Column:
    """Cast to string; ``null_text`` gives NULL a visible text (``nan``, ``NaT``, ``None``)."""
    c = _col(c)
    text = float_text(c) if isinstance(dtype, (T.DoubleType, T.FloatType)) else c.cast("string")
    return text if null_text is None else F.coalesce(text, F.lit(null_text))


def stringify_objects(df: DataFrame, null_text: str = "None", columns: Iterable[str] | None = None) -> DataFrame:
    """Every text column as text, with NULL spelt out."""
    names = set(df.columns if columns is None else columns)
    text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name in names]
    return df.withColumns({n: to_text(F.col(f"`{n}`"), null_text=null_text) for n in text}) if text else df
