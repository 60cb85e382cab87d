"""A lattice of column types: the least type that holds several, and the one a column's texts are read back as.

    boolean < whole numbers < decimal < double < string        date < timestamp < string

Types of one chain meet at the larger one; all others meet at string. A whole number beyond 2**53 loses digits as a double.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import float_text

__all__ = ["as_schema", "reinfer", "wider", "wider_schema"]

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_TEXT = (T.StringType, T.VarcharType, T.CharType)


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type that holds the values of both."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if any(isinstance(t, (T.ArrayType, T.MapType, T.StructType, T.BinaryType)) for t in (a, b)):
        raise TypeError(f"no type holds both {a.simpleString()} and {b.simpleString()}")
    for one, other in ((a, b), (b, a)):
        if isinstance(one, T.BooleanType) and isinstance(other, T.NumericType):
            return other
        if isinstance(one, T.DateType) and isinstance(other, (T.TimestampType, T.TimestampNTZType)):
            return other
    if isinstance(a, _WHOLE) and isinstance(b, _WHOLE):
        return max(a, b, key=lambda t: _WHOLE.index(type(t)))
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        if any(isinstance(t, (T.FloatType, T.DoubleType)) for t in (a, b)):
            return T.DoubleType()
        def digits(t):
            return (t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else (19, 0)
        (left, x), (right, y) = digits(a), digits(b)
        return T.DecimalType(max(left, right) + max(x, y), max(x, y)) if max(left, right) + max(x, y) <= 38 else T.DoubleType()
    if {type(a), type(b)} == {T.TimestampType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    return T.StringType()


def wider_schema(schemas: Iterable[T.StructType]) -> T.StructType:
    """All columns of the schemas, in order of appearance, each with the least type that holds all of its own."""
    kinds: dict[str, list[T.DataType]] = {}
    for schema in schemas:
        for f in schema:
            kinds.setdefault(f.name, []).append(f.dataType)
    return T.StructType([T.StructField(name, reduce(wider, types), True) for name, types in kinds.items()])


def as_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of a wider schema: casts to it, NULL for columns that are not there."""
    have = {f.name: f.dataType for f in df.schema}

    def column(f: T.StructField) -> Column:
        if f.name not in have:
            return F.lit(None).cast(f.dataType).alias(f.name)
        c, kind = F.col(f"`{f.name}`"), have[f.name]
        if isinstance(f.dataType, T.StringType) and isinstance(kind, (T.DoubleType, T.FloatType)):
            return float_text(c).alias(f.name)
        return (c if kind == f.dataType else c.cast(f.dataType)).alias(f.name)

    return df.select(*[column(f) for f in schema])


_INTEGER = r"^\s*[+-]?\d+\s*$"
_FLOAT = r"^\s*[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?|(?i:inf|infinity))\s*$"
_TRUTH = ("True", "TRUE", "true", "False", "FALSE", "false")


def _read_back(c: Column, kind: str) -> Column:
    if kind == "boolean":
        return F.lower(c) == "true"
    if kind == "bigint":
        return F.trim(c).cast("bigint")
    if kind == "decimal(20,0)":
        return F.trim(c).cast("decimal(20,0)")
    if kind == "double":
        return F.trim(c).cast("double")
    return c


def reinfer(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """The types a table has after a trip through an untyped file, where every column's type is judged anew from its texts.

    For a column of texts, over all its values but NULL: all whole numbers - ``bigint`` (beyond it ``decimal(20,0)`` where none is negative, all
    are below 2**64 and there is no NULL, else text as it stands); all numbers - ``double``; all true or false - ``boolean``; else text as it stands. So leading zeros of digit text go.
    A NULL beside whole numbers makes them ``double``, a NULL beside truth values leaves them text. A column without values is ``double``.
    Typed columns follow the same rules by their texts: whole numbers become ``bigint`` or, with NULLs, ``double``; truth values with NULLs and all
    times become text. Missing-value tokens are expected to be NULL already (``na_normalise``). All values are judged in one aggregate with
    partial results on the map side, one row back, and cast in one projection. An empty table has text columns throughout.
    """
    chosen = set(df.columns if columns is None else columns)
    fields = [f for f in df.schema if f.name in chosen]
    checks = [F.count(F.lit(1)).alias("rows")]
    for i, f in enumerate(fields):
        c = F.col(f"`{f.name}`")
        checks.append(F.count(c).alias(f"held{i}"))
        if isinstance(f.dataType, _TEXT):
            whole = c.rlike(_INTEGER)
            number = F.when(whole, F.trim(c).try_cast("decimal(38,0)"))
            checks += [
                F.every(whole).alias(f"whole{i}"), F.every(c.isNull() | number.isNotNull()).alias(f"fits{i}"), F.min(number).alias(f"least{i}"), F.max(number).alias(f"most{i}"),
                F.every(c.rlike(_FLOAT)).alias(f"float{i}"), F.every(c.isin(*_TRUTH)).alias(f"truth{i}"),
            ]
    seen = df.agg(*checks).first()

    def kind(i: int, t: T.DataType) -> str:
        held, gaps = seen[f"held{i}"], seen[f"held{i}"] < seen["rows"]
        if not seen["rows"]:
            return "string"
        if not held:
            return "double"
        if isinstance(t, _WHOLE):
            return "double" if gaps else "bigint"
        if isinstance(t, T.BooleanType):
            return "string" if gaps else "boolean"
        if isinstance(t, T.NumericType):
            return "double"
        if not isinstance(t, _TEXT):
            return "string"
        if seen[f"whole{i}"]:
            if seen[f"fits{i}"] and -(2 ** 63) <= seen[f"least{i}"] and seen[f"most{i}"] < 2 ** 63:
                return "double" if gaps else "bigint"
            unsigned = seen[f"fits{i}"] and seen[f"least{i}"] >= 0 and seen[f"most{i}"] < 2 ** 64
            return "decimal(20,0)" if unsigned and not gaps else "string"
        if seen[f"float{i}"]:
            return "double"
        return "boolean" if seen[f"truth{i}"] and not gaps else "string"

    made = {}
    for i, f in enumerate(fields):
        c, k = F.col(f"`{f.name}`"), kind(i, f.dataType)
        if isinstance(f.dataType, _TEXT):
            made[f.name] = _read_back(c, k)
        elif k == "string" and isinstance(f.dataType, T.BooleanType):
            made[f.name] = F.when(c, "True").when(~c, "False")
        elif k != f.dataType.simpleString():
            made[f.name] = c.cast(k)
    return df.withColumns(made) if made else df
