"""Declared types: reading them, combining them, and casting a table to them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from fnmatch import fnmatchcase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .times import at, clamp_timestamp, out_of_range, MAX_TIME

__all__ = [
    "TYPE_PATTERNS", "TARGET_TYPES", "declared_schema", "declared_pairs", "type_class", "type_class_of",
    "first_declared", "type_sync", "align_to_target", "to_whole", "whole_or_null", "to_number", "to_double",
]

# Declared-type pattern -> class; the first match wins.
TYPE_PATTERNS = (
    ("*char*", "text"),
    ("date", "text"),
    ("text", "text"),
    ("*int*", "number"),
    ("*double*", "number"),
    ("*time*", "time"),
)

# Warehouse type name -> Spark type.
TARGET_TYPES = {"INT64": "bigint", "STRING": "string", "FLOAT64": "double", "TIMESTAMP": "timestamp_ntz"}

Declared = Sequence[tuple[str, str]]


def _declared_name(t: T.DataType) -> str:
    if isinstance(t, T.StringType):
        return "text"
    if isinstance(t, (T.VarcharType, T.CharType)):
        return t.simpleString()
    if isinstance(t, T.BooleanType):
        return "tinyint(1)"
    if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
        return "datetime"
    return t.simpleString()


def declared_pairs(df: DataFrame) -> list[tuple[str, str]]:
    """(field, declared type) of a table, from its schema; nothing is read."""
    return [(f.name, _declared_name(f.dataType)) for f in df.schema]


def declared_schema(df: DataFrame, spark: SparkSession | None = None) -> DataFrame:
    """The same as a (Field, Type) table, as ``describe`` gives it."""
    return (spark or df.sparkSession).createDataFrame(declared_pairs(df), "Field string, Type string")


def type_class(declared: str | None) -> str | None:
    """Class of one declared type (metadata, on the driver)."""
    return next((kind for glob, kind in TYPE_PATTERNS if declared is not None and fnmatchcase(declared, glob)), None)


def type_class_of(c: Column | str) -> Column:
    """Class of a column of declared types; NULL where no pattern matches."""
    c = F.col(c) if isinstance(c, str) else c
    result = F.lit(None).cast("string")
    for glob, kind in reversed(TYPE_PATTERNS):
        hit = c.like(glob.replace("*", "%"))
        result = F.when(hit, F.lit(kind)).otherwise(result)
    return result


def first_declared(*tables: Declared) -> list[tuple[str, str]]:
    """Union of declared schemas; the first table that declares a field wins."""
    merged: dict[str, str] = {}
    for table in tables:
        for field, declared in table:
            merged.setdefault(field, declared)
    return list(merged.items())


_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_SPECIAL = r"(?i)^\s*[+-]?(inf|infinity|nan)\s*$"


def to_number(c: Column) -> Column:
    """Double, or NULL where the text is no number (a plain cast would take ``12d``)."""
    c = c.cast("string")
    return F.when(c.rlike(_NUMBER) | c.rlike(_SPECIAL), F.trim(c).try_cast("double"))


def _or_fail(c: Column, value: Column, what: str) -> Column:
    """The value; a NULL made of something else fails the job, whatever the ANSI setting. The value is worked out once."""
    return F.coalesce(value, F.when(c.isNotNull(), F.raise_error(F.concat(F.lit(f"{what}: "), c.cast("string")))))


_PLAIN_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)\s*$"
_WITH_POWER = r"^\s*([+-]?)(\d*)\.?(\d*)[eE]([+-]?\d+)\s*$"


def whole_or_null(c: Column, dtype: T.DataType | None = None) -> Column:
    """Whole number with the fraction cut off, or NULL where there is none or it is no 64-bit one."""
    if dtype is None or isinstance(dtype, T.StringType):
        c = c.cast("string")
        # the digits before the point as they stand: no cast that could round them up
        plain = F.regexp_replace(c, r"(?s)^\s*([+-]?)(\d*).*$", "$10$2")  # a zero between sign and digits, which may be none
        sign, whole, fraction, power = (F.regexp_extract(c, _WITH_POWER, g) for g in range(1, 5))
        # an exponent moves the point; 60 digits are too many for any whole number, unless all are zeros
        point = F.greatest(F.least(F.length(whole) + power.try_cast("bigint"), F.lit(60)), F.lit(0)).cast("int")
        moved = F.concat(sign, F.lit("0"), F.rpad(F.concat(whole, fraction), point, F.lit("0")))
        c = F.when(c.rlike(_PLAIN_NUMBER), plain).when(c.rlike(_NUMBER), moved).try_cast("decimal(38,0)")
    return c.try_cast("bigint")


def to_whole(c: Column | str, dtype: T.DataType | None = None) -> Column:
    """Whole number: fractions are cut off, NULL stays NULL; what is no 64-bit number fails the job, whatever the ANSI setting."""
    c = F.col(c) if isinstance(c, str) else c
    return _or_fail(c, whole_or_null(c, dtype), "not a whole number")


def to_double(c: Column | str, dtype: T.DataType | None = None) -> Column:
    """Double; unreadable text fails the job, whatever the ANSI setting."""
    c = F.col(c) if isinstance(c, str) else c
    if dtype is not None and not isinstance(dtype, T.StringType):
        return c.cast("double")
    return _or_fail(c, to_number(c), "not a number")


def type_sync(
    df: DataFrame,
    declared: Declared | Mapping[str, str] | DataFrame,
    integers: str = "double",
    on_failure: str = "keep",
) -> DataFrame:
    """Cast every declared column to the class of its declared type.

    Undeclared columns and unmatched types stay as they are. ``integers`` is ``double``
    (what readers of the published tables see) or ``bigint`` (exact above 2**53).

    ``on_failure`` says what one unreadable text value does to its column: ``keep``
    leaves the whole column as text, ``null`` blanks the value. Only ``keep`` needs to
    look at the data: a single map-side aggregate over the text columns in question,
    one row back. Typed sources have no such column and are not read twice.

    A time column with a value outside the nanosecond range is clamped, not kept.
    """
    if isinstance(declared, DataFrame):
        wanted = declared.filter(F.col("Field").isin(*df.columns)).select("Field", "Type")
        declared = {r["Field"]: r["Type"] for r in wanted.collect()}  # at most one row per column
    declared = dict(declared)

    casts: dict[str, Column] = {}
    doubtful: dict[str, tuple[Column, Column]] = {}
    for f in df.schema:
        kind, c, name = type_class(declared.get(f.name)), F.col(f"`{f.name}`"), f.name
        is_text = isinstance(f.dataType, T.StringType)
        if kind == "text" and not is_text:
            casts[name] = c.cast("string")
        elif kind == "number":
            whole = integers == "bigint" and fnmatchcase(declared[name], "*int*")
            if is_text:
                parsed = whole_or_null(c) if whole else to_number(c)
                casts[name] = parsed
                doubtful[name] = (parsed, F.lit(False))
            elif isinstance(f.dataType, (T.NumericType, T.BooleanType)):
                casts[name] = c.cast("bigint" if whole else "double")
        elif kind == "time":
            if is_text:
                parsed = c.try_cast("timestamp_ntz")
                casts[name] = parsed
                doubtful[name] = (parsed, out_of_range(parsed))
            elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
                casts[name] = clamp_timestamp(c.cast("timestamp_ntz"))

    if doubtful and on_failure == "keep":
        checks = []
        for name, (parsed, outside) in doubtful.items():
            checks.append(F.bool_or(F.col(f"`{name}`").isNotNull() & parsed.isNull()).alias(f"bad:{name}"))
            checks.append(F.bool_or(outside).alias(f"out:{name}"))
        seen = df.agg(*checks).first()
        for name, (parsed, _) in doubtful.items():
            if seen[f"out:{name}"]:
                # the range error makes every cell that cannot be held the largest time
                c = F.col(f"`{name}`")
                casts[name] = F.when(c.isNotNull() & (parsed.isNull() | out_of_range(parsed)), at(MAX_TIME)).otherwise(
                    parsed
                )
            elif seen[f"bad:{name}"]:
                del casts[name]
    elif doubtful:
        for name, (parsed, _) in doubtful.items():
            if type_class(declared[name]) == "time":
                casts[name] = clamp_timestamp(parsed)
    return df.withColumns(casts) if casts else df


def align_to_target(df: DataFrame, target: T.StructType | Mapping[str, str]) -> DataFrame:
    """Cast the columns a target also has to the target's types, matched by name; a value that does not fit fails the job.

    ``target`` is a schema, or a mapping of column name to warehouse type name.
    """
    if isinstance(target, T.StructType):
        wanted = {f.name: f.dataType for f in target}
    else:
        wanted = {n: TARGET_TYPES.get(t.upper(), t) for n, t in target.items()}
    have = {f.name: f.dataType for f in df.schema}
    casts = {}
    for name, t in wanted.items():
        if name in have and t != have[name] and not (isinstance(t, str) and have[name].simpleString() == t):
            c = F.col(f"`{name}`")
            to_long = t == "bigint" or isinstance(t, T.LongType)
            casts[name] = to_whole(c, have[name]) if to_long else _or_fail(c, c.try_cast(t), f"{name} does not fit its type")
    return df.withColumns(casts) if casts else df
