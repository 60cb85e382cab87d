"""Aggregates: sums, item amounts, counts, profiles, first row per key."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .joins import lookup

__all__ = [
    "sum_by_key", "item_amount", "invoice_amounts", "taxed_invoice_amounts", "row_count", "is_empty", "profile_non_null", "observe_profile",
    "dedupe_keep_first", "first_table_wins", "preview",
]


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def sum_by_key(df: DataFrame, key: str, amount: str, name: str) -> DataFrame:
    """Sum per key; NULLs are skipped, a group of NULLs only gives NULL."""
    return df.groupBy(_q(key).alias(key)).agg(F.sum(_q(amount)).alias(name))


def item_amount(
    quantity: Column, price: Column, discount: Column, tax: Column, exclusive: Column, untaxed_rate: int = 110
) -> Column:
    """Amount of one item, discount and tax in percent.

    An exclusive tax multiplies discounted items by their own rate and undiscounted ones
    by the fixed 110/100; included (or unknown) tax adds nothing. Pass decimals: the
    products are then exact.
    """
    hundredth = F.lit("0.01").cast("decimal(2,2)")
    hundred = F.lit(100).cast("decimal(3,0)")
    gross = quantity * price
    net = gross * ((hundred - discount) * hundredth)
    taxed = (hundred + tax) * hundredth
    # the second factor keeps every branch at one scale
    return F.when(
        F.coalesce(exclusive, F.lit(False)),
        F.when(discount.isNotNull(), net * taxed).otherwise(gross * (F.lit(untaxed_rate).cast("decimal(3,0)") * hundredth)),
    ).otherwise(F.when(discount.isNotNull(), net).otherwise(gross))


def invoice_amounts(
    invoices: DataFrame, items: DataFrame, key: str, item_key: str, amount: Column, discount: Column, name: str
) -> DataFrame:
    """Inner join of invoices to the sum of their items, less the invoice discount."""
    sums = items.select(_q(item_key).alias("_key"), amount.alias("_amount")).groupBy("_key").agg(
        F.sum("_amount").alias("_amount")
    )
    joined = invoices.join(sums, _q(key) == F.col("_key"), "inner")
    return joined.withColumn(name, F.col("_amount") - discount).drop("_key", "_amount")


def taxed_invoice_amounts(
    invoices: DataFrame, items: DataFrame, taxes: DataFrame, key: str, item_key: str, tax_key: Mapping[str, str],
    amount: Callable[[], Column], take: Mapping[str, str], discount: Column, name: str,
) -> DataFrame:
    """``invoice_amounts`` over items whose tax settings are looked up first; items without one count as untaxed.

    ``tax_key`` maps item column to tax column, ``take`` names the columns ``amount`` needs of the taxes.
    """
    return invoice_amounts(invoices, lookup(items, taxes, tax_key, take), key, item_key, amount(), discount, name)


def row_count(df: DataFrame, name: str = "rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def is_empty(df: DataFrame) -> bool:
    """Stops at the first row found."""
    return df.isEmpty()


def _profile_columns(df: DataFrame) -> list[Column]:
    return [F.count(F.lit(1)).alias("rows"), *[F.count(_q(c)).alias(f"n:{c}") for c in df.columns]]


def profile_non_null(df: DataFrame) -> DataFrame:
    """Rows, non-null count and type per column, from one pass with map-side counts."""
    counted = df.agg(*_profile_columns(df))
    entries = [
        F.struct(
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.col("rows"),
            F.col(f"`n:{f.name}`").alias("non_null"),
        )
        for f in df.schema
    ]
    return counted.select(F.inline(F.array(*entries)))


def observe_profile(df: DataFrame, name: str = "profile") -> tuple[DataFrame, Observation]:
    """The same counts, taken while the returned frame is written: no pass of its own."""
    seen = Observation(name)
    return df.observe(seen, *_profile_columns(df)), seen


def dedupe_keep_first(df: DataFrame, key: str | Sequence[str], order: Iterable[str]) -> DataFrame:
    """First row per key in the given order; ties go by the remaining columns.

    Written as a minimum of row structs instead of a row number: it is combined
    map-side, so no task ever receives the whole of a hot key. NULL keys form one group.
    """
    keys = [key] if isinstance(key, str) else list(key)
    first = [c for c in order if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in first]
    if not first and not rest:
        return df.distinct()
    row = F.min(F.struct(*[_q(c) for c in first + rest])).alias("_row")
    kept = df.groupBy(*[_q(k) for k in keys]).agg(row)
    return kept.select(*[_q(c) if c in keys else F.col("_row").getField(c).alias(c) for c in df.columns])


def first_table_wins(tables: Sequence[DataFrame], key: str | Sequence[str]) -> DataFrame:
    """Union of tables with one row per key, taken from the earliest table that has it."""
    ranked = [t.withColumn("_rank", F.lit(i)) for i, t in enumerate(tables)]
    union = ranked[0]
    for t in ranked[1:]:
        union = union.unionByName(t, allowMissingColumns=True)
    return dedupe_keep_first(union, key, ["_rank"]).drop("_rank")


def preview(df: DataFrame, n: int = 5, order: Iterable[str] = ()) -> DataFrame:
    """A few rows to look at; with an order, the same ones each time."""
    order = [_q(c) for c in order]
    return (df.orderBy(*order) if order else df).limit(n)
