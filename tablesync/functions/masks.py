"""Masks for personal columns, as plain column expressions (no Python per row).

The masks truncate; they are not hashes and do not protect rare values.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .domains import FREE_DOMAINS

__all__ = ["mask_phone", "mask_email", "mask_general", "mask_flag", "mask_table", "value_mask"]


def _text(c: Column | str, null: str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.cast("string"), F.lit(null))


@lru_cache(maxsize=1)
def _all_numeric() -> str:
    """Pattern for text made only of Unicode numerals.

    ``\\p{N}`` has digits, letter numbers and other numbers; the ideographs that
    also carry a numeric value (category Lo) are added from the Unicode tables.
    """
    code_points = (chr(c) for c in range(0x110000))
    ideographs = "".join(c for c in code_points if c.isnumeric() and unicodedata.category(c)[0] != "N")
    return rf"^[\p{{N}}{ideographs}]+$"


def mask_phone(c: Column | str) -> Column:
    """Keep the first four digits and hide the rest; ``-`` when no digit is left.

    A leading ``628`` is read as the national ``08``. Text that is numeric as a
    whole but not ASCII (other scripts' digits) keeps its own first four signs.
    """
    text = _text(c, "")
    foreign = (F.octet_length(text) > F.char_length(text)) & text.rlike(_all_numeric())
    number = F.when(foreign, text).otherwise(F.regexp_replace(text, "[^0-9]+", ""))
    head = F.substring(F.regexp_replace(number, "^62(?=8)", "0"), 1, 4)
    hidden = "x" * 8
    # nullif evaluates its operand once, a CASE over it would do so twice
    return F.coalesce(F.nullif(F.concat(head, F.lit(hidden)), F.lit(hidden)), F.lit("-"))


def mask_email(c: Column | str, domains: Iterable[str] = FREE_DOMAINS) -> Column:
    """Three leading characters of the name, and the domain if it is a public one."""
    text = _text(c, "h@h")
    at = F.instr(text, "@")
    name = F.substring_index(text, "@", 1)
    domain = text.substr(at + 1, F.char_length(text))
    shown_name = F.when(F.char_length(name) > 3, F.concat(F.substring(name, 1, 3), F.lit("xxx"))).otherwise(
        F.lit("x" * 6)
    )
    shown_domain = (
        F.when(at == 0, F.lit("xxx.xxx"))
        .when(domain == "h", F.lit("-"))
        .when(F.lower(domain).isin(*domains), domain)
        .otherwise(F.lit("privatedomain"))
    )
    return F.concat(shown_name, F.lit("@"), shown_domain)


def mask_general(c: Column | str) -> Column:
    """Last four characters of longer text; shorter text is hidden whole."""
    text = _text(c, "")
    return (
        F.when(F.char_length(text) > 4, F.concat(F.lit("x" * 6), F.substring(text, -4, 4)))
        .when(text == "", F.lit("-"))
        .otherwise(F.lit("x" * 10))
    )


def mask_flag(c: Column | str) -> Column:
    """1 where there is a value, 0 for NULL and empty text; a blank counts as a value."""
    return F.when(_text(c, "") != "", F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def value_mask(name: str):
    """The mask a column gets by its name; the match is case-sensitive."""
    if "email" in name:
        return mask_email
    if "phone" in name:
        return mask_phone
    return mask_general


def mask_table(df: DataFrame, value_cols: Iterable[str] = (), flag_cols: Iterable[str] = ()) -> DataFrame:
    """Mask all named columns in one projection; the flag wins where both name a column."""
    masks = {name: value_mask(name)(F.col(f"`{name}`")) for name in value_cols}
    for name in flag_cols:
        source = masks.get(name, F.col(f"`{name}`"))
        masks[name] = mask_flag(source)
    return df.withColumns(masks) if masks else df
