"""Which folders can hold a key: mergeable Bloom filters, kept as tables.

A folder's filter is ``slots`` 64-bit words. A key sets ``BITS`` bits in each of ``WORDS`` words that its hashes choose, so a filter
is one ``bit_or`` per word: partial on the map side, and the filter of a union is the ``bit_or`` of the filters. A key is
looked up by an equi-join on its words; it can be in a folder only if all of them hold its bits. Nothing of it is collected but
the names of the folders hit. With ``BITS_PER_KEY`` bits a key about two keys in 10**9 hit a folder that does not hold them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.keys import fits_broadcast

__all__ = ["BITS_PER_KEY", "filter_of", "folders_hit"]

WORDS, BITS, BITS_PER_KEY = 4, 4, 48
SCHEMA = "folder string, slots bigint, slot bigint, word bigint"

# what a cast to double can read, and little else: a text that it can't costs an exception
_NUMERIC = r"(?i)^[\x00-\x20]*+[+-]?(nan|inf(inity)?|(\d++\.?\d*+|\.\d++)(e[+-]?\d++)?[fd]?|0x[0-9a-f]*+\.?[0-9a-f]*+p[+-]?\d++[fd]?)[\x00-\x20]*$"


def _told(key: Column) -> Column:
    """A text that keys have in common if they are equal under any type one of them may be widened to: numbers, also as text, by their double."""
    text = key.cast("string")
    return F.coalesce(F.when(text.rlike(_NUMERIC), text.try_cast("double").cast("string")), text)


def _words(keys: DataFrame, key: str, *kept: str) -> DataFrame:
    """(kept columns, i, slot, mask): the words of each key, of filters of ``slots`` words. A key's text is made once, and each hash of it."""
    told = keys.select(*kept, "slots", _told(F.col(key)).alias("_told"))
    h = F.col("_hash")
    hashed = told.select(*kept, "slots", F.posexplode(F.array(*[F.xxhash64(F.lit(i), "_told") for i in range(WORDS)])).alias("i", "_hash"))
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), F.call_function("shiftright", h, F.lit(6 * b)).bitwiseAND(63).cast("int")) for b in range(BITS)]
    return hashed.select(*kept, "slots", "i", F.shiftrightunsigned(h, 24).bitwiseAND(F.col("slots") - 1).alias("slot"), reduce(Column.bitwiseOR, bits).alias("mask"))


def filter_of(rows: DataFrame, folder: str, key: str, bits_per_key: int = BITS_PER_KEY, counts: DataFrame | None = None) -> DataFrame:
    """(folder, slots, slot, word) of rows with a column that names their folder; NULL keys are in no filter.

    ``slots`` is a power of two with ``bits_per_key`` bits for each row, so it is known from a count.
    ``counts``, (folder, n) of these rows with a key, spares the reading for it.
    """
    keys = rows.select(F.col(folder).alias("folder"), F.col(f"`{key}`").alias("key")).where("key is not null")
    words = F.ceil(F.col("n") * F.lit(bits_per_key) / 64)
    counts = keys.groupBy("folder").agg(F.count(F.lit(1)).alias("n")) if counts is None else counts
    sizes = counts.select(
        "folder", F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(words, F.lit(1)).cast("double")))).cast("long").alias("slots"))
    # a row a folder: a join by shuffle would bring each folder's keys, and then its words, to one task
    at = _words(keys.join(F.broadcast(sizes), "folder"), "key", "folder")
    return at.groupBy("folder", "slots", "slot").agg(F.bit_or("mask").alias("word"))


def _asked(keys: DataFrame, sizes: list[int]) -> DataFrame:
    """(_key, slots, i, slot, mask) of keys in filters of these numbers of slots."""
    sized = keys.where("_key is not null").select("_key", F.explode(F.array(*[F.lit(s).cast("long") for s in sizes])).alias("slots"))
    asked = _words(sized, "_key", "_key")
    # Catalyst's estimate knows nothing of the rows a key becomes: it would have the driver build a table many times the bound
    return asked.hint("merge") if fits_broadcast(asked) and not fits_broadcast(asked, WORDS * len(sizes)) else asked


def folders_hit(filters: DataFrame, keys: DataFrame, sizes: list[int]) -> list[str]:
    """The folders whose filter holds one of the keys (column ``_key``); ``sizes`` are the numbers of slots that occur."""
    if not sizes:
        return []
    asked = _asked(keys, sorted(set(sizes)))
    hits = filters.join(asked, ["slots", "slot"]).where(F.col("word").bitwiseAND(F.col("mask")) == F.col("mask"))
    found = F.bit_or(F.call_function("shiftleft", F.lit(1), F.col("i")))  # the same word of a key counts once
    whole = hits.groupBy("folder", "_key").agg(found.alias("found")).where(F.col("found") == (1 << WORDS) - 1)
    return sorted(r["folder"] for r in whole.select("folder").distinct().collect())  # a row per folder at most
