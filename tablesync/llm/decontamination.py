"""Benchmark passages in documents: rare n-gram seeds, then Smith-Waterman alignment of words.

1. The corpus counts of the items' word n-grams are taken in one pass. An n-gram here is spaced: up to ``skip`` words may stand
   between two of its words, in the item as in the document, so a word inserted, changed or left out every few words
   leaves n-grams in common. The seeds of an item are its n-grams that are at most ``common`` times as frequent as its median one.
   The measure is the item's own, so an item copied into very many documents keeps its seeds.
2. A second pass emits passages: the words around seeds that are near each other. Near is up to the length of the items, which are
   taken by classes of length (up to 64 words, 256, 1,024 and so on), so a long item does not widen the passages of short ones.
3. Passages and items are joined by seeds, and aligned where they share ``support`` of the item's n-grams (one at
   least): 2 for an equal word, -1 for a changed, an extra or a missing one. A row comes out where the score is at least ``threshold`` of a full copy's, so edited copies are found.
4. Sequences of ``run`` words of an item are seeds however frequent they are, and one of them is enough to compare. What the
   alignments leave is searched for them, so ``run`` equal words give a row in an item of any length; its score is their share of the item.

Both passes look words up in bitmaps sized by the number of n-grams (64 MB at most), two for each class of length there is
(the classes are a logarithm of the longest item); false hits are dropped by the joins. Nothing is capped: a bitmap that fills up costs time, not results.

Words are runs of letters and digits in lower case; marks do not count. Defined results: NULL and empty texts have no
passages; items of fewer words than an n-gram are not looked for; an item or document that occurs twice gives its rows
twice; rows without id are kept under NULL; empty tables give no rows; further columns are not used.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.sources.staging import stage

from .words import combine, mix, word_chunks

__all__ = ["align", "bitmap", "bitmap_bits", "find_passages", "in_bitmap"]

LEAST_BITS, MOST_BITS = 26, 29  # sizes of a bitmap as powers of two: 8 MB, 64 MB


def bitmap_bits(n: int) -> int:
    """The size for ``n`` values: 8 MB, beyond 8 million values 8 bits each, 64 MB at most. A smaller one has more false hits."""
    return min(max(LEAST_BITS, (8 * n).bit_length()), MOST_BITS)


def bitmap(hashes: DataFrame, column: str, bits: int | None = None) -> bytes:
    """A set of 64-bit values as a bitmap sized by their number, put together by segments of 8 KB and collected as those."""
    bits = bitmap_bits(hashes.count()) if bits is None else bits
    low = F.col(column).bitwiseAND(F.lit((1 << bits) - 1))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), low.bitwiseAND(F.lit(63)).cast("int"))
    words = hashes.select(F.shiftright(low, 6).alias("word"), one.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))

    def fill(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        part = np.zeros(1 << 10, dtype=np.int64)
        part[rows["word"].to_numpy() & 1023] = rows["bits"].to_numpy()
        return pd.DataFrame({"segment": [key[0]], "data": [part.tobytes()]})

    segments = words.groupBy(F.shiftright("word", 10).alias("segment")).applyInPandas(fill, "segment long, data binary")
    out = np.zeros(1 << (bits - 6), dtype=np.int64)
    for row in segments.collect():  # at most 2**(bits - 16)
        out[row["segment"] << 10:(row["segment"] + 1) << 10] = np.frombuffer(row["data"], dtype=np.int64)
    return out.tobytes()


def in_bitmap(data: bytes, hashes: np.ndarray) -> np.ndarray:
    bits = np.frombuffer(data, dtype=np.uint64)
    low = hashes & np.uint64(len(bits) * 64 - 1)
    return (bits[(low >> np.uint64(6)).astype(np.int64)] >> (low & np.uint64(63))) & np.uint64(1) == 1


def _grams(words: np.ndarray, n: int) -> np.ndarray:
    m = max(0, len(words) - n + 1)
    return combine([words[i:i + m] for i in range(n)]) if m else np.empty(0, np.uint64)


_PLACES = np.multiply.accumulate(np.full(64, 0x9E3779B97F4A7C15, dtype=np.uint64))  # an odd factor for each place of an n-gram


def spaced_grams(words: np.ndarray, n: int, skip: int) -> Iterator[tuple[int, np.ndarray]]:
    """(words spanned, hashes by first word) for every way to leave out up to ``skip`` words between two of an n-gram's."""
    weighed = [words * _PLACES[i] for i in range(n)]
    for steps in product(range(1, skip + 2), repeat=n - 1):
        at = [0, *accumulate(steps)]
        m = max(0, len(words) - at[-1])
        total = weighed[0][:m].copy()
        for part, i in zip(weighed[1:], at[1:]):
            total += part[i:i + m]
        yield at[-1] + 1, mix(total)


def _item_words(items: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in word_chunks(batch.column("text"), bare=True):
                rows = [w.tobytes() for _, w in chunk.rows()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("item_id").slice(chunk.first, len(rows)), pa.array(rows, pa.binary())], names=["item_id", "words"])

    return items.select(F.col("item_id").cast("long"), F.lower("text").alias("text")).mapInArrow(run, "item_id long, words binary")


def _item_grams(items: DataFrame, n: int, skip: int | None) -> DataFrame:
    """(row, reach, gram) of the distinct n-grams of an item; ``skip`` None: of words one after the other."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row, reach, data in zip(batch["row"], batch["reach"], batch["words"]):
                words = np.frombuffer(data, dtype=np.uint64)
                parts = [_grams(words, n)] if skip is None else [g for _, g in spaced_grams(words, n, skip)]
                grams = np.unique(np.concatenate(parts)).view(np.int64)
                yield pd.DataFrame({"row": np.full(len(grams), row), "reach": np.full(len(grams), reach), "gram": grams})

    return items.select("row", "reach", "words").mapInPandas(run, "row long, reach long, gram long")


def _counted(docs: DataFrame, known: bytes, n: int, skip: int) -> DataFrame:
    """(gram, n): how often the n-grams that the bitmap knows occur."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in word_chunks(batch.column("text"), bare=True):
                # those across two texts are counted as well: too few to change a rank
                hits = [grams[in_bitmap(known, grams)] for _, grams in spaced_grams(chunk.hashes, n, skip)]
                found, times = np.unique(np.concatenate(hits), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(times)], names=["gram", "n"])

    return docs.select(F.lower("text").alias("text")).mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def _passages(docs: DataFrame, classes: list[tuple[int, int, bytes, bytes]], n: int, skip: int, run_words: int) -> DataFrame:
    """(doc_id, reach, start, grams, words): words around seeds and runs that lie at most ``reach`` words apart.

    ``classes``: reach, least number of seeds, bitmaps of seeds and of runs.
    """

    def near(chunk, grams: list[tuple[int, bool, np.ndarray]], reach: int, least: int, seeds: bytes, runs: bytes) -> Iterator[tuple]:
        parts = []
        for size, long, all_grams in grams:
            hits = np.flatnonzero(in_bitmap(runs if long else seeds, all_grams))
            owner = np.searchsorted(chunk.bounds, hits, "right") - 1
            inner = hits + size <= chunk.bounds[np.minimum(owner + 1, len(chunk.bounds) - 1)]
            parts.append((hits[inner], owner[inner], hits[inner] + size, all_grams[hits[inner]], np.full(inner.sum(), long)))
        hits, owner, ends, found, long = (np.concatenate(p) for p in zip(*parts))
        order = np.argsort(hits, kind="stable")
        hits, owner, ends, found, long = hits[order], owner[order], ends[order], found[order], long[order]
        new = np.flatnonzero(np.concatenate([[True], (np.diff(hits) > reach) | (np.diff(owner) != 0)])) if len(hits) else []
        for a, b in zip(new, [*new[1:], len(hits)]):
            some = np.unique(found[a:b])
            if len(some) >= least or long[a:b].any():
                row = owner[a]
                lo = max(chunk.bounds[row], hits[a] - reach)
                hi = min(chunk.bounds[row + 1], ends[a:b].max() + reach)
                yield chunk.first + row, reach, lo - chunk.bounds[row], some.view(np.int64), chunk.hashes[lo:hi].tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for chunk in word_chunks(batch.column("text"), bare=True):
                grams = [(size, False, g) for size, g in spaced_grams(chunk.hashes, n, skip)]
                grams.append((run_words, True, _grams(chunk.hashes, run_words)))
                out = [found for one in classes for found in near(chunk, grams, *one)]
                if out:
                    rows, reach, starts, some, words = zip(*out)
                    yield pa.RecordBatch.from_arrays([
                        ids.take(pa.array(rows)), pa.array(np.array(reach, dtype=np.int64)), pa.array(np.array(starts, dtype=np.int64)),
                        pa.array([list(s) for s in some], pa.list_(pa.int64())), pa.array(words, pa.binary())],
                        names=["doc_id", "reach", "start", "grams", "words"])

    return docs.select(F.col("doc_id").cast("long"), F.lower("text").alias("text")).mapInArrow(
        run, "doc_id long, reach long, start long, grams array<long>, words binary")


def _best_end(item: np.ndarray, words: np.ndarray) -> tuple[int, int]:
    """Score of the best local alignment and where it ends in ``words`` (exclusive); a row of the table at a time."""
    slope = np.arange(len(words) + 1)
    row = np.zeros(len(words) + 1, dtype=np.int64)
    best, end = 0, 0
    for word in item:
        step = np.zeros_like(row)
        step[1:] = np.maximum(row[:-1] + np.where(words == word, 2, -1), row[1:] - 1)
        np.maximum(step, 0, out=step)
        row = np.maximum.accumulate(step + slope) - slope
        at = int(row.argmax())
        if row[at] > best:
            best, end = int(row[at]), at
    return best, end


def align(item: np.ndarray, words: np.ndarray, threshold: float) -> list[tuple[float, int, int]]:
    """(score, start, end) of the places in ``words`` that align with the item, the best first."""
    found, words = [], words.copy()
    while len(item):
        best, end = _best_end(item, words)
        if best < threshold * 2 * len(item) or not best:
            return found
        _, back = _best_end(item[::-1], words[:end][::-1])
        found.append((best / (2 * len(item)), end - back, end))
        words[end - back:end] = 0  # the hash of no word, practically
    return found


def equal_runs(item: np.ndarray, words: np.ndarray, run: int) -> list[tuple[float, int, int]]:
    """(share of the item, start, end) of the places in ``words`` that hold ``run`` or more of its words one after the other."""
    if not np.isin(_grams(words, run), _grams(item, run)).any():
        return []
    row = np.zeros(len(words) + 1, dtype=np.int64)
    most = row
    for word in item:
        step = np.zeros_like(row)
        step[1:] = np.where(words == word, row[:-1] + 1, 0)
        row, most = step, np.maximum(most, step)
    found, last = [], 0
    for end in np.flatnonzero(most >= run).tolist():
        start = max(end - int(most[end]), last)
        if (end == len(words) or most[end + 1] != most[end] + 1) and end - start >= run:
            found.append(((end - start) / len(item), start, end))
            last = end
    return found


def _reach() -> Column:
    """The class of an item's length: the least of 64, 256, 1,024 ... that is no less."""
    length = F.octet_length("words") / 8
    return F.pow(F.lit(4.0), F.greatest(F.lit(3.0), F.ceil(F.log2(F.greatest(length, F.lit(1.0))) / 2))).cast("long")


def find_passages(
    docs: DataFrame, items: DataFrame, n: int = 3, common: float = 8.0, support: float = 0.08, threshold: float = 0.5, run: int = 13,
    skip: int = 1,
) -> DataFrame:
    """(doc_id, item_id, start_word, end_word, score) of the passages of ``items`` (item_id, text) in ``docs`` (doc_id, text)."""
    listed = stage(_item_words(items).withColumn("row", F.monotonically_increasing_id()).withColumn("reach", _reach()), "items").read()
    grams = stage(_item_grams(listed, n, skip), "item-grams").read()
    counts = _counted(docs, bitmap(grams, "gram"), n, skip)
    counted = stage(grams.join(counts, "gram", "left").select("row", "reach", "gram", F.coalesce("n", F.lit(0)).alias("n")), "item-counts").read()
    usual = counted.groupBy("row").agg(F.median("n").alias("usual"), F.count(F.lit(1)).alias("of"))
    needed = F.greatest(F.lit(1), F.floor(F.col("of") * support)).alias("needed")
    rare = F.col("n") <= F.greatest(F.lit(1.0), F.col("usual")) * common
    seeds = stage(counted.join(usual, "row").where(rare).select("row", "reach", "gram", needed), "seeds").read()
    runs = stage(_item_grams(listed, run, None), "item-runs").read()
    least = seeds.groupBy("reach").agg(F.min("needed").alias("least")).orderBy("reach").collect()  # a logarithm of the longest item
    classes = [(r["reach"], r["least"], bitmap(seeds.where(F.col("reach") == r["reach"]), "gram"),
                bitmap(runs.where(F.col("reach") == r["reach"]), "gram")) for r in least]
    found = stage(_passages(docs, classes, n, skip, run), "passages").read().withColumn("passage", F.monotonically_increasing_id())
    known = seeds.withColumn("long", F.lit(False)).unionByName(
        runs.select("row", "reach", "gram", F.lit(0).cast("long").alias("needed"), F.lit(True).alias("long")))
    pairs = found.select("passage", "reach", F.explode("grams").alias("gram")).join(known, ["gram", "reach"]).groupBy("passage", "row").agg(
        F.count_if(~F.col("long")).alias("shared"), F.max("needed").alias("needed"), F.bool_or("long").alias("long")).where(
        "long or shared >= needed").select("passage", "row")
    pairs = stage(pairs, "pairs").read()

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc_id, start, words, item_id, item in batch.itertuples(index=False, name=None):
                item, words = np.frombuffer(item, dtype=np.uint64), np.frombuffer(words, dtype=np.uint64).copy()
                places = align(item, words, threshold)
                for _, lo, hi in places:
                    words[lo:hi] = 0
                for value, lo, hi in places + equal_runs(item, words, run):
                    out.append((doc_id, item_id, start + lo, start + hi, value))
            yield pd.DataFrame(out, columns=["doc_id", "item_id", "start_word", "end_word", "score"])

    sides = pairs.join(found.select("passage", "doc_id", "start", "words"), "passage").join(
        listed.select("row", "item_id", F.col("words").alias("item")), "row")
    # ids travel as text: pandas makes numbers with a NULL among them floats
    out = sides.select(F.col("doc_id").cast("string"), "start", "words", F.col("item_id").cast("string"), "item").mapInPandas(
        score, "doc_id string, item_id string, start_word long, end_word long, score double")
    return out.withColumns({c: F.col(c).cast("long") for c in ("doc_id", "item_id")})
