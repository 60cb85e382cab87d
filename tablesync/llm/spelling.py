"""Spelling variants: words one code point apart, found by an index of grams of variable length.

The gram dictionary holds the frequent grams of the vocabulary (pruned by frequency and to ``max_grams``). A word, with a mark at each end,
is cut into one gram for each start: it grows from ``QMIN`` code points until it is no frequent gram, or has ``QMAX``. A gram
is made of its own code points alone, so an edit affects only grams that hold its place; the most grams over one place is the word's
bound of affected grams. Of any bound + 1 grams of a word one is therefore in every near word, at the same place or one further.
Each word is listed under its bound + 1 rarest grams with place and length; both words of a near pair order the grams they
share alike, so the rarest of these is among the listed ones of both. Lists are merged by a join on gram, place and length, and every
candidate is verified by its edit distance. Words of ``SHORTEST`` code points have more grams than one place can hold, so none needs another way.

Results for odd input: NULL and empty texts have no words; a NULL id counts as empty text; a text of any length is read whole; repeated rows
count as often as they stand there; an empty table gives no words; columns beside id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch

__all__ = ["count_words", "forms", "gram_dictionary", "listed_grams", "near_pairs", "variants"]

QMIN, QMAX = 2, 5
SHORTEST = 5  # shorter words are left out: SHORTEST + 1 grams start in a marked word, at most QMAX hold one place
RUN = r"[a-zÀ-ÿ]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lowered_runs(text: Column) -> Column:
    """The maximal runs of letters, A-Z lower-cased."""
    return F.regexp_extract_all(F.translate(text, _UPPER, _LOWER), F.lit(RUN), F.lit(0))


def with_slips(doc_id: Column, run: Column, every: int = 97) -> Column:
    """The run, in one of ``every`` cases (told by a checksum of id and run) without one code point."""
    mark = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    place = (mark % F.length(run)).cast("int")
    return F.when(mark % every == 0, F.concat(F.substring(run, F.lit(1), place), F.substring(run, place + 2, F.length(run)))).otherwise(run)


def count_words(words: DataFrame, least: int = 3) -> DataFrame:
    """(word, n) of words (column ``word``) of ``SHORTEST`` code points or more that stand ``least`` times or more."""
    long = words.where(F.length("word") >= SHORTEST)
    return long.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def gram_dictionary(vocabulary: DataFrame, list_size: int = 20, max_grams: int = 100_000) -> dict[str, int]:
    """The grams of ``QMIN`` to ``QMAX`` code points that stand more than ``list_size`` times in the words; the ``max_grams`` most frequent of them.

    Grams left out end sooner, so lists get longer; no pair is lost by it.
    """
    marked = vocabulary.select(F.concat(F.lit("^"), "word", F.lit("$")).alias("s"))
    cut = F.transform(F.sequence(F.lit(QMIN), F.lit(QMAX)), lambda q: F.transform(
        F.sequence(F.lit(1), F.length("s") - q + 1), lambda p: F.substring("s", p, q)))
    counted = marked.select(F.explode(F.flatten(cut)).alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    frequent = counted.where(F.col("n") > list_size).orderBy(F.desc("n"), "gram").limit(max_grams)
    return {r["gram"]: r["n"] for r in frequent.collect()}  # at most max_grams rows


def listed_grams(word: str, frequent: dict[str, int]) -> list[tuple[str, int]]:
    """(gram, place) of the word's bound + 1 rarest grams."""
    s = f"^{word}$"
    held, grams = [0] * len(s), []
    for p in range(len(s) - QMIN + 1):
        end = p + QMIN
        while end - p < QMAX and end < len(s) and s[p:end] in frequent:
            end += 1
        gram = s[p:end]
        grams.append((frequent.get(gram, 0), gram, p))
        for i in range(p, end):
            held[i] += 1
    grams.sort()  # rare ones first; equal grams in the order of their places, which an edit keeps
    return [(gram, p) for _, gram, p in grams[:max(held) + 1]]


def _letters(word: str) -> int:
    """64 bits of the code points in a word; one edit changes two at most."""
    bits = 0
    for c in word:
        bits |= 1 << (ord(c) % 63)
    return bits


def _index(vocabulary: DataFrame, frequent: dict[str, int]) -> DataFrame:
    """(word, n, letters, size, gram, place): the lists."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, counts = batch.column(0).to_pylist(), batch.column(1)
            owner, letters, sizes, grams, places = [], [], [], [], []
            for i, word in enumerate(words):
                bits = _letters(word)
                for gram, place in listed_grams(word, frequent):
                    owner.append(i)
                    letters.append(bits)
                    sizes.append(len(word))
                    grams.append(gram)
                    places.append(place)
            at = pa.array(owner, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), counts.take(at), pa.array(letters, pa.int64()), pa.array(sizes, pa.int32()), pa.array(grams, pa.string()),
                 pa.array(places, pa.int32())], ["word", "n", "letters", "size", "gram", "place"])

    return vocabulary.select("word", "n").mapInArrow(cut, "word string, n long, letters long, size int, gram string, place int")


def near_pairs(vocabulary: DataFrame, hold: Scratch, list_size: int = 20, max_grams: int = 100_000) -> DataFrame:
    """(a, na, b, nb): every two words of (word, n) that differ by one inserted, deleted or replaced code point, once."""
    lists = hold(_index(vocabulary, gram_dictionary(vocabulary, list_size, max_grams)), "lists").read()

    def key(longer: int, further: int) -> Column:
        return F.xxhash64("gram", F.col("size") + longer, F.col("place") + further)

    # words of one length share a gram at one place; in the longer of two it stands there or one further
    asked = lists.select(
        F.explode(F.array(key(0, 0), key(1, 0), key(1, 1))).alias("key"), F.col("word").alias("a"), F.col("n").alias("na"),
        F.col("letters").alias("la"), F.col("size").alias("sa"))
    held = lists.select(key(0, 0).alias("held"), F.col("word").alias("b"), F.col("n").alias("nb"), F.col("letters").alias("lb"), F.col("size").alias("sb"))
    match = (
        (F.col("key") == F.col("held")) & ((F.col("sa") < F.col("sb")) | (F.col("a") < F.col("b")))
        & (F.bit_count(F.col("la").bitwiseXOR(F.col("lb"))) <= 2) & (F.levenshtein("a", "b", 1) == 1))
    return asked.join(held, match).select("a", "na", "b", "nb").distinct()


def forms(vocabulary: DataFrame, pairs: DataFrame) -> DataFrame:
    """(word, n, n_near, form, form_n): the near word of the largest count (ties: the first), where that is twice the word's own or more."""
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("nb").alias("m")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("na").alias("m")))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "other")).alias("best"))
    found = vocabulary.join(best, "word", "left").withColumn("form_n", -F.col("best.m"))
    wins = F.col("form_n") >= 2 * F.col("n")
    return found.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(wins, F.col("best.other")).alias("form"),
        F.when(wins, F.col("form_n")).alias("form_n"))


def _roots(formed: DataFrame, hold: Scratch) -> DataFrame:
    """(word, root) of the words with a form. Counts double from form to form, so chains are short; each round doubles what is followed."""
    here = hold(formed.where("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        step = here.read().select(F.col("word").alias("at"), F.col("root").alias("on"))
        ahead = hold(here.read().join(step, F.col("root") == F.col("at"), "left").select(
            "word", F.coalesce("on", "root").alias("root"), F.col("on").isNotNull().alias("moved")), "roots")
        if ahead.read().where("moved").isEmpty():
            return here.read()
        here = ahead


def variants(words: DataFrame, least: int = 3, list_size: int = 20, max_grams: int = 100_000) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of the words (column ``word``, one row an occurrence) that stand ``least`` times or more.

    ``root`` is the last word on the way from form to form, the word itself where it has none. The result reads two staged tables.
    """
    hold = Scratch()
    vocabulary = hold(count_words(words, least), "vocabulary").read()
    formed = hold(forms(vocabulary, near_pairs(vocabulary, hold, list_size, max_grams)), "forms")
    roots = hold(_roots(formed.read(), hold), "ends")
    hold.release(formed, roots)
    return formed.read().join(roots.read(), "word", "left").withColumn("root", F.coalesce("root", "word"))
