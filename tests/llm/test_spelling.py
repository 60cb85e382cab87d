import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tablesync.llm import spelling
from tablesync.llm.scratch import Scratch


def brute_words(docs):
    found = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            found[run] += len(run) >= 5
    return {w: n for w, n in found.items() if n >= 3}


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(counts):
    out = {}
    near = {w: [v for v in counts if v != w and one_apart(v, w)] for w in counts}
    form = {}
    for w in counts:
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (counts[w], len(near[w]), form[w], counts.get(form[w]), root)
    return out


def rows_of(df):
    return {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in df.collect()}


def random_words(seed, n, parts):
    rng = random.Random(seed)
    words = set()
    while len(words) < n:
        w = "".join(rng.choice(parts) for _ in range(rng.randint(2, 6)))
        if len(w) < 5:
            continue
        words.add(w)
        for _ in range(2):  # neighbours
            i, c = rng.randrange(len(w) + 1), rng.choice("abéñ")
            words.add(rng.choice([w[:i] + c + w[i:], w[:i] + c + w[i + 1:], w[:i] + w[i + 1:]]))
    return {w: rng.choice([3, 3, 4, 6, 8, 20, 50, 400]) for w in sorted(words) if len(w) >= 5}


@pytest.mark.parametrize("list_size,max_grams", [(1, 100_000), (4, 100_000), (4, 7), (1000, 10)])
def test_all_pairs_whatever_the_dictionary(spark, list_size, max_grams):
    counts = random_words(5, 700, ["an", "na", "a", "th", "é", "ti", "on", "ñ", "aaa", "er"])
    vocabulary = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(4)
    hold = Scratch()
    found = {frozenset((r["a"], r["b"])) for r in spelling.near_pairs(vocabulary, hold, list_size, max_grams).collect()}
    words = sorted(counts)
    assert found == {frozenset((a, b)) for i, a in enumerate(words) for b in words[i + 1:] if one_apart(a, b)}
    got = rows_of(spelling.forms(vocabulary, spelling.near_pairs(vocabulary, hold, list_size, max_grams)).withColumn("root", F.lit(None)))
    assert {w: v[:4] for w, v in got.items()} == {w: v[:4] for w, v in brute(counts).items()}


def test_the_bound_holds_for_every_edit():
    # a word's listed grams are one more than one place can hold, so an edit leaves one of them
    rng = random.Random(3)
    frequent = dict.fromkeys(("^a", "^ab", "^aba", "ab", "aba", "abab", "ba", "bab", "baba", "b$", "ab$"), 9)
    for _ in range(300):
        w = "".join(rng.choice("ab") for _ in range(rng.randint(5, 12)))
        listed = spelling.listed_grams(w, frequent)
        for place in range(1, len(w) + 1):
            assert any(not p <= place < p + len(g) for g, p in listed)
        assert len(set(listed)) == len(listed) <= len(w) + 1


def test_chains_of_forms_end_at_their_root(spark):
    counts = {f"{'a' * i}{'b' * (12 - i)}": 3 * 2 ** i for i in range(13)}
    words = spark.createDataFrame(list(counts.items()), "w string, n int").select(F.explode(F.array_repeat("w", F.col("n"))).alias("word"))
    got = rows_of(spelling.variants(words))
    assert got == brute(counts) and got["b" * 12][4] == "a" * 12


def test_nulls_ties_long_texts_repeats_and_other_columns(spark):
    docs = [(None, "hello HELLO Hello hellp"), (1, None), (2, ""), (3, "hellp hellp jello jello jello ÉCOLE École éCOLE"), (3, "x" * 400_000), (4, "one two, 3 four")]
    docs += [(4, "hello Straße")] * 5 + [(i, "mellow yellow fellow bellow " * 3) for i in range(400, 600)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"word": F.lit("w"), "n": F.lit(1)})
    runs = df.select("doc_id", F.explode(spelling.lowered_runs(F.col("text"))).alias("run"))
    got = rows_of(spelling.variants(runs.select(spelling.with_slips(F.col("doc_id"), F.col("run")).alias("word"))))
    assert got == brute(brute_words(docs)) and len(got) > 8


def test_empty_table(spark):
    assert spelling.variants(spark.createDataFrame([], "word string")).collect() == []
