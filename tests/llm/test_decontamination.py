import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablesync.llm import decontamination as dec

VOCABULARY = [f"{a}{b}{c}" for a in "bdfgklmnprst" for b in "aeiou" for c in ("n", "r", "lo", "mi", "ta")]


def sentence(rng, n):
    return [rng.choice(VOCABULARY) for _ in range(n)]


def edited(rng, words, share):
    out = []
    for w in words:
        x = rng.random()
        out += [] if x < share / 3 else [rng.choice(VOCABULARY)] if x < 2 * share / 3 else [w, "extra"] if x < share else [w]
    return out


@pytest.fixture(scope="module")
def planted():
    rng = random.Random(7)
    items = {i: sentence(rng, rng.randint(12, 50)) for i in range(25)}
    docs, want = [], set()
    for d in range(200):
        words = sentence(rng, rng.randint(0, 300))
        if d % 4 == 0:
            i = rng.randrange(25)
            copy = edited(rng, items[i], 0.0 if d % 8 else 0.2)
            at = rng.randint(0, len(words))
            words[at:at] = copy
            want.add((d, i))
        if d % 10 == 3:  # a third of an item is no copy of it
            words += items[0][: len(items[0]) // 3]
        docs.append((d, " ".join(words).capitalize() + "."))
    for d in range(200, 260):  # one item in a quarter of all documents
        docs.append((d, " ".join(sentence(rng, 40) + items[3] + sentence(rng, 5))))
        want.add((d, 3))
    return items, docs, want


def search(spark, docs, items, **more):
    d = spark.createDataFrame([(*r, "x", 1) for r in docs], "doc_id long, text string, words string, row int")
    i = spark.createDataFrame([(k, t, "y") for k, t in items], "item_id long, text string, gram string")
    return dec.find_passages(d, i, **more).collect()


def test_planted_copies_are_found_and_others_left_alone(spark, planted):
    items, docs, want = planted
    rows = search(spark, docs, [(i, " ".join(w).upper()) for i, w in items.items()])
    assert {(r["doc_id"], r["item_id"]) for r in rows} == want
    texts = dict(docs)
    for r in rows:
        words = texts[r["doc_id"]].lower().rstrip(".").split()
        best = brute(items[r["item_id"]], words)
        assert r["score"] == pytest.approx(best / (2 * len(items[r["item_id"]])))
        assert brute(items[r["item_id"]], words[r["start_word"]:r["end_word"]]) == best


def brute(item, words):
    table = [[0] * (len(words) + 1) for _ in range(len(item) + 1)]
    for i, a in enumerate(item, 1):
        for j, b in enumerate(words, 1):
            table[i][j] = max(0, table[i - 1][j - 1] + (2 if a == b else -1), table[i - 1][j] - 1, table[i][j - 1] - 1)
    return max(map(max, table))


def test_alignment_is_smith_waterman():
    rng = np.random.default_rng(3)
    for _ in range(200):
        item, words = (rng.integers(1, 6, n).astype(np.uint64) for n in rng.integers(1, 15, 2))
        found = dec.align(item, words, 0.01)
        best = brute(list(item), list(words))
        assert (found[0][0] * 2 * len(item) if found else 0) == pytest.approx(best)
        for score, lo, hi in found[:1]:
            assert brute(list(item), list(words[lo:hi])) == best


def test_all_places_of_a_text(spark):
    rng = random.Random(1)
    item, filler = sentence(rng, 20), sentence(rng, 500)
    text = " ".join(item + filler + item + item + filler[:3] + item)
    rows = search(spark, [(1, text)], [(9, " ".join(item))])
    assert sorted((r["start_word"], r["end_word"]) for r in rows) == [(0, 20), (520, 540), (540, 560), (563, 583)]


def test_defined_results(spark):
    rng = random.Random(2)
    item = sentence(rng, 30)
    docs = [(1, None), (2, ""), (3, " ... "), (None, " ".join(item)), (4, " ".join(item)), (4, " ".join(item)), (5, "one two")]
    items = [(7, " ".join(item)), (7, " ".join(item)), (8, None), (9, ""), (10, "one two"), (None, "three words only here")]
    rows = search(spark, docs, items)
    assert sorted(((r["doc_id"], r["item_id"]) for r in rows), key=repr) == sorted([(None, 7)] * 2 + [(4, 7)] * 4, key=repr)
    assert search(spark, [], items) == [] and search(spark, docs, []) == []


def test_a_long_run_of_a_longer_item(spark):
    """Equal words one after the other count however long the item is, and however frequent its n-grams are."""
    rng = random.Random(6)
    item = sentence(rng, 300)
    around = lambda: sentence(rng, 30)
    docs = [(1, around() + item[100:200] + around()), (2, around() + item[40:53] + around()), (3, around() + item[40:52] + around()),
            (4, item[:20] + around() + item[250:270]), (5, item), (6, around() + item[280:300] + item[:200])]
    docs += [(100 + i, item[40:53] + around()) for i in range(40)]
    rows = search(spark, [(i, " ".join(w)) for i, w in docs], [(9, " ".join(item))])
    got = sorted((r["doc_id"], r["start_word"], r["end_word"], round(r["score"] * 300)) for r in rows if r["doc_id"] < 100)
    assert [g for g in got if g[0] < 6] == [(1, 30, 130, 100), (2, 30, 43, 13), (4, 0, 20, 20), (4, 50, 70, 20), (5, 0, 300, 300)]
    assert [g[1:3] for g in got if g[0] == 6] == [(30, 50), (50, 250)]
    assert {r["doc_id"] for r in rows if r["doc_id"] >= 100} == set(range(100, 140))


def test_equal_runs():
    rng = np.random.default_rng(8)
    for _ in range(200):
        item, words = (rng.integers(1, 4, n).astype(np.uint64) for n in rng.integers(1, 30, 2))
        runs = {tuple(item[i:i + 4]) for i in range(len(item) - 3)}
        places = [j for j in range(len(words) - 3) if tuple(words[j:j + 4]) in runs]
        found = dec.equal_runs(item, words, 4)
        assert bool(found) == bool(places) and all(b <= c for (_, _, b), (_, c, _) in zip(found, found[1:]))
        assert all(any(a < j + 4 and j < b for _, a, b in found) for j in places)
        for share, a, b in found:
            assert any(tuple(item[i:i + b - a]) == tuple(words[a:b]) for i in range(len(item))) and share == (b - a) / len(item)


def test_very_long_text(spark):
    rng = random.Random(4)
    item = sentence(rng, 40)
    words = sentence(rng, 50_000) + item + sentence(rng, 50_000)
    rows = search(spark, [(1, " ".join(words))], [(1, " ".join(item))])
    assert [(r["start_word"], r["end_word"], r["score"]) for r in rows] == [(50_000, 50_040, 1.0)]


def test_bitmap_sizes():
    sizes = [dec.bitmap_bits(n) for n in (0, 1, (1 << 23) - 1, 1 << 23, 1 << 24, 1 << 25, 1 << 40)]
    assert sizes == [26, 26, 26, 27, 28, 29, 29]


def test_bitmap(spark):
    rng = np.random.default_rng(5)
    values = rng.integers(-2**63, 2**63, 3000)
    df = spark.createDataFrame([(int(v),) for v in (*values, *values[:10], 0, -1)], "h long")
    for bits in (16, 20):
        data = dec.bitmap(df, "h", bits)
        assert len(data) == 2**bits // 8 and dec.in_bitmap(data, values.view(np.uint64)).all()
        others = rng.integers(-2**63, 2**63, 20_000).view(np.uint64)
        low = {int(v) % 2**bits for v in (*values, 0, -1)}
        assert dec.in_bitmap(data, others).tolist() == [int(o) % 2**bits in low for o in others]
    assert not dec.in_bitmap(dec.bitmap(df.limit(0), "h", 16), values.view(np.uint64)).any()


def spread_out(rng, words, kind, every):
    out = []
    for i, w in enumerate(words):
        hit = i % every == every - 1
        out += [] if hit and kind == "left out" else [rng.choice(VOCABULARY) + "x"] if hit and kind == "changed" else [w]
        out += [rng.choice(VOCABULARY) + "y"] if hit and kind == "inserted" else []
    return out


def test_recall_against_all_pairs(spark):
    """Every pair that aligning all documents with all items finds is found by the seeds."""
    rng = random.Random(12)
    items = {i: sentence(rng, rng.randint(15, 59)) for i in range(20)}
    docs = {}
    for kind, every in [("inserted", 1), ("inserted", 2), ("inserted", 3), ("changed", 3), ("changed", 4), ("left out", 3), ("left out", 5)]:
        for i in range(8):
            docs[len(docs)] = sentence(rng, 25) + spread_out(rng, items[i], kind, every) + sentence(rng, 10)
    for share in (0.2, 0.4, 0.6):
        for i in range(20):
            docs[len(docs)] = sentence(rng, 30) + edited(rng, items[i], share)
    docs[len(docs)] = sentence(rng, 200)
    number = {w: i + 1 for i, w in enumerate({w for words in (*docs.values(), *items.values()) for w in words})}
    as_array = lambda words: np.array([number[w] for w in words], dtype=np.uint64)
    want = {(d, i) for d, words in docs.items() for i, item in items.items() if dec.align(as_array(item), as_array(words), 0.5)}
    rows = search(spark, [(d, " ".join(w)) for d, w in docs.items()], [(i, " ".join(w)) for i, w in items.items()])
    assert {(r["doc_id"], r["item_id"]) for r in rows} == want and len(want) > 90


def test_a_long_item_does_not_widen_the_passages_of_others(spark):
    rng = random.Random(13)
    short, long = sentence(rng, 20), sentence(rng, 3000)
    text = sentence(rng, 4000) + short + sentence(rng, 4000)
    rows = search(spark, [(1, " ".join(text)), (2, " ".join(long))], [(1, " ".join(short)), (2, " ".join(long))])
    assert sorted(map(tuple, rows)) == [(1, 1, 4000, 4020, 1.0), (2, 2, 0, 3000, 1.0)]
    items = spark.createDataFrame([(i, " ".join(w)) for i, w in ((1, short), (2, long), (3, sentence(rng, 65)), (4, ["a"] * 64))], "item_id long, text string")
    assert [r[0] for r in dec._item_words(items).select(dec._reach()).collect()] == [64, 4096, 256, 64]
    grams = dec._item_grams(dec._item_words(items).selectExpr("item_id as row", "words").withColumn("reach", dec._reach()), 3, 1)
    classes = [(reach, 2, dec.bitmap(grams.where(F.col("reach") == reach), "gram"), bytes(8)) for reach in (64, 4096)]
    found = dec._passages(spark.createDataFrame([(1, " ".join(text))], "doc_id long, text string"), classes, 3, 1, 13)
    assert max(len(r["words"]) for r in found.where("reach = 64").collect()) // 8 <= 20 + 6 * 64


def test_spaced_grams():
    words = np.arange(1, 30, dtype=np.uint64)
    by_span = list(dec.spaced_grams(words, 3, 1))
    assert [(size, len(g)) for size, g in by_span] == [(3, 27), (4, 26), (4, 26), (5, 25)]
    assert len(np.unique(np.concatenate([g for _, g in by_span]))) == 27 + 26 + 26 + 25
    without = np.delete(words, 10)  # what spans a word left out in one text stands side by side in the other
    shared = np.intersect1d(np.concatenate([g for _, g in dec.spaced_grams(without, 3, 1)]), by_span[1][1])
    assert len(shared) >= 22
    assert [len(g) for _, g in dec.spaced_grams(words[:2], 3, 1)] == [0, 0, 0, 0]
