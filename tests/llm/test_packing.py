import base64
import itertools
import random
import time
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest

from tablesync.llm import packing
from tablesync.llm.queries import tokenizer_files

DOCS = [(1, "the quick brown fox"), (2, None), (3, ""), (4, "word " * 3000), (5, "naïve 日本語 <|endoftext|> \x00 don't"), (1, "the quick brown fox"),
        (None, "no id"), (7, "a" * 5000)]


def docs_of(spark, rows=DOCS):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, sequence_id string, offset int")


def test_ids_are_the_tokenizers_own():
    fast, slow = packing.Encoder(*tokenizer_files()), packing.Encoder(tokenizer_files()[0])
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(5)
    chars = "aAzZ09 .,'!?\n\t-éüß€’<|>_#  日😀\x00"
    texts = ["".join(rng.choices(chars, k=rng.randint(0, 60))) for _ in range(3000)] + [t for _, t in DOCS if t] + [" " * 9000, "\n \n" * 800, "I'll we've it's", "<|endoftext|>"]
    for text in texts:
        assert fast(text) == slow(text) == own.encode(text, add_special_tokens=False).ids


def test_ids_where_blanks_meet():
    from tokenizers import Tokenizer

    fast, own = packing.Encoder(*tokenizer_files()), Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(6)
    texts = ["".join(t) for n in range(6) for t in itertools.product(" \n\ta'1.", repeat=n)]
    texts += ["".join(rng.choices("abcdefgé1.", k=n)) for n in (1999, 2000, 5000, 60000)] + ["a" * 60000, "x" + "\n " * 1500 + "y", "ab  " * 900 + "."]
    for text, coded in zip(texts, own.encode_batch(texts, add_special_tokens=False)):
        assert fast(text) == coded.ids, text[:40]


def tiktoken_alone(pattern):
    import tiktoken

    with open(tokenizer_files()[1], "rb") as lines:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={}).encode_ordinary


def test_other_patterns_are_taken_as_they_are():
    pattern = r"\p{L}+|[^\p{L}]+"
    fast, own = packing.Encoder(*tokenizer_files()[:2], pattern), tiktoken_alone(pattern)
    for text in ("one, two", "a \n\n b", "x  y", ""):
        assert fast(text) == own(text)


def test_choosing_a_library_costs_less_than_it_saves(spark):
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").where("text <> ''").limit(400).collect()]
    fast, given = packing.Encoder(*tokenizer_files()), tiktoken_alone(tokenizer_files()[2])

    def seconds(encode):
        began = time.thread_time()
        for text in texts:
            encode(text)
        return time.thread_time() - began

    times = [(seconds(fast), seconds(given)) for _ in range(7)]
    assert min(t for t, _ in times) < min(t for _, t in times)


@pytest.mark.parametrize("capacity", [64, 1024])
def test_pieces_cover_every_text(spark, capacity):
    encode = packing.Encoder(*tokenizer_files())
    got = defaultdict(list)
    for r in packing.pieces(docs_of(spark), *tokenizer_files(), capacity=capacity).collect():
        got[r["doc_id"]].append(r)
    for doc_id, text in DOCS:
        ids = [*encode(text or ""), 2]
        parts = sorted({(r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got[doc_id]})
        assert [p for p, *_ in parts] == list(range(-(-len(ids) // capacity))) and sum(n for _, _, n, _ in parts) == len(ids)
        assert all(n == capacity for p, _, n, _ in parts if p) and len(got[doc_id]) == len(parts) * [d for d, _ in DOCS].count(doc_id)
        for _, start, n, crc in parts:
            assert crc == zlib.crc32(np.array(ids[start:start + n], "<u4").tobytes())


def check(rows, capacity):
    by = defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_packing_is_gapless_and_close_to_the_bound(spark):
    rng = random.Random(3)
    sizes = [rng.choice([5, 60, 100, 333, 512, 700, 1023, 1024]) if rng.random() < 0.5 else rng.randint(1, 1024) for _ in range(3000)]
    parts = spark.createDataFrame([(i, n, "a") for i, n in enumerate(sizes)], "doc_id long, length long, part string")
    out = packing.pack(parts, 1024, block_items=256)
    rows = out.collect()
    assert out.columns == ["doc_id", "length", "part", "sequence_id", "offset"] and sorted(r["doc_id"] for r in rows) == list(range(3000))
    whole: list = []  # best fit of all parts at once, the longest first
    packing.best_fit(sorted(range(3000), key=lambda i: -sizes[i]), sizes, whole, [], 1024)
    assert check(rows, 1024) <= 1.01 * len(whole)  # though no block has more than 256 parts


def test_equal_rows_null_ids_and_nothing(spark):
    parts = packing.pieces(docs_of(spark), *tokenizer_files(), capacity=64)
    rows = packing.pack(parts, 64, block_items=2).collect()
    check(rows, 64)
    assert len(rows) == parts.count()
    assert packing.pack(parts.limit(0), 64).collect() == []
    assert packing.pieces(docs_of(spark).limit(0), *tokenizer_files()).collect() == []


def test_one_task_gets_one_block(spark):
    parts = spark.range(5000).selectExpr("id as doc_id", "cast(10 as long) as length")
    rows = packing.pack(parts, 100, block_items=100).collect()
    assert check(rows, 100) == 500


def smallest(sizes, capacity):
    """The least number of bins, by trying all."""
    best = [len(sizes)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + sizes[i] <= capacity:
                go(i + 1, bins[:k] + [bins[k] + sizes[i]] + bins[k + 1:])
        go(i + 1, bins + [sizes[i]])

    go(0, [])
    return best[0]


def test_evolution_finds_the_optimum_of_small_cases():
    rng = random.Random(1)
    for _ in range(40):
        sizes = [rng.randint(10, 60) for _ in range(9)]
        best = packing.evolve(sizes, 100, [], 1, members=6, generations=40)[0]
        assert sorted(i for b in best for i in b) == list(range(9)) and all(sum(sizes[i] for i in b) <= 100 for b in best)
        assert len(best) == smallest(sizes, 100)


def test_operators_keep_a_solution_whole():
    rng = random.Random(2)
    sizes = [rng.randint(1, 100) for _ in range(200)]
    island = packing._Island(sizes, 100, rng)
    one, two = island.first(0.0), island.first(0.5)
    for _ in range(50):
        one = island.mutate(island.cross(one, two))
        assert sorted(i for b in one for i in b) == list(range(200)) and min(island.rooms(one)) >= 0
    assert packing._to_bins(packing._to_bytes(one, 200)) == [sorted(b) for b in one]
    better = packing.evolve(sizes, 100, [one], 3, generations=10)
    assert island.fitness(better[0]) >= island.fitness(one)


def test_the_whole_query(spark):
    from zlib import crc32

    import numpy as np
    from tokenizers import Tokenizer

    from tablesync.llm.queries import QUERIES, tokenizer_files

    sf = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    names = sorted(texts)
    coded = Tokenizer.from_file(str(tokenizer_files()[0])).encode_batch([texts[d] for d in names], add_special_tokens=False)
    ids = {d: np.array([*c.ids, 2], dtype="<u4") for d, c in zip(names, coded)}
    pieces, sequences = {}, {}
    for r in QUERIES["op9_packing"](spark, sf).collect():
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert sorted(pieces) == names
    for d, held in pieces.items():
        held.sort(key=lambda r: r["piece"])
        assert [r["piece"] for r in held] == list(range(len(held))) and all(r["length"] == 1024 for r in held[1:] if len(held) > 1)
        at = 0
        for r in held:
            assert r["start"] == at and r["ids_crc32"] == crc32(ids[d][at:at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids[d]) and (len(held) == 1 or at > 1024)
    for places in sequences.values():
        places.sort()
        assert [p[0] for p in places] == [sum(n for _, n in places[:i]) for i in range(len(places))] and sum(n for _, n in places) <= 1024
