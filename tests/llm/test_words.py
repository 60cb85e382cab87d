import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from tablesync.llm.words import SPAN_BYTES, combine, shingle_sets, word_chunks

WORD = re.compile("[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def texts_of(texts, **more):
    out = [[] for _ in texts]
    for chunk in word_chunks(pa.array(texts, pa.string()), **more):
        for row, hashes in chunk.rows():
            out[row] = hashes.tolist()
    return out


def check(texts, **more):
    got, seen = texts_of(texts, **more), {}
    for text, hashes in zip(texts, got):
        words = WORD.findall((text or "").translate(LOWER))
        assert len(words) == len(hashes)
        for word, h in zip(words, hashes):
            assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.none() | st.text(alphabet="aAbB é日 \t\n\r\x0b\x0c\x00\x85 ", max_size=30), max_size=8), st.integers(1, 40))
def test_words_are_those_of_the_pattern(texts, chunk):
    check(texts, chunk_bytes=chunk)


def test_nothing_and_long_texts():
    assert list(word_chunks(pa.array([], pa.string()))) == []
    check([None, "", " ", "x" * (SPAN_BYTES + 7) + " y", "ab " * 900_000, "z"])
    long = texts_of(["x" * (3 * SPAN_BYTES) + " y", "y", "a b " * 700_000 + "y"])
    assert long[0][1] == long[1][0] == long[2][-1] and len(long[2]) == 1_400_001


def test_sliced_columns_and_marks():
    column = pa.array(["zero", "One TWO", None, "three"], pa.string()).slice(1, 2)
    chunk, = word_chunks(column)
    assert np.diff(chunk.bounds).tolist() == [2, 0] and chunk.owners().tolist() == [0, 0]
    plain = texts_of(["le ciel bleu", "Le, ciel! (bleu)..."], bare=True)
    assert plain[0] == plain[1]


@pytest.mark.parametrize("width", [1, 2, 5])
def test_shingle_sets(width):
    texts = ["a b c d e f", "A b c d e", "a b c", "", None, "a a a a a a a a", "c b a"]
    words = [WORD.findall((t or "").translate(LOWER)) for t in texts]
    want = [{tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} - {()} for w in words]
    got = {}
    for chunk in word_chunks(pa.array(texts, pa.string()), chunk_bytes=9):
        for row, tokens in shingle_sets(chunk, width):
            assert (np.diff(tokens.astype(object)) > 0).all()
            got[row] = set(tokens.tolist())
    for i in range(len(texts)):
        assert len(got[i]) == len(want[i])
        for j in range(len(texts)):
            assert len(got[i] & got[j]) == len(want[i] & want[j])


def test_order_and_length_count():
    one, two = np.array([1], np.uint64), np.array([2], np.uint64)
    assert len({int(combine(p)[0]) for p in ([one], [two], [one, two], [two, one], [one, one], [one, one, one])}) == 6
