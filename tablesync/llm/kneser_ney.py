"""An interpolated modified Kneser-Ney bigram model, counted by Spark and memory-mapped by its workers.

Words are 64-bit hashes (``words``). A first pass counts them: tasks count some million tokens at a time and send the
distinct words, cut by hash into parts, as compressed arrays; a part is merged and written to the shared folder as a
sorted array of hashes and one of counts. A word's number is its place in all parts together. A second pass counts
pairs of numbers the same way, cut by a hash of the pair; a third exchange merges statistics by context (sum, and how
many successors occur once, twice, more often) and by word (how many distinct words come before it). Tasks map the
arrays and search them. Parts are cut by hash or number, so a frequent word or pair adds one entry per
million tokens to its part.

With d(c) the discount of count c (from the counts of counts):
  P(w | u) = (c(uw) - d(c(uw))) / c(u.) + g(u) P(w),  P(w) = (n(w) - d'(n(w))) / n + g' / (V + 1)
where n(w) counts the distinct words before w, and V + 1 leaves a share for unknown words. After an unknown word P(w) holds.
All probabilities after a context, that of one unknown word included, add up to 1.

Where the shared folder is no mounted file system, a part is read into memory instead of mapped.

Defined results: a NULL or empty text is the end token alone. Without training rows every probability is 1.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.sources.staging import shared_folder, stage

from .words import combine, mix, word_chunks

__all__ = ["KneserNey", "learn", "score"]

FLUSH_TOKENS = 1_000_000
PART_BYTES = 16 << 20  # of text; parts grow instead of becoming more than
MAX_PARTS = 1 << 16
END = mix(np.array([2], dtype=np.uint64))[0]

#: The columns behind the key of each kind of table; a file with a value beyond them has 64 bits for all.
VALUES = {
    "word": (np.uint64,),  # count
    "bigram": (np.uint32,),  # count
    "context": (np.uint64, np.uint32, np.uint32, np.uint32),  # sum, successors seen once, twice, more often
    "before": (np.uint32,),  # distinct words before
}


def _pack(columns: list[np.ndarray]) -> bytes:
    """Columns as differences, the first bytes of all values together, then the second ones, and so on."""
    out = []
    for c in columns:
        steps = np.diff(c, prepend=c.dtype.type(0))
        out.append(steps.view(np.uint8).reshape(len(c), c.itemsize).T.tobytes())
    return zstandard.ZstdCompressor(level=3).compress(b"".join(out))


def _unpack(data: bytes, kinds: tuple) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    n = len(raw) // sum(np.dtype(k).itemsize for k in kinds)
    out, at = [], 0
    for k in kinds:
        size = np.dtype(k).itemsize
        steps = np.ascontiguousarray(raw[at:at + n * size].reshape(size, n).T).view(k).reshape(n)
        out.append(np.cumsum(steps, dtype=k))
        at += n * size
    return out


def _part_of(kind: str, keys: np.ndarray, parts: int, words: int) -> np.ndarray:
    """Words are cut by their hash, pairs by a hash of theirs, statistics by the word's number."""
    if kind in ("context", "before"):
        return (keys * np.uint64(parts) // np.uint64(words + 2)).astype(np.int64)
    high = (mix(keys) if kind == "bigram" else keys) >> np.uint64(32)
    return (high * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _cut(kind: str, columns: list[np.ndarray], keys: np.ndarray, parts: int, words: int = 0) -> Iterator[tuple[str, int, bytes]]:
    """Rows cut into parts, in each part in their order."""
    of = _part_of(kind, keys, parts, words)
    order = np.argsort(of, kind="stable")
    edges = np.searchsorted(of[order], np.arange(parts + 1))
    for p in np.flatnonzero(np.diff(edges)):
        yield kind, int(p), _pack([c[order[edges[p]:edges[p + 1]]] for c in columns])


def _pair(u: np.ndarray, w: np.ndarray, words: int) -> np.ndarray:
    """A key for two numbers: one of its own while there are fewer than 2^32 words, a 64-bit hash beyond."""
    return u * np.uint64(words + 2) + w if words + 2 < 1 << 32 else combine([u, w])


def _grouped(keys: np.ndarray, sums: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Distinct keys in order, the place of one of each, and the sums by key."""
    if not len(keys):
        return keys, np.empty(0, np.int64), [np.empty(0, np.int64) for _ in sums]
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    heads = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    return ranked[heads], order[heads], [np.add.reduceat(s[order].astype(np.int64), heads) for s in sums]


def _tokens(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row, tokens, bounds): words and the end of every text."""
    for chunk in word_chunks(texts):
        n = chunk.last - chunk.first
        bounds = chunk.bounds + np.arange(n + 1)
        tokens = np.full(bounds[-1], END, dtype=np.uint64)
        inner = np.ones(len(tokens), dtype=bool)
        inner[bounds[1:] - 1] = False
        tokens[inner] = chunk.hashes
        yield chunk.first, chunk.last, tokens, bounds


def _before(numbers: np.ndarray, bounds: np.ndarray, start: int) -> np.ndarray:
    """The number before each token; ``start`` before the first of a text."""
    out = np.empty_like(numbers)
    out[1:] = numbers[:-1]
    out[bounds[:-1]] = start
    return out


ROWS = pa.schema([("kind", pa.string()), ("part", pa.int32()), ("data", pa.binary())])


def _batches(rows: Iterator[tuple[str, int, bytes]]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[2])
        if size > 8 << 20:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), ROWS)], schema=ROWS)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), ROWS)], schema=ROWS)


@dataclass
class KneserNey:
    """What a task needs to score: the parts' files, and discounts and totals."""

    root: str
    parts: int
    tokens: int = 0
    words: int = 0
    bigrams: int = 0
    files: dict[tuple[str, int], tuple[str, int]] = field(default_factory=dict)
    firsts: dict[int, int] = field(default_factory=dict)  # number of each part's first word
    discounts: tuple[float, float, float, float] = (0.0, 0.5, 1.0, 1.5)  # by bigram count, 0 to 3 and more
    lower: tuple[float, float, float, float] = (0.0, 0.5, 1.0, 1.5)  # by number of words before
    spare: float = 1.0  # the lower model's share for the uniform one

    def find(self, kind: str, keys: np.ndarray) -> list[np.ndarray]:
        """The values of the rising keys, 0 where a key is unknown; of words first their numbers (unknown: one above all)."""
        out = [np.zeros(len(keys), dtype=np.uint64) for _ in VALUES[kind]]
        numbers = np.full(len(keys), self.words + 1, dtype=np.uint64)
        of = _part_of(kind, keys, self.parts, self.words)
        order = np.argsort(of, kind="stable")
        edges = np.searchsorted(of[order], np.arange(self.parts + 1))
        for p in map(int, np.flatnonzero(np.diff(edges))):
            if (kind, p) not in self.files:
                continue
            have, *values = _mapped(self.root, kind, *self.files[kind, p])
            asked = order[edges[p]:edges[p + 1]]
            at = np.minimum(np.searchsorted(have, keys[asked]), len(have) - 1)
            hit = have[at] == keys[asked]
            for o, v in zip(out, values):
                o[asked[hit]] = v[at[hit]]
            if kind == "word":
                numbers[asked[hit]] = at[hit].astype(np.uint64) + np.uint64(self.firsts[p])
        return [numbers, *out] if kind == "word" else out

    def log10_probabilities(self, tokens: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 P of each token after the one before it, and the count of each token in training."""
        distinct, at_w = np.unique(tokens, return_inverse=True)
        numbers, counts = self.find("word", distinct)
        by_number = np.argsort(numbers, kind="stable")
        left = np.empty(len(numbers), dtype=np.int64)
        left[by_number] = self.find("before", numbers[by_number])[0]
        lower = (left - np.array(self.lower)[np.minimum(left, 3)]) / max(self.bigrams, 1) + self.spare / (self.words + 1)
        w = numbers[at_w]
        before = _before(w, bounds, self.words)
        u, at_u = np.unique(before, return_inverse=True)
        total, *seen = self.find("context", u)
        rest = sum(d * s for d, s in zip(self.discounts[1:], seen)) / np.maximum(total, 1)
        rest = np.where(total > 0, rest, 1.0)
        keys, at = np.unique(_pair(before, w, self.words), return_inverse=True)
        c = self.find("bigram", keys)[0][at].astype(np.int64)
        p = np.where(c > 0, (c - np.array(self.discounts)[np.minimum(c, 3)]) / np.maximum(total[at_u], 1), 0.0) + rest[at_u] * lower[at_w]
        return np.log10(p), counts[at_w]


def _flushed(read: Callable[[pa.Array], Iterator[tuple[np.ndarray, ...]]], flush: Callable[..., Iterator[tuple[str, int, bytes]]]):
    """Collect what ``read`` gives of each batch of texts, and ``flush`` it every ``FLUSH_TOKENS`` tokens."""
    limit = FLUSH_TOKENS

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, bytes]]:
        held, size = [], 0
        for batch in batches:
            for columns in read(batch.column("text")):
                held.append(columns)
                size += len(columns[0])
                if size >= limit:
                    yield from flush(*map(np.concatenate, zip(*held)))
                    held, size = [], 0
        if size:
            yield from flush(*map(np.concatenate, zip(*held)))

    return lambda batches: _batches(rows(batches))


def _word_counts(parts: int):
    def flush(tokens: np.ndarray) -> Iterator[tuple[str, int, bytes]]:
        keys, n = np.unique(tokens, return_counts=True)
        yield from _cut("word", [keys, n.astype(np.uint64)], keys, parts)

    return _flushed(lambda texts: ((tokens,) for _, _, tokens, _ in _tokens(texts)), flush)


def _pair_counts(model: KneserNey):
    def read(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for _, _, tokens, bounds in _tokens(texts):
            w, at = np.unique(tokens, return_inverse=True)
            numbers = model.find("word", w)[0][at]
            yield _before(numbers, bounds, model.words), numbers

    def flush(u: np.ndarray, w: np.ndarray) -> Iterator[tuple[str, int, bytes]]:
        keys, at, n = np.unique(_pair(u, w, model.words), return_index=True, return_counts=True)
        yield from _cut("bigram", [u[at], w[at], n.astype(np.uint32)], keys, model.parts, model.words)

    return _flushed(read, flush)


def _store(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def _write(root: str, kind: str, columns: list[np.ndarray]) -> str:
    store, folder = _store(root)
    kinds = (np.uint64, *VALUES[kind])
    wide = any(len(c) and int(c.max()) > np.iinfo(k).max for c, k in zip(columns, kinds))
    name = f"{kind}-{'wide-' if wide else ''}{uuid.uuid4().hex}"
    with store.open_output_stream(f"{folder}/{name}", compression=None) as out:
        for c, k in zip(columns, kinds):
            out.write(c.astype(np.uint64 if wide else k).tobytes())
    return name


#: A part's file; ``ones`` to ``fours`` are entries of value 1 to 4, ``total`` the sum of values.
FILES = "kind string, part int, file string, n long, total long, ones long, twos long, threes long, fours long"
_FILE = [f.split()[0] for f in FILES.split(", ")]


def _filed(root: str, kind: str, part: int, columns: list[np.ndarray]) -> dict:
    values = columns[1]
    of = {name: int(np.count_nonzero(values == k)) for k, name in enumerate(("ones", "twos", "threes", "fours"), 1)}
    return {"kind": kind, "part": part, "file": _write(root, kind, columns), "n": len(values), "total": int(values.sum()), **of}


@lru_cache(maxsize=4096)
def _mapped(root: str, kind: str, file: str, n: int) -> list[np.ndarray]:
    store, folder = _store(root)
    kinds, path = (np.uint64, *VALUES[kind]), f"{folder}/{file}"
    kinds = (np.uint64,) * len(kinds) if file.startswith(f"{kind}-wide-") else kinds
    if store.type_name == "local":
        raw = np.memmap(path, dtype=np.uint8, mode="r")
    else:
        with store.open_input_file(path) as source:
            raw = np.frombuffer(source.read(), dtype=np.uint8)
    out, at = [], 0
    for k in kinds:
        size = n * np.dtype(k).itemsize
        out.append(raw[at:at + size].view(k))
        at += size
    return out


def _discounts(ones: int, twos: int, threes: int, fours: int) -> tuple[float, float, float, float]:
    """Chen and Goodman's estimates; one half, 1 and 1.5 where the counts of counts give none."""
    if min(ones, twos, threes, fours) == 0:
        return 0.0, 0.5, 1.0, 1.5
    y = ones / (ones + 2 * twos)
    raw = 1 - 2 * y * twos / ones, 2 - 3 * y * threes / twos, 3 - 4 * y * fours / threes
    return 0.0, *(min(max(d, 0.05), k - 0.05) for k, d in enumerate(raw, 1))


def learn(docs: DataFrame) -> KneserNey:
    """Count (text) rows and write the model to the shared folder."""
    spark = docs.sparkSession
    root = f"{shared_folder(spark)}/ngrams-{uuid.uuid4().hex}"
    store, folder = _store(root)
    store.create_dir(folder, recursive=True)
    size = docs.agg(F.sum(F.octet_length("text") + F.lit(1))).first()[0] or 0
    parts = int(min(MAX_PARTS, max(1, size // PART_BYTES + 1)))
    texts, blobs = docs.select("text"), "kind string, part int, data binary"

    def merge_words(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        found = [_unpack(d, (np.uint64, np.uint64)) for d in rows["data"]]
        keys, _, (n,) = _grouped(np.concatenate([f[0] for f in found]), [np.concatenate([f[1] for f in found])])
        return pd.DataFrame([_filed(root, *key, [keys, n.astype(np.uint64)])], columns=_FILE)

    # a file for each kind and part, so at most 4 * MAX_PARTS names
    files = texts.mapInArrow(_word_counts(parts), blobs).groupBy("kind", "part").applyInPandas(merge_words, FILES).collect()
    model = KneserNey(root, parts, sum(f["total"] for f in files), sum(f["n"] for f in files), files=_named(files))
    at = 0
    for f in sorted(files, key=lambda f: f["part"]):
        model.firsts[f["part"]] = at
        at += f["n"]
    words = model.words

    def merge_pairs(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        found = [_unpack(d, (np.uint64, np.uint64, np.uint32)) for d in rows["data"]]
        u, w, c = (np.concatenate([f[i] for f in found]) for i in range(3))
        keys, at, (n,) = _grouped(_pair(u, w, words), [c])
        u, w = u[at], w[at]
        out = [{**_filed(root, *key, [keys, n]), "data": None}]
        ctx, _, sums = _grouped(u, [n, n == 1, n == 2, n > 2])
        after = _cut("context", [ctx, sums[0].astype(np.uint64), *(s.astype(np.uint32) for s in sums[1:])], ctx, parts, words)
        last, _, (left,) = _grouped(w, [np.ones(len(w), np.int64)])
        for name, p, data in (*after, *_cut("before", [last, left.astype(np.uint32)], last, parts, words)):
            out.append({"kind": name, "part": p, "data": data})
        return pd.DataFrame(out, columns=[*_FILE, "data"]).astype({c: "Int64" for c in _FILE[3:]})

    def merge_sums(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        kinds = VALUES[key[0]]
        found = [_unpack(d, (np.uint64, *kinds)) for d in rows["data"]]
        columns = [np.concatenate([f[i] for f in found]) for i in range(1 + len(kinds))]
        keys, _, sums = _grouped(columns[0], columns[1:])
        return pd.DataFrame([_filed(root, *key, [keys, *sums])], columns=_FILE)

    sent = texts.mapInArrow(_pair_counts(model), blobs)
    held = stage(sent.groupBy("kind", "part").applyInPandas(merge_pairs, FILES + ", data binary"), "ngram-parts")
    merged = held.read()
    sums = merged.where("file is null").select("kind", "part", "data").groupBy("kind", "part").applyInPandas(merge_sums, FILES)
    more = [*merged.where("file is not null").select(*_FILE).collect(), *sums.collect()]
    held.release()
    model.files |= _named(more)
    counts = {kind: [sum(f[c] for f in more if f["kind"] == kind) for c in ("ones", "twos", "threes", "fours")] for kind in ("bigram", "before")}
    model.discounts, model.lower = _discounts(*counts["bigram"]), _discounts(*counts["before"])
    model.bigrams = sum(f["n"] for f in more if f["kind"] == "bigram")
    if model.bigrams:
        (ones, twos, *_), low = counts["before"], model.lower
        model.spare = (low[1] * ones + low[2] * twos + low[3] * (words - ones - twos)) / model.bigrams
    return model


def _named(files: list) -> dict[tuple[str, int], tuple[str, int]]:
    return {(f["kind"], f["part"]): (f["file"], f["n"]) for f in files}


def score(docs: DataFrame, model: KneserNey) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of every row of (doc_id, text).

    ``score`` is the text's log10 probability; ``base_score`` that of single words, with 0.1 added to every count.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, tokens, bounds in _tokens(batch.column("text")):
                p, counts = model.log10_probabilities(tokens, bounds)
                base = np.log10((counts + 0.1) / (model.tokens + 0.1 * (model.words + 1)))
                sums = [np.add.reduceat(x, bounds[:-1]) for x in (counts > 0, base, p)]
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(first, last - first), pa.array(np.diff(bounds)), pa.array(sums[0].astype(np.int64)),
                    pa.array(np.full(last - first, model.tokens)), pa.array(sums[1]), pa.array(sums[2])],
                    names=["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")
