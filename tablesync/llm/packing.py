"""Packing documents into token sequences with a grouping genetic algorithm on islands.

``pieces`` tokenizes whole texts and cuts only documents longer than a sequence. Full pieces are sequences of
their own; the rest is packed. A solution is a grouping of items into bins. Crossover injects whole
well-filled bins of one parent into the other, drops the bins that now hold an item twice, and puts the
displaced items back by best fit, longest first; mutation dissolves the emptiest bins.

Items are dealt at random into blocks of ``block_items``. Every block is worked on by ``islands`` populations,
each a row of its own that Spark may run anywhere; after an epoch each sends its elite to the next
island of the block. The best grouping wins, its badly filled bins are dissolved, and their items
of all blocks form the next round's blocks, until one block is left. A task holds one island at a
time, and memory does not depend on the input.

Defined results: NULL and empty texts are the end token alone; equal rows are items of their own; an empty table
gives no rows; further columns are not carried.
"""

from __future__ import annotations

import base64
import random
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch

__all__ = ["Encoder", "evolve", "pack", "pieces"]

#: Texts of these characters, without "<|", are split alike by both libraries; tiktoken is four times as fast.
_UNUSUAL = re.compile("[^\t\n\r -~¡-ɏ‐-‧€]")
#: A run this long goes to the other library, which has no recursion limit.
_LONG_RUN = re.compile(r"\S{2000}|\s{2000}")
#: GPT-2's pattern. But for blanks of which three follow each other, or two end the text, it splits as the plain one does,
#: which looks nowhere ahead and so needs no backtracking, however long a run is.
_GPT2 = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_PLAIN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s"""
_BLANKS = re.compile(r"\s\s(?:\s|\Z)")


class Encoder:
    """Token ids of a text as the tokenizer file gives them. ``ranks`` and ``pattern`` name the same vocabulary for tiktoken."""

    def __init__(self, tokenizer: str, ranks: str | None = None, pattern: str | None = None):
        self._tokenizer, self._ranks, self._pattern = tokenizer, ranks, pattern if ranks else None

    def _tiktoken(self, pattern: str):
        import tiktoken

        with open(self._ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={}).encode_ordinary

    # each is loaded by the first text that needs it
    @cached_property
    def _plain(self):
        return self._tiktoken(_PLAIN)

    @cached_property
    def _fast(self):
        return self._tiktoken(self._pattern)

    @cached_property
    def _slow(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self._tokenizer)

    def __call__(self, text: str) -> list[int]:
        if self._pattern and "<|" not in text and not _UNUSUAL.search(text):
            if self._pattern == _GPT2 and not _BLANKS.search(text):
                return self._plain(text)
            if not _LONG_RUN.search(text):
                return self._fast(text)
        return self._slow.encode(text, add_special_tokens=False).ids


@lru_cache(maxsize=2)
def _encoder(*files: str | None) -> Encoder:
    return Encoder(*files)


def pieces(
    docs: DataFrame, tokenizer: str, ranks: str | None = None, pattern: str | None = None,
    capacity: int = 1024, end_id: int = 2,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): a document's ids and the end id, cut from the end where too long."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = _encoder(tokenizer, ranks, pattern)
        for batch in batches:
            out = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = array("I", encode(text) if text else ())
                ids.append(end_id)
                ids = np.array(ids, dtype="<u4")
                first = (len(ids) - 1) % capacity + 1
                for k, start in enumerate(range(first - capacity, len(ids), capacity)):
                    part = ids[max(0, start):start + capacity]
                    out.append((doc_id, k, max(0, start), len(part), zlib.crc32(part.tobytes())))
            yield pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32"])

    # ids travel as text: pandas makes numbers with a NULL among them floats
    out = docs.select(F.col("doc_id").cast("string"), "text").mapInPandas(
        cut, "doc_id string, piece int, start long, length long, ids_crc32 long")
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))


def best_fit(order: list[int], sizes: list[int], bins: list[list[int]], room: list[int], capacity: int) -> None:
    """Put items, in this order, where they leave least room; open a bin where none has room."""
    by_room: dict[int, list[int]] = {}
    free = 0  # bit r is set while some bin has r left
    for b, r in enumerate(room):
        if r:
            by_room.setdefault(r, []).append(b)
            free |= 1 << r
    for item in order:
        size = sizes[item]
        rest = free >> size
        if rest:
            r = size + (rest & -rest).bit_length() - 1
            b = by_room[r].pop()
            if not by_room[r]:
                free &= ~(1 << r)
            bins[b].append(item)
        else:
            b, r = len(bins), capacity
            bins.append([item])
            room.append(r)
        left = r - size
        room[b] = left
        if left:
            by_room.setdefault(left, []).append(b)
            free |= 1 << left


class _Island:
    def __init__(self, sizes: list[int], capacity: int, rng: random.Random):
        self.sizes, self.capacity, self.rng = sizes, capacity, rng

    def rooms(self, bins: list[list[int]]) -> list[int]:
        return [self.capacity - sum(map(self.sizes.__getitem__, b)) for b in bins]

    def fitness(self, bins: list[list[int]]) -> tuple[int, int]:
        """Fewer bins first, then the more unequal filling, which leaves room in one place."""
        return -len(bins), sum((self.capacity - r) ** 2 for r in self.rooms(bins))

    def refill(self, kept: list[list[int]], items: list[int]) -> list[list[int]]:
        bins = [b.copy() for b in kept]
        best_fit(sorted(items, key=lambda i: -self.sizes[i]), self.sizes, bins, self.rooms(bins), self.capacity)
        return bins

    def first(self, noise: float) -> list[list[int]]:
        key = [-s * (1 + noise * self.rng.random()) for s in self.sizes]
        bins: list[list[int]] = []
        best_fit(sorted(range(len(key)), key=key.__getitem__), self.sizes, bins, [], self.capacity)
        return bins

    def cross(self, mother: list[list[int]], father: list[list[int]]) -> list[list[int]]:
        rooms = self.rooms(father)
        good = sorted(range(len(father)), key=lambda b: (rooms[b], self.rng.random()))[: max(1, len(father) // 2)]
        gifts = [father[b] for b in good if self.rng.random() < 0.5] or [father[good[0]]]
        given = {i for b in gifts for i in b}
        kept, displaced = [], []
        for b in mother:
            if given.isdisjoint(b):
                kept.append(b)
            else:
                displaced += [i for i in b if i not in given]
        return self.refill(kept + gifts, displaced)

    def mutate(self, bins: list[list[int]]) -> list[list[int]]:
        rooms = self.rooms(bins)
        order = sorted(range(len(bins)), key=lambda b: -rooms[b])
        gone = set(order[:2]) | set(self.rng.sample(range(len(bins)), min(len(bins), 3)))
        return self.refill([b for k, b in enumerate(bins) if k not in gone], [i for k in gone for i in bins[k]])


def evolve(
    sizes: list[int], capacity: int, population: list[list[list[int]]], seed: int, members: int = 4, generations: int = 6,
) -> list[list[list[int]]]:
    """A population after some generations, best first. Given members (migrants among them) are kept while they are good."""
    island = _Island(sizes, capacity, random.Random(seed))
    alive = list(population)
    while len(alive) < members:
        alive.append(island.first(0.0 if not alive else 0.3))
    least = -(-sum(sizes) // capacity)
    rate = island.fitness
    for _ in range(generations):
        alive.sort(key=rate, reverse=True)
        if len(alive[0]) <= least:
            break
        mother, father = island.rng.sample(alive[:members], 2) if members > 1 else (alive[0], alive[0])
        for child in (island.cross(mother, father), island.mutate(alive[0])):
            alive.append(child)
        alive = sorted(alive, key=rate, reverse=True)[:members]
    return sorted(alive, key=rate, reverse=True)[:members]


def _to_bytes(bins: list[list[int]], n: int) -> bytes:
    of = np.empty(n, dtype="<i4")
    for k, b in enumerate(bins):
        of[b] = k
    return of.tobytes()


def _to_bins(data: bytes) -> list[list[int]]:
    of = np.frombuffer(data, dtype="<i4").tolist()
    bins: list[list[int]] = [[] for _ in range(max(of, default=-1) + 1)]
    for i, b in enumerate(of):
        bins[b].append(i)
    return bins


def _round(items: DataFrame, count: int, number: int, capacity: int, block_items: int, islands: int, epochs: int, seed: int, hold: Scratch) -> DataFrame:
    """Items with ``bin`` (in their block) and ``room`` (left in that bin)."""
    blocks = max(1, -(-count // block_items))
    dealt = items.withColumn("block", F.pmod(F.xxhash64(F.lit(seed + number), "id"), F.lit(blocks)))
    fields = [c for c in dealt.columns if c != "block"]
    fields = [F.col(c) for c in dealt.columns if c not in ("block", "id")]
    # a block holds about block_items items, however the input is keyed, as ids are dealt at random
    listed = dealt.groupBy("block").agg(F.array_sort(F.collect_list(F.struct(F.col("id"), *fields))).alias("items"))
    groups = hold(listed, "pack-items").read()
    lengths = groups.select("block", F.transform("items", lambda x: x.length).alias("sizes"))
    isles = lengths.select("*", F.explode(F.array(*map(F.lit, range(islands)))).alias("island"),
                           F.array().cast("array<binary>").alias("members"), F.lit(None).cast("binary").alias("migrant"))

    def epoch(step: int):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for row in batch.itertuples(index=False):
                    sizes = [int(x) for x in row.sizes]
                    known = [_to_bins(m) for m in (*row.members, *((row.migrant,) if row.migrant is not None else ()))]
                    salt = hash((seed, number, step, int(row.block), int(row.island)))
                    best = evolve(sizes, capacity, known, salt)
                    n, squares = _Island(sizes, capacity, random.Random(0)).fitness(best[0])
                    yield pd.DataFrame({
                        "block": [row.block], "island": [row.island], "members": [[_to_bytes(b, len(sizes)) for b in best]],
                        "bins": [-n], "squares": [squares]})

        return run

    out = None
    for step in range(epochs):
        # a number of its own: by size alone the planner would give all blocks to one task
        out = hold(isles.repartition(max(1, blocks * islands // 8), "block", "island").mapInPandas(
            epoch(step), "block long, island int, members array<binary>, bins long, squares long"), "pack-epoch").read()
        elite = out.select("block", F.pmod(F.col("island") + 1, F.lit(islands)).alias("island"), F.col("members")[0].alias("migrant"))
        isles = out.select("block", "island", "members").join(elite, ["block", "island"]).join(lengths, "block")
    winner = out.groupBy("block").agg(F.min_by(F.col("members")[0], F.struct("bins", -F.col("squares"), "island")).alias("of"))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                of, sizes = np.frombuffer(row.of, dtype="<i4"), np.array(row.sizes, dtype=np.int64)
                room = capacity - np.bincount(of, weights=sizes).astype(np.int64)
                order = np.argsort(of, kind="stable")
                before = np.cumsum(sizes[order]) - sizes[order]
                heads = np.searchsorted(of[order], of[order], "left")
                offset = np.empty(len(of), dtype=np.int64)
                offset[order] = before - before[heads]
                yield pd.DataFrame({"block": [row.block], "bin": [of.tolist()], "offset": [offset.tolist()], "room": [room[of].tolist()]})

    placed = winner.join(lengths, "block").select("block", "of", "sizes").mapInPandas(
        place, "block long, bin array<int>, offset array<long>, room array<long>")
    zipped = groups.join(placed, "block").select("block", F.explode(F.arrays_zip("items", "bin", "offset", "room")).alias("z"))
    return zipped.select("z.items.*", "block", "z.bin", "z.offset", "z.room")


def pack(
    parts: DataFrame, capacity: int = 1024, block_items: int = 1024, islands: int = 2, epochs: int = 2,
    poor: float = 0.03, seed: int = 0,
) -> DataFrame:
    """Parts (with ``length``) with ``sequence_id`` and ``offset`` in it. ``poor``: share of room from which a bin is dissolved."""
    have = [c for c in parts.columns if c.lower() not in ("sequence_id", "offset")]
    item = F.struct(*[F.col(f"`{c}`") for c in have])
    hold = Scratch()
    kept_parts = hold(parts.select(item.alias("part"), F.col("length").alias("length")), "pack-parts")
    whole = kept_parts.read().withColumn("id", F.monotonically_increasing_id())

    def result(rows: DataFrame, sequence: Column, offset: Column) -> DataFrame:
        return rows.select("part.*", sequence.alias("sequence_id"), offset.cast("long").alias("offset"))

    done = [result(whole.where(F.col("length") >= capacity), F.lit(1 << 62) + F.col("id"), F.lit(0))]
    read = [kept_parts]  # what the result reads
    left = hold(whole.where(F.col("length") < capacity), "pack-left")
    number = 0
    while left.rows:
        last = left.rows <= block_items or number == 12
        read.append(hold(_round(left.read(), left.rows, number, capacity, block_items, islands, epochs, seed, hold), "pack-round"))
        out = read[-1].read()
        kept = out if last else out.where(F.col("room") <= F.lit(int(poor * capacity)))
        sequence = F.shiftleft(F.lit(number).cast("long"), 56) + F.shiftleft("block", 20) + F.col("bin")
        done.append(result(kept, sequence, F.col("offset")))
        if last:
            break
        before, left = left.rows, hold(out.where(F.col("room") > F.lit(int(poor * capacity))).select("part", "length", "id"), "pack-left")
        number = 12 if left.rows > 0.7 * before else number + 1  # what does not pack better is packed as it is
    hold.release(*read)
    rows = done[0]
    for more in done[1:]:
        rows = rows.unionByName(more)
    return rows
