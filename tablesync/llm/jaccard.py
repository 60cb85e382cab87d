"""Exact Jaccard join of word-shingle sets, and the components of its links.

Documents with equal sets are one node. Two nodes link when 100 * shared >= ``percent`` * all. The order of
a set's shingles is any one order for all sets, here those found frequent last, then by hash. Frequent are shingles whose
hash falls into one of 2^``BUCKETS`` counters that is far above the mean.

1. **Families.** Nodes that agree in one of ``SLOTS`` minimum hashes, and with a leader in half of ``HASHES``, are dealt at random into
   bounded blocks. In a block, sets are compared that look alike and are not connected yet, so a large group of near copies costs
   links in proportion to its size, not to its square. The links' components are what step 2 starts from.
2. **Index.** Linked sets share a shingle among their first ones. Such postings (shingle, node, size, position) are kept where
   a shingle belongs to two components. A shingle's list has one entry for a component and size class, with the least size and
   most remaining positions: blocks of the list that a set, or all of a component, skips where sizes and positions
   rule it out. What two components share among their first shingles is then counted, and what is left is
   counted again for their sets: a pair goes if even all that may follow behind its last shared shingle is too little.
3. **Answers from answers.** A candidate x of y that is linked to a set R already needs no comparison where what is
   known decides: shared(y, x) is at least shared(y, R) + shared(x, R) - |R| and at most shared(y, R) + |x| - shared(x, R).
   The rest is compared in full. All links together give the components.

Which shingles count as frequent, and what the families find, changes the work and never the result. Shingles and sets
are compared as 64-bit hashes; equal hashes of different shingles or sets are not expected below some 10^9 documents.

Defined results: a text without words (or NULL) has the empty set and is a component of its own. A text of fewer words than
a shingle is one shingle. Rows of one doc_id are separate texts. ``component_id`` is NULL only where no row of the
component has an id. An empty table gives no rows; further columns are not used.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .decontamination import bitmap, bitmap_bits, in_bitmap
from .graph import components
from .scratch import Scratch
from .words import mix, shingle_sets, word_chunks

__all__ = ["similar_components"]

BUCKETS = 22  # 2^22 counters of shingles, by hash
SEGMENTS = 256  # they travel in so many pieces
COUNT_TOKENS = 1_000_000  # shingles a task counts at once
HASHES, SLOTS = 18, 4  # minimum hashes of a set; those that families are formed by
CHUNK_ENTRIES = 1 << 14  # first shingles of a component's sets handled at once
BLOCK_NODES, BLOCK_TOKENS = 256, 1 << 19  # compared in one task at once


def _node(tokens: np.ndarray) -> np.int64:
    with np.errstate(over="ignore"):
        return mix(np.array([mix(tokens).sum() + np.uint64(len(tokens))], dtype=np.uint64)).view(np.int64)[0]


def _sets(batches: Iterator[pa.RecordBatch], width: int, wanted: bytes | None = None) -> Iterator[tuple]:
    """(doc_id, set) of each row; with ``wanted`` only rows whose id that bitmap has."""
    for batch in batches:
        ids, texts = batch.column("doc_id"), batch.column("text")
        if wanted is not None:
            keep = in_bitmap(wanted, ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
            ids, texts = ids.filter(pa.array(keep)), texts.filter(pa.array(keep))
        names = ids.to_pylist()
        for chunk in word_chunks(texts):
            for row, tokens in shingle_sets(chunk, width):
                yield names[row], tokens


def _sketches(width: int):
    keys = mix(np.arange(1, HASHES + 1, dtype=np.uint64)) | np.uint64(1)
    buckets = 1 << BUCKETS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        docs, held, size, counts = [], [], 0, np.zeros(buckets, dtype=np.uint32)

        def flush() -> pd.DataFrame:
            places = (np.concatenate(held) & np.uint64(buckets - 1)).astype(np.int64)
            np.add.at(counts, places, np.uint32(1))  # in place: counting apart takes 32 MB more
            return pd.DataFrame(docs, columns=["doc_id", "n", "node", "mins"]).assign(segment=None, counts=None)

        for doc_id, tokens in _sets(batches, width):
            mins = [int((tokens * k).min().view(np.int64)) for k in keys] if len(tokens) else []
            docs.append((doc_id, len(tokens), _node(tokens), mins))
            held.append(tokens)
            size += len(tokens)
            if size >= COUNT_TOKENS or len(docs) >= 20_000:
                yield flush()
                docs, held, size = [], [], 0
        if docs:
            yield flush()
        for k, part in enumerate(counts.reshape(SEGMENTS, -1)):
            if part.any():
                yield pd.DataFrame({"n": [-1], "segment": [k], "counts": [zlib.compress(part.tobytes(), 1)]}).assign(doc_id=None, node=None, mins=None)

    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("node", pa.int64()), ("mins", pa.list_(pa.int64())),
                        ("segment", pa.int32()), ("counts", pa.binary())])
    return lambda batches: (pa.RecordBatch.from_pandas(f, schema=schema, preserve_index=False) for f in run(batches))


def _frequent(sketch: DataFrame) -> np.ndarray:
    """Which counters are far above the mean, as a bitmap of fixed size."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for segment, counts in zip(batch["segment"], batch["counts"]):
                part = np.frombuffer(zlib.decompress(counts), dtype=np.uint32)
                sums[segment] = sums.get(segment, np.uint64(0)) + part.astype(np.uint64)
        yield pd.DataFrame({"segment": list(sums), "counts": [s.tobytes() for s in sums.values()]})

    pieces = sketch.where("n = -1").select("segment", "counts").repartition(SEGMENTS // 4, "segment")
    total = np.zeros((SEGMENTS, (1 << BUCKETS) // SEGMENTS), dtype=np.uint64)
    for row in pieces.mapInPandas(add, "segment int, counts binary").collect():  # at most SEGMENTS rows
        total[row["segment"]] = np.frombuffer(row["counts"], dtype=np.uint64)
    flat = total.ravel()
    return np.packbits(flat > flat.mean() + 10 * np.sqrt(flat.mean()) + 8)


def _postings(docs: DataFrame, width: int, percent: int, frequent: np.ndarray, known: bytes | None) -> DataFrame:
    """(token, node, n, pos) of the first shingles of each set; with ``known`` only those that the bitmap has."""
    names = ["token", "node", "n", "pos"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = np.unpackbits(frequent).astype(bool)
        seen, out, size = set(), [], 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=names)

        for _, tokens in _sets(batches, width):
            n = len(tokens)
            node = _node(tokens)
            if not n or node in seen:
                continue
            if len(seen) < 1_000_000:
                seen.add(node)  # copies read by this task; others merge later
            last = common[(tokens & np.uint64(len(common) - 1)).astype(np.int64)]
            tokens = np.concatenate([tokens[~last], tokens[last]])
            first = tokens[: n - -(-percent * n // 100) + 1]
            pos = np.arange(len(first))
            if known is not None:
                keep = in_bitmap(known, first)
                first, pos = first[keep], pos[keep]
            out.append((first.view(np.int64), np.full(len(first), node), np.full(len(first), n), pos))
            size += len(first)
            if size >= 200_000:
                yield flush()
                out, size = [], 0
        if out:
            yield flush()

    return docs.mapInArrow(run, "token long, node long, n long, pos long")


def _set_table(docs: DataFrame, width: int, nodes: DataFrame, reps: DataFrame, hold: Scratch) -> DataFrame:
    """(node, tokens binary) of the given nodes, from one document of each."""
    ids = nodes.join(reps, "node").select(F.coalesce("rep", F.lit(0)).alias("rep"))
    wanted = bitmap(ids, "rep", bitmap_bits(nodes.count()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        for _, tokens in _sets(batches, width, wanted):
            out.append((_node(tokens), tokens.tobytes()))
            size += len(out[-1][1])
            if size > 4 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["node", "tokens"])
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["node", "tokens"])

    made = docs.mapInArrow(run, "node long, tokens binary").join(nodes, "node", "left_semi")
    return hold(made.groupBy("node").agg(F.min("tokens").alias("tokens")), "sets").read()


def _shared(pairs: DataFrame, sets: DataFrame, hold: Scratch) -> DataFrame:
    """(a, b) with ``shared``, the number of shingles in both, and the two sizes."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = [np.frombuffer(t, dtype=np.uint64) for t in batch["x"]]
            y = [np.frombuffer(t, dtype=np.uint64) for t in batch["y"]]
            shared = [len(np.intersect1d(p, q, assume_unique=True)) for p, q in zip(x, y)]
            yield pd.DataFrame({"a": batch["a"], "b": batch["b"], "shared": shared, "na": list(map(len, x)), "nb": list(map(len, y))})

    sides = pairs.join(sets.select(F.col("node").alias("a"), F.col("tokens").alias("x")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("tokens").alias("y")), "b")
    return hold(sides.select("a", "b", "x", "y").mapInPandas(run, "a long, b long, shared long, na long, nb long"), "shared").read()


def _needed(small: str, low: str, high: str, percent: int) -> Column:
    """The least number of shared first shingles of linked sets, one of ``small`` shingles or more, one of ``low`` to ``high`` and not smaller.

    They need all shared ones less the most that can follow the larger prefix, ceil(size * percent / 100) - 1. That grows in steps, so
    the least need is not the largest set's but that of the smallest set of its step; steps below need more.
    """
    high = F.least(F.col(high), F.floor(F.col(small) * 100 / percent))
    follow = F.ceil(high * percent / 100) - 1
    large = F.greatest(F.least(F.col(low), high), F.floor(follow * 100 / percent) + 1)
    return (F.col(small) + large) * percent / (100 + percent) - follow


def _candidates(entries: DataFrame, percent: int, hold: Scratch) -> DataFrame:
    """Pairs (a, b) of components that the lists do not rule out."""
    # sizes within 100 : percent of each other fall into the same block or neighbouring ones
    step = float(np.log(100 / percent) * 1.03) if percent < 100 else 1.0
    lists = hold(entries.groupBy("token", "label", F.floor(F.log(F.col("n")) / F.lit(step)).cast("int").alias("block")).agg(
        F.min("n").alias("least"), F.max("n").alias("most"), F.max(F.col("n") - F.col("pos")).alias("rest")), "lists").read()
    both = F.explode(F.array(F.col("block") - 1, F.col("block"), F.col("block") + 1))
    left = lists.select("token", F.col("label").alias("a"), F.col("least").alias("a1"), F.col("most").alias("a2"), F.col("rest").alias("ra"), both.alias("block"))
    right = lists.select("token", "block", F.col("label").alias("b"), F.col("least").alias("b1"), F.col("most").alias("b2"), F.col("rest").alias("rb"))
    near = left.join(right, ["token", "block"]).where(
        (F.col("a") < F.col("b")) & (F.col("a2") * 100 >= F.col("b1") * percent) & (F.col("b2") * 100 >= F.col("a1") * percent)
        & (F.least("ra", "rb") * (100 + percent) >= F.lit(percent) * (F.col("a1") + F.col("b1"))))
    near = hold(near.select("a", "b").distinct(), "near-components").read()

    # a component of very many entries is not gathered, and goes on uncounted
    many = entries.groupBy("label").agg(F.count(F.lit(1)).alias("many")).where(F.col("many") > 4 * CHUNK_ENTRIES).select("label")
    # staged, so its true size decides the join: where it is a broadcast, entries of a large component go before any exchange
    many = hold(many, "large-components").read()
    whole = hold(entries.join(many, "label", "left_anti").groupBy("label").agg(
        F.min("n").alias("least"), F.max("n").alias("most"), F.collect_set("token").alias("tokens")), "component-tokens").read()

    sides = near.join(whole.select(F.col("label").alias("a"), F.col("least").alias("a1"), F.col("most").alias("a2"), F.col("tokens").alias("ta")), "a", "left").join(
        whole.select(F.col("label").alias("b"), F.col("least").alias("b1"), F.col("most").alias("b2"), F.col("tokens").alias("tb")), "b", "left")
    enough = F.size(F.array_intersect("ta", "tb")) >= F.least(_needed("a1", "b1", "b2", percent), _needed("b1", "a1", "a2", percent)) - F.lit(1e-6)
    return sides.where(F.col("ta").isNull() | F.col("tb").isNull() | enough).select("a", "b")


def _may_link(components: DataFrame, entries: DataFrame, percent: int, hold: Scratch) -> DataFrame:
    """The pairs (a, b) of sets of two components that can still link, given all they share among their first shingles.

    Up to the earlier end of the two prefixes all shared shingles are known. One side has no more of its prefix left there,
    the other may have, but none before its last shared position. Components meet in chunks of bounded size.
    """
    held = entries.groupBy("label", "node").agg(F.max("n").alias("n"), F.collect_list("token").alias("t"), F.collect_list("pos").alias("p"))
    chunks = entries.groupBy(F.col("label").alias("large")).agg(F.ceil(F.count(F.lit(1)) / CHUNK_ENTRIES).alias("chunks")).where("chunks > 1")
    chunks = hold(chunks, "chunk-counts").read()  # its true size decides the join, as above
    # the hash keeps the grouping from reusing the join's partitioning, which would bring a large component to one task
    same = (F.xxhash64("label") == F.xxhash64("large")) & (F.col("label") == F.col("large"))
    held = held.join(chunks, same, "left").groupBy("label", F.pmod(F.xxhash64("node"), F.coalesce("chunks", F.lit(1))).alias("chunk")).agg(
        F.collect_list(F.struct("node", "n", "t", "p")).alias("sets"))
    held = hold(held, "chunks").read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for left, right in zip(*(batch.column(c).to_pylist() for c in ("x", "y"))):
                ys = [(s["node"], s["n"], dict(zip(s["t"], s["p"]))) for s in right]
                for s in left:
                    x, n, at = s["node"], s["n"], dict(zip(s["t"], s["p"]))
                    for y, m, other in ys:
                        common = at.keys() & other.keys() if n * 100 >= m * percent and m * 100 >= n * percent else ()
                        if common:
                            end_x, end_y = (k - (k - -(-percent * k // 100) + 1) for k in (n, m))
                            last_x, last_y = max(map(at.__getitem__, common)), max(map(other.__getitem__, common))
                            more = max(min(end_x, m - last_y - 1), min(n - last_x - 1, end_y))
                            if (len(common) + more) * (100 + percent) >= percent * (n + m):
                                out.append((x, y))
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.int64()) for k in (0, 1)], names=["a", "b"])

    sides = components.join(held.select(F.col("label").alias("a"), F.col("sets").alias("x")), "a").join(
        held.select(F.col("label").alias("b"), F.col("sets").alias("y")), "b")
    return sides.select("x", "y").mapInArrow(run, "a long, b long")


def _links(percent: int, shared: Column, na: Column, nb: Column) -> Column:
    return shared * (100 + percent) >= F.lit(percent) * (na + nb)


def _families(docs: DataFrame, width: int, percent: int, nodes: DataFrame, reps: DataFrame, slots: int, hold: Scratch) -> DataFrame:
    """Links (a, b, shared, na, nb) inside families of sets that look alike: enough to connect most, not all there are."""
    keyed = nodes.select("node", "n", "mins", F.posexplode(F.slice("mins", 1, max(slots, 1))).alias("slot", "least")).where(F.lit(slots > 0))
    luck = F.struct(F.xxhash64("node", "slot").alias("luck"), "n", "mins")
    heads = hold(keyed.groupBy("slot", "least").agg(F.min(luck).alias("head"), F.count(F.lit(1)).alias("many")).where("many > 1").select(
        "slot", "least", F.col("head.n").alias("size"), F.col("head.mins").alias("other"), "many"), "heads").read()
    agreed = F.size(F.filter(F.zip_with("mins", "other", lambda a, b: a == b), lambda same: same))
    blocks = F.greatest(F.ceil(F.col("many") / BLOCK_NODES), F.ceil(F.col("many") * F.col("size") / BLOCK_TOKENS))
    near = keyed.join(heads, ["slot", "least"]).where(
        (F.col("n") * 100 >= F.col("size") * percent) & (F.col("size") * 100 >= F.col("n") * percent) & (agreed * 2 >= F.size("mins")))
    near = hold(near.select("node", "n", "mins", "slot", "least", F.pmod(F.xxhash64("slot", "node"), blocks).alias("block")), "families").read()
    sets = _set_table(docs, width, hold(near.select("node").distinct(), "ends").read(), reps, hold)

    def links(rows: pd.DataFrame) -> list[tuple]:
        out, names = [], rows["node"].to_numpy()
        if len(rows) > 1:
            tokens = [frozenset(np.frombuffer(x, dtype=np.uint64).tolist()) for x in rows["tokens"]]
            mins, sizes, group = np.stack(rows["mins"].to_numpy()), np.array(list(map(len, tokens))), np.arange(len(rows))
            for i in range(len(rows) - 1):
                alike = (mins[i + 1:] == mins[i]).sum(1)
                rest = np.flatnonzero((3 * alike >= 2 * mins.shape[1]) & (group[i + 1:] != group[i]))
                for j in (i + 1 + rest[np.argsort(-alike[rest], kind="stable")]).tolist():
                    if group[i] != group[j]:
                        shared = len(tokens[i] & tokens[j])
                        if shared * (100 + percent) >= percent * (sizes[i] + sizes[j]):
                            out.append((names[i], names[j], shared, sizes[i], sizes[j]))
                            group[group == group[j]] = group[i]
        return out

    def connect(rows: pd.DataFrame) -> pd.DataFrame:
        found = [link for _, block in rows.groupby(["slot", "least", "block"], sort=False) for link in links(block)]
        return pd.DataFrame(found, columns=["a", "b", "shared", "na", "nb"])

    # most blocks are a few sets: many of them make one call
    calls = 1 + (near.agg(F.sum("n")).first()[0] or 0) // BLOCK_TOKENS
    call = F.pmod(F.xxhash64("slot", "least", "block"), F.lit(calls)).alias("call")
    found = near.join(sets, "node").groupBy(call).applyInPandas(connect, "a long, b long, shared long, na long, nb long")
    return hold(found, "family-links").read()


def similar_components(docs: DataFrame, width: int = 5, percent: int = 80, slots: int = SLOTS) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of (doc_id, text)."""
    hold = Scratch()
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketch = hold(docs.mapInArrow(_sketches(width), "doc_id long, n long, node long, mins array<long>, segment int, counts binary"), "sketch").read()
    rows = sketch.where("n >= 0").select("doc_id", "n", "node")
    nodes = hold(sketch.where("n > 0").groupBy("node").agg(
        F.min("doc_id").alias("rep"), F.min("n").alias("n"), F.min("mins").alias("mins")), "nodes").read()
    reps = nodes.select("node", "rep")

    # 1. families
    test = _links(percent, F.col("shared"), F.col("na"), F.col("nb"))
    family = _families(docs, width, percent, nodes, reps, slots, hold)
    labels = hold(components(family.select("a", "b"), hold=hold), "labels").read()

    # 2. index
    frequent = _frequent(sketch)
    several = _postings(docs, width, percent, frequent, None).groupBy("token").agg(
        F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi").select("token")
    known = bitmap(hold(several, "several").read(), "token")
    hits = _postings(docs, width, percent, frequent, known).distinct().join(labels, "node", "left").select(
        "token", "node", "n", "pos", F.coalesce("label", "node").alias("label"))
    hits = hold(hits, "postings").read()
    mixed = hold(hits.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("token"), "mixed").read()
    entries = hold(hits.join(mixed, "token", "left_semi"), "entries").read()
    pairs = hold(_candidates(entries, percent, hold), "candidates").read()
    pairs = hold(_may_link(pairs, entries, percent, hold), "may-link").read()

    # 3. answers from answers
    both = family.unionByName(family.selectExpr("b as a", "a as b", "shared", "nb as na", "na as nb"))
    leader = both.groupBy(F.col("a").alias("x")).agg(
        F.max(F.struct("shared", F.col("b").alias("leader"), F.col("nb").alias("size"), F.col("na").alias("n"))).alias("s")).select("x", "s.*")
    leader = hold(leader, "leaders").read()
    hung = pairs.join(leader.withColumnRenamed("x", "a"), "a", "left").where(F.col("leader").isNull() | (F.col("leader") != F.col("b")))
    hung = hold(hung.select("a", "b", "leader", "size", F.col("shared").alias("held"), "n"), "hung").read()
    asked = hung.where("leader is not null").select(F.col("leader").alias("a"), "b").distinct()
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).unionByName(asked.select(F.col("a").alias("node"))).distinct()
    sets = _set_table(docs, width, hold(ends, "ends").read(), reps, hold)
    to_leader = _shared(hold(asked, "asked").read(), sets, hold)
    told = hung.join(to_leader.select(F.col("a").alias("leader"), "b", F.col("shared").alias("known"), F.col("nb").alias("size_b")), ["leader", "b"], "left")
    low, high = F.col("known") + F.col("held") - F.col("size"), F.col("known") + F.col("n") - F.col("held")
    yes = _links(percent, low, F.col("n"), F.col("size_b"))
    no = ~_links(percent, high, F.col("n"), F.col("size_b"))
    told = hold(told.select("a", "b", F.coalesce(yes, F.lit(False)).alias("yes"), F.coalesce(no, F.lit(False)).alias("no")), "told").read()
    direct = pairs.join(leader.select(F.col("x").alias("a"), F.col("leader").alias("b")), ["a", "b"], "left_semi")
    rest = hold(told.where("not yes and not no").select("a", "b"), "rest").read()
    links = [family.select("a", "b"), to_leader.where(test).select("a", "b"), told.where("yes").select("a", "b"),
             direct.select("a", "b"), _shared(rest, sets, hold).where(test).select("a", "b")]
    every = links[0]
    for more in links[1:]:
        every = every.unionByName(more)
    final = hold(components(every, hold=hold), "components").read()

    placed = hold(rows.join(final, "node", "left").select("doc_id", "n", F.coalesce("label", "node").alias("label")), "placed")
    named = placed.read().where("n > 0").groupBy("label").agg(F.min("doc_id").alias("component_id"))
    names = hold(named, "names")
    hold.release(placed, names)
    left, right = placed.read(), names.read()
    return left.join(right, (left["label"] == right["label"]) & (left["n"] > 0), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
