"""Exact top-k by inner product with Fagin's threshold algorithm over sorted per-dimension lists.

Rows are dealt into blocks of about ``block_rows``. A block keeps, for every dimension, its rows sorted by that
component. A query reads the lists of its non-zero components in step, each from its good end (sorted access), scores
every row it meets in full (random access), and stops when the threshold, the score of a row that had
the last read value everywhere, is under the kth score so far: no unread row can then enter. Reading doubles
from step to step; once it has met half of a block, the unread rest is scored without further sorted access.

Queries meet rows in a grid of bounded cells (a block of rows, a block of queries), and the k best of each cell are merged.

Defined results: vectors that are NULL or hold a NULL or non-finite component, and rows without id, take no part. Rows
equal in id and vector count once. A shorter vector has zeros at its end. Ties go to the smaller id. A score
beyond 64 bits is given as the nearest that they hold. Further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablesync.sources.staging import stage

__all__ = ["scaled", "threshold_top_k", "top_k"]


def scaled(vector: Column, factor: int = 256) -> Column:
    """Whole numbers floor(factor * x); NULL for a vector that takes no part."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~bad, F.transform(vector, lambda x: F.floor(x.cast("double") * factor).cast("long")))


def _matrix(vectors: pd.Series, width: int, kind: type) -> np.ndarray:
    out = np.zeros((len(vectors), width), dtype=kind)
    for row, v in zip(out, vectors):
        row[: len(v)] = v
    return out


def threshold_top_k(
    ids: np.ndarray, rows: np.ndarray, lists: np.ndarray, query: np.ndarray, own: int, k: int, start: int = 4,
) -> list[tuple[int, int]]:
    """(id, score) of the best ``k`` rows but ``own``. ``lists[d]`` has row numbers by rising component d; ids rise."""
    n = len(ids)
    up, down = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
    seen = np.zeros(n, dtype=bool)
    seen[np.searchsorted(ids, own):np.searchsorted(ids, own, "right")] = True
    best_score, best_row = np.empty(0, rows.dtype), np.empty(0, np.int64)
    depth, step = 0, start
    while True:
        last = min(n, depth + step)
        met = np.concatenate([lists[up, n - last:n - depth].ravel(), lists[down, depth:last].ravel()])
        rest = last == n or not len(met) or 2 * (np.count_nonzero(seen) + len(met)) >= n
        if rest:
            fresh = np.flatnonzero(~seen)
        else:
            fresh = np.unique(met[~seen[met]])
            seen[fresh] = True
        score = np.concatenate([best_score, rows[fresh] @ query])
        row = np.concatenate([best_row, fresh])
        if len(score) > k:
            least = np.partition(score, len(score) - k)[len(score) - k] if score.dtype != object else sorted(score)[-k]
            near = score >= least
            score, row = score[near], row[near]
        order = sorted(range(len(score)), key=lambda i: (-score[i], row[i]))[:k]
        best_score, best_row = score[order], row[order]
        if rest:
            break
        bound = (rows[lists[up, n - last], up] @ query[up]) + (rows[lists[down, last - 1], down] @ query[down])
        if len(best_score) == k and best_score[-1] > bound:
            break
        depth, step = last, 2 * step
    return [(int(ids[r]), int(s)) for s, r in zip(best_score, best_row)]


def top_k(
    rows: DataFrame, queries: DataFrame, k: int = 5, block_rows: int = 8192, block_queries: int = 1024,
) -> DataFrame:
    """(query_id, rank, vec_id, score) from (vec_id, vector) frames of whole-number vectors."""
    def kept(df: DataFrame, label: str):
        return stage(df.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull())
                     .select(F.col("vec_id").cast("long"), "vector").distinct(), label)

    base, asked = kept(rows, "topk-rows"), kept(queries, "topk-queries")
    parts, chunks = max(1, -(-base.rows // block_rows)), max(1, -(-asked.rows // block_queries))

    def grid(df: DataFrame, own: str, of: int, other: str, others: int) -> DataFrame:
        mine = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(of)).cast("int").alias(own)
        return df.select("*", mine, F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(other))

    left = grid(base.read(), "part", parts, "chunk", chunks).groupBy("part", "chunk")
    right = grid(asked.read(), "chunk", chunks, "part", parts).groupBy("part", "chunk")

    def search(have: pd.DataFrame, want: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(have) and len(want):
            have = have.sort_values("vec_id", kind="stable")
            width = max(have["vector"].map(len).max(), want["vector"].map(len).max(), 1)
            ids = have["vec_id"].to_numpy(np.int64)
            exact, asked_for = _matrix(have["vector"], width, np.int64), _matrix(want["vector"], width, np.int64)
            peak = float(np.abs(exact.astype(float)).max()) * float(np.abs(asked_for.astype(float)).max()) * width
            kind = np.float64 if peak < 2.0 ** 52 else object  # whole numbers are exact in either
            table, wanted = exact.astype(kind), asked_for.astype(kind)
            lists = np.argsort(exact, axis=0, kind="stable").T.copy()
            for query_id, query in zip(want["vec_id"].to_numpy(np.int64), wanted):
                out += [(query_id, i, min(max(s, -2**63), 2**63 - 1)) for i, s in threshold_top_k(ids, table, lists, query, query_id, k)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    found = left.cogroup(right).applyInPandas(search, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
