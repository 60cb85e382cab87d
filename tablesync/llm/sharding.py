"""A uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

1. The rows are staged with a running id, which cuts them into blocks of at most ``block_rows`` rows.
2. How many rows each block sends to each shard is one row of a matrix with fixed margins. Under a
   uniform permutation it is multivariate hypergeometric, so it is drawn: a binary tree over the
   blocks splits the shards' capacities between its two halves at every node, level by level.
3. Every block is permuted (rows ranked by a hash of seed and id), the ranks are cut at the block's
   row of the matrix, and the rows go to their shards.
4. Every shard is permuted again: rows fall into cells by a second hash, cells are counted, and the
   slot is the cell's start plus the rank inside the cell, so no task sorts a whole shard.

Everything is a DataFrame plan. Draws hash (seed, block, level, shard), so a lost task repeats its draw.
The matrix needs one row per block; only its root (a block id and a count per ``block_rows`` rows) is one row.

Nulls, empty texts, ties and repeated rows are rows like any other: equal rows have ids of their own.
An empty table gives an empty result. An input column named like an output column is replaced.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablesync.sources.staging import stage

__all__ = ["communication_matrix", "shuffle_into_shards"]

REACH = 9.0  # standard deviations around the mode that a draw covers: all that 53 random bits can reach


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluate once, use often."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _uniform(*parts: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(1 << 53))


def _steps(first: Column, last: Column, down: bool = False) -> Column:
    """first..last, or first..last downwards; empty where there is none."""
    some = first >= last if down else first <= last
    step = F.lit(-1 if down else 1).cast("long")
    return F.when(some, F.sequence(first, last, step)).otherwise(F.array().cast("array<bigint>"))


def hypergeometric(total: Column, good: Column, sample: Column, u: Column) -> Column:
    """How many of ``sample`` draws without replacement are good, by inversion of ``u`` outwards from the mode."""
    t, g, n = (c.cast("double") for c in (total, good, sample))
    lo, hi = F.greatest(F.lit(0).cast("long"), sample - total + good), F.least(good, sample)
    mode = F.least(hi, F.greatest(lo, F.floor((n + 1) * (g + 1) / (t + 2)).cast("long")))
    spread = F.sqrt(n * g * (t - g) * F.greatest(t - n, F.lit(0.0)) / F.greatest(t * t * F.greatest(t - 1, F.lit(1.0)), F.lit(1.0)))
    reach = F.ceil(F.lit(REACH) * spread).cast("long") + 16

    def walk(v: Column) -> Column:
        top, low = F.least(v.hi, v.mode + v.reach), F.greatest(v.lo, v.mode - v.reach)
        ups, downs = _steps(v.mode, top - 1), _steps(v.mode, low + 1, down=True)

        def up(w: Column, k: Column) -> Column:
            x = k.cast("double")
            return w * (v.g - x) * (v.n - x) / ((x + 1) * (v.t - v.g - v.n + x + 1))

        def down(w: Column, k: Column) -> Column:
            x = k.cast("double")
            return w * x * (v.t - v.g - v.n + x) / ((v.g - x + 1) * (v.n - x + 1))

        def mass(steps: Column, ratio: Callable, start: float) -> Column:
            zero = F.struct(F.lit(1.0).alias("w"), F.lit(start).alias("sum"))
            return F.aggregate(steps, zero, lambda a, k: _let(
                ratio(a.w, k), lambda w: F.struct(w.alias("w"), (a.sum + w).alias("sum"))))["sum"]

        def pick(steps: Column, ratio: Callable, start: float, goal: Column, at: Column, move: int) -> Column:
            zero = F.struct(F.lit(1.0).alias("w"), F.lit(start).alias("sum"), at.alias("at"))
            return F.aggregate(steps, zero, lambda a, k: _let(ratio(a.w, k), lambda w: F.struct(
                w.alias("w"), (a.sum + w).alias("sum"),
                F.coalesce(a.at, F.when(goal < a.sum + w, k + F.lit(move).cast("long"))).alias("at"))))["at"]

        none = F.lit(None).cast("long")
        return _let(
            F.struct(mass(ups, up, 1.0).alias("up"), mass(downs, down, 0.0).alias("down")),
            lambda m: _let(v.u * (m.up + m.down), lambda goal: F.coalesce(
                F.when(goal < m.up, pick(ups, up, 1.0, goal, F.when(goal < 1.0, v.mode), 1)),
                pick(downs, down, 0.0, goal - m.up, none, -1), low)))

    return F.when(lo == hi, lo).otherwise(_let(
        F.struct(t.alias("t"), g.alias("g"), n.alias("n"), u.alias("u"), lo.alias("lo"), hi.alias("hi"),
                 mode.alias("mode"), reach.alias("reach")), walk))


def _split(caps: Column, sample: Column, seed: int, level: int, node: Column) -> Column:
    """The share of each shard's capacity that falls to the left half, drawn shard by shard."""
    whole = F.aggregate(caps, F.lit(0).cast("long"), lambda a, c: a + c)
    zero = F.struct(whole.alias("total"), sample.alias("sample"), F.array().cast("array<bigint>").alias("out"))
    return F.aggregate(caps, zero, lambda a, cap: _let(
        hypergeometric(a.total, cap, a.sample, _uniform(F.lit(seed), F.lit(level), node, F.size(a.out))),
        lambda x: F.struct((a.total - cap).alias("total"), (a.sample - x).alias("sample"),
                           F.concat(a.out, F.array(x)).alias("out"))))["out"]


def communication_matrix(blocks: DataFrame, capacities: list[int], seed: int) -> DataFrame:
    """(block, n) to (block, sends): rows each block sends to each shard, with exact margins."""
    count = blocks.count()
    nodes = blocks.agg(F.array_sort(F.collect_list(F.struct("block", "n"))).alias("blocks")).select(
        "blocks", F.array(*[F.lit(c).cast("long") for c in capacities]).alias("caps"))
    for level in range((count - 1).bit_length() if count > 1 else 0):
        size = F.size("blocks")
        half = F.ceil(size / 2).cast("int")
        cut = nodes.select(F.slice("blocks", F.lit(1), half).alias("l"), F.slice("blocks", half + 1, size - half).alias("r"), "caps")
        n_left = F.aggregate("l", F.lit(0).cast("long"), lambda a, b: a + b.n)
        drawn = cut.withColumn("x", _split(F.col("caps"), n_left, seed, level, F.col("l")[0]["block"]))
        rest = F.zip_with("caps", "x", lambda c, x: c - x)
        nodes = drawn.select(F.explode(F.array(
            F.struct(F.col("l").alias("blocks"), F.col("x").alias("caps")),
            F.struct(F.col("r").alias("blocks"), rest.alias("caps")))).alias("node")).select("node.*").where(F.size("blocks") > 0)
        if level == 5:  # enough subtrees to go on in parallel
            nodes = nodes.repartition(min(1024, 1 + count // 64), F.col("blocks")[0]["block"])
    return nodes.where(F.size("blocks") > 0).select(F.col("blocks")[0]["block"].alias("block"), F.col("caps").alias("sends"))


def shuffle_into_shards(
    df: DataFrame, shards: int = 24, seed: int = 0, block_rows: int = 1 << 15, cell_rows: int = 1 << 13,
) -> DataFrame:
    """All rows with ``shard`` (sizes at most one apart) and ``slot`` (gapless from 0), a uniform permutation of the rows."""
    if block_rows & (block_rows - 1):
        raise ValueError("block_rows must be a power of two")
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")
    rows = stage(df.select(row, F.monotonically_increasing_id().alias("id")), "shard-rows")
    block = F.shiftright("id", block_rows.bit_length() - 1).alias("block")

    tagged = rows.read().select("row", "id", block)
    counts = tagged.groupBy("block").agg(F.count(F.lit(1)).alias("n"))
    capacities = [rows.rows // shards + (s < rows.rows % shards) for s in range(shards)]
    matrix = communication_matrix(counts, capacities, seed)

    inside = Window.partitionBy("block").orderBy(F.xxhash64(F.lit(seed), F.lit("block"), F.col("id")), "id")
    ranked = tagged.withColumn("rank", F.row_number().over(inside) - 1)
    ends = F.transform("sends", lambda x, i: F.aggregate(F.slice("sends", F.lit(1), i + 1), F.lit(0).cast("long"), lambda a, c: a + c))
    matrix = matrix.select(F.col("block"), ends.alias("ends"))
    sent = ranked.join(matrix, "block").select(
        "row", "id", F.size(F.filter("ends", lambda e: e <= F.col("rank"))).alias("shard"))
    dealt = stage(sent, "shard-dealt")
    rows.release()

    cells = max(1, -(-rows.rows // (shards * cell_rows)))
    key = F.xxhash64(F.lit(seed), F.lit("shard"), F.col("id"))
    placed = dealt.read().withColumn("key", key).withColumn("cell", F.pmod("key", F.lit(cells)).cast("int"))
    sizes = placed.groupBy("shard", "cell").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    rank = F.row_number().over(Window.partitionBy("shard", "cell").orderBy("key", "id")) - 1
    kept = [F.col("row")[c].alias(c) for c in df.columns if c.lower() not in ("shard", "slot")]
    return placed.withColumn("rank", rank).join(starts, ["shard", "cell"]).select(
        *kept, "shard", (F.col("start") + F.col("rank")).cast("long").alias("slot"))
