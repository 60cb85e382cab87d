"""A Merkle manifest of a dataset: one hash tree per group over its rows in order, one over the groups' roots.

Rows are numbered inside their group without a task per group: they are range-partitioned, numbered by their place in the sorted
partition, and shifted by what earlier partitions hold of the group. A pass then takes ``3 ** levels`` neighbours as a
block: rows are sorted once by (group, block, place), and for each level a lag and lead by ``3 ** level`` rows, masked by the
node's slot and the length of its run, give a node's siblings; the row of a run's first child hashes the parent. What
stands at the head of each block is a node of the next pass, so a pass holds a block at a time whatever the size of a group, and
the number of passes grows with the logarithm of the largest group.

Results for odd input: a NULL group is a group of its own and the first one; NULL keys come first; rows of equal key are ordered by
their digest, so equal rows change places without any effect; a group of one row has that row as its root and no siblings; an empty
table has no rows and no root. Texts of any length are hashed whole. All columns travel inside one struct, so none can clash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import Scratch

__all__ = ["FANOUT", "build", "folded", "leaf", "proof_text"]

FANOUT = 3
LEVELS = 7  # of one pass: a block has 3 ** 7 rows


def leaf(columns: Sequence[Column]) -> Column:
    """Hex SHA-256 of the values side by side, each as its length in bytes, a colon and its text; ``-`` for NULL."""
    def told(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(told, columns)), 256)


def folded(digest: Column, path: Column) -> Column:
    """The root that a row's digest leads to by its path."""
    return F.aggregate(path, digest, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def proof_text(path: Column) -> Column:
    """The siblings of a path side by side, level by level, left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


def _numbered(rows: DataFrame, hold: Scratch) -> DataFrame:
    """(tree, key, digest, row) with ``pos``, the place in its tree from 0, and ``n``, the rows of the tree."""
    order = ["tree", "key", "digest", "tie"]
    # the tie tells equal rows apart, so that many of one key still spread over the ranges
    laid = rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    laid = hold(laid.drop("tie").withColumn("at", F.monotonically_increasing_id()), "ordered").read()
    laid = laid.withColumn("part", F.shiftright("at", 33))
    parts = laid.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("held"))
    tree = Window.partitionBy("tree")  # a row per range the tree lies in
    parts = parts.select(
        "tree", "part", (F.sum("held").over(tree.orderBy("part")) - F.col("held") - F.col("first")).alias("shift"),
        F.sum("held").over(tree).alias("n"))
    parts = hold(parts, "parts").read()
    return laid.join(parts, ["tree", "part"]).select("tree", "digest", "row", (F.col("at") + F.col("shift")).alias("pos"), "n")


def _levels(nodes: DataFrame, levels: int) -> DataFrame:
    """One pass: ``block``, ``top`` (the block's digest, on its first row) and ``path`` (the siblings inside the block)."""
    def div(a: Column, by: int) -> Column:
        return F.floor(a / F.lit(by)) if by > 1 else a  # places are far below 2 ** 53

    pos, n = F.col("pos"), F.col("n")
    here = Window.partitionBy("tree", "block").orderBy("pos")
    frame = nodes.withColumns({"block": div(pos, FANOUT ** levels), "top": F.col("digest")})
    steps = []
    for level in range(levels):
        step = FANOUT ** level
        frame = frame.withColumns({
            f"{side}{k}": move("top", k * step).over(here) for side, move in (("lag", F.lag), ("lead", F.lead)) for k in (1, 2)})
        place, nodes_here = div(pos, step), F.ceil(n / F.lit(step)) if step > 1 else n
        slot = place % FANOUT
        run = F.least(F.lit(FANOUT), nodes_here - place + slot)  # nodes of the run this one is in
        is_node, alive = pos % step == 0, nodes_here > 1

        def beside(side: str, k: int, there: Column) -> Column:
            return F.when(there, F.col(f"{side}{k}")).otherwise("")

        left = F.concat(beside("lag", 2, slot > 1), beside("lag", 1, slot > 0))
        right = F.concat(beside("lead", 1, slot + 1 < run), beside("lead", 2, slot + 2 < run))
        steps.append(f"step{level}")
        frame = frame.withColumn(steps[-1], F.when(is_node & alive, F.struct(left.alias("left"), right.alias("right"))))
        parent = F.sha2(F.concat(F.col("top"), F.col(f"{steps[-1]}.right")), 256)
        first_child = pos % (step * FANOUT) == 0
        frame = frame.withColumn("top", F.when(first_child, F.when(alive, parent).otherwise(F.col("top")))).drop(
            *[f"{side}{k}" for side in ("lag", "lead") for k in (1, 2)])
    # a node's row comes before all rows under it
    upto = here.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    frame = frame.withColumns({s: F.last(s, ignorenulls=True).over(upto) for s in steps})
    return frame.withColumn("path", F.filter(F.array(*steps), lambda s: s.isNotNull())).drop(*steps)


def _climb(nodes: DataFrame, hold: Scratch, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """The passes from the rows to one node a tree, and those nodes: (tree, block, digest)."""
    passes = []
    while True:
        frame = _levels(nodes, levels)
        passes.append(frame)
        heads = frame.where(F.col("pos") % FANOUT ** levels == 0)
        nodes = hold(heads.select(
            "tree", F.col("block").alias("pos"), F.ceil(F.col("n") / F.lit(FANOUT ** levels)).alias("n"), F.col("top").alias("digest")), "nodes").read()
        if (nodes.agg(F.max("n")).first()[0] or 0) <= 1:
            return passes, nodes.select("tree", F.col("pos").alias("block"), "digest")


def _descend(passes: list[DataFrame], above: DataFrame, hold: Scratch) -> DataFrame:
    """The first pass's rows, each with what ``above`` (tree, block, path and more) says of its root, ``path`` led up to there."""
    more = [c for c in above.columns if c not in ("tree", "block", "path")]
    for frame in reversed(passes):
        found = frame.join(above.withColumnRenamed("path", "above"), ["tree", "block"]).withColumn("path", F.concat("path", "above"))
        if frame is passes[0]:
            return found.select("row", "digest", "path", *more)
        above = hold(found.select("tree", F.col("pos").alias("block"), "path", *more), "above").read()


def build(rows: DataFrame, group: Column, key: Column, digest: Column, levels: int = LEVELS) -> DataFrame:
    """(row, digest, subroot, root, path) of every row; ``row`` is a struct of the columns given.

    ``digest`` is the hex digest of a row, ``group`` its tree, ``key`` its order there. Groups are ordered by their UTF-8 bytes, NULL
    first, and their roots are the leaves of the tree whose root is ``root``. ``path`` lists for each level up to it the digests of the
    siblings before (``left``) and after (``right``) the node. The result reads the numbered rows and the paths above blocks, which stay.
    """
    hold, upper = Scratch(), Scratch()
    packed = rows.select(
        F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit("")).alias("tree"), key.alias("key"), digest.alias("digest"),
        F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"))
    packed = upper(packed, "leaves").read()  # the ranges are sampled before they are cut: rows are hashed once
    passes, subroots = _climb(_numbered(packed, hold), upper, levels)
    groups = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("key"), "digest", F.struct("tree").alias("row"))
    over, top = _climb(_numbered(groups, upper), upper, levels)
    nothing = F.array().cast(passes[0].schema["path"].dataType)
    over = _descend(over, top.select("tree", "block", F.col("digest").alias("root"), nothing.alias("path")), upper)
    above = hold(over.select("row.tree", F.lit(0).cast("long").alias("block"), F.col("digest").alias("subroot"), "root", "path"), "above").read()
    result = _descend(passes, above, hold)
    upper.release()
    return result
