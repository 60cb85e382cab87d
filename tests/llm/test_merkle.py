import hashlib

import pytest
from pyspark.sql import functions as F

from tablesync.llm import merkle


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_leaf(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def brute_tree(digests):
    """The root, and for each leaf the (left, right) siblings from the bottom up."""
    paths, at, level = [[] for _ in digests], list(range(len(digests))), list(digests)
    while len(level) > 1:
        runs = [level[i:i + 3] for i in range(0, len(level), 3)]
        for leaf, place in enumerate(at):
            run, slot = runs[place // 3], place % 3
            paths[leaf].append(("".join(run[:slot]), "".join(run[slot + 1:])))
        level, at = [sha("".join(run)) for run in runs], [place // 3 for place in at]
    return level[0], paths


def brute(rows):
    """(key, group, digest) rows to (key, digest) -> what build gives."""
    groups = {}
    for key, group, digest in rows:
        groups.setdefault(group, []).append((key is not None, key, digest))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    subroots, below = [], {}
    for name in names:
        held = sorted(groups[name], key=lambda r: (r[0], r[1] or 0, r[2]))
        root, paths = brute_tree([d for _, _, d in held])
        subroots.append(root)
        below[name] = [(k, d, p) for (_, k, d), p in zip(held, paths)]
    root, over = brute_tree(subroots)
    return sorted(
        (str(k), d, subroots[i], root, tuple(p + over[i])) for i, name in enumerate(names) for k, d, p in below[name])


def got(built):
    return sorted((str(r["row"]["id"]), r["digest"], r["subroot"], r["root"], tuple((s["left"], s["right"]) for s in r["path"])) for r in built.collect())


@pytest.mark.parametrize("levels", [1, 2, 7])
def test_trees_of_any_size_in_any_number_of_passes(spark, levels):
    rows, key = [], 0
    for group, n in ((None, 1), ("", 2), ("a", 3), ("é", 4), ("b", 10), ("hot", 100), ("B", 28)):
        for _ in range(n):
            key += 7
            rows.append((key % 149, group, sha(str(key))))
    df = spark.createDataFrame(rows, "id long, `group` string, d string").repartition(5)
    assert got(merkle.build(df, F.col("group"), F.col("id"), F.col("d"), levels)) == brute(rows)


def test_ties_repeated_rows_nulls_and_clashing_names(spark):
    rows = [(None, "x", sha("1")), (None, "x", sha("2")), (3, "x", sha("3")), (3, "x", sha("3")), (3, "x", sha("0")), (9, None, sha("9"))] + [(5, "h", sha("5"))] * 50
    df = spark.createDataFrame(rows, "id long, tree string, digest string").withColumns(
        {"pos": F.lit("p"), "row": F.lit(1), "path": F.lit("q"), "block": F.lit(None), "n": F.lit(2), "at": F.lit(0)})
    built = merkle.build(df, F.col("tree"), F.col("id"), F.col("digest"), 2)
    assert got(built) == brute(rows)
    assert set(built.schema["row"].dataType.names) == set(df.columns)


def test_empty_table(spark):
    df = spark.createDataFrame([], "id long, g string, d string")
    assert merkle.build(df, F.col("g"), F.col("id"), F.col("d")).collect() == []


def test_one_row(spark):
    df = spark.createDataFrame([(1, "g", sha("x"))], "id long, g string, d string")
    r = merkle.build(df, F.col("g"), F.col("id"), F.col("d")).first()
    assert (r["subroot"], r["root"], r["path"]) == (sha("x"), sha("x"), [])


def test_leaf_tells_null_empty_and_split_apart(spark):
    values = [(None, "a"), ("", "a"), ("1:a", None), ("é" * 70000, "b"), ("-", "-"), ("x\ny", "z")]
    df = spark.createDataFrame(values, "a string, b string")
    found = [r[0] for r in df.select(merkle.leaf([F.col("a"), F.col("b")])).collect()]
    assert found == [brute_leaf(v) for v in values] and len(set(found)) == len(values)


def test_a_changed_row_is_found_and_no_other(spark):
    df = spark.range(40).select("id", (F.col("id") % 3).cast("string").alias("g"), F.sha2(F.col("id").cast("string"), 256).alias("d"))
    df = df.withColumn("now", F.when(F.col("id") == 17, F.sha2(F.lit("changed"), 256)).otherwise(F.col("d")))
    built = merkle.build(df, F.col("g"), F.col("id"), F.col("d"), 1)
    wrong = built.where(merkle.folded(F.col("row.now"), F.col("path")) != F.col("root"))
    assert [r["row"]["id"] for r in wrong.collect()] == [17]
