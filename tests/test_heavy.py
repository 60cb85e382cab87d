"""Heavy keys and the joins that salt them."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tablesync.operators import heavy, joins
from tablesync.sources.staging import stage


def skewed(spark, n=60_000):
    """A third of all rows on one key, a twentieth on another, some without a key."""
    return spark.range(0, n, 1, 8).selectExpr(
        "id", "case when id % 3 = 0 then -1 when id % 20 = 1 then -2 when id % 50 = 2 then null else id % 7919 end as k")


@pytest.mark.parametrize("share", [0.3, 0.04, 0.001, 0.0002])
def test_every_key_above_the_share_is_found_with_its_count(spark, share):
    df = skewed(spark)
    counts = Counter(r.k for r in df.collect())
    want = {k: n for k, n in counts.items() if k is not None and n >= share * 60_000}
    assert {r.k: r.rows for r in heavy.heavy_keys(df, ["k"], share).collect()} == want
    two = df.selectExpr("id", "k as a", "cast(k % 2 as string) as b")
    assert {r.a: r.rows for r in heavy.heavy_keys(two, ["a", "b"], share).collect()} == want


def test_counts_of_a_small_summary_are_within_its_bound(spark):
    """No key above the bound is missed, none is listed that does not occur, and none is counted too low."""
    df, tracked = skewed(spark), 256
    counts = Counter(str(r.k) for r in df.collect() if r.k is not None)
    watched, found = heavy.observe_keys(df, ["k"], tracked)
    stage(watched, "watched").release()
    got = dict(found(1))
    least = 7 / tracked * 60_000
    assert {k for k, n in counts.items() if n >= least} <= set(got) <= set(counts)
    assert all(counts[k] <= n <= counts[k] + 3.5 / tracked * 60_000 for k, n in got.items())


def test_heavy_keys_defined_results(spark):
    df = spark.createDataFrame([(None, "a"), (None, "a"), (1, "a"), (1, None)], "k int, rows string")
    assert [tuple(r) for r in heavy.heavy_keys(df, ["k"], 0.5).collect()] == [(1, 2)]
    assert heavy.heavy_keys(df.limit(0), ["k"], 0.5).collect() == []
    with pytest.raises(ValueError):
        heavy.heavy_keys(df, ["k"], 0)
    with pytest.raises(TypeError):
        heavy.heavy_keys(df.selectExpr("cast(k as double) as k"), ["k"], 0.5)


def test_hot_keys_are_dealt_over_salts_in_one_pass(spark, settings, tmp_path):
    settings(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
             spark__sql__adaptive__enabled="false", spark__sql__shuffle__partitions="8")
    many = skewed(spark)
    base = spark.range(-3, 8000).selectExpr("id as uuid").unionAll(spark.range(3).selectExpr("cast(null as bigint)"))
    held = []

    def staging(df, label):
        held.append(label)
        return stage(df, label).read()

    got = joins.fan_out(base, many, {"uuid": "k"}, {"v": "id"}, staging, hot_rows=2_000)
    assert held == ["base", "right"]
    want = base.join(many.selectExpr("k", "id as v"), F.col("uuid") == F.col("k"), "left").drop("k")
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0 and got.columns == ["uuid", "v"]
    # every output partition stays near what a task should get, where the plain join has a third of all in one
    largest = lambda df: df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert largest(want) > 20_000 and largest(got) < 14_000


def test_salting_keeps_unmatched_rows_and_repeats(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    base = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), ("c", 3), (None, 4)], "k string, n int")
    right = spark.createDataFrame([("a", i % 2) for i in range(9)] + [("b", 7), ("d", 8), (None, 9)], "key string, v int")
    for hot_rows in (1, 2, 4, 100):
        got = joins.staged_fan_out(base, right, {"k": "key"}, {"v": "v"}, lambda df, label: stage(df, label).read(), hot_rows)
        want = [("a", 1, i % 2) for i in range(9)] * 2 + [("b", 2, 7), ("c", 3, None), (None, 4, None)]
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    empty = joins.staged_fan_out(base, right.limit(0), {"k": "key"}, {"v": "v"}, lambda df, label: stage(df, label).read(), 1)
    assert empty.count() == 5 and empty.where("v is not null").count() == 0
