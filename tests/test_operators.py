from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tablesync.sources.staging import stage
from tablesync.operators import aggregates, columns, joins, keys, replace
from tablesync.operators.window import Window, change_window, changed_groups, contiguous_window, daily_window

RUN = datetime(2024, 1, 6, 2, 0, 0, 500)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- windows -----------------------------------------------------------------------


def test_daily_window():
    assert daily_window(RUN) == Window(datetime(2024, 1, 5), datetime(2024, 1, 6, 2))
    assert daily_window(datetime(2024, 3, 1, 0, 0)).lower == datetime(2024, 2, 29)


def test_window_edges(spark):
    texts = ["2024-01-04 23:59:59.999999", "2024-01-05 00:00:00", "2024-01-06 01:59:59.999999", "2024-01-06 02:00:00", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("u", F.col("t").cast("timestamp_ntz"))
    assert [r.t for r in change_window(df, "u", RUN).collect()] == texts[1:3]


def test_window_is_pushed_to_the_scan(spark):
    df = change_window(spark.read.parquet("/root/testdata/sf0.001/events.parquet"), "ts", RUN).select("event_id")
    text = plan(df)
    assert "GreaterThanOrEqual(ts,2024-01-05T00:00)" in text and "LessThan(ts,2024-01-06T02:00)" in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in text


def test_consecutive_windows_touch():
    a = contiguous_window(datetime(2024, 1, 5), datetime(2024, 1, 6, 19))
    b = contiguous_window(a.upper, datetime(2024, 1, 7, 19))
    assert a.upper == b.lower
    with pytest.raises(ValueError):
        contiguous_window(b.upper, a.upper)


def test_window_slices_cover():
    parts = daily_window(RUN).slices(7)
    assert parts[0].lower == datetime(2024, 1, 5) and parts[-1].upper == datetime(2024, 1, 6, 2)
    assert all(a.upper == b.lower for a, b in zip(parts, parts[1:]))


def test_changed_groups(spark):
    df = spark.sql("""select * from values ('a', timestamp_ntz '2020-01-01 00:00:00'), ('a', timestamp_ntz '2024-01-05 05:00:00'),
        ('b', timestamp_ntz '2020-01-01 00:00:00'), (null, timestamp_ntz '2024-01-05 06:00:00') as t(g, u)""")
    assert [r.g for r in changed_groups(df, "u", RUN, "g").collect()] == ["a", "a"]


# --- projections -------------------------------------------------------------------


def test_non_zero_needs_all(spark):
    df = spark.createDataFrame([(1, 1), (0, 1), (1, None), (2, -1)], "a int, b int")
    assert rows(columns.all_non_zero(df, ["a", "b"])) == [(1, 1), (2, -1)]


def test_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "uuid int, meta_id int, z int")
    assert columns.rename(df, {"uuid": "id", "nope": "x"}).columns == ["id", "meta_id", "z"]
    swapped = columns.rename_swap(df, {"uuid": "meta_id", "meta_id": "uuid"})
    assert swapped.columns == ["meta_id", "uuid", "z"] and swapped.first()["uuid"] == 2
    two_steps = columns.rename_swap(columns.rename_swap(df, {"uuid": "item", "meta_id": "uuid"}), {"uuid": "plan_id", "item": "uuid"})
    assert two_steps.first().asDict() == {"uuid": 1, "plan_id": 2, "z": 3}
    assert columns.drop_and_sort_columns(df.withColumnRenamed("z", "Z"), ["meta_id"]).columns == ["Z", "uuid"]


def test_shift_moves_columns(spark):
    df = spark.sql("select timestamp_ntz '2024-01-01 00:00:00' a, 1 b, timestamp_ntz '2024-01-01 20:00:00' c")
    assert columns.shift_and_replace(df, ["a", "c"], 7).columns == ["b", "a", "c"]
    stay = columns.shift_and_replace(df, ["a", "c"], 7, move_to_end=False)
    assert tuple(stay.first()) == (datetime(2024, 1, 1, 7), 1, datetime(2024, 1, 2, 3))


# --- joins -------------------------------------------------------------------------


@pytest.fixture(params=["broadcast", "shuffle"])
def strategy(request, settings):
    if request.param == "shuffle":
        settings(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    return request.param


def test_lookup(spark, strategy):
    base = spark.createDataFrame([(1, "a"), (2, None), (3, "zz"), (4, "a")], "id int, k string")
    look = spark.createDataFrame([("a", "A", 1), ("b", "B", 2), (None, "N", 3)], "uuid string, name string, v int")
    got = joins.lookup(base, look, {"k": "uuid"}, {"k_name": "name"})
    assert got.columns == ["id", "k", "k_name"]
    assert rows(got) == [(1, "a", "A"), (2, None, None), (3, "zz", None), (4, "a", "A")]
    assert ("BroadcastHashJoin" in plan(got)) == (strategy == "broadcast")
    assert rows(joins.replace_by_lookup(base, look, "k", "uuid", "name")) == [(1, "A"), (2, None), (3, None), (4, "A")]


def test_lookup_rejects_a_name_that_is_taken(spark):
    base = spark.createDataFrame([(1, "a")], "id int, k string")
    with pytest.raises(ValueError, match="already exist"):
        joins.lookup(base, base, {"k": "k"}, {"id": "id"})


def test_fan_out(spark, strategy):
    base = spark.createDataFrame([(1,), (2,), (None,), (4,)], "id int")
    many = spark.createDataFrame([(1, "x"), (1, "y"), (1, None), (3, "z"), (None, "n"), (4, "w")], "ref int, v string")
    got = joins.fan_out(base, many, {"id": "ref"}, {"v": "v"})
    assert rows(got) == sorted([(1, "x"), (1, "y"), (1, None), (2, None), (None, None), (4, "w")], key=repr)


def test_two_column_keys(spark, strategy):
    base = spark.createDataFrame([(1, "a"), (1, "b")], "i int, k string")
    right = spark.createDataFrame([(1, "a", 7), (1, "c", 8)], "x int, y string, v int")
    assert rows(joins.fan_out(base, right, {"i": "x", "k": "y"}, {"v": "v"})) == [(1, "a", 7), (1, "b", None)]


def test_preagg_join(spark, strategy):
    base = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    items = spark.createDataFrame([(1, 5), (1, None), (2, None), (9, 4)], "ref int, amount int")
    assert rows(joins.preagg_join(base, items, {"id": "ref"}, {"total": "amount"})) == [(1, 5), (2, None), (3, None)]


def test_small_base_reduces_a_large_right_side(spark, settings, tmp_path):
    spark.range(20000).selectExpr("id as ref", "repeat(cast(id as string), 20) as v").write.parquet(f"{tmp_path}/big")
    spark.range(3).write.parquet(f"{tmp_path}/base")
    big, base = spark.read.parquet(f"{tmp_path}/big"), spark.read.parquet(f"{tmp_path}/base")
    settings(spark__sql__autoBroadcastJoinThreshold="20000")
    assert keys.fits_broadcast(base) and not keys.fits_broadcast(big)
    got = joins.preagg_join(base, big.selectExpr("ref", "length(v) as n"), {"id": "ref"}, {"n": "n"})
    assert got.count() == 3 and "LeftSemi, BuildRight" in plan(got)


SKEW = dict(
    spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
    spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20000",
    spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    spark__sql__adaptive__advisoryPartitionSizeInBytes="10000", spark__sql__shuffle__partitions="8",
)


def executed(df):
    df.collect()
    return plan(df)


def test_hot_keys_are_split(spark, settings):
    """A third of all rows on one key: every join shape lets the adaptive planner split it."""
    settings(**SKEW)
    many = spark.range(0, 60000, 1, 8).selectExpr("id", "case when id % 3 = 0 then -1 else id % 5000 end as k", "cast(id as string) as v")
    few = spark.range(-1, 5000, 1, 8).selectExpr("id as uuid", "cast(id as string) as name")

    found = joins.lookup(many, few, {"k": "uuid"}, {"name": "name"})
    assert "SortMergeJoin(skew=true)" in executed(found)
    assert found.count() == 60000 and found.filter("name = cast(k as string)").count() == 60000

    held = []

    def staging(df, label):
        held.append(stage(df, label))
        return held[-1].read()

    spread = joins.fan_out(few.drop("name"), many, {"uuid": "k"}, {"v": "v"}, staging, hot_rows=10_000)
    assert "SortMergeJoin(skew=true)" in executed(spread) and spread.count() == 60000 and len(held) == 2
    even = joins.fan_out(few.drop("name"), many, {"uuid": "k"}, {"v": "v"}, staging)  # no key is hot by its own measure
    assert "LeftOuter" in executed(even) and "LeftAnti" not in plan(even) and even.count() == 60000

    summed = joins.preagg_join(many, few.selectExpr("uuid", "length(name) n"), {"k": "uuid"}, {"n": "n"})
    assert "SortMergeJoin(skew=true)" in executed(summed) and summed.filter("n = length(cast(k as string))").count() == 60000

    # many rows per key on both sides; the delta's hot key is collapsed map-side
    delta = many.filter("k < 20")
    kept = replace.delete_by_keys(many, delta.filter("id % 5 > 0 and k >= 0"), "k")
    assert "SortMergeJoin(skew=true)" in executed(kept)
    gone = {r.k for r in delta.filter("id % 5 > 0 and k >= 0").collect()}
    assert kept.count() == many.filter(~F.col("k").isin(*gone)).count()

    times = many.selectExpr("k", "timestamp_ntz '2024-01-05 00:00:00' + interval '1' minute * (id % 9000) as u")
    groups = changed_groups(times, "u", RUN, "k")
    assert "SortMergeJoin(skew=true)" in executed(groups)


@pytest.mark.parametrize("bound", ["-1", "10000000"])
def test_fan_out_reads_each_side_once(spark, settings, tmp_path, bound):
    """A right side that changes from read to read never costs a base row, nor doubles one."""
    settings(spark__sql__autoBroadcastJoinThreshold=bound, spark__sql__adaptive__autoBroadcastJoinThreshold=bound)
    spark.range(1000).selectExpr("id as k").write.parquet(f"{tmp_path}/base")
    base = spark.read.parquet(f"{tmp_path}/base")
    changing = spark.range(1000).selectExpr("id as k", "id as v").where(F.rand() < 0.5)
    held = []

    def staging(df, label):
        held.append(stage(df, label))
        return held[-1].read()

    lazy = joins.fan_out(base, changing, {"k": "k"}, {"v": "v"})
    assert plan(lazy).split("Initial Plan")[0].count("FileScan") <= 1 and plan(lazy).count("Range (") <= 2
    for got in (lazy, joins.fan_out(base, changing, {"k": "k"}, {"v": "v"}, staging), joins.fan_out(base, changing, {"k": "k"}, {"v": "v"}, staging, 1)):
        assert sorted(r.k for r in got.collect()) == list(range(1000))


def test_null_keys_are_split_and_survive(spark, settings):
    settings(**SKEW)
    target = spark.range(0, 60000, 1, 8).selectExpr("case when id % 3 = 0 then null else id end as k", "cast(id as string) as v")
    delta = spark.range(0, 3000).selectExpr("case when id % 2 = 0 then null else id end as k", "'new' as v")
    state = replace.keyed_replace(target, delta, "k")
    assert "SortMergeJoin(skew=true)" in executed(state)
    gone = sum(1 for i in range(3000) if i % 2 and i % 3)
    assert state.count() == 60000 - gone + 3000


def test_keys_of_different_types_match(spark, strategy):
    target = spark.createDataFrame([(1.0, "a"), (2.0, "b")], "k double, v string")
    delta = spark.createDataFrame([(2, "c")], "k int, v string")
    assert rows(replace.delete_by_keys(target, delta, "k")) == [(1.0, "a")]
    base = spark.createDataFrame([("1",), ("2",)], "k string")
    assert rows(joins.fan_out(base, delta, {"k": "k"}, {"v": "v"})) == [("1", None), ("2", "c")]


def test_aggregates_combine_before_the_shuffle(spark):
    df = spark.range(0, 100000, 1, 4).selectExpr("cast(id % 2 as string) as k", "id as a", "cast(id as string) as b")
    for result in (aggregates.dedupe_keep_first(df, "k", ["a"]), aggregates.sum_by_key(df, "k", "a", "s"), keys.key_set(df, "k")):
        text = executed(result)
        assert text.count("partial_") >= 1 or text.count("HashAggregate") >= 2
        assert "Window" not in text


# --- aggregates --------------------------------------------------------------------


def test_sum_of_nulls(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", None)], "k string, v int")
    assert rows(aggregates.sum_by_key(df, "k", "v", "s")) == [("a", 1), ("b", None)]


def test_item_amount(spark):
    cases = [(2, 10, 10, 11, True, "19.98"), (2, 10, None, 11, True, "22"), (2, 10, 10, 11, False, "18"), (2, 10, None, 11, None, "20"),
             (2, 10, None, None, True, "22"), (2, 10, 10, None, True, None), (None, 10, None, None, False, None)]
    df = spark.createDataFrame([c[:5] for c in cases], "q int, p int, d int, t int, x boolean")
    dec = lambda c, t="decimal(5,2)": F.col(c).cast(t)
    got = df.select(aggregates.item_amount(dec("q"), dec("p", "decimal(9,2)"), dec("d"), dec("t"), F.col("x")).alias("v")).collect()
    assert [None if r.v is None else float(r.v) for r in got] == [None if c[5] is None else float(c[5]) for c in cases]


def test_dedupe(spark):
    data = [("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), (None, 5, "n"), (None, 4, "m"), ("b", None, "q"), ("b", 0, "r")]
    df = spark.createDataFrame(data, "k string, o int, v string")
    got = aggregates.dedupe_keep_first(df, "k", ["o"])
    assert got.columns == df.columns and got.dtypes == df.dtypes
    assert rows(got) == sorted([("a", 1, "y"), (None, 4, "m"), ("b", None, "q")], key=repr)
    assert rows(aggregates.dedupe_keep_first(df.select("k"), "k", [])) == sorted([("a",), (None,), ("b",)], key=repr)


def test_first_table_wins(spark):
    one = spark.createDataFrame([("name", "text")], "Field string, Type string")
    two = spark.createDataFrame([("name", "int"), ("code", "int")], "Field string, Type string")
    assert rows(aggregates.first_table_wins([one, two], "Field")) == [("code", "int"), ("name", "text")]


def test_profiles_agree(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert rows(aggregates.profile_non_null(df)) == [("a", "int", 2, 2), ("b", "string", 2, 1)]
    observed, seen = aggregates.observe_profile(df, "p1")
    observed.write.parquet(f"{tmp_path}/out")
    assert seen.get == {"rows": 2, "n:a": 2, "n:b": 1}
    assert not aggregates.is_empty(df) and aggregates.is_empty(df.limit(0))


# --- maintenance -------------------------------------------------------------------


TARGET = [(1, "old"), (1, "old2"), (2, "keep"), (None, "nullkey")]
DELTA = [(1, "n1"), (1, "n2"), (3, "n3")]


def test_keyed_replace(spark, strategy):
    t, d = spark.createDataFrame(TARGET, "k int, v string"), spark.createDataFrame(DELTA, "k int, v string")
    want = sorted([(1, "n1"), (1, "n2"), (2, "keep"), (3, "n3"), (None, "nullkey")], key=repr)
    once = replace.keyed_replace(t, d, "k")
    assert rows(once) == want
    assert rows(replace.keyed_replace(once, d, "k")) == want  # repeating a run changes nothing
    assert rows(replace.keyed_replace(t, d.limit(0), "k")) == rows(t)
    assert rows(replace.keyed_replace(None, d, "k")) == rows(d)
    assert rows(replace.append_rows(t, d)) == sorted(TARGET + DELTA, key=repr)
    assert rows(replace.full_refresh(t, d)) == sorted(DELTA, key=repr)


def test_replace_with_new_and_missing_columns(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    d = spark.createDataFrame([(2, 9)], "k int, w int")
    assert rows(replace.keyed_replace(t, d, "k")) == [(1, "a", None), (2, None, 9)]


def test_keys_ship_alone(spark):
    t = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    text = plan(replace.delete_by_keys(t, t.filter("o_orderstatus = 'F'"), "o_orderkey"))
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in text and "LeftAnti" in text


def test_purge(spark):
    df = spark.createDataFrame([("20240116",), ("20240117",), ("20240120",), ("20250101",), (None,), ("20231231",)], "d string")
    got = replace.purge_trailing_days(df, "d", date(2024, 1, 20))
    assert rows(got) == sorted([("20240116",), (None,), ("20231231",)], key=repr)


def test_preview(spark):
    df = spark.range(100).orderBy(F.desc("id"))
    assert [r.id for r in aggregates.preview(df, 3, ["id"]).collect()] == [0, 1, 2]
    assert aggregates.preview(df).count() == 5
