import io
import random
from datetime import date, datetime, timedelta
from itertools import product

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.lattice import reinfer, wider, wider_schema
from tablesync.operators.arrival import ARRIVAL, keep_first_arrived, with_arrival
from tablesync.operators.fingerprints import unchanged_keys
from tablesync.operators.keys import estimated_bytes, key_set
from tablesync.operators.reconcile import KeyRange, _within, differing_keys, differing_ranges
from tablesync.operators.replace import purge_trailing_days
from tablesync.operators.slices import slice_edges, slice_predicates
from tablesync.operators.window import Window
from tablesync.plans import SPECS, run_job
from tablesync.plans.ledger import RunLedger, gaps, merged, overlaps
from tablesync.plans.runner import delta as delta_of
from tablesync.plans.runner import published_table
from tablesync.sources.catalog import FrameCatalog, JdbcCatalog, ParquetCatalog
from tablesync.sources.keyfilter import SCHEMA, WORDS, _asked, _told, filter_of, folders_hit
from tablesync.sources.partitioned import PartitionedTable
from tablesync.sources.staging import stage

RUN = datetime(2024, 1, 6, 2)


def bag(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def months(spark, n=12, each=20):
    return spark.range(n * each).selectExpr(
        "concat('k', id) as k", f"timestamp_ntz '2023-01-15 00:00:00' + make_interval(0, cast(id div {each} as int)) as created_at", "id as v")


# --- key filters ---------------------------------------------------------------------


def test_filters_hold_every_key_and_hardly_any_other(spark):
    rows = spark.range(6000).selectExpr("concat('f', id % 3) as folder", "case when id % 50 <> 7 then id end as k")
    filters = filter_of(rows, "folder", "k")
    assert filters.schema.simpleString() == T.StructType.fromDDL(SCHEMA).simpleString()
    sizes = [r[0] for r in filters.select("slots").distinct().collect()]
    for key in (0, 1, 5000, 5999):
        assert f"f{key % 3}" in folders_hit(filters, spark.createDataFrame([(key,)], "_key long"), sizes)
    strangers = spark.range(10_000, 60_000).selectExpr("id as _key")
    assert folders_hit(filters, strangers, sizes) == []
    assert folders_hit(filters, strangers.limit(0), sizes) == [] and folders_hit(filters, spark.sql("select cast(null as long) as _key"), sizes) == []


def test_filters_merge_and_know_keys_under_wider_types(spark):
    one = spark.sql("select 'f' as folder, 7L as k union all select 'f', 8L")
    two = spark.sql("select 'f' as folder, '9' as k union all select 'f', 'x9'")
    a, b = filter_of(one, "folder", "k"), filter_of(two, "folder", "k")
    union = a.unionByName(b).groupBy("folder", "slots", "slot").agg(F.bit_or("word").alias("word"))
    sizes = [r[0] for r in union.select("slots").distinct().collect()]
    assert len(sizes) == 1
    for key in ("'7'", "7", "7.0D", "cast(8 as decimal(9,2))", "'9'", "9", "'x9'"):
        assert folders_hit(union, spark.sql(f"select {key} as _key"), sizes) == ["f"]


def test_a_folder_is_no_single_task(spark, settings):
    # two folders: a join by folder would leave each folder's words where its keys are
    settings(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__coalescePartitions__enabled="false")
    rows = spark.range(4000).selectExpr("concat('f', id % 2) as folder", "concat('k', id) as k")
    filters = filter_of(rows, "folder", "k")
    dealt = [r["count"] for r in filters.groupBy(F.spark_partition_id()).count().collect()]
    assert len(dealt) == 8 and max(dealt) < 0.25 * sum(dealt)
    counts = spark.createDataFrame([("f0", 2000), ("f1", 2000)], "folder string, n long")
    assert bag(filter_of(rows, "folder", "k", counts=counts)) == bag(filters)


def test_the_filter_of_one_month_is_written_by_many_tasks(spark, settings, tmp_path):
    settings(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__coalescePartitions__enabled="false")
    table = PartitionedTable(spark, str(tmp_path), "d", "t", key="k")
    rows = spark.range(3000).selectExpr("if(id % 10 = 0, null, concat('k', id)) as k", "if(id < 2900, timestamp_ntz '2024-01-05 00:00:00', null) as created_at")
    table.replace(rows, RUN)
    files = [f for run in (tmp_path / "d/t/filters").iterdir() for f in run.glob("part-*.parquet")]
    assert len(files) == 8
    held = table.manifest()
    assert {m: f.rows for m, f in held.items()} == {202401: 2900, None: 100} and held[202401].slots == 2048 and held[None].slots == 128
    assert {f.folder.split("created_month=")[1] for f in held.values()} == {"202401", "__HIVE_DEFAULT_PARTITION__"}
    asked = {"k1": [202401], "k2999": [None], "k10": []}
    for key, months in asked.items():
        assert [f.month for f in table.folders_of(spark.createDataFrame([(key,)], "_key string"), "k")] == months


def test_the_text_of_a_key_is_made_once(spark):
    filters = filter_of(spark.range(9).selectExpr("'f' as folder", "concat('i', id) as k"), "folder", "k")
    assert filters._jdf.queryExecution().optimizedPlan().toString().lower().count("try_cast(") == 1


def test_the_words_of_many_keys_are_not_broadcast(spark, settings):
    keys = spark.range(1000).selectExpr("concat('k', id) as _key")
    filters = filter_of(spark.range(50_000).selectExpr("'f' as folder", "concat('k', id) as k"), "folder", "k")
    slots = filters.first()["slots"]

    def plan():
        return filters.join(_asked(keys, [slots]), ["slots", "slot"])._jdf.queryExecution().sparkPlan().toString()

    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    size = estimated_bytes(_asked(keys, [slots]))
    for limit, broadcast in ((size - 1, False), (size + 1, False), (WORDS * size - 1, False), (WORDS * size, True)):
        settings(spark__sql__autoBroadcastJoinThreshold=limit)
        assert ("BroadcastHashJoin" in plan()) == broadcast, limit
    settings(spark__sql__autoBroadcastJoinThreshold=size + 1)
    assert folders_hit(filters, keys, [slots]) == ["f"] and folders_hit(filters, keys.unionByName(keys), [slots]) == ["f"]


def test_texts_of_numbers_are_known(spark):
    texts = ["1", "01", "1.0", " 1 ", "\t1\n", "+1", "-1", ".5", "5.", "1e3", "1E+3", "1d", "1F", "0x1p3", "0X1.8P-1", "nan", "NaN", "-nan", "inf", "-Infinity", "+INF", "infinit", "1e", "e1",
             ".", "+", "", " ", "1 2", "k1", "i1", "1-2", "1_000", "١", "1\u00a0", "\u20031", "1dd", "0x1", "1e400", "9" * 400, "9" * 5000 + "x"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = F.coalesce(F.col("t").try_cast("double").cast("string"), F.col("t"))
    assert [r.t for r in rows.select("t", _told(F.col("t")).alias("a"), plain.alias("b")).where("not a <=> b").collect()] == []


def test_a_replace_opens_only_the_folders_hit(spark, tmp_path):
    table = PartitionedTable(spark, str(tmp_path), "d", "t", key="k")
    table.replace(months(spark), RUN)
    wanted = key_set(spark.createDataFrame([("k45",), ("k47",), ("k230",), ("none",), (None,)], "k string"), "k")
    opened = table.folders_of(wanted, "k")
    assert sorted(f.month for f in opened) == [202303, 202312]
    read = {f.split("created_month=")[1].split("/")[0] for f in table.rows_of(wanted, "k").inputFiles()}
    assert read == {"202303", "202312"} and sorted(r.k for r in table.rows_of(wanted, "k").collect()) == ["k230", "k45", "k47"]
    # a column without a filter opens all of them
    assert len(table.folders_of(key_set(months(spark).selectExpr("v as k"), "k"), "v")) == 12
    before = table.folders()
    # a key whose rows lie in another month than the delta's own
    table.keyed_replace(spark.sql("select 'k45' as k, timestamp_ntz '2023-07-01 00:00:00' as created_at, -1L as v"), "k", RUN)
    after = table.folders()
    assert {m for m in after if after[m] != before[m]} == {202303, 202307}
    want = [r for r in map(tuple, months(spark).collect()) if r[0] != "k45"] + [("k45", datetime(2023, 7, 1), -1)]
    assert sorted(map(tuple, table.read().collect())) == sorted(want)


def test_random_replaces_agree_with_a_dictionary(spark, tmp_path):
    rng, state = random.Random(4), {}
    table = PartitionedTable(spark, str(tmp_path), "d", "t", key="k")
    for step in range(5):
        keys = rng.sample(range(60), 12)
        rows = [(k, datetime(2023, rng.randint(1, 5), 1), step * 100 + i) for k in keys for i in range(rng.randint(1, 2))]
        table.keyed_replace(spark.createDataFrame(rows, "k int, created_at timestamp_ntz, v int"), "k", RUN + timedelta(days=step))
        state.update({k: [r for r in rows if r[0] == k] for k in keys})
        assert bag(table.read().select("created_at", "k", "v")) == sorted([(r[1], r[0], r[2]) for rows in state.values() for r in rows], key=repr)
    table.expire(1)
    assert len(bag(table.read())) == sum(map(len, state.values()))


# --- what did not change -------------------------------------------------------------


def test_unchanged_keys_are_bags(spark):
    before = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0), (2, "a", 0.0), (2, "a", 0.0), (3, None, 1.0), (None, "n", 1.0), (4, "x", None), (5, "p", 1.0)], "k int, s string, d double")
    after = spark.createDataFrame([(1, "b", 2.0), (1, "a", 1.0), (2, "a", -0.0), (3, None, 1.0), (None, "n", 1.0), (4, None, None), (5, "p", 9.0), (6, "new", 0.0)], "k int, s string, d double")
    assert sorted(r[0] for r in unchanged_keys(before, after, "k").collect()) == [1, 3]
    assert sorted(r[0] for r in unchanged_keys(before, after, "k", ["D"]).collect()) == [1, 3, 5]


def test_an_unchanged_delta_writes_no_folder(spark, tmp_path):
    table = PartitionedTable(spark, str(tmp_path), "d", "t", key="k")
    rows = months(spark, 4).withColumn("updated_at", F.lit(1))
    table.replace(rows, RUN)
    before, runs = table.folders(), sorted(p.name for p in (tmp_path / "d/t/rows").iterdir())
    same = rows.where("v % 7 = 0")
    first = table.keyed_replace(same, "k", RUN, skip_unchanged=True)
    table.keyed_replace(same.withColumn("updated_at", F.lit(2)), "k", RUN, skip_unchanged=True, ignore=["updated_at"])
    assert table.folders() == before and sorted(p.name for p in (tmp_path / "d/t/rows").iterdir()) == runs and first in table.versions()
    # one of many rows changes: its month alone is written
    table.keyed_replace(rows.withColumn("v", F.when(F.col("k") == "k25", -1).otherwise(F.col("v"))), "k", RUN, skip_unchanged=True)
    assert {m for m, f in table.folders().items() if f != before[m]} == {202302} and table.read().where("v = -1").count() == 1
    # a key of the key source without rows goes, one with a NULL key is added
    keys = spark.createDataFrame([("k0",), ("k1",)], "k string")
    table.keyed_replace(rows.where("k = 'k1'").unionByName(rows.where("k = 'k5'").withColumn("k", F.lit(None).cast("string"))), "k", RUN, keys=keys)
    assert table.read().where("k = 'k0'").isEmpty() and table.read().where("k is null").count() == 1 and table.read().count() == 80


def test_an_append_repeated_by_token_adds_once(spark, tmp_path):
    table = PartitionedTable(spark, str(tmp_path), "d", "t")
    first = table.append(months(spark, 2), RUN, token="a")
    assert table.append(months(spark, 2), RUN, token="a") == first and table.read().count() == 40
    table.append(months(spark, 1), RUN, token="b")
    table.append(months(spark, 1), RUN)  # without one rows are added as often as asked
    table.keyed_replace(months(spark, 1).limit(1), "k", RUN)
    again = PartitionedTable(spark, str(tmp_path), "d", "t")
    assert again.tokens() == ["a", "b"] and again.append(months(spark, 2), RUN, token="b") == again.versions()[-1]
    assert again.read().count() == 40 + 20 + 20 - 2


def test_purge_by_folder(spark, tmp_path):
    rows = spark.range(120).selectExpr(
        "id", "timestamp_ntz '2023-12-01 00:00:00' + make_interval(0, 0, 0, cast(id as int)) as created_at").withColumn(
        "ymd", F.when(F.col("id") % 40 != 3, F.date_format("created_at", "yyyyMMdd")))
    table = PartitionedTable(spark, str(tmp_path), "d", "t", day_column="ymd")
    table.replace(rows, RUN)
    before = table.folders()
    table.purge(date(2024, 1, 20), RUN, days=4)
    after = table.folders()
    assert bag(table.read()) == bag(purge_trailing_days(rows, "ymd", date(2024, 1, 20)))
    assert after[202312] == before[202312] and after[202401] != before[202401] and 202402 in after  # a row without a day stays in February
    assert 202403 in after or rows.where("created_at >= timestamp_ntz '2024-03-01' and ymd is null").isEmpty()
    newest = table.versions()[-1]
    assert table.purge(date(2024, 1, 20), RUN, days=4) != "" and bag(table.read(newest)) == bag(table.read())
    whole = PartitionedTable(spark, str(tmp_path), "d", "u", day_column="ymd")
    whole.replace(rows.where("ymd is not null"), RUN)
    held = whole.folders()
    whole.purge(date(2024, 2, 4), RUN, days=4)  # the bound lies between two months: nothing is read or written
    assert whole.folders() == {m: f for m, f in held.items() if m < 202402}
    with pytest.raises(ValueError):
        PartitionedTable(spark, str(tmp_path), "d", "v").purge(date(2024, 1, 1), RUN)


# --- types ---------------------------------------------------------------------------


KINDS = [T.NullType(), T.BooleanType(), T.ShortType(), T.IntegerType(), T.LongType(), T.DecimalType(20, 2), T.DecimalType(38, 30), T.FloatType(), T.DoubleType(), T.DateType(),
         T.TimestampType(), T.TimestampNTZType(), T.StringType()]


def test_the_lattice_is_one():
    for a, b, c in product(KINDS, repeat=3):
        assert wider(a, b) == wider(b, a) and wider(a, a) == a
        assert wider(wider(a, b), b) == wider(a, b)
    assert wider(T.IntegerType(), T.StringType()) == T.StringType() and wider(T.LongType(), T.DoubleType()) == T.DoubleType()
    assert wider(T.DateType(), T.IntegerType()) == T.StringType() and wider(T.LongType(), T.DecimalType(10, 2)) == T.DecimalType(21, 2)
    with pytest.raises(TypeError):
        wider(T.ArrayType(T.LongType()), T.LongType())


def test_months_of_changing_types_are_read_whole(spark, tmp_path):
    table = PartitionedTable(spark, str(tmp_path), "d", "t", key="k")
    eras = [("2023-01-01", "1", "7", ""), ("2023-02-01", "cast(2 as bigint)", "0.5D", ", 'x' as more"), ("2023-03-01", "'x3'", "cast(null as int)", ", 'y' as more")]
    for i, (at, v, n, more) in enumerate(eras):
        table.append(spark.sql(f"select {i} as k, timestamp_ntz '{at} 00:00:00' as created_at, {v} as v, {n} as n{more}"), RUN + timedelta(days=i))
    assert dict(table.read().dtypes) == {"k": "int", "created_at": "timestamp_ntz", "v": "string", "n": "double", "more": "string"}
    assert bag(table.read().select("k", "more", "n", "v")) == sorted([(0, None, 7.0, "1"), (1, "x", 0.5, "2"), (2, "y", None, "x3")], key=repr)
    # a replace in an old month widens that one alone
    table.keyed_replace(spark.sql("select 0 as k, timestamp_ntz '2023-01-09 00:00:00' as created_at, 'new' as v"), "k", RUN + timedelta(days=5))
    assert bag(table.read().select("k", "v")) == [(0, "new"), (1, "2"), (2, "x3")]
    assert wider_schema([table.schema(table.versions()[0]), table.schema()]) == table.schema()


VALUES = [
    ["1", "2"], ["01", "2"], ["1", None], ["9223372036854775808", "1"], ["9223372036854775808", "-1"], ["18446744073709551616", "1"], ["99999999999999999999", None],
    ["1.", "2"], [".5", "1e5"], ["True", "false"], ["True", None], ["True", "1"], [" 1", "2 "], ["1e", "2"], ["+5", "3"], ["inf", "1"], ["-Infinity", "1"], ["1_0", "2"],
    ["0x1", "2"], [None, None], ["٣", "1"], [" True", "True"], ["1\t", "2"], ["12d", "1"], ["abc", "1"], ["-0", "0"], ["1.5", None], ["TRUE", "FALSE"], ["1", "1.5"], ["9223372036854775807", "-9223372036854775808"],
]
PANDAS = {"int64": "bigint", "uint64": "decimal(20,0)", "float64": "double", "bool": "boolean", "object": "string"}


def test_reinfer_as_an_untyped_file_does(spark):
    names = [f"c{i}" for i in range(len(VALUES))]
    df = spark.createDataFrame([tuple(v[r] for v in VALUES) for r in range(2)], ", ".join(f"{n} string" for n in names)).coalesce(1)
    back = pd.read_csv(io.StringIO(pd.DataFrame({n: v for n, v in zip(names, VALUES)}).to_csv(index=False)))
    got = reinfer(df)
    assert [(n, t) for n, t in got.dtypes] == [(n, PANDAS[str(back[n].dtype)]) for n in names]
    rows = got.collect()
    for n in names:
        want = [None if pd.isna(v) else str(v) if back[n].dtype == object else v for v in back[n].tolist()]  # truth values beside a gap stay texts
        assert [r[n] for r in rows] == want, n


def test_reinfer_of_typed_columns_some_columns_and_no_rows(spark):
    df = spark.sql("""select * from values (1, true, cast(1 as double), timestamp_ntz '2024-01-01 00:00:00', '007', '007'),
        (2, null, null, null, '8', '8') as t(i, b, d, at, s, kept)""").withColumn("n", F.when(F.col("i") == 1, F.col("i")))
    got = reinfer(df, ["i", "b", "d", "at", "s", "n"])
    assert dict(got.dtypes) == {"i": "bigint", "b": "string", "d": "double", "at": "string", "s": "bigint", "kept": "string", "n": "double"}
    assert tuple(got.orderBy("i").first()) == (1, "True", 1.0, "2024-01-01 00:00:00", 7, "007", 1.0)
    assert set(dict(reinfer(df.limit(0)).dtypes).values()) == {"string"}


def test_a_spec_that_reloads_with_inferred_types(spark):
    from dataclasses import replace

    frame = spark.createDataFrame([("u1", "007", "NA", datetime(2024, 1, 5, 3)), ("u2", "8", "5", datetime(2024, 1, 5, 4))], "uuid string, code string, n string, updated_at timestamp_ntz")
    spec = replace(SPECS["sms_logs"], reload="inferred", sync=False)
    got = delta_of(spec, FrameCatalog({spec.source: frame}), RUN)
    assert dict(got.dtypes)["code"] == "bigint" and dict(got.dtypes)["n"] == "double" and sorted(r.code for r in got.collect()) == [7, 8]


# --- arrival -------------------------------------------------------------------------


def test_first_arrived_whatever_the_partitions(spark, settings, tmp_path):
    rows = spark.range(5000).selectExpr("id % 100 as k", "id as v", "repeat('x', 50) as pad").orderBy(F.xxhash64("id"))
    rows.repartitionByRange(6, F.xxhash64("v")).sortWithinPartitions(F.xxhash64("v")).write.parquet(f"{tmp_path}/t")
    files = sorted(p for p in (tmp_path / "t").iterdir() if p.suffix == ".parquet")
    want = {}
    for f in files:
        for r in pd.read_parquet(f).itertuples():
            want.setdefault(r.k, r.v)
    for size in ("4096", "134217728"):
        settings(spark__sql__files__maxPartitionBytes=size, spark__sql__files__openCostInBytes="1")
        for n in (1, 5):
            got = keep_first_arrived(with_arrival(spark.read.parquet(f"{tmp_path}/t")).repartition(n), "k")
            assert {r.k: r.v for r in got.collect()} == want and ARRIVAL not in got.columns


def test_rows_of_other_sources_are_numbered_once(spark):
    held = []

    def staging(df, label):
        held.append(stage(df, label))
        return held[-1].read()

    df = spark.range(0, 1000, 1, 4).selectExpr("id % 10 as k", "id as v")
    got = keep_first_arrived(with_arrival(df, staging).repartition(3), "k")
    assert {r.k: r.v for r in got.collect()} == {i: i for i in range(10)} and len(held) == 1


def test_a_spec_that_keeps_the_first_row_read(spark, tmp_path):
    from dataclasses import replace

    rows = [(f"u{i % 40}", f"name {i}", datetime(2024, 1, 5, 3, i % 60)) for i in range(200)]
    (tmp_path / "src/invoicer").mkdir(parents=True)
    pd.DataFrame(rows, columns=["uuid", "name", "updated_at"]).astype({"updated_at": "datetime64[us]"}).to_parquet(tmp_path / "src/invoicer/sms_logs.parquet")
    spec = replace(SPECS["sms_logs"], first_arrived=True)
    catalog = ParquetCatalog(spark, f"{tmp_path}/src", suffix=".parquet")
    run_job(spec, catalog, f"{tmp_path}/pub", RUN, f"{tmp_path}/snap")
    got = published_table(spec, spark, f"{tmp_path}/pub").read()
    assert {r.sms_log_id: r.name for r in got.collect()} == {f"u{i}": f"name {i}" for i in range(40)}
    assert ARRIVAL not in got.columns and not [p for p in (tmp_path / "snap").rglob("*.csv") if ARRIVAL in p.read_text()]


# --- slices --------------------------------------------------------------------------


def skewed(spark):
    """Half of the rows share a time, some lack a time or a key."""
    return spark.range(20_000).selectExpr(
        "case when id % 50 <> 3 then concat('u', sha1(cast(id as string))) end as uuid",
        """case when id % 97 = 5 then null when id % 2 = 0 then timestamp_ntz '2024-01-05 10:00:00'
           else timestamp_ntz '2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, cast(id % 7000 as int)) end as updated_at""", "id").cache()


@pytest.mark.parametrize("n", [1, 2, 7, 16])
def test_slices_hold_every_row_once_and_are_even(spark, n):
    rows = skewed(spark)
    edges = slice_edges(rows, "updated_at", "uuid", n)
    parts = [[r.id for r in rows.where(p).collect()] for p in slice_predicates(edges, "updated_at", "uuid")]
    assert sorted(i for p in parts for i in p) == list(range(20_000))
    if n > 1:
        timed = parts[:-1]
        assert len(timed) == n and max(map(len, timed)) <= 2 * sum(map(len, timed)) / n


def test_slices_of_odd_tables(spark):
    empty = spark.createDataFrame([], "t timestamp_ntz, k string")
    assert slice_edges(empty, "t", "k", 4) == [] and slice_predicates([], "t", "k") == ["1 = 1"]
    same = spark.range(50).selectExpr("timestamp_ntz '2024-01-01 00:00:00' as t", "'it''s\\\\' as k")
    edges = slice_edges(same, "t", "k", 4)
    assert len(edges) == 1 and sum(same.where(p).count() for p in slice_predicates(edges, "t", "k")) == 50


def test_a_database_is_asked_for_even_slices(spark, monkeypatch):
    asked, rows = [], skewed(spark)

    def read(table, predicates):
        asked.append(predicates)
        return rows.where(" or ".join(f"({p})" for p in predicates))

    catalog = JdbcCatalog(spark, "jdbc:mysql://host/db", {}, slices=4, equal_depth=True, slice_by={"a.t": "updated_at"})
    monkeypatch.setattr(catalog, "_read", read)
    monkeypatch.setattr(catalog, "declared", lambda table: [("uuid", "varchar(36)"), ("updated_at", "datetime")])
    monkeypatch.setattr(catalog, "_query", lambda text: rows.selectExpr("min(updated_at) lo", "max(updated_at) hi"))
    assert catalog.scan("a.t").count() == 20_000 and len(asked[-1]) == 5
    window = Window(datetime(2024, 1, 1, 5), datetime(2024, 1, 5, 11))
    want = {r.id for r in rows.where(window.holds("updated_at")).collect()}
    assert sorted(r.id for r in catalog.scan("a.t", window).collect()) == sorted(want) and all("updated_at < '2024-01-05 11" in p for p in asked[-1])
    monkeypatch.setattr(catalog, "declared", lambda table: [("updated_at", "datetime")])
    catalog.scan("a.t", window)
    assert asked[-1] == catalog.predicates(window, "updated_at")  # no key: slices of the window


# --- reconciliation ------------------------------------------------------------------


def test_planted_differences_are_found_and_equal_ranges_left_alone(spark):
    source = spark.range(50_000).selectExpr("id as k", "id * 3 as v", "cast(id as string) as s")
    target = source.where("k <> 777").withColumn("v", F.when(F.col("k") == 30_001, -1).otherwise(F.col("v"))).unionByName(spark.sql("select 60000L as k, 1L as v, 'x' as s"))
    found = {r.k: r.status for r in differing_keys(source, target, "k", fan_out=16, small=500).collect()}
    assert found == {777: "missing", 30_001: "changed", 60_000: "extra"}
    ranges = differing_ranges(source, target, "k", fan_out=16, small=500)
    assert len(ranges) == 3 and all(r.rows <= 1000 for r in ranges)
    held = source.where(" or ".join(f"(k >= {r.low or 0} and k < {r.high or 10 ** 9})" for r in ranges)).count()
    assert held <= 3000  # of 50,000 rows; all others were read once
    assert differing_ranges(source, source, "k") == [] and differing_keys(source, source, "k").collect() == []
    assert differing_keys(source, target, "k", ["s"]).where("status = 'changed'").isEmpty()  # a column that is the same


def test_reconciling_bags_nulls_ties_and_empty_sides(spark):
    source = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), (None, 1), ("d", None), ("e", 5)], "k string, v int")
    target = spark.createDataFrame([("a", 1), ("b", 1), (None, 2), ("d", 0), ("e", 5), ("f", 6)], "k string, v int")
    assert {r.k: r.status for r in differing_keys(source, target, "k", small=1).collect()} == {"a": "changed", None: "changed", "d": "changed", "f": "extra"}
    none = source.limit(0)
    assert {r.status for r in differing_keys(source, none, "k").collect()} == {"missing"} and differing_keys(source, none, "k").count() == 5
    assert {r.status for r in differing_keys(none, target, "k").collect()} == {"extra"} and differing_keys(none, none, "k").collect() == []


def test_differences_everywhere_are_found(spark):
    # thousands of ranges differ at once, more than the planner's stack holds one after the other
    source = spark.range(30_000).selectExpr("id as k", "id % 11 as v")
    target = source.where("k % 9 <> 4").selectExpr("k", "if(k % 7 = 3, v + 1, v) as v").unionByName(spark.range(30_000, 30_500).selectExpr("id as k", "0L as v"))
    found = {r.k: r.status for r in differing_keys(source, target, "k", small=20).collect()}
    want = {k: "missing" if k % 9 == 4 else "changed" for k in range(30_000) if k % 9 == 4 or k % 7 == 3}
    assert found == {**want, **dict.fromkeys(range(30_000, 30_500), "extra")}


@pytest.mark.parametrize("kind", ["bigint", "string", "timestamp_ntz"])
@pytest.mark.parametrize("first", [None, 7])
def test_rows_within_many_ranges(spark, kind, first):
    told = {"bigint": lambda n: n, "string": lambda n: f"k{n:06d}", "timestamp_ntz": lambda n: RUN + timedelta(hours=n)}[kind]
    text = {"bigint": "id", "string": "concat('k', lpad(id, 6, '0'))", "timestamp_ntz": "timestamp_ntz '2024-01-06 02:00:00' + make_interval(0, 0, 0, 0, cast(id as int))"}[kind]
    rows = spark.range(4000).selectExpr("id", f"case when id % 100 <> 99 then {text} end as k")
    # some touch the one before; one is open below, one above, and one has the rows without a key
    spans = [(20 * i, 20 * i + (20 if i % 3 == 0 else 11)) for i in range(1, 150)]
    ranges = [KeyRange(None if first is None else told(first), told(15)), *[KeyRange(told(a), told(b)) for a, b in spans], KeyRange(told(3900), None)]
    want = {n for n in range(4000) if n % 100 != 99 and ((first or 0) <= n < 15 or n >= 3900 or any(a <= n < b for a, b in spans))}
    assert {r.id for r in _within(rows, "k", ranges).collect()} == want
    assert {r.id for r in _within(rows, "k", [KeyRange(blank=True), *ranges]).collect()} == want | set(range(99, 4000, 100))


# --- the ledger ----------------------------------------------------------------------


def hours(*spans):
    return [Window(RUN + timedelta(hours=a), RUN + timedelta(hours=b)) for a, b in spans]


def test_intervals_against_sets_of_hours():
    rng = random.Random(1)
    for _ in range(200):
        spans = [(a, a + rng.randint(0, 6)) for a in (rng.randint(0, 30) for _ in range(rng.randint(0, 6)))]
        flat = [h for a, b in spans for h in range(a, b)]
        asset = {h for a, b in spans for h in range(a, b)}
        cells = lambda ws: [int((w.lower - RUN).total_seconds() // 3600) + i for w in ws for i in range(int((w.upper - w.lower).total_seconds() // 3600))]
        windows = hours(*spans)
        assert cells(merged(windows)) == sorted(asset)
        assert cells(gaps(windows, *hours((3, 25)))) == sorted(set(range(3, 25)) - asset)
        assert cells(overlaps(windows)) == sorted({h for h in flat if flat.count(h) > 1})


def test_a_skipped_run_is_made_up_and_a_repeated_one_does_nothing(spark, tmp_path):
    ledger, done = RunLedger(spark, str(tmp_path), "d", "t"), []
    with pytest.raises(ValueError):
        ledger.due(RUN)
    assert ledger.run(RUN + timedelta(hours=24), done.append, RUN) == hours((0, 24))
    assert ledger.run(RUN + timedelta(hours=24), done.append) == [] and len(done) == 1
    ledger.record(*hours((48, 72)))  # a run that did not wait for the one before
    assert ledger.due(RUN + timedelta(hours=96)) == hours((24, 48), (72, 96))

    def fails(window):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        ledger.run(RUN + timedelta(hours=96), fails)
    assert RunLedger(spark, str(tmp_path), "d", "t").covered() == hours((0, 24), (48, 72))
    ledger.run(RUN + timedelta(hours=96), done.append)
    assert ledger.covered() == hours((0, 96)) and done == hours((0, 24), (24, 48), (72, 96)) and not ledger.record(*hours((5, 9)))
