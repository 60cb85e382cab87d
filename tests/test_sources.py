import time
from datetime import date, datetime
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.operators.replace import keyed_replace
from tablesync.operators.window import daily_window
from tablesync.sources.bucketed import BucketedTable
from tablesync.sources.catalog import FrameCatalog, JdbcCatalog, ParquetCatalog
from tablesync.sources.partitioned import PartitionedTable
from tablesync.sources.published import PublishedTable
from tablesync.sources.snapshot import read_csv_lenient, read_snapshot, snapshot_csv
from tablesync.sources.staging import shared_folder, stage

RUN = datetime(2024, 1, 6, 2)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_staged_table(spark):
    staged = stage(spark.range(10).filter("id > 3"), "t")
    assert staged.rows == 6 and staged.path.startswith(f"{shared_folder(spark)}/staged/t-")
    assert staged.read().count() == 6
    staged.release()
    assert not Path(staged.path).exists()
    assert stage(spark.range(0), "none").rows == 0


def test_staging_leaves_no_shuffle_files(spark, tmp_path):
    def shuffles():
        return {f.getName() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()) if f.getName().startswith("shuffle_")}

    before, frees = shuffles(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    stage(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "t")
    table = PartitionedTable(spark, str(tmp_path), "d", "t", key="k")
    table.replace(spark.range(1000).selectExpr("id as k", "timestamp_ntz '2024-01-01 00:00:00' + make_interval(0, cast(id % 3 as int)) as created_at"), RUN)
    table.keyed_replace(table.read().where("k % 2 = 0"), "k", RUN)
    assert spark.conf.get(frees, None) is None and table.read().count() == 1000
    left = time.time() + 10  # they are deleted in the background
    while shuffles() - before and time.time() < left:
        time.sleep(0.2)
    # but for the counts of a row a month or task
    assert len(shuffles() - before) <= 16


def test_shared_folder_follows_the_session(spark):
    def session(master, **conf):
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))

    assert shared_folder(session("yarn", **{"spark.checkpoint.dir": "hdfs:///shared/"})) == "hdfs:///shared"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session("yarn"))
    assert shared_folder(spark) == shared_folder(spark)  # local, unset: one scratch folder


def test_publish_reads_what_it_replaces(spark, tmp_path):
    table = PublishedTable(spark, str(tmp_path), "d", "t")
    assert table.read() is None and not table.exists()
    table.append(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), RUN)
    table.keyed_replace(spark.createDataFrame([(2, "c")], "k int, v string"), "k", RUN)
    table.append(spark.createDataFrame([(2, "d")], "k int, v string"), RUN)
    assert rows(table.read()) == [(1, "a"), (2, "c"), (2, "d")]
    assert len(table.versions()) == 3 and table.versions() == sorted(table.versions())
    # a later run, then a rerun of the earlier one: the last publish is the newest
    table.replace(spark.createDataFrame([(9, "z")], "k int, v string"), datetime(2024, 1, 7, 2))
    table.replace(spark.createDataFrame([(8, "y")], "k int, v string"), RUN)
    assert rows(table.read()) == [(8, "y")]
    assert len(table.expire(2)) == 3 and len(table.versions()) == 2 and rows(table.read()) == [(8, "y")]


def test_failed_publish_changes_nothing(spark, tmp_path):
    table = PublishedTable(spark, str(tmp_path), "d", "t")
    table.replace(spark.createDataFrame([(1, "a")], "k int, v string"), RUN)
    bad = table.read().withColumn("v", F.when(F.col("k") == 1, F.raise_error(F.lit("broken"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="broken"):
        table.replace(bad, RUN)
    assert rows(table.read()) == [(1, "a")]
    table.replace(table.read(), RUN)  # the uncommitted folder is no obstacle
    assert rows(table.read()) == [(1, "a")]


def month_rows(spark, data):
    df = spark.createDataFrame(data, "k string, t string, v int")
    return df.select("k", F.col("t").cast("timestamp_ntz").alias("created_at"), "v")


def test_only_touched_months_are_rewritten(spark, tmp_path):
    table = PartitionedTable(spark, str(tmp_path), "d", "t")
    assert table.read() is None and not table.exists() and not list(tmp_path.iterdir())
    table.replace(month_rows(spark, [("a", "2024-01-03", 1), ("b", "2024-02-03", 2), ("c", "2024-03-03", 3), ("n", None, 4), (None, "2024-02-09", 5)]), RUN)
    before, files = table.folders(), {p: p.stat().st_mtime_ns for p in Path(f"{tmp_path}/d/t/rows").rglob("*.parquet")}
    # b changes in place, c moves to a month of its own and leaves its old one empty
    table.keyed_replace(month_rows(spark, [("b", "2024-02-04", 20), ("b", "2024-02-05", 21), ("c", "2024-04-01", 30)]), "k", RUN)
    assert [(r.k, r.v) for r in table.read().orderBy("v").collect()] == [("a", 1), ("n", 4), (None, 5), ("b", 20), ("b", 21), ("c", 30)]
    after = table.folders()
    assert after.keys() == {None, 202401, 202402, 202404} and all(p.exists() and p.stat().st_mtime_ns == t for p, t in files.items())
    assert (after[None], after[202401]) == (before[None], before[202401]) and after[202402] != before[202402]
    # the older version is still there to be read
    assert table.read(table.versions()[0]).count() == 5
    # the row without a time
    table.keyed_replace(month_rows(spark, [("n", "2024-01-09", 40)]), "k", RUN)
    assert table.read().count() == 6 and rows(table.read().filter("k = 'n'").select("v")) == [(40,)]
    # a new column, and rows added to a month that is there
    table.append(month_rows(spark, [("a", "2024-01-03", 2)]).withColumn("w", F.lit("new")), RUN)
    assert table.read().count() == 7 and rows(table.read().filter("w is not null").select("k", "w")) == [("a", "new")]
    # replace drops every other month; what no kept version names goes
    table.replace(month_rows(spark, [("z", "2024-01-01", 0)]), RUN)
    assert [r.k for r in table.read().collect()] == ["z"]
    assert len(table.expire(1)) == 4 and len(list(Path(f"{tmp_path}/d/t/rows").rglob("created_month=*"))) == 1
    assert [r.k for r in table.read().collect()] == ["z"]
    table.replace(table.read().limit(0), RUN)
    assert table.read().count() == 0 and "w" not in table.read().columns


def test_interrupted_publish_changes_nothing(spark, tmp_path, monkeypatch):
    table = PartitionedTable(spark, str(tmp_path), "d", "t")
    table.replace(month_rows(spark, [("a", "2024-01-03", 1), ("b", "2024-02-03", 2)]), RUN)
    with monkeypatch.context() as m:
        m.setattr(PartitionedTable, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            table.keyed_replace(month_rows(spark, [("a", "2024-03-03", 9)]), "k", RUN)
    again = PartitionedTable(spark, str(tmp_path), "d", "t")
    files = set(tmp_path.rglob("*"))
    assert [(r.k, r.v) for r in again.read().orderBy("k").collect()] == [("a", 1), ("b", 2)]
    assert set(tmp_path.rglob("*")) == files  # readers write nothing
    again.keyed_replace(month_rows(spark, [("a", "2024-03-03", 9)]), "k", RUN)
    assert again.expire(1) and {f.name for f in Path(f"{tmp_path}/d/t/rows").rglob("created_month=*")} == {"created_month=202402", "created_month=202403"}
    assert [(r.k, r.v) for r in again.read().orderBy("k").collect()] == [("a", 9), ("b", 2)]


def test_table_without_times_is_one_month(spark, tmp_path):
    table = PartitionedTable(spark, str(tmp_path), "d", "t")
    table.replace(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), RUN)
    table.keyed_replace(spark.createDataFrame([(2, "c")], "k int, v string"), "k", RUN)
    assert rows(table.read()) == [(1, "a"), (2, "c")] and list(table.folders()) == [None]


def test_bucketed_tables_of_like_paths_are_apart(spark, tmp_path):
    tail = "x" * 110
    one, two = (BucketedTable(spark, f"{tmp_path}/{side}/{tail}", "d", "t", "k", 2) for side in ("staging", "production"))
    one.replace(spark.range(3).selectExpr("id as k"), RUN)
    two.replace(spark.range(5).selectExpr("id as k"), RUN)
    upper = BucketedTable(spark, f"{tmp_path}/STAGING/{tail}", "d", "t", "k", 2)
    upper.replace(spark.range(7).selectExpr("id as k"), RUN)
    assert (one.read().count(), two.read().count(), upper.read().count()) == (3, 5, 7)
    version = one.versions()[0]
    spark.sql(f"DROP TABLE {one._entry(version)}")
    spark.sql(f"CREATE TABLE {one._entry(version)} (k bigint) USING parquet LOCATION '{two.path}/{version}'")
    with pytest.raises(RuntimeError, match="is a table at"):
        one.read()


def test_bucketed_target_is_not_shuffled(spark, settings, tmp_path):
    settings(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    table = BucketedTable(spark, str(tmp_path), "d", "t", "k", 4)
    assert table.read() is None
    table.replace(spark.range(1000).selectExpr("id as k", "id * 2 as v"), RUN)
    delta = spark.range(990, 1010).selectExpr("id as k", "-id as v")
    state = keyed_replace(table.read(), table._placed(delta), "k", placed=True)
    plan = state._jdf.queryExecution().executedPlan().toString()
    target_side = plan[: plan.index("HashAggregate")]
    assert "Bucketed: true" in plan and "Exchange" not in target_side and "LeftAnti" in target_side
    table.keyed_replace(delta, "k", RUN)
    table.append(spark.createDataFrame([(5000, 1)], "k long, v long"), RUN)
    want = {**{i: i * 2 for i in range(990)}, **{i: -i for i in range(990, 1010)}, 5000: 1}
    assert {r.k: r.v for r in table.read().collect()} == want and table.read().count() == len(want)

    # another session finds the version by its folder and registers it with its buckets
    spark.sql(f"DROP TABLE {table._entry(table.versions()[-1])}")
    again = BucketedTable(spark, str(tmp_path), "d", "t", "k", 4)
    assert {r.k: r.v for r in again.read().collect()} == want
    again.keyed_replace(spark.createDataFrame([(5000, 2)], "k long, v long"), "k", RUN)
    assert {r.k: r.v for r in again.read().collect()} == {**want, 5000: 2}
    gone = again.expire(1)
    assert gone and not any(spark.catalog.tableExists(again._entry(v)) for v in gone) and again.read().count() == len(want)
    with pytest.raises(ValueError, match="bucketed by k"):
        again.keyed_replace(delta, "v", RUN)


AWKWARD = [(1, 'a "quoted", text', 1.5, "2024-01-01 02:03:04.000005"), (2, "line\nbreak", None, None), (3, None, -0.1, "2024-01-01"),
           (4, "back\\slash", 1e20, "0001-01-01"), (5, " spaces ", 0.1, "9999-12-31 23:59:59.999999")]


def test_snapshot_round_trip(spark, tmp_path):
    df = spark.createDataFrame(AWKWARD, "i long, s string, d double, t string").withColumn("t", F.col("t").cast("timestamp_ntz"))
    snapshot_csv(df, str(tmp_path), "t", date(2024, 1, 5))
    snapshot_csv(spark.range(1).selectExpr("id i"), str(tmp_path), "t", date(2024, 1, 4))
    back = read_snapshot(spark, str(tmp_path), "t", date(2024, 1, 5), df.schema, multiline=True)
    assert rows(back) == rows(df)
    snapshot_csv(df.limit(1), str(tmp_path), "t", date(2024, 1, 5))  # same day again
    assert read_snapshot(spark, str(tmp_path), "t", date(2024, 1, 5), df.schema).count() == 1
    assert {p.name for p in (tmp_path / "t").iterdir()} == {"run_date=2024-01-04", "run_date=2024-01-05"}


def test_snapshot_shows_empty_text_as_missing(spark, tmp_path):
    df = spark.createDataFrame([(1, ""), (2, None)], "i int, s string")
    snapshot_csv(df.coalesce(1), str(tmp_path), "t", date(2024, 1, 5))
    lines = next((tmp_path / "t" / "run_date=2024-01-05").glob("*.csv")).read_text().splitlines()
    assert lines == ["i,s", "1,", "2,"]


def test_lenient_csv(spark, tmp_path):
    (tmp_path / "x.csv").write_text('a,b,c\n1,  x, 2.5\nbroken,y,1\n2, NA,\n3, "q, r",nan\n4,z,1,extra\n5,z,1,\n6,w\n7,v,x\n')
    schema = T.StructType.fromDDL("a int, b string, c double")
    want = [(None, "y", 1.0), (1, "x", 2.5), (2, None, None), (3, "q, r", None), (6, "w", None), (7, "v", None)]
    got = read_csv_lenient(spark, f"{tmp_path}/x.csv", schema)
    assert rows(got) == sorted(want, key=repr)
    assert rows(got.select("b")) == sorted([r[1:2] for r in want], key=repr) and got.count() == len(want)


def test_lenient_csv_takes_fields_of_a_megabyte(spark, tmp_path):
    long = "word, " * 200_000
    (tmp_path / "x.csv").write_text(f'1,"{long}",2\n2,"{long}"\n3,"say ""{long}""",4\n4,short\n')
    got = read_csv_lenient(spark, f"{tmp_path}/x.csv", T.StructType.fromDDL("a int, b string"), header=False)
    assert rows(got.selectExpr("a", "length(b)")) == [(2, len(long)), (4, 5)]


def test_catalogs(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/gateway/users")
    assert ParquetCatalog(spark, str(tmp_path)).scan("gateway.users").count() == 3
    assert ParquetCatalog(spark, str(tmp_path)).declared("gateway.users") == [("id", "bigint")]
    frames = FrameCatalog({"a.b": lambda: spark.range(2), "a.c": spark.range(1)}, {"a.c": [("id", "int(11)")]})
    assert frames.scan("a.b").count() == 2 and frames.declared("a.b") == [("id", "bigint")]
    assert frames.declared("a.c") == [("id", "int(11)")]


def test_database_reads_are_sliced(spark):
    catalog = JdbcCatalog(spark, "jdbc:mysql://host/db", {"user": "u"}, slices=2)
    assert catalog.predicates(daily_window(RUN), "updated_at") == [
        "updated_at >= '2024-01-05 00:00:00.000000' AND updated_at < '2024-01-05 13:00:00.000000'",
        "updated_at >= '2024-01-05 13:00:00.000000' AND updated_at < '2024-01-06 02:00:00.000000'",
    ]
    catalog = JdbcCatalog(spark, "jdbc:mysql://host/db", {}, slices=3, slice_by={"gateway.users": "created_at"}, namespaces={"gateway": "shop"})
    assert catalog.whole_predicates(datetime(2024, 1, 1), datetime(2024, 1, 4), "created_at") == [
        "created_at < '2024-01-02 00:00:00.000000'",
        "created_at >= '2024-01-02 00:00:00.000000' AND created_at < '2024-01-03 00:00:00.000000'",
        "created_at >= '2024-01-03 00:00:00.000000'", "created_at IS NULL",
    ]
    assert catalog.whole_predicates(None, None, "created_at") == ["1 = 1"]
    one = JdbcCatalog(spark, "jdbc:mysql://host/db", {}, slices=1)
    assert one.whole_predicates(datetime(2024, 1, 1), datetime(2024, 1, 4), "created_at") == ["1 = 1"]
    assert "table_schema = 'shop' AND table_name = 'users'" in catalog.declared_query("gateway.users")
    assert "table_schema = 'gateway'" in one.declared_query("gateway.users") and one.properties["fetchsize"] == "10000"
    assert JdbcCatalog(spark, "", {"fetchsize": "5"}).properties["fetchsize"] == "5"
    with pytest.raises(ValueError):
        JdbcCatalog(spark, "", {}, slices=0)


def test_database_reads_of_whole_tables_and_of_keys(spark, monkeypatch):
    """What is asked of the database; the reads themselves need one and are not run here."""
    asked = []
    catalog = JdbcCatalog(spark, "jdbc:mysql://host/db", {}, slices=2, namespaces={"gateway": "shop"}, match_keys=3)
    bounds = spark.sql("select timestamp_ntz '2024-01-01' lo, timestamp_ntz '2024-01-03' hi")
    monkeypatch.setattr(catalog, "_read", lambda table, predicates: asked.append((table, predicates)) or spark.range(1))
    monkeypatch.setattr(catalog, "_query", lambda text: asked.append(text) or bounds)
    monkeypatch.setattr(catalog, "declared", lambda table: [("uuid", "varchar(36)")] + [("created_at", "datetime")] * (table == "gateway.users"))
    catalog.scan("gateway.users")
    assert asked == ["SELECT min(created_at) AS lo, max(created_at) AS hi FROM shop.users", ("gateway.users", [
        "created_at < '2024-01-02 00:00:00.000000'", "created_at >= '2024-01-02 00:00:00.000000'", "created_at IS NULL"])]
    catalog.scan("gateway.plain")
    assert asked[-1] == ("gateway.plain", None)
    keys = spark.createDataFrame([("a",), ("it's",), ("a",), (None,), ("b\\",)], "key string")
    catalog.scan_matching("gateway.users", "uuid", keys)
    assert asked[-1] == ("gateway.users", ["uuid IN ('a', 'b\\\\')", "uuid IN ('it''s')"])
    catalog.scan_matching("gateway.users", "uuid", spark.range(0).selectExpr("id as key"))
    assert asked[-1] == ("gateway.users", ["1 = 0"])
    assert catalog.scan_matching("gateway.users", "uuid", spark.range(9).selectExpr("id as key")) is None
    assert catalog.scan_matching("gateway.users", "uuid", spark.sql("select 1.5 as key")) is None
