"""Queries of table maintenance: key filters, arrival order, re-inference, reconciliation, ledgers and the like."""

from __future__ import annotations

import uuid
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.functions import lattice, times
from tablesync.operators.arrival import keep_first_arrived, with_arrival
from tablesync.operators.reconcile import differing_keys
from tablesync.operators.slices import slice_edges, slice_predicates
from tablesync.operators.window import Window, change_window
from tablesync.plans.ledger import RunLedger
from tablesync.sources.partitioned import PartitionedTable
from tablesync.sources.staging import shared_folder

from .base import LOWER, RUN_TS, UPPER, WINDOW, Tables, query


def _monthly(t: Tables, name: str, **more) -> PartitionedTable:
    return PartitionedTable(t.spark, shared_folder(t.spark), f"monthly-{uuid.uuid4().hex}", name, **more)


_LATE = "o_orderdate >= date '2001-06-01'"


@query("publish_by_filter", f"""
select * from {{orders}} t where not exists (select 1 from {{orders}} d where d.{_LATE} and d.o_orderkey = t.o_orderkey)
union all select * replace (case when o_orderkey % 2 = 0 then o_totalprice + 1 else o_totalprice end as o_totalprice) from {{orders}} where {_LATE}""")
def _(t: Tables) -> DataFrame:
    # the filters name the folders to open; odd keys do not change and leave the replace
    table = _monthly(t, "orders", time_column="o_orderdate", key="o_orderkey")
    table.replace(t.orders, RUN_TS)
    delta = t.orders.where(F.col("o_orderdate") >= times.at(datetime(2001, 6, 1))).withColumn(
        "o_totalprice", F.when(F.col("o_orderkey") % 2 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    table.keyed_replace(delta, "o_orderkey", RUN_TS, skip_unchanged=True)
    return table.read()


_DAY = "strftime({c}, '%Y%m%d')"


@query("purge_by_folder", f"""
select *, case when event_id % 50 = 0 then null else strftime(ts, '%Y%m%d') end as ymd from {{events}}
where event_id % 50 = 0 or not (cast(ts as date) > date '2024-01-20' - 4)""")
def _(t: Tables) -> DataFrame:
    # a folder a month: those after the bound leave by the manifest, the one it cuts is rewritten
    day = F.when(F.col("event_id") % 50 != 0, F.date_format("ts", "yyyyMMdd"))
    table = _monthly(t, "events", time_column="ts", day_column="ymd")
    table.replace(t.events.withColumn("ymd", day), RUN_TS)
    table.purge(date(2024, 1, 20), RUN_TS)
    return table.read()


@query("append_once", "select * from {customer} union all select * replace (c_custkey + 1000000 as c_custkey) from {customer} where c_custkey % 3 = 0")
def _(t: Tables) -> DataFrame:
    # the second append is run twice, as a repeated job would
    table = _monthly(t, "customer")
    table.append(t.customer, RUN_TS, token="first")
    more = t.customer.where("c_custkey % 3 = 0").withColumn("c_custkey", F.col("c_custkey") + 1000000)
    for _ in range(2):
        table.append(more, RUN_TS, token="second")
    return table.read()


@query("changing_types", """
select o_orderkey, o_orderdate, case when o_orderdate >= date '1998-01-01' then 'n' || cast(o_custkey as varchar) else cast(o_custkey as varchar) end as code,
  case when o_orderdate >= date '2000-01-01' then o_totalprice else cast(o_custkey as double) end as amount,
  case when o_orderdate >= date '2000-01-01' then o_orderstatus end as later
from {orders}""")
def _(t: Tables) -> DataFrame:
    # whole numbers, then texts in one column; whole numbers, then doubles in another; a column that comes later
    table = _monthly(t, "orders", time_column="o_orderdate", key="o_orderkey")
    edges = [datetime(1998, 1, 1), datetime(2000, 1, 1)]
    d, number = F.col("o_orderdate"), F.col("o_custkey").cast("int")
    eras = [
        (d < times.at(edges[0]), [number.alias("code"), number.alias("amount")]),
        ((d >= times.at(edges[0])) & (d < times.at(edges[1])), [F.concat(F.lit("n"), number.cast("string")).alias("code"), F.col("o_custkey").alias("amount")]),
        (d >= times.at(edges[1]), [F.concat(F.lit("n"), number.cast("string")).alias("code"), F.col("o_totalprice").alias("amount"), F.col("o_orderstatus").alias("later")]),
    ]
    for i, (when, columns) in enumerate(eras):
        table.append(t.orders.where(when).select("o_orderkey", "o_orderdate", *columns), RUN_TS + timedelta(days=i))
    return table.read()


@query("reload_inferred", """
select c_custkey, c_custkey as zeros, cast(c_nationkey as double) as gaps, c_acctbal as balance, c_custkey % 2 = 0 as truth,
  case when c_custkey % 3 = 0 then null else 'True' end as half_truth, cast(null as double) as nothing,
  cast(18446744073709551615 as decimal(20,0)) - c_custkey as huge, c_name as name, cast(c_custkey as varchar) || 'x' as almost
from {customer}
where c_custkey % 3 <> 0 union all
select c_custkey, c_custkey, null, c_acctbal, c_custkey % 2 = 0, null, null, cast(18446744073709551615 as decimal(20,0)) - c_custkey, c_name, cast(c_custkey as varchar) || 'x'
from {customer} where c_custkey % 3 = 0""")
def _(t: Tables) -> DataFrame:
    # every step of the lattice: leading zeros, whole numbers with and without gaps, beyond 64 bits, truth values, nothing at all
    rows = t.customer.select(
        "c_custkey", F.lpad(F.col("c_custkey").cast("string"), 12, "0").alias("zeros"),
        F.when(F.col("c_custkey") % 3 != 0, F.col("c_nationkey").cast("string")).alias("gaps"), F.col("c_acctbal").cast("string").alias("balance"),
        F.when(F.col("c_custkey") % 2 == 0, "True").otherwise("FALSE").alias("truth"), F.when(F.col("c_custkey") % 3 != 0, "True").alias("half_truth"),
        F.lit(None).cast("string").alias("nothing"),
        (F.lit("18446744073709551615").cast("decimal(20,0)") - F.col("c_custkey")).cast("decimal(20,0)").cast("string").alias("huge"), F.col("c_name").alias("name"),
        F.concat(F.col("c_custkey").cast("string"), F.lit("x")).alias("almost"))
    return lattice.reinfer(rows)


@query("dedupe_arrival", """
select * exclude (place, rn) from (select *, row_number() over (partition by l_orderkey order by place) as rn
  from (select *, row_number() over () as place from {lineitem})) where rn = 1""")
def _(t: Tables) -> DataFrame:
    # the first line of each order as the file has them, whatever the partitions
    return keep_first_arrived(with_arrival(t.lineitem).repartition(7), "l_orderkey")


@query("depth_slices", "select * replace (case when event_id % 3 = 0 then timestamp '2024-01-10 00:00:00' else ts end as ts) from {events}")
def _(t: Tables) -> DataFrame:
    # a third of the rows share one time, as after a bulk update; the slices together hold every row once
    rows = t.events.withColumn("ts", F.when(F.col("event_id") % 3 == 0, times.at(datetime(2024, 1, 10))).otherwise(F.col("ts")))
    parts = [rows.where(p) for p in slice_predicates(slice_edges(rows, "ts", "event_id", 6), "ts", "event_id")]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


@query("reconcile", """
select o_orderkey, case when o_orderkey % 97 = 5 then 'missing' when o_orderkey % 89 = 7 then 'changed' else 'extra' end as status from (
  select o_orderkey from {orders} where o_orderkey % 97 = 5 or o_orderkey % 89 = 7
  union all select -o_orderkey - 1 from {orders} where o_orderkey % 101 = 3)""")
def _(t: Tables) -> DataFrame:
    # rows a change window never shows: deleted, written late, and left behind
    k = F.col("o_orderkey")
    late = F.when(k % 89 == 7, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    extra = t.orders.where(k % 101 == 3).withColumn("o_orderkey", -k - 1)
    target = t.orders.where(k % 97 != 5).withColumn("o_totalprice", late).unionByName(extra)
    return differing_keys(t.orders, target, "o_orderkey", small=500)


@query("ledger_runs", f"select * from {{events}} where ts >= {LOWER} - interval '3' day and ts < {UPPER}")
def _(t: Tables) -> DataFrame:
    # a run two days later makes up the skipped ones, a repeated one reads nothing; together they hold every change once
    ledger, seen = RunLedger(t.spark, shared_folder(t.spark), uuid.uuid4().hex, "events"), []

    def work(window: Window) -> None:
        seen.append(change_window(t.events, "ts", window))

    start = WINDOW.lower - timedelta(days=3)
    ledger.run(start + timedelta(days=1), work, start)
    for _ in range(2):
        ledger.run(WINDOW.upper, work)
    whole = seen[0]
    for rows in seen[1:]:
        whole = whole.unionByName(rows)
    return whole
