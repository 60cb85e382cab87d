"""One query per operator over the test tables."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions import masks, text, times, types
from tablesync.operators import aggregates, columns, joins, replace
from tablesync.operators.heavy import heavy_keys
from tablesync.operators.window import change_window, change_window_raw, changed_groups, contiguous_window
from tablesync.plans import SPECS, run_job
from tablesync.plans.runner import enriched, masked, published_table, settled, snapshot_name
from tablesync.sources.bucketed import BucketedTable
from tablesync.sources.catalog import FrameCatalog
from tablesync.sources.partitioned import PartitionedTable
from tablesync.sources.published import PublishedTable, scan_published
from tablesync.sources.snapshot import read_csv_lenient, read_snapshot, snapshot_csv
from tablesync.sources.staging import shared_folder, stage

from . import sqltext
from .base import LOWER, RUN_TS, UPPER, WINDOW, Tables, query
from .sources import frames

# --- derived inputs, valid in Spark and DuckDB alike -------------------------------

CONTACTS = """
select c_custkey, c_name, c_acctbal,
  case c_custkey % 8 when 0 then null when 1 then '' when 2 then '+62 8' || cast(c_custkey * 7919 as varchar(20))
    when 3 then '021-' || cast(c_custkey as varchar(20)) when 4 then 'no digits' when 5 then '628'
    when 6 then '0812' || cast(c_custkey as varchar(20)) else 'x1' end as phone,
  case c_custkey % 9 when 0 then null when 1 then ''
    when 2 then 'user' || cast(c_custkey as varchar(20)) || '@gmail.com' when 3 then 'ab@Yahoo.COM'
    when 4 then 'budi@acme.co.id' when 5 then 'nodomain' when 6 then 'a@b@c' when 7 then 'abcd@' else 'budi@h' end as email
from {customer}
"""

# all e-mail-like and phone-like pieces of whole texts
EMAIL_LIKE, PHONE_LIKE = "[A-Za-z0-9._-]+@[A-Za-z0-9.-]+", "[+]?[0-9][0-9 ()-]+[0-9]"

LOOSE_VALUES = """
select c_custkey,
  case c_custkey % 7 when 0 then '12.50' when 1 then null when 2 then ' 3e2 ' when 3 then '-7' when 4 then '.5'
    when 5 then '+4.' else cast(c_custkey as varchar(20)) end as number_text,
  case c_custkey % 5 when 0 then '12x' when 1 then null else '7' end as broken_text,
  case c_custkey % 4 when 0 then '2024-02-28 10:00:00' when 1 then null when 2 then '2024-02-28' else '2023-12-31 23:59:59.5' end
    as time_text,
  case c_custkey % 6 when 0 then '2024-02-30 00:00:00' when 1 then 'soon' when 2 then '9999-12-31 00:00:00'
    when 3 then null when 4 then '1500-01-01 00:00:00' else '2024-02-28 10:00:00' end as mixed_time,
  case c_custkey % 19 when 0 then '' when 1 then '#N/A' when 2 then '#N/A N/A' when 3 then '#NA' when 4 then '-1.#IND'
    when 5 then '-1.#QNAN' when 6 then '-NaN' when 7 then '-nan' when 8 then '1.#IND' when 9 then '1.#QNAN'
    when 10 then '<NA>' when 11 then 'N/A' when 12 then 'NA' when 13 then 'NULL' when 14 then 'NaN' when 15 then 'n/a'
    when 16 then 'nan' when 17 then 'null' else 'None' end as token,
  case c_custkey % 6 when 0 then '  plain' when 1 then '  a, b' when 2 then ' NA' when 3 then '   ' when 4 then ' "q"'
    else c_name end as spaced,
  cast(c_custkey % 11 as double) / 7 * 1000000 * (c_custkey + 1) as ratio,
  c_nationkey, c_acctbal, c_name
from {customer}
"""

DAYS = """
select event_id, user_id,
  case when event_id % 10 = 3 then null
    else substr(replace(cast(ts as varchar(30)), '-', ''), 1, 8) end as ymd
from {events}
"""


# --- scans, sources, sinks ---------------------------------------------------------

_DELTA = "select * replace (o_totalprice + 1 as o_totalprice) from {orders} where o_orderdate >= date '2001-01-01'"
ORDERS = "select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority from {orders}"


@query("scan", ORDERS)
def _(t: Tables) -> DataFrame:
    return t.orders


@query("declared_types", """
select field, type, count(v) as non_null, count(*) as n from (
  select 'l_orderkey' as field, 'bigint' as type, cast(l_orderkey as varchar) as v from {lineitem}
  union all select 'l_linenumber', 'int', cast(l_linenumber as varchar) from {lineitem}
  union all select 'l_quantity', 'double', cast(l_quantity as varchar) from {lineitem}
  union all select 'l_returnflag', 'text', l_returnflag from {lineitem}
  union all select 'l_shipdate', 'datetime', cast(l_shipdate as varchar) from {lineitem}
) group by field, type""")
def _(t: Tables) -> DataFrame:
    # the declared schema joined to what a profile of the data says
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate")
    declared = types.declared_schema(rows).select(F.col("Field").alias("field"), F.col("Type").alias("declared"))
    counted = aggregates.profile_non_null(rows).select(F.col("column").alias("field"), "non_null", F.col("rows").alias("n"))
    return counted.join(declared, "field").select("field", F.col("declared").alias("type"), "non_null", "n")


def _published(t: Tables, name: str) -> PublishedTable:
    return PublishedTable(t.spark, shared_folder(t.spark), "published", f"{name}-{datetime.now():%Y%m%d%H%M%S%f}")


@query("publish_and_read_back", ORDERS)
def _(t: Tables) -> DataFrame:
    table = _published(t, "orders")
    table.replace(t.orders, RUN_TS)
    return table.read()


@query("scan_published", """
select c_mktsegment, o_orderstatus, count(*) as n from {orders} join {customer} on c_custkey = o_custkey
group by c_mktsegment, o_orderstatus""")
def _(t: Tables) -> DataFrame:
    orders, customers = _published(t, "orders"), _published(t, "customers")
    orders.replace(t.orders, RUN_TS)
    customers.replace(t.customer, RUN_TS)
    return scan_published(t.spark, """
        select c_mktsegment, o_orderstatus, count(*) as n from {orders} join {customers} on c_custkey = o_custkey
        group by c_mktsegment, o_orderstatus""", {"orders": orders, "customers": customers})


@query("publish_bucketed", f"""
select * from {{orders}} t where not exists (select 1 from ({_DELTA}) d where d.o_orderkey = t.o_orderkey)
union all select * from ({_DELTA})""")
def _(t: Tables) -> DataFrame:
    # the table is laid out by its key and stays where it is
    name = f"orders-{datetime.now():%Y%m%d%H%M%S%f}"
    table = BucketedTable(t.spark, shared_folder(t.spark), "bucketed", name, "o_orderkey", 8)
    table.replace(t.orders, RUN_TS)
    table.keyed_replace(_late_orders(t), "o_orderkey", RUN_TS)
    return table.read()


@query("publish_by_month", f"""
select * from {{orders}} t where not exists (
  select 1 from {{orders}} d where d.o_orderdate >= date '2001-01-01' and d.o_orderkey = t.o_orderkey)
union all select * replace (o_totalprice + 1 as o_totalprice) from {{orders}} where o_orderdate >= date '2001-01-01'""")
def _(t: Tables) -> DataFrame:
    # only the months of the late orders are rewritten
    name = f"orders-{datetime.now():%Y%m%d%H%M%S%f}"
    table = PartitionedTable(t.spark, shared_folder(t.spark), "monthly", name, "o_orderdate")
    table.replace(t.orders, RUN_TS)
    table.keyed_replace(_late_orders(t), "o_orderkey", RUN_TS)
    return table.read()


@query("snapshot_csv", ORDERS)
def _(t: Tables) -> DataFrame:
    root = f"{shared_folder(t.spark)}/snapshots-{datetime.now():%Y%m%d%H%M%S%f}"
    snapshot_csv(t.orders, root, "orders", RUN_TS.date())
    return read_snapshot(t.spark, root, "orders", RUN_TS.date(), t.orders.schema)


@query("snapshot_long_text", "select doc_id, case when text = '' then null else text end as text, lang from {documents}")
def _(t: Tables) -> DataFrame:
    # line breaks, commas and quotes inside fields; whole texts
    root = f"{shared_folder(t.spark)}/snapshots-{datetime.now():%Y%m%d%H%M%S%f}"
    rows = t.documents.select("doc_id", "text", "lang")
    snapshot_csv(rows, root, "documents", RUN_TS.date())
    return read_snapshot(t.spark, root, "documents", RUN_TS.date(), rows.schema, multiline=True)


@query("snapshot_renamed", """
select 'cr' || cast(event_id as varchar(20)) as company_referral_used_id, value as reward from {events}""")
def _(t: Tables) -> DataFrame:
    # the snapshot of a run, read by the names of its header
    spec, root = SPECS["company_referral_used"], f"{shared_folder(t.spark)}/renamed-{datetime.now():%Y%m%d%H%M%S%f}"
    run_job(spec, FrameCatalog(frames(t)), f"{root}/published", RUN_TS, f"{root}/snapshots")
    path = f"{root}/snapshots/{snapshot_name(spec)}/run_date={WINDOW.lower:%Y-%m-%d}"
    return t.spark.read.option("header", True).csv(path).select("company_referral_used_id", F.col("reward").cast("double").alias("reward"))


@query("csv_lenient", f"""
select l_orderkey, case when l_linenumber = 5 then null else l_partkey end as l_partkey,
  case when l_linenumber = 5 then null else {sqltext.na("l_returnflag")} end as l_returnflag
from {{lineitem}} where l_linenumber <> 3""")
def _(t: Tables) -> DataFrame:
    # lines numbered 3 have a field too many and are skipped, lines numbered 5 are short
    path = f"{shared_folder(t.spark)}/lines-{datetime.now():%Y%m%d%H%M%S%f}"
    number = F.col("l_linenumber")
    fields = F.when(number == 5, F.array(F.col("l_orderkey").cast("string"))).otherwise(
        F.array(F.col("l_orderkey").cast("string"), F.col("l_partkey").cast("string"), F.col("l_returnflag"))
    )
    fields = F.when(number == 3, F.array_append(fields, "more")).otherwise(fields)
    t.lineitem.select(F.array_join(fields, ",  ").alias("value")).write.text(path)
    schema = T.StructType.fromDDL("l_orderkey bigint, l_partkey bigint, l_returnflag string")
    return read_csv_lenient(t.spark, path, schema, header=False)


@query("csv_lenient_long", """
select doc_id, case when doc_id % 5 = 2 then null else replace(text, chr(10), ' ') end as text
from {documents} where doc_id % 5 <> 1""")
def _(t: Tables) -> DataFrame:
    # whole texts as quoted fields; of five lines one has a field too many and one is short
    path = f"{shared_folder(t.spark)}/texts-{datetime.now():%Y%m%d%H%M%S%f}"
    number, key = F.col("doc_id") % 5, F.col("doc_id").cast("string")
    flat = F.translate("text", "\n", " ")
    quoted = F.concat(F.lit('"'), F.replace(flat, F.lit('"'), F.lit('""')), F.lit('"'))
    line = F.when(number == 1, F.concat_ws(",", key, quoted, quoted)).when(number == 2, key).otherwise(F.concat_ws(",", key, quoted))
    t.documents.select(line.alias("value")).write.text(path)
    return read_csv_lenient(t.spark, path, T.StructType.fromDDL("doc_id bigint, text string"), header=False)


@query("reload_lenient", f"""
select c_custkey, {sqltext.na("case when regexp_matches(spaced, '[,\"]') then spaced else ltrim(spaced, ' ') end")} as spaced
from ({LOOSE_VALUES})""")
def _(t: Tables) -> DataFrame:
    return text.na_normalise(t.sql(LOOSE_VALUES).select("c_custkey", "spaced"), lenient=True)


@query("append", f"{ORDERS} union all {ORDERS} where o_orderstatus = 'F'")
def _(t: Tables) -> DataFrame:
    return replace.append_rows(t.orders, t.orders.filter("o_orderstatus = 'F'"))


@query("staged_rows", "select o_custkey, count(*) as n from {orders} group by o_custkey")
def _(t: Tables) -> DataFrame:
    return stage(t.orders.select("o_custkey"), "orders").read().groupBy("o_custkey").agg(F.count("*").alias("n"))


# --- filters -----------------------------------------------------------------------

_IN_WINDOW = f"ts >= {LOWER} and ts < {UPPER}"


@query("change_window", f"select * from {{events}} where {_IN_WINDOW}")
def _(t: Tables) -> DataFrame:
    return change_window(t.events, "ts", RUN_TS)


@query("change_window_raw", f"select event_id, ts from {{events}} where ts >= date '2024-01-05' and ts < {UPPER}")
def _(t: Tables) -> DataFrame:
    return change_window_raw(t.events, "ts", RUN_TS).select("event_id", "ts")


@query("contiguous_windows", f"select * from {{events}} where ts >= {LOWER} and ts < timestamp '2024-01-08 02:00:00'")
def _(t: Tables) -> DataFrame:
    # two runs in a row see every change once
    first = contiguous_window(datetime(2024, 1, 5), RUN_TS)
    second = contiguous_window(first.upper, datetime(2024, 1, 8, 2))
    return change_window(t.events, "ts", first).unionByName(change_window(t.events, "ts", second))


@query("changed_groups", f"""
select * from {{events}} where user_id in (select user_id from {{events}} where {_IN_WINDOW})""")
def _(t: Tables) -> DataFrame:
    return changed_groups(t.events, "ts", RUN_TS, "user_id")


@query("all_non_zero", """
select * from {lineitem} where l_quantity <> 0 and l_extendedprice <> 0 and l_discount <> 0 and l_tax <> 0""")
def _(t: Tables) -> DataFrame:
    return columns.all_non_zero(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])


@query("skip_if_empty", """
select uuid as sms_log_id, case when attempts < 0 then 1 else 1 end as versions, 'empty' as status
from (select 'sms' || cast(event_id as varchar(20)) as uuid, user_id as attempts from {events})""")
def _(t: Tables) -> DataFrame:
    # a run without changes publishes nothing: the table stays, with the one version it had
    spec, root = SPECS["sms_logs"], f"{shared_folder(t.spark)}/skip-{datetime.now():%Y%m%d%H%M%S%f}"
    catalog = FrameCatalog(frames(t))
    table = published_table(spec, t.spark, root)
    table.replace(settled(spec, masked(spec, enriched(spec, catalog.scan(spec.source), catalog)), catalog), RUN_TS)
    status = run_job(spec, catalog, root, datetime(2050, 1, 1)).status
    return table.read().select("sms_log_id", F.lit(len(table.versions())).alias("versions"), F.lit(status).alias("status"))


DECLARED_TEXTS = """
select l_orderkey, l_linenumber, case l_partkey % 12 when 0 then 'varchar(' || cast(l_suppkey as varchar(9)) || ')'
  when 1 then 'date' when 2 then 'datetime' when 3 then 'text' when 4 then 'longtext' when 5 then 'tinyint(1)'
  when 6 then 'bigint(20) unsigned' when 7 then 'double' when 8 then 'decimal(18,2)' when 9 then 'timestamp'
  when 10 then 'point' else 'json' end as declared
from {lineitem}
"""


@query("type_pattern_match", f"""
select kind, count(*) as n, count(distinct declared) as spellings from (select declared,
  case when declared like '%char%' then 'text' when declared in ('date', 'text') then 'text'
    when contains(declared, 'int') then 'number' when contains(declared, 'double') then 'number'
    when contains(declared, 'time') then 'time' end as kind
  from ({DECLARED_TEXTS})) group by kind""")
def _(t: Tables) -> DataFrame:
    rows = t.sql(DECLARED_TEXTS).withColumn("kind", types.type_class_of("declared"))
    return rows.groupBy("kind").agg(F.count("*").alias("n"), F.countDistinct("declared").alias("spellings"))


@query("before_year", f"{ORDERS} where year(o_orderdate) < 1998")
def _(t: Tables) -> DataFrame:
    return t.orders.filter(times.before_year("o_orderdate", 1998))


@query("on_day", "select * from {events} where cast(ts as date) = date '2024-01-05'")
def _(t: Tables) -> DataFrame:
    return t.events.filter(times.on_day("ts", date(2024, 1, 5)))


# --- projections -------------------------------------------------------------------


@query("star_and_lookup_columns", """
select o.*, c_name as customer_name, c_mktsegment as segment from {orders} o left join {customer} on c_custkey = o_custkey""")
def _(t: Tables) -> DataFrame:
    return joins.lookup(
        t.orders, t.customer, {"o_custkey": "c_custkey"}, {"customer_name": "c_name", "segment": "c_mktsegment"}
    )


@query("explicit_projection", """
select l_orderkey, l_linenumber as line, l_quantity, l_shipdate, l_returnflag as flag, l_partkey, l_suppkey from {lineitem}""")
def _(t: Tables) -> DataFrame:
    return columns.project(t.lineitem, {
        "l_orderkey": "l_orderkey", "line": "l_linenumber", "l_quantity": "l_quantity", "l_shipdate": "l_shipdate",
        "flag": "l_returnflag", "l_partkey": "l_partkey", "l_suppkey": "l_suppkey",
    })


@query("rename", "select * rename (c_custkey as customer_id) from {customer}")
def _(t: Tables) -> DataFrame:
    return columns.rename(t.customer, {"c_custkey": "customer_id", "not_there": "x"})


@query("rename_swap", """
select o_orderkey as plan_item_id, o_custkey as o_orderkey, o_totalprice from {orders}""")
def _(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    return columns.rename_swap(rows, {"o_orderkey": "plan_item_id", "o_custkey": "o_orderkey"})


@query("drop_columns", "select o_orderkey, o_custkey, o_orderstatus, o_totalprice from {orders}")
def _(t: Tables) -> DataFrame:
    return columns.drop_columns(t.orders, ["o_orderdate", "o_orderpriority"])


@query("drop_sort_columns", "select o_custkey, o_orderdate, o_orderkey, o_orderstatus, o_totalprice from {orders}")
def _(t: Tables) -> DataFrame:
    return columns.drop_and_sort_columns(t.orders, ["o_orderpriority"])


@query("shift_replace", "select * replace (ts + interval '7' hour as ts) from {events}")
def _(t: Tables) -> DataFrame:
    return columns.shift_and_replace(t.events, ["ts"], 7)


@query("shift_in_place", """
select o_orderkey, o_orderdate + interval '14' hour as o_orderdate, l_partkey, l_shipdate + interval '7' hour as shipped
from {orders} left join {lineitem} on l_orderkey = o_orderkey""")
def _(t: Tables) -> DataFrame:
    base = columns.shift_and_replace(t.orders.select("o_orderkey", "o_orderdate"), ["o_orderdate"], 14, move_to_end=False)
    rows = joins.fan_out(base, t.lineitem, {"o_orderkey": "l_orderkey"}, {"l_partkey": "l_partkey", "shipped": "l_shipdate"})
    return rows.withColumn("shipped", times.shift_hours("shipped", 7))


@query("copy_column", "select *, c_name as location_name from {customer}")
def _(t: Tables) -> DataFrame:
    return columns.copy_column(t.customer, "c_name", "location_name")


@query("overwrite_from", """
select l_orderkey, l_linenumber, l_shipdate, l_shipdate as updated_at, l_shipdate as deleted_at from {lineitem}""")
def _(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate").withColumns(
        {"updated_at": F.lit(None).cast("timestamp_ntz"), "deleted_at": F.lit(None).cast("timestamp_ntz")}
    )
    return columns.overwrite_from(rows, ["updated_at", "deleted_at"], "l_shipdate")


@query("replace_by_lookup", """
select c_custkey, c_name, n_name as c_nationkey from {customer}
left join {nation} on n_nationkey = c_nationkey and c_nationkey % 5 <> 2""")
def _(t: Tables) -> DataFrame:
    unknown = F.when(F.col("c_nationkey") % 5 != 2, F.col("c_nationkey")).otherwise(-1)  # keys without a match
    rows = t.customer.select("c_custkey", "c_name", unknown.alias("c_nationkey"))
    return joins.replace_by_lookup(rows, t.nation, "c_nationkey", "n_nationkey", "n_name")


# --- joins -------------------------------------------------------------------------


@query("lookup_chain", """
select c_custkey, c_name, n_name as nation, case when n_regionkey = 2 then 99 else n_regionkey end as region_key, r_name as region
from {customer} left join {nation} on n_nationkey = c_nationkey
left join {region} on r_regionkey = case when n_regionkey = 2 then 99 else n_regionkey end""")
def _(t: Tables) -> DataFrame:
    # one region's number is unknown to the second lookup
    nation = t.nation.withColumn("n_regionkey", F.when(F.col("n_regionkey") == 2, 99).otherwise(F.col("n_regionkey")))
    one = joins.lookup(
        t.customer.select("c_custkey", "c_name", "c_nationkey"), nation, {"c_nationkey": "n_nationkey"},
        {"nation": "n_name", "region_key": "n_regionkey"},
    ).drop("c_nationkey")
    return joins.lookup(one, t.region, {"region_key": "r_regionkey"}, {"region": "r_name"})


@query("fan_out", """
select c_custkey, c_name, o_orderkey, o_totalprice from {customer}
left join {orders} on c_custkey = case when o_custkey % 3 = 1 then -1 else o_custkey end""")
def _(t: Tables) -> DataFrame:
    # customers without a match, and matches of no customer; sides written first, and split where a key is hot
    held = []

    def staging(df: DataFrame, label: str) -> DataFrame:
        held.append(stage(df, label))
        return held[-1].read()

    right = t.orders.withColumn("o_custkey", F.when(F.col("o_custkey") % 3 == 1, -1).otherwise(F.col("o_custkey")))
    return joins.fan_out(
        t.customer.select("c_custkey", "c_name"), right, {"c_custkey": "o_custkey"},
        {"o_orderkey": "o_orderkey", "o_totalprice": "o_totalprice"}, staging,
    )


_MANY_ON_ONE = "case when l_partkey % 3 = 0 then -1 else l_partkey end"


@query("heavy_keys", f"""
select part, count(*) as rows from (select {_MANY_ON_ONE} as part, l_linenumber from {{lineitem}})
group by part having count(*) * 500 >= (select count(*) from {{lineitem}})""")
def _(t: Tables) -> DataFrame:
    return heavy_keys(t.lineitem.select(F.expr(_MANY_ON_ONE).alias("part")), ["part"], share=0.002)


@query("fan_out_salted", f"""
select p_partkey, p_name, l_orderkey, l_linenumber from (
  select p_partkey, p_name from {{part}} union all select -1, 'any' from {{region}} where r_regionkey = 0)
left join {{lineitem}} on p_partkey = {_MANY_ON_ONE}""")
def _(t: Tables) -> DataFrame:
    # a third of all rows has one key: it is found while the rows are written, and dealt over salts
    any_part = t.region.where("r_regionkey = 0").selectExpr("-1 as p_partkey", "'any' as p_name")
    base = t.part.select("p_partkey", "p_name").unionAll(any_part)
    right = t.lineitem.withColumn("part", F.expr(_MANY_ON_ONE).cast(base.schema["p_partkey"].dataType))
    return joins.staged_fan_out(
        base, right, {"p_partkey": "part"}, {"l_orderkey": "l_orderkey", "l_linenumber": "l_linenumber"},
        lambda df, label: stage(df, label).read(), hot_rows=1000)


@query("fan_out_lazy", """
select c_custkey, o_orderkey from {customer} left join {orders} on c_custkey = o_custkey""")
def _(t: Tables) -> DataFrame:
    return joins.fan_out(t.customer.select("c_custkey"), t.orders, {"c_custkey": "o_custkey"}, {"o_orderkey": "o_orderkey"})


@query("two_joins_off_one_base", """
select o_orderkey, c_name, l_partkey, l_extendedprice from {orders}
left join {customer} on c_custkey = o_custkey left join {lineitem} on l_orderkey = o_orderkey""")
def _(t: Tables) -> DataFrame:
    one = joins.lookup(t.orders.select("o_orderkey", "o_custkey"), t.customer, {"o_custkey": "c_custkey"}, {"c_name": "c_name"})
    return joins.fan_out(
        one.drop("o_custkey"), t.lineitem, {"o_orderkey": "l_orderkey"},
        {"l_partkey": "l_partkey", "l_extendedprice": "l_extendedprice"},
    )


@query("join_projected_subquery", """
select o_orderkey, o_totalprice, line_total from {orders}
left join (select l_orderkey, l_extendedprice as line_total from {lineitem}) on l_orderkey = o_orderkey""")
def _(t: Tables) -> DataFrame:
    return joins.fan_out(
        t.orders.select("o_orderkey", "o_totalprice"), t.lineitem.select("l_orderkey", "l_extendedprice"),
        {"o_orderkey": "l_orderkey"}, {"line_total": "l_extendedprice"},
    )


@query("preagg_join", """
select o_orderkey, o_totalprice, line_amount from {orders} left join (
  select l_orderkey, sum(cast(l_extendedprice as decimal(12,2))) as line_amount from {lineitem} group by l_orderkey
) on l_orderkey = o_orderkey""")
def _(t: Tables) -> DataFrame:
    return joins.preagg_join(
        t.orders.select("o_orderkey", "o_totalprice"), t.lineitem, {"o_orderkey": "l_orderkey"},
        {"line_amount": F.col("l_extendedprice").cast("decimal(12,2)")},
    )


# --- aggregates --------------------------------------------------------------------


@query("sum_by_key", """
select l_suppkey, sum(case when l_linenumber <> 3 then cast(l_extendedprice as decimal(12,2)) end) as amount
from {lineitem} group by l_suppkey""")
def _(t: Tables) -> DataFrame:
    rows = t.lineitem.select(
        "l_suppkey", F.when(F.col("l_linenumber") != 3, F.col("l_extendedprice").cast("decimal(12,2)")).alias("v")
    )
    return aggregates.sum_by_key(rows, "l_suppkey", "v", "amount")


_ITEM_SQL = """
select l_orderkey, sum(case
    when l_linenumber % 3 = 1 and l_discount <> 0
      then cast(q * p as decimal(26,4)) * (100 - d) * cast(0.01 as decimal(2,2)) * ((100 + x) * cast(0.01 as decimal(2,2)))
    when l_linenumber % 3 = 1 then q * p * cast(1.10 as decimal(3,2))
    when l_discount <> 0 then cast(q * p as decimal(26,4)) * (100 - d) * cast(0.01 as decimal(2,2))
    else q * p end) as amount
from (select *, cast(l_quantity as decimal(5,2)) as q, cast(l_extendedprice as decimal(9,2)) as p,
  cast(l_discount * 100 as decimal(5,2)) as d, cast(l_tax * 100 as decimal(5,2)) as x from {lineitem})
group by l_orderkey"""


def _item_amount():
    discount = F.col("l_discount") * 100
    return aggregates.item_amount(
        F.col("l_quantity").cast("decimal(5,2)"),
        F.col("l_extendedprice").cast("decimal(9,2)"),
        F.when(F.col("l_discount") != 0, discount.cast("decimal(5,2)")),
        (F.col("l_tax") * 100).cast("decimal(5,2)"),
        F.when(F.col("l_linenumber") % 3 != 2, F.col("l_linenumber") % 3 == 1),
    )


@query("item_amount", f"select l_orderkey, cast(amount as decimal(38,6)) as amount from ({_ITEM_SQL})")
def _(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", _item_amount().alias("v"))
    return aggregates.sum_by_key(rows, "l_orderkey", "v", "amount").withColumn("amount", F.col("amount").cast("decimal(38,6)"))


@query("invoice_amounts", f"""
select o_orderkey, cast(amount - cast(o_totalprice as decimal(12,2)) as decimal(38,6)) as invoice_amount
from {{orders}} join ({_ITEM_SQL}) on l_orderkey = o_orderkey""")
def _(t: Tables) -> DataFrame:
    rows = aggregates.invoice_amounts(
        t.orders.select("o_orderkey", "o_totalprice"), t.lineitem, "o_orderkey", "l_orderkey", _item_amount(),
        F.col("o_totalprice").cast("decimal(12,2)"), "invoice_amount",
    )
    return rows.select("o_orderkey", F.col("invoice_amount").cast("decimal(38,6)").alias("invoice_amount"))


@query("taxed_invoice_amounts", """
select o_orderkey, cast(amount - cast(o_totalprice as decimal(12,2)) as decimal(38,6)) as invoice_amount
from {orders} join (select l_orderkey, sum(case
    when coalesce(s_nationkey % 2 = 0, false) and d is not null
      then cast(q * p as decimal(26,4)) * (100 - d) * cast(0.01 as decimal(2,2)) * ((100 + x) * cast(0.01 as decimal(2,2)))
    when coalesce(s_nationkey % 2 = 0, false) then q * p * cast(1.10 as decimal(3,2))
    when d is not null then cast(q * p as decimal(26,4)) * (100 - d) * cast(0.01 as decimal(2,2))
    else q * p end) as amount
  from (select *, cast(l_quantity as decimal(5,2)) as q, cast(l_extendedprice as decimal(9,2)) as p,
      case when l_discount <> 0 then cast(l_discount * 100 as decimal(5,2)) end as d, cast(s_nationkey as decimal(5,2)) as x
    from {lineitem} left join {supplier} on s_suppkey = case when l_linenumber = 5 then -1 else l_suppkey end)
  group by l_orderkey) on l_orderkey = o_orderkey""")
def _(t: Tables) -> DataFrame:
    # the rates are looked up; every fifth line names an unknown one
    items = t.lineitem.withColumn("tax_id", F.when(F.col("l_linenumber") == 5, -1).otherwise(F.col("l_suppkey")))
    discount = F.when(F.col("l_discount") != 0, (F.col("l_discount") * 100).cast("decimal(5,2)"))

    def amount():
        return aggregates.item_amount(
            F.col("l_quantity").cast("decimal(5,2)"), F.col("l_extendedprice").cast("decimal(9,2)"), discount,
            F.col("rate").cast("decimal(5,2)"), F.col("rate") % 2 == 0)

    rows = aggregates.taxed_invoice_amounts(
        t.orders.select("o_orderkey", "o_totalprice"), items, t.supplier, "o_orderkey", "l_orderkey", {"tax_id": "s_suppkey"},
        amount, {"rate": "s_nationkey"}, F.col("o_totalprice").cast("decimal(12,2)"), "invoice_amount",
    )
    return rows.select("o_orderkey", F.col("invoice_amount").cast("decimal(38,6)").alias("invoice_amount"))


@query("row_count", "select count(*) as rows from {lineitem}")
def _(t: Tables) -> DataFrame:
    return aggregates.row_count(t.lineitem)


@query("profile", f"""
select 'phone' as "column", 'string' as type, count(*) as rows, count(phone) as non_null from ({CONTACTS})
union all select 'email', 'string', count(*), count(email) from ({CONTACTS})
union all select 'c_custkey', 'bigint', count(*), count(c_custkey) from ({CONTACTS})
union all select 'c_acctbal', 'double', count(*), count(c_acctbal) from ({CONTACTS})
union all select 'c_name', 'string', count(*), count(c_name) from ({CONTACTS})""")
def _(t: Tables) -> DataFrame:
    return aggregates.profile_non_null(t.sql(CONTACTS))


@query("dedupe_first", """
select * exclude (rn) from (select *, row_number() over (partition by l_orderkey order by l_shipdate, l_linenumber,
  l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) as rn
  from {lineitem}) where rn = 1""")
def _(t: Tables) -> DataFrame:
    return aggregates.dedupe_keep_first(t.lineitem, "l_orderkey", ["l_shipdate", "l_linenumber"])


@query("preview", "select * from {orders} order by o_orderkey limit 5")
def _(t: Tables) -> DataFrame:
    return aggregates.preview(t.orders, 5, ["o_orderkey"])


# --- table maintenance -------------------------------------------------------------


def _late_orders(t: Tables) -> DataFrame:
    rows = t.orders.filter(F.col("o_orderdate") >= times.at(datetime(2001, 1, 1)))
    return rows.withColumn("o_totalprice", F.col("o_totalprice") + 1)


@query("delete_by_keys", f"""
select * from {{lineitem}} l where not exists (select 1 from ({_DELTA}) d where d.o_orderkey = l.l_orderkey)""")
def _(t: Tables) -> DataFrame:
    return replace.delete_by_keys(t.lineitem, _late_orders(t), "l_orderkey", "o_orderkey")


@query("keyed_replace", f"""
select * from {{orders}} t where not exists (select 1 from ({_DELTA}) d where d.o_orderkey = t.o_orderkey)
union all select * from ({_DELTA})""")
def _(t: Tables) -> DataFrame:
    return replace.keyed_replace(t.orders, _late_orders(t), "o_orderkey")


_GROUP_DELTA = "select l_orderkey, l_linenumber + 100 as l_linenumber, l_shipdate from {lineitem} where l_shipdate >= date '2001-03-01'"
_NULLED = "select case when l_linenumber = 7 then null else l_orderkey end as l_orderkey, l_linenumber, l_shipdate from {lineitem}"


@query("keyed_replace_groups", f"""
select * from ({_NULLED}) t where not exists (select 1 from ({_GROUP_DELTA}) d where d.l_orderkey = t.l_orderkey)
union all select * from ({_GROUP_DELTA})""")
def _(t: Tables) -> DataFrame:
    # several rows per key on both sides, and a hot NULL key in the target that survives
    return replace.keyed_replace(t.sql(_NULLED), t.sql(_GROUP_DELTA), "l_orderkey")


@query("full_refresh", """
select c_custkey as user_id, c_name, timestamp '2024-01-01 00:00:00' + interval '1' hour * c_custkey + interval '7' hour as created_at
from {customer}""")
def _(t: Tables) -> DataFrame:
    source = t.sql("select c_custkey, c_name, {ts} '2024-01-01 00:00:00' + interval '1' hour * c_custkey as created_at from {customer}")
    rows = columns.rename(columns.shift_and_replace(source, ["created_at"], 7), {"c_custkey": "user_id"})
    table = _published(t, "users")
    table.replace(rows.limit(0), RUN_TS)
    table.replace(replace.full_refresh(table.read(), rows), RUN_TS)
    return table.read()


@query("publish_keyed", f"""
select * from {{orders}} t where not exists (select 1 from ({_DELTA}) d where d.o_orderkey = t.o_orderkey)
union all select * from ({_DELTA})""")
def _(t: Tables) -> DataFrame:
    # the plan reads the version it replaces
    table = _published(t, "orders")
    table.replace(t.orders, RUN_TS)
    table.keyed_replace(_late_orders(t), "o_orderkey", RUN_TS)
    return table.read()


@query("purge_trailing_days", f"""
select * from ({DAYS}) where ymd is null or not (strptime(ymd, '%Y%m%d') > timestamp '2024-01-20 00:00:00' - interval '4' day)""")
def _(t: Tables) -> DataFrame:
    return replace.purge_trailing_days(t.sql(DAYS), "ymd", date(2024, 1, 20))


@query("schema_precedence", """
select k, name from (select k, name, row_number() over (partition by k order by r, name) as rn from (
  select c_custkey as k, c_name as name, 0 as r from {customer}
  union all select o_custkey + 700, o_orderpriority, 1 from {orders}
  union all select s_suppkey, s_name, 2 from {supplier})) where rn = 1""")
def _(t: Tables) -> DataFrame:
    first = t.customer.select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"))
    second = t.orders.select((F.col("o_custkey") + 700).alias("k"), F.col("o_orderpriority").alias("name"))
    third = t.supplier.select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"))
    return aggregates.first_table_wins([first, second, third], "k")


# --- scalar functions --------------------------------------------------------------


@query("mask_phone", f"select c_custkey, {sqltext.phone('phone')} as phone from ({CONTACTS})")
def _(t: Tables) -> DataFrame:
    return t.sql(CONTACTS).select("c_custkey", masks.mask_phone("phone").alias("phone"))


@query("mask_email", f"select c_custkey, {sqltext.email('email')} as email from ({CONTACTS})")
def _(t: Tables) -> DataFrame:
    return t.sql(CONTACTS).select("c_custkey", masks.mask_email("email").alias("email"))


@query("mask_general", f"select c_custkey, {sqltext.general('c_name')} as c_name, {sqltext.general('phone')} as phone from ({CONTACTS})")
def _(t: Tables) -> DataFrame:
    return t.sql(CONTACTS).select(
        "c_custkey", masks.mask_general("c_name").alias("c_name"), masks.mask_general("phone").alias("phone")
    )


@query("mask_flag", f"select c_custkey, {sqltext.flag('phone')} as phone, {sqltext.flag('c_acctbal')} as c_acctbal from ({CONTACTS})")
def _(t: Tables) -> DataFrame:
    return t.sql(CONTACTS).select(
        "c_custkey", masks.mask_flag("phone").alias("phone"), masks.mask_flag("c_acctbal").alias("c_acctbal")
    )


@query("mask_table", f"""
select c_custkey, {sqltext.general('c_name')} as c_name, {sqltext.flag('c_acctbal')} as c_acctbal,
  {sqltext.phone('phone')} as phone, {sqltext.email('email')} as email from ({CONTACTS})""")
def _(t: Tables) -> DataFrame:
    return masks.mask_table(t.sql(CONTACTS), ["c_name", "phone", "email"], ["c_acctbal"])


@query("mask_found_contacts", f"""
select doc_id, 'phone' as kind, {sqltext.phone('found')} as masked
from (select doc_id, unnest(regexp_extract_all(text, '{PHONE_LIKE}')) as found from {{documents}})
union all select doc_id, 'email', {sqltext.email('found')}
from (select doc_id, unnest(regexp_extract_all(text, '{EMAIL_LIKE}')) as found from {{documents}})""")
def _(t: Tables) -> DataFrame:
    def found(kind: str, pattern: str) -> DataFrame:
        pieces = F.explode(F.regexp_extract_all("text", F.lit(pattern), F.lit(0)))
        return masks.mask_table(t.documents.select("doc_id", pieces.alias(kind)), [kind]).select(
            "doc_id", F.lit(kind).alias("kind"), F.col(kind).alias("masked"))

    return found("phone", PHONE_LIKE).unionByName(found("email", EMAIL_LIKE))


@query("mask_long_text", f"select doc_id, {sqltext.general('text')} as text, {sqltext.phone('text')} as phone_in_text from {{documents}}")
def _(t: Tables) -> DataFrame:
    return t.documents.select(
        "doc_id", masks.mask_general("text").alias("text"), masks.mask_phone("text").alias("phone_in_text")
    )


@query("shift_hours", "select event_id, ts + interval '14' hour as later, ts - interval '7' hour as earlier from {events}")
def _(t: Tables) -> DataFrame:
    return t.events.select(
        "event_id", times.shift_hours("ts", 14).alias("later"), times.shift_hours("ts", -7).alias("earlier")
    )


@query("calendar_day", "select cast(ts as date) as day, count(*) as n from {events} group by 1")
def _(t: Tables) -> DataFrame:
    return t.events.groupBy(times.calendar_day("ts").alias("day")).agg(F.count("*").alias("n"))


@query("text_prefix", """
select c_custkey, case when strpos(c_name, '#') > 0 then left(c_name, strpos(c_name, '#') - 1) else c_name end as prefix,
  c_mktsegment as whole from {customer}""")
def _(t: Tables) -> DataFrame:
    return t.customer.select(
        "c_custkey", text.text_before("c_name").alias("prefix"), text.text_before("c_mktsegment").alias("whole")
    )


@query("ymd_dates", f"""
select event_id, cast(strptime(ymd, '%Y%m%d') as date) as day, cast(strptime(ymd, '%Y%m%d') as date) - 4 as four_days_before
from ({DAYS})""")
def _(t: Tables) -> DataFrame:
    day = times.parse_ymd("ymd")
    return t.sql(DAYS).select("event_id", day.alias("day"), times.days_before(day, 4).alias("four_days_before"))


@query("strict_time", f"select c_custkey, cast(time_text as timestamp) as at from ({LOOSE_VALUES})")
def _(t: Tables) -> DataFrame:
    return t.sql(LOOSE_VALUES).select("c_custkey", times.to_time_strict("time_text").alias("at"))


@query("coerce_time", f"select c_custkey, {sqltext.time_or_null('mixed_time')} as at from ({LOOSE_VALUES})")
def _(t: Tables) -> DataFrame:
    return t.sql(LOOSE_VALUES).select("c_custkey", times.to_time_coerce("mixed_time").alias("at"))


@query("type_sync", f"""
select c_custkey, try_cast(number_text as double) as number_text, broken_text, try_cast(time_text as timestamp) as time_text,
  case when mixed_time is null then null else coalesce({sqltext.time_or_null('mixed_time')},
    timestamp '2262-04-11 23:47:16.854775') end as mixed_time,
  token, cast(c_nationkey as double) as c_nationkey, cast(c_acctbal as varchar) as c_acctbal
from ({LOOSE_VALUES})""")
def _(t: Tables) -> DataFrame:
    rows = t.sql(LOOSE_VALUES).drop("spaced", "ratio", "c_name")
    return types.type_sync(rows, [
        ("number_text", "int(11)"), ("broken_text", "bigint(20)"), ("time_text", "datetime"), ("mixed_time", "timestamp"),
        ("token", "varchar(20)"), ("c_nationkey", "smallint(6)"), ("c_acctbal", "text"), ("unknown", "double"),
    ])


@query("clamp_timestamp", """
select o_orderkey, case when o_orderkey % 5 = 0 then null when o_orderkey % 5 = 1 then o_orderdate
  else timestamp '2262-04-11 23:47:16.854775' end as at from {orders}""")
def _(t: Tables) -> DataFrame:
    later = t.sql("""
        select o_orderkey, case o_orderkey % 5 when 0 then null when 1 then o_orderdate when 2 then o_orderdate + interval '290' year
          when 3 then o_orderdate - interval '480' year else o_orderdate + interval '7000' year end as at from {orders}""")
    return later.withColumn("at", times.clamp_timestamp("at"))


@query("na_normalise", f"""
select c_custkey, {sqltext.na('token')} as token, c_name, case when isnan(ratio) then null else ratio end as ratio
from (select c_custkey, token, c_name, case when c_custkey % 5 = 0 then cast('nan' as double) else c_acctbal end as ratio from ({LOOSE_VALUES}))""")
def _(t: Tables) -> DataFrame:
    rows = t.sql(LOOSE_VALUES).select(
        "c_custkey", "token", "c_name",
        F.when(F.col("c_custkey") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("c_acctbal")).alias("ratio"),
    )
    return text.na_normalise(rows)


@query("whole_numbers", f"""
select c_custkey, cast(trunc(c_acctbal) as bigint) as balance,
  case c_custkey % 7 when 0 then 12 when 1 then null when 2 then 300 when 3 then -7 when 4 then 0 when 5 then 4 else c_custkey end as number,
  case c_custkey % 5 when 0 then 0 when 1 then 0 when 2 then 12345678901 when 3 then -3 else null end as cut
from {{customer}}""")
def _(t: Tables) -> DataFrame:
    # eleven digits behind the point, exponents, and numbers that no 32-bit integer holds
    rows = t.sql(LOOSE_VALUES).withColumn("fraction", F.expr("""
        case c_custkey % 5 when 0 then '0.99999999999' when 1 then '-0.99999999996' when 2 then '12345678901.9999999999999'
          when 3 then '-3.9999999999e0' else null end"""))
    return rows.select(
        "c_custkey", types.to_whole("c_acctbal", T.DoubleType()).alias("balance"), types.to_whole("number_text").alias("number"),
        types.to_whole("fraction").alias("cut"),
    )


@query("to_text", f"""
select c_custkey, cast(ratio as varchar) as ratio, coalesce(cast(time_text as varchar), 'nan') as time_text,
  cast(c_nationkey as varchar) as c_nationkey from ({LOOSE_VALUES})""")
def _(t: Tables) -> DataFrame:
    return t.sql(LOOSE_VALUES).select(
        "c_custkey", text.to_text("ratio", T.DoubleType()).alias("ratio"),
        text.to_text("time_text", null_text="nan").alias("time_text"), text.to_text("c_nationkey").alias("c_nationkey"),
    )


@query("to_double", f"""
select c_custkey, cast(number_text as double) as number, cast(c_nationkey as double) as c_nationkey, cast(c_custkey as varchar) as key_text
from ({LOOSE_VALUES})""")
def _(t: Tables) -> DataFrame:
    return t.sql(LOOSE_VALUES).select(
        "c_custkey", types.to_double("number_text").alias("number"),
        types.to_double("c_nationkey", T.IntegerType()).alias("c_nationkey"), text.to_text("c_custkey").alias("key_text"),
    )


@query("align_to_target", """
select cast(o_orderkey as double) as o_orderkey, cast(o_custkey as varchar) as o_custkey,
  cast(trunc(o_totalprice) as bigint) as o_totalprice, cast(cast(o_orderdate as varchar) as timestamp) as o_orderdate,
  case when o_orderkey % 2 = 0 then 0 else 12345678901 end as cut, o_orderpriority from {orders}""")
def _(t: Tables) -> DataFrame:
    cut = F.when(F.col("o_orderkey") % 2 == 0, "0.99999999999").otherwise("1.23456789019e10")
    rows = t.orders.drop("o_orderstatus").withColumn("o_orderdate", F.col("o_orderdate").cast("string")).withColumn("cut", cut)
    return types.align_to_target(rows, {
        "o_totalprice": "INT64", "o_orderkey": "FLOAT64", "o_custkey": "STRING", "o_orderdate": "TIMESTAMP", "absent": "INT64", "cut": "INT64",
    })


@query("stringify_objects", f"select c_custkey, c_name, c_acctbal, coalesce(phone, 'None') as phone, coalesce(email, 'None') as email from ({CONTACTS})")
def _(t: Tables) -> DataFrame:
    return text.stringify_objects(t.sql(CONTACTS))


# --- the flagship: window, join, mask, rename, replace -----------------------------


@query("flagship", f"""
with changed as (select o_orderkey as order_id, o_custkey, o_totalprice, o_orderdate, o_orderpriority,
    {sqltext.general('c_name')} as customer_name
  from {{orders}} left join {{customer}} on c_custkey = o_custkey
  where o_orderdate >= timestamp '1998-06-01 00:00:00' and o_orderdate < timestamp '1998-06-02 19:00:00')
select o_orderkey as order_id, o_custkey, o_totalprice, o_orderdate, o_orderpriority, 'published' as customer_name
from {{orders}} where not exists (select 1 from changed where order_id = o_orderkey)
union all select * from changed""")
def flagship(t: Tables) -> DataFrame:
    """Orders of a change window, customer joined and masked, group-replaced into the published state."""
    changed = change_window(t.orders, "o_orderdate", datetime(1998, 6, 2, 19)).drop("o_orderstatus")
    named = joins.lookup(changed, t.customer, {"o_custkey": "c_custkey"}, {"customer_name": "c_name"})
    rows = columns.rename(masks.mask_table(named, ["customer_name"]), {"o_orderkey": "order_id"})
    target = columns.rename(t.orders, {"o_orderkey": "order_id"}).drop("o_orderstatus").withColumn(
        "customer_name", F.lit("published")
    )
    return replace.keyed_replace(target, rows, "order_id")
