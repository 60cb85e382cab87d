"""The 37 table specs, each run over source tables derived from the test tables.

The result of a query is the published table after the run: for a group replace, a prior
state (older versions of the rows changed before the middle of the window) with the
changed rows swapped in. The SQL states the outcome per column, table by table.
"""

from __future__ import annotations

import uuid
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.functions.times import at
from tablesync.operators.columns import all_non_zero
from tablesync.plans import SPECS, delta, next_state, run_job
from tablesync.plans.runner import changed_rows, enriched, masked, published_table, settled
from tablesync.sources.catalog import FrameCatalog
from tablesync.sources.staging import shared_folder

from . import sqltext as s
from .base import LOWER, RUN_TS, UPPER, WINDOW, Tables, query
from .sources import SOURCES, duckdb_text, frames

MIDDLE = WINDOW.lower + timedelta(hours=13)


def _prior(spec, catalog) -> DataFrame:
    older = all_non_zero(catalog.scan(spec.source), spec.non_zero).filter(F.col("updated_at") < at(MIDDLE))
    older = older.withColumn("updated_at", F.timestamp_add("DAY", F.lit(-30), F.col("updated_at")))
    return settled(spec, masked(spec, enriched(spec, older, catalog)), catalog)


def _run(name: str, verbatim: bool):
    def build(t: Tables) -> DataFrame:
        spec = SPECS[name].verbatim() if verbatim else SPECS[name]
        catalog = FrameCatalog(frames(t))
        rows = delta(spec, catalog, RUN_TS)
        if spec.publish == "full":
            return next_state(spec, None, rows)
        return next_state(spec, _prior(spec, catalog), rows, changed_rows(spec, catalog, RUN_TS))

    return build


# a spec of each shape, run as deployed: staged, with a snapshot, committed, and read back
DEPLOYED = ("companies", "users", "invoices", "subscriptions", "invoice_down_payments", "plans", "partners_unmasked", "mailgun_trackings")


def _deployed(name: str):
    def build(t: Tables) -> DataFrame:
        spec, catalog = SPECS[name], FrameCatalog(frames(t))
        root = f"{shared_folder(t.spark)}/deployed-{uuid.uuid4().hex}"
        table = published_table(spec, t.spark, f"{root}/published")
        if spec.publish == "keyed":
            table.replace(_prior(spec, catalog), RUN_TS - timedelta(days=1))
        result = run_job(spec, catalog, f"{root}/published", RUN_TS, f"{root}/snapshots")
        if result.status != "published":
            raise RuntimeError(f"{name}: {result.status}")
        return table.read()

    return build


# --- column outcomes ---------------------------------------------------------------


def same(*names):
    return {n: f"b.{n}" for n in names}


def text(*names, of="b"):
    """Text columns after the reload: missing-value tokens are NULL."""
    return {n: s.na(f"{of}.{n}") for n in names}


def number(*names, of="b"):
    return {n: f"cast({of}.{n} as double)" for n in names}


def times(hours=0):
    shift = f" + interval '{hours}' hour" if hours else ""
    return {n: f"b.{n}{shift}" for n in ("created_at", "updated_at")}


def flags(*names):
    """Flags of text columns: the declared type makes them text again."""
    return {n: f"cast({s.flag('b.' + n)} as varchar)" for n in names}


def key(name):
    return {name: "b.uuid"}


def job(name, columns, joins="", where="", window=True, group_of=None, verbatim=False):
    """Register a spec as a query, with SQL from its column outcomes."""
    spec = SPECS[name]
    source = duckdb_text(spec.source)
    picked = ", ".join(f'{expr} as "{out}"' for out, expr in columns.items())
    for table in [n for n in SOURCES if "{" + n + "}" in joins]:
        joins = joins.replace("{" + table + "}", "(" + duckdb_text(table) + ")")
    more = f" and {where}" if where else ""

    def rows(base):
        return f"select {picked} from ({base}) b {joins}"

    changed = f"select * from ({source}) b where updated_at >= {LOWER} and updated_at < {UPPER}{more}"
    if group_of:
        changed = f"select * from ({source}) where {group_of} in (select {group_of} from ({changed}))"
    if not window:
        sql = rows(source)
    else:
        older = (
            f"select * replace (updated_at - interval '30' day as updated_at) from ({source}) b "
            f"where updated_at < timestamp '{MIDDLE}'{more}"
        )
        k = spec.key
        sql = (
            f"with d as ({rows(changed)}), p as ({rows(older)}) "
            f"select * from p where not exists (select 1 from d where d.{k} = p.{k}) union all select * from d"
        )
    label = f"job_{name}_verbatim" if verbatim else f"job_{name}"
    query(label, sql)(_run(name, verbatim))
    if name in DEPLOYED and not verbatim:
        query(f"run_{name}", sql)(_deployed(name))


_BUSINESS = "left join {gateway.business_type} bt on bt.uuid = b.business_type_child"
_TAX = "left join {invoicer.tax_settings} x on x.uuid = b.tax_id"
_AMOUNTS = "debit_amount <> 0 and credit_amount <> 0 and debit_balance <> 0 and credit_balance <> 0"

job("sms_logs", {**key("sms_log_id"), **text("destination", "status", "message"), **same("cost"), **number("attempts"), **times()})
job("shorten_urls", {**key("shorten_url_id"), **text("url"), **number("size"), **times()})
job("companies_unmasked", {
    **key("company_id"),
    **text("company_name", "company_email", "company_phone", "company_address1", "company_address2", "company_website",
           "company_bank_name", "company_bank_account"),
    "business_type_child": "bt.name", **same("balance"), **times(7),
}, _BUSINESS)
job("users_unmasked", {
    **key("user_id"), **same("name", "lastname", "email", "username", "phone", "verificationToken"), **number("role"), **times(7),
}, window=False)
job("users", {
    **key("user_id"), "name": s.general("b.name"), "lastname": s.general("b.lastname"), "email": s.email("b.email"),
    "username": s.general("b.username"), "phone": s.phone("b.phone"), **flags("verificationToken"), **number("role"), **times(7),
}, window=False)
job("companies", {
    **key("company_id"), "company_name": s.general("b.company_name"), "company_email": s.email("b.company_email"),
    "company_phone": s.phone("b.company_phone"),
    **flags("company_address1", "company_address2", "company_website", "company_bank_name", "company_bank_account"),
    "business_type_child": "bt.name", **same("balance"), **times(7),
}, _BUSINESS)
job("invoices", {
    **key("invoice_id"), **flags("terms", "notes", "signature_text_footer"), **number("customer_no"), **same("discount"),
    "invoice_amount": 'x."grandTotalUnformatted"', **times(14),
}, "left join {invoicer.invoice_totals} x on x.invoice_id = b.uuid")
job("invoice_items", {
    **key("invoice_item_id"), **same("invoice_id", "tax_id", "quantity", "price"), **number("position"),
    "tax_name": "x.name", "tax_value": "x.value", **times(),
}, _TAX)
job("invoice_reminder_histories", {
    **key("invoice_reminder_id"), **text("channel", "reason"), **number("invoice_no"), **times(),
})
job("invoice_reminder_settings", {
    **key("invoice_reminder_setting_id"), **text("mode"), **number("days_before", "active"), **times(),
})
job("mailgun_trackings", {
    **key("mailgun_tracking_id"), **text("event", "recipient"), "created_at": s.time_or_null("b.created_at"),
    "updated_at": "b.updated_at",
})
job("order_items", {
    **key("order_item_id"), **same("order_id", "tax_id", "discount"), **number("position"), "tax_name": "x.name",
    "tax_value": "x.value", **times(),
}, _TAX)
_PAYMENTS = {
    **key("payment_id"), **same("method"),
    **{c: s.flag("b." + c) for c in (
        "notes", "veritrans_masked_card", "veritrans_permata_va_number", "veritrans_signature_key")},
    "veritrans_gross_amount": "cast(trunc(b.veritrans_gross_amount) as bigint)",
    **same("veritrans_status_code", "veritrans_transaction_time"), **times(), "method_name": "x.name",
    "selected": "cast(x.selected as double)", "active_in": "x.active_in", "active_out": "x.active_out",
    "is_digital_payment": "cast(x.is_digital_payment as double)",
}
_METHODS = "left join {invoicer.payment_methods} x on x.uuid = b.method"
job("payments", _PAYMENTS, _METHODS)
job("payments", {**_PAYMENTS, "veritrans_transaction_time": "coalesce(b.veritrans_transaction_time, 'nan')"}, _METHODS,
    verbatim=True)
job("payments_invoices", {**key("payment_invoice_id"), **same("payment_id", "invoice_id", "amount"), **times()})
job("orders", {
    **key("order_id"), **flags("supplier_reference", "terms", "notes"), **text("status"), **same("total"), **times(),
})
job("products", {
    **key("product_id"), **text("name", "uom_id"), **same("price"), **number("stock"), **times(), "uom_name": "x.name",
    "uom_symbol": "cast(x.symbol as double)", "uom_code": "x.code",
}, "left join {invoicer.uoms} x on x.uuid = b.uom_id")
job("partners", {
    **key("partner_id"), "name": s.general("b.name"), "email": s.email("b.email"), "mobile": s.general("b.mobile"),
    "phone": s.phone("b.phone"), **flags("notes", "address1", "address2", "virtual_account", "website"), **times(),
    **same("deleted_at"), **number("payment_term"), **text("increment_num"),
})


def _trimmed(c):
    return s.na(f"(case when regexp_matches({c}, '[,\"\\n\\r]') then {c} else ltrim({c}, ' ') end)")


_PARTNERS = {
    **key("partner_id"),
    **{c: _trimmed("b." + c) for c in (
        "name", "email", "mobile", "phone", "notes", "address1", "address2", "virtual_account", "website")},
    **times(), **same("deleted_at"), **number("payment_term"), "increment_num": "b.increment_num",
}
# two source rows per key: the older one stays
_FIRST = "qualify row_number() over (partition by b.uuid order by b.created_at, b.updated_at, b.name) = 1"
job("partners_unmasked", _PARTNERS, _FIRST, window=False)
job("partners_unmasked", {
    **_PARTNERS, "updated_at": "b.created_at", "deleted_at": "b.created_at", "increment_num": "coalesce(b.increment_num, 'nan')",
}, _FIRST, window=False, verbatim=True)
_PLANS = {"plan_id": "b.meta_id", "uuid": "b.uuid", **flags("meta_value"), **text("meta_key"), **times()}
# an early-named column is not declared any more, a flag is: meta_value stays text
job("plans", _PLANS, group_of="meta_id")
job("plans", _PLANS, verbatim=True)
job("schedulers", {**key("scheduler_id"), **text("name", "payload"), **number("attempts"), **same("weight"), **times()},
    window=False)
job("subscriptions", {
    **key("subscription_id"), **same("package_id", "status"), "start_date": "cast(b.start_date as timestamp)",
    "end_date": "cast(b.end_date as timestamp)", "package_name": "p.package_name", "length": "cast(p.length as double)",
    "price": "p.price",
    **{c: "x." + c for c in (
        "subscription_order_id", "transaction_id", "gross_amount", "payment_type", "transaction_status", "referral_code")},
    "transaction_time": "x.transaction_time + interval '7' hour", "payment_date": "x.payment_date + interval '7' hour",
    "fraud_status": s.na("x.fraud_status"), **times(7),
}, "left join {gateway.packages} p on p.uuid = b.package_id left join {gateway.paywall_payments} x on x.subscription_id = b.uuid")
job("user_comment_metasetting", {
    **key("user_comment_metasetting_id"), **text("role", "setting"), **number("position"), **times(7),
})
_EXPENSES = {**key("expense_id"), **flags("notes"), **same("custom_fields", "status", "total"), **times()}
job("expenses", _EXPENSES)
job("expenses", {**_EXPENSES, "custom_fields": "coalesce(b.custom_fields, 'nan')"}, verbatim=True)
job("stock_fifo_inputs", {**key("stock_fifo_input_id"), **number("product_no"), **same("quantity"), **times()})
job("stock_fifo_outputs", {**key("stock_fifo_output_id"), **same("product_id", "quantity"), **text("reason"), **times()})
job("stock_movements", {**key("stock_movement_id"), **text("kind", "remark"), **same("quantity"), **times()})
job("stock_documents", {
    **key("stock_document_id"), **same("stock_document_type_id"),
    **flags("notes", "description", "tracking_no", "driver_name", "vehicle_number"), **number("n_chars"), **times(),
    "stock_document_type": "x.name", "prefix": "x.prefix",
}, "left join {invoicer.stock_document_types} x on x.uuid = b.stock_document_type_id")
job("locations", {
    **key("location_id"), "location_name": s.na("b.name"), **same("location_type_id", "area"), **times(14),
    "location_type_name": "x.name", "track_value": "cast(x.track_value as double)",
}, "left join {invoicer.location_types} x on x.uuid = b.location_type_id")
job("finance_transactions", {
    **key("finance_transactions_id"), **same("finance_transaction_type_id", "amount"), **flags("reference"), **times(),
    "finance_transaction_type_code": "cast(x.code as double)", "finance_transaction_type_name": "x.name",
    "finance_transaction_type": "x.type",
}, "left join {invoicer.finance_transaction_types} x on x.uuid = b.finance_transaction_type_id")
job("account_histories", {
    **key("account_history_id"), **same("account_id", "debit_amount", "credit_amount", "debit_balance"),
    **number("credit_balance"), **times(), **{c: "x." + c for c in ("account_type_id", "account_parent_id", "account_code")},
    "account_name": "x.name", "account_status": "x.status", "is_deleteable": "cast(x.is_deleteable as bigint)",
    "original_account_code": s.na("x.original_account_code"), "account_type_name": "y.name",
    "account_type_name_lang": "y.name_lang", "account_type_normal_balance": "cast(y.normal_balance as double)",
}, "left join {invoicer.accounts} x on x.uuid = b.account_id left join {invoicer.account_types} y on y.uuid = x.account_type_id",
    where=_AMOUNTS)
job("finance_account_history", {
    **key("finance_account_history_id"),
    **same("finance_account_id", "debit_amount", "credit_amount", "debit_balance", "credit_balance"), **times(),
    **{c: "x." + c for c in ("currency_id", "finance_account_type_id", "cash_code", "cash_name", "bank_branch_name")},
    "bank_name": s.na("x.bank_name"), "bank_city_name": s.na("x.bank_city_name"),
    "bank_account_no": f"cast({s.flag('x.bank_account_no')} as varchar)",
    "bank_account_name": f"cast({s.flag('x.bank_account_name')} as varchar)", "finance_account_type_name": "y.name",
}, "left join {invoicer.finance_accounts} x on x.uuid = b.finance_account_id "
   "left join {invoicer.finance_account_types} y on y.uuid = x.finance_account_type_id", where=_AMOUNTS)
job("invoice_down_payments", {
    **key("invoice_down_payment_id"), "assigned_status": "cast(b.assigned_status as bigint)",
    "sent": "cast(trunc(b.sent) as bigint)", **text("status"), **times(), "invoice_dp_amount": "x.total",
}, "left join (select invoice_down_payment_id as k, sum(amount) as total from {invoicer.invoice_down_payment_items} group by 1) x "
   "on x.k = b.uuid")
job("invoice_down_payment_items", {
    **key("invoice_down_payment_item_id"), **same("invoice_down_payment_id", "amount"),
    "index": 'cast(b."index" as bigint)', **times(),
})
job("company_type", {"uuid": "b.uuid", **text("name", "label"), **number("sort_order"), **times(14)})
job("company_referral_used", {**key("company_referral_used_id"), **same("code", "reward"), **times()}, window=False)
_REFERRALS = {**key("referral_code_id"), **same("company_id", "code", "uses"), **times()}
_COMPANY = "left join {gateway.companies} x on x.uuid = b.company_id"
job("referral_codes", {
    **_REFERRALS, "company_name": s.general("x.company_name"), "company_email": s.email("x.company_email"),
}, _COMPANY, window=False)
job("referral_codes", {**_REFERRALS, "company_name": "x.company_name", "company_email": "x.company_email"}, _COMPANY,
    window=False, verbatim=True)
job("imported_invoice_batches", {
    **key("batch_id"), **same("company_id"), **text("file_path", "import_status"), **times(), "invoice_id": "x.invoice_id",
}, "left join {invoicer.imported_invoice_batch_invoice} x on x.batch_id = b.uuid")
