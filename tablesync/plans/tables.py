"""The 37 replicated tables.

Fixed values: the names of sources, targets, keys and columns, and which columns are
masked, shifted or cast, are those the published tables have.
"""

from __future__ import annotations

from .spec import Join, TableSpec

__all__ = ["SPECS", "spec"]

INTERNAL = "datascience"  # the unmasked dataset

_BUSINESS_TYPE = Join(
    "gateway.business_type", {"business_type_child": "uuid"}, {"business_type_child_name": "name"}
)
_TAX = Join("invoicer.tax_settings", {"tax_id": "uuid"}, {"tax_name": "name", "tax_value": "value"})
_AMOUNTS = ("debit_amount", "credit_amount", "debit_balance", "credit_balance")


def _plain(name: str, key: str, **more) -> TableSpec:
    """An invoicer table that is only windowed, synced and keyed."""
    return TableSpec(name, f"invoicer.{name}", f"raw_data_{name}", key, **more)


_ALL = (
    _plain("sms_logs", "sms_log_id"),
    _plain("shorten_urls", "shorten_url_id"),
    TableSpec(
        "companies_unmasked", "gateway.companies", "companies", "company_id", INTERNAL,
        joins=(_BUSINESS_TYPE,), replaces={"business_type_child_name": "business_type_child"},
        shift_hours=7, casts={"business_type_child": "text"},
    ),
    TableSpec(
        "users_unmasked", "gateway.users", "users", "user_id", INTERNAL,
        publish="full", windowed=False, shift_hours=7, reload=None,
    ),
    TableSpec(
        "users", "gateway.users", "raw_data_users", "user_id",
        publish="full", windowed=False, shift_hours=7, reload=None,
        value_masks=("name", "lastname", "email", "username", "phone"), flag_masks=("verificationToken",),
    ),
    TableSpec(
        "companies", "gateway.companies", "raw_data_companies", "company_id",
        joins=(_BUSINESS_TYPE,), replaces={"business_type_child_name": "business_type_child"}, shift_hours=7,
        value_masks=("company_name", "company_email", "company_phone"),
        flag_masks=(
            "company_address1", "company_address2", "company_website", "company_bank_name", "company_bank_account",
        ),
        casts={"business_type_child": "text"},
    ),
    _plain(
        "invoices", "invoice_id", shift_hours=14,
        joins=(Join("invoicer.invoice_totals", {"uuid": "invoice_id"}, {"invoice_amount": "grandTotalUnformatted"},
                    kind="fan_out"),),
        flag_masks=("terms", "signature_text_footer", "notes"),
    ),
    _plain("invoice_items", "invoice_item_id", joins=(_TAX,)),
    _plain("invoice_reminder_histories", "invoice_reminder_id", snapshot=False),
    _plain("invoice_reminder_settings", "invoice_reminder_setting_id"),
    _plain("mailgun_trackings", "mailgun_tracking_id",
           casts={"created_at": "time_or_null", "updated_at": "time_or_null"}),
    _plain("order_items", "order_item_id", joins=(_TAX,)),
    _plain(
        "payments", "payment_id",
        joins=(Join(
            "invoicer.payment_methods", {"method": "uuid"},
            {"method_name": "name", "selected": "selected", "active_in": "active_in", "active_out": "active_out",
             "is_digital_payment": "is_digital_payment"},
            declares=True,
        ),),
        flag_masks=("notes", "veritrans_masked_card", "veritrans_permata_va_number", "veritrans_signature_key"),
        casts={
            "notes": "whole", "veritrans_masked_card": "whole", "veritrans_transaction_time": "text",
            "veritrans_gross_amount": "whole", "veritrans_signature_key": "whole",
            "veritrans_status_code": "whole", "veritrans_permata_va_number": "whole",
        },
    ),
    _plain("payments_invoices", "payment_invoice_id"),
    _plain("orders", "order_id", flag_masks=("supplier_reference", "terms", "notes")),
    _plain(
        "products", "product_id",
        joins=(Join("invoicer.uoms", {"uom_id": "uuid"},
                    {"uom_name": "name", "uom_symbol": "symbol", "uom_code": "code"}, declares=True),),
    ),
    _plain(
        "partners", "partner_id",
        value_masks=("name", "email", "mobile", "phone"),
        flag_masks=("notes", "address1", "address2", "virtual_account", "website"),
    ),
    TableSpec(
        "partners_unmasked", "invoicer.partners", "partners", "partner_id", INTERNAL,
        publish="full", windowed=False, reload="lenient", sync=False, dedupe_order=("created_at", "updated_at"),
        casts={
            "created_at": "time_or_null", "updated_at": "time_or_null", "deleted_at": "time_or_null",
            "payment_term": "double", "increment_num": "text",
        },
        legacy={"overwrite": {"updated_at": "created_at", "deleted_at": "created_at"}},
    ),
    _plain(
        # the published key is coarser than a row, so a change brings the rest of its plan along
        "plans", "plan_id", whole_groups="meta_id",
        early_names={"uuid": "plan_item_id", "meta_id": "uuid"},
        names={"uuid": "plan_id", "plan_item_id": "uuid"},
        flag_masks=("meta_value",), legacy={"whole_groups": None},
    ),
    _plain("schedulers", "scheduler_id", publish="full", windowed=False),
    TableSpec(
        "subscriptions", "gateway.subscriptions", "raw_data_subscriptions", "subscription_id",
        joins=(
            Join("gateway.packages", {"package_id": "uuid"},
                 {"package_name": "package_name", "length": "length", "price": "price"}, declares=True),
            Join("gateway.paywall_payments", {"uuid": "subscription_id"},
                 {c: c for c in (
                     "subscription_order_id", "transaction_id", "gross_amount", "payment_type", "transaction_status",
                     "transaction_time", "payment_date", "fraud_status", "referral_code",
                 )},
                 kind="fan_out", shift={"transaction_time": 7, "payment_date": 7}, declares=True),
        ),
        shift_hours=7, shift_last=True, casts={"start_date": "time", "end_date": "time"},
    ),
    TableSpec(
        "user_comment_metasetting", "gateway.user_comment_metasetting", "raw_data_user_comment_metasetting",
        "user_comment_metasetting_id", shift_hours=7,
    ),
    _plain("expenses", "expense_id", flag_masks=("notes",), casts={"custom_fields": "text", "status": "whole"}),
    _plain("stock_fifo_inputs", "stock_fifo_input_id"),
    _plain("stock_fifo_outputs", "stock_fifo_output_id"),
    _plain("stock_movements", "stock_movement_id"),
    _plain(
        "stock_documents", "stock_document_id",
        joins=(Join("invoicer.stock_document_types", {"stock_document_type_id": "uuid"},
                    {"stock_document_type": "name", "prefix": "prefix"}, declares=True),),
        flag_masks=("notes", "description", "tracking_no", "driver_name", "vehicle_number"),
    ),
    _plain(
        "locations", "location_id", shift_hours=14, copies={"location_name": "name"}, drops=("name",),
        joins=(Join("invoicer.location_types", {"location_type_id": "uuid"},
                    {"location_type_name": "name", "track_value": "track_value"}, declares=True),),
        sort_columns=True,
    ),
    TableSpec(
        # the published name is spelt without its second "c"
        "finance_transactions", "invoicer.finance_transactions", "raw_data_finance_transations",
        "finance_transactions_id",
        joins=(Join("invoicer.finance_transaction_types", {"finance_transaction_type_id": "uuid"},
                    {"finance_transaction_type_code": "code", "finance_transaction_type_name": "name",
                     "finance_transaction_type": "type"}, declares=True),),
        flag_masks=("reference",),
    ),
    _plain(
        "account_histories", "account_history_id", non_zero=_AMOUNTS,
        joins=(
            Join("invoicer.accounts", {"account_id": "uuid"},
                 {"account_type_id": "account_type_id", "account_parent_id": "account_parent_id",
                  "account_code": "account_code", "account_name": "name", "account_status": "status",
                  "is_deleteable": "is_deleteable", "original_account_code": "original_account_code"}, declares=True),
            Join("invoicer.account_types", {"account_type_id": "uuid"},
                 {"account_type_name": "name", "account_type_name_lang": "name_lang",
                  "account_type_normal_balance": "normal_balance"}, declares=True),
        ),
        casts={"is_deleteable": "whole"},
    ),
    _plain(
        "finance_account_history", "finance_account_history_id", non_zero=_AMOUNTS,
        joins=(
            Join("invoicer.finance_accounts", {"finance_account_id": "uuid"},
                 {c: c for c in (
                     "currency_id", "finance_account_type_id", "cash_code", "cash_name", "bank_name",
                     "bank_account_no", "bank_account_name", "bank_branch_name", "bank_city_name",
                 )}),
            Join("invoicer.finance_account_types", {"finance_account_type_id": "uuid"},
                 {"finance_account_type_name": "name"}),
        ),
        flag_masks=("bank_account_name", "bank_account_no"), sync=False,
        casts={"created_at": "time_or_null", "updated_at": "time_or_null",
               "bank_account_no": "text", "bank_account_name": "text"},
    ),
    _plain(
        "invoice_down_payments", "invoice_down_payment_id",
        joins=(Join("invoicer.invoice_down_payment_items", {"uuid": "invoice_down_payment_id"},
                    {"invoice_dp_amount": "amount"}, kind="sum"),),
        casts={"assigned_status": "whole", "sent": "whole"},
    ),
    _plain("invoice_down_payment_items", "invoice_down_payment_item_id", casts={"index": "whole"}),
    TableSpec("company_type", "gateway.company_type", "raw_data_company_type", "uuid", shift_hours=14, names={}),
    TableSpec(
        "company_referral_used", "gateway.company_referral_used", "raw_data_company_referral_used",
        "company_referral_used_id", publish="full", windowed=False, reload=None, sync=False,
        early_names={"uuid": "company_referral_used_id"}, names={},
    ),
    TableSpec(
        "referral_codes", "gateway.referral_codes", "raw_data_referral_codes", "referral_code_id",
        publish="full", windowed=False, reload=None, sync=False,
        joins=(Join("gateway.companies", {"company_id": "uuid"},
                    {"company_name": "company_name", "company_email": "company_email"}),),
        # the table is public, so what its columns show is masked
        value_masks=("company_name", "company_email"), legacy={"value_masks": ()},
    ),
    _plain(
        "imported_invoice_batches", "batch_id",
        joins=(Join("invoicer.imported_invoice_batch_invoice", {"uuid": "batch_id"}, {"invoice_id": "invoice_id"},
                    kind="fan_out"),),
        columns=("uuid", "company_id", "created_at", "file_path", "import_status", "updated_at", "invoice_id"),
    ),
)

SPECS = {s.name: s for s in _ALL}


def spec(name: str) -> TableSpec:
    return SPECS[name]
