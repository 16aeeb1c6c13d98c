"""Star schema of the warehouse: column types, primary keys and entity targets.

Types: ids and names STRING, money DECIMAL(18,2), quantities and prices DECIMAL(18,4),
flags BOOLEAN, dates DATE, date keys INT (yyyymmdd, null when undated).
"""

from __future__ import annotations

MONEY = "decimal(18,2)"
QUANTITY = "decimal(18,4)"

_GENERIC = "client_id string, id string, name string, fully_qualified_name string, is_active boolean"

# The entities kept only as (id, name, fully qualified name, active flag).
GENERIC_TABLES = {
    "Class": "dim_class",
    "Department": "dim_department",
    "TaxCode": "dim_tax_code",
    "TaxRate": "dim_tax_rate",
    "Term": "dim_term",
    "PaymentMethod": "dim_payment_method",
    "CompanyInfo": "dim_company_info",
    "BillPayment": "fact_bill_payment",
    "Deposit": "fact_deposit",
    "CreditMemo": "fact_credit_memo",
    "RefundReceipt": "fact_refund_receipt",
    "SalesReceipt": "fact_sales_receipt",
    "JournalEntry": "fact_journal_entry",
    "Transfer": "fact_transfer",
}

# The entities with a table layout of their own.
ENTITY_TABLES = {
    "Account": "dim_account",
    "Customer": "dim_customer",
    "Vendor": "dim_vendor",
    "Item": "dim_item",
    "Employee": "dim_employee",
    "Invoice": "fact_invoice",
    "Bill": "fact_bill",
    "Payment": "fact_payment",
    "Purchase": "fact_purchase",
    "Estimate": "fact_estimate",
    **GENERIC_TABLES,
}

# Line tables filled from the Line array of a transaction.
LINE_TABLES = {
    "Invoice": "fact_invoice_line",
    "Bill": "fact_bill_line",
    "Purchase": "fact_purchase_line",
    "Payment": "fact_payment_line",
    "Estimate": "fact_estimate_line",
    # not filled by the source system's own loader, though it pulls these documents
    "CreditMemo": "fact_credit_memo_line",
    "SalesReceipt": "fact_sales_receipt_line",
    "RefundReceipt": "fact_refund_receipt_line",
    "JournalEntry": "fact_journal_entry_line",
}
# Documents without a header layout of their own that carry money.
BOOKED = ("CreditMemo", "SalesReceipt", "RefundReceipt", "JournalEntry")

# Column layout of the warehouse tables.
TABLES: dict[str, str] = {
    "dim_client": """client_id string, client_name string, qbo_realm_id string, industry string,
        onboarded_date date, is_active boolean""",
    "dim_date": """date_key int, full_date date, day_of_week int, day_name string, day_of_month int,
        day_of_year int, week_of_year int, month_num int, month_name string, month_short string,
        quarter_num int, quarter_name string, year_num int, fiscal_month int, fiscal_quarter int,
        fiscal_year int, is_weekend boolean, is_holiday boolean""",
    "dim_account": f"""client_id string, account_id string, account_name string,
        fully_qualified_name string, classification string, account_type string,
        account_sub_type string, is_sub_account boolean, parent_account_id string,
        is_active boolean, current_balance {MONEY}, currency_code string""",
    "dim_customer": f"""client_id string, customer_id string, display_name string,
        company_name string, given_name string, family_name string, email string, phone string,
        billing_city string, billing_state string, billing_postal_code string, is_job boolean,
        is_active boolean, balance {MONEY}, parent_customer_id string""",
    "dim_vendor": f"""client_id string, vendor_id string, display_name string, company_name string,
        email string, phone string, is_1099 boolean, is_active boolean, balance {MONEY}""",
    "dim_item": f"""client_id string, item_id string, item_name string, description string,
        item_type string, unit_price {QUANTITY}, purchase_cost {QUANTITY}, is_active boolean,
        income_account_id string, expense_account_id string, track_qty boolean,
        qty_on_hand {QUANTITY}""",
    "dim_employee": """client_id string, employee_id string, display_name string,
        given_name string, family_name string, hired_date date, is_active boolean""",
    "fact_invoice": f"""client_id string, invoice_id string, doc_number string, txn_date date,
        due_date date, customer_id string, total_amount {MONEY}, balance {MONEY},
        total_tax {MONEY}, email_status string, print_status string, txn_date_key int,
        due_date_key int""",
    "fact_invoice_line": f"""client_id string, invoice_id string, line_id string, line_num int,
        description string, amount {MONEY}, quantity {QUANTITY}, unit_price {QUANTITY},
        item_id string, item_name string, account_id string, account_name string,
        tax_code_ref string, service_date date, detail_type string, linked_txn_id string,
        linked_txn_type string""",
    "fact_payment": f"""client_id string, payment_id string, txn_date date, total_amount {MONEY},
        customer_id string, deposit_to_account_id string, payment_method_id string,
        unapplied_amount {MONEY}, txn_date_key int""",
    "fact_payment_line": f"""client_id string, payment_id string, amount {MONEY},
        linked_invoice_id string, linked_txn_type string, original_open_balance string,
        invoice_doc_number string, line_num int""",
    "fact_bill": f"""client_id string, bill_id string, txn_date date, due_date date,
        vendor_id string, total_amount {MONEY}, balance {MONEY}, txn_date_key int,
        due_date_key int""",
    "fact_bill_line": f"""client_id string, bill_id string, line_id string, line_num int,
        description string, amount {MONEY}, detail_type string, quantity {QUANTITY},
        unit_price {QUANTITY}, item_id string, item_name string, account_id string,
        account_name string, billable_status string, customer_id string, customer_name string,
        tax_code_ref string""",
    "fact_purchase": f"""client_id string, purchase_id string, txn_date date, payment_type string,
        total_amount {MONEY}, account_id string, vendor_id string, vendor_type string,
        is_credit boolean, doc_number string, txn_date_key int""",
    "fact_purchase_line": f"""client_id string, purchase_id string, line_id string,
        description string, amount {MONEY}, detail_type string, item_id string, item_name string,
        account_id string, account_name string, billable_status string, customer_id string,
        tax_code_ref string""",
    "fact_estimate": f"""client_id string, estimate_id string, doc_number string, txn_date date,
        customer_id string, total_amount {MONEY}, txn_status string, linked_invoice_id string,
        txn_date_key int""",
    "fact_estimate_line": f"""client_id string, estimate_id string, line_id string, line_num int,
        description string, amount {MONEY}, quantity {QUANTITY}, unit_price {QUANTITY},
        item_id string, item_name string, account_id string, account_name string,
        tax_code_ref string, detail_type string""",
    **{table: _GENERIC for table in GENERIC_TABLES.values()},
    **{GENERIC_TABLES[e]: f"""{_GENERIC}, doc_number string, txn_date date, customer_id string,
        total_amount {MONEY}, txn_date_key int""" for e in BOOKED},
    **{f"fact_{e}_line": f"""client_id string, {e}_id string, line_id string, line_num int,
        description string, amount {MONEY}, quantity {QUANTITY}, unit_price {QUANTITY},
        item_id string, item_name string, account_id string, account_name string,
        tax_code_ref string, service_date date, detail_type string"""
       for e in ("credit_memo", "sales_receipt", "refund_receipt")},
    "fact_journal_entry_line": f"""client_id string, journal_entry_id string, line_id string,
        line_num int, description string, amount {MONEY}, posting_type string,
        account_id string, account_name string, detail_type string""",
    "security_user_client_map": "user_email string, client_id string",
    "report_rows": """client_id string, report_table string, report_name string,
        start_period string, end_period string, report_year int, row_ord string, section string,
        row_type string, cells array<struct<title:string,value:string>>""",
}

# Primary keys, tenant first.
PRIMARY_KEYS: dict[str, tuple[str, ...]] = {
    "dim_client": ("client_id",),
    "dim_date": ("date_key",),
    "dim_account": ("client_id", "account_id"),
    "dim_customer": ("client_id", "customer_id"),
    "dim_vendor": ("client_id", "vendor_id"),
    "dim_item": ("client_id", "item_id"),
    "dim_employee": ("client_id", "employee_id"),
    "fact_invoice": ("client_id", "invoice_id"),
    "fact_invoice_line": ("client_id", "invoice_id", "line_id"),
    "fact_payment": ("client_id", "payment_id"),
    # the line's place keeps lines apart that name no invoice, or the same one
    "fact_payment_line": ("client_id", "payment_id", "linked_invoice_id", "line_num"),
    "fact_bill": ("client_id", "bill_id"),
    "fact_bill_line": ("client_id", "bill_id", "line_id"),
    "fact_purchase": ("client_id", "purchase_id"),
    "fact_purchase_line": ("client_id", "purchase_id", "line_id"),
    "fact_estimate": ("client_id", "estimate_id"),
    "fact_estimate_line": ("client_id", "estimate_id", "line_id"),
    **{table: ("client_id", "id") for table in GENERIC_TABLES.values()},
    **{f"fact_{e}_line": ("client_id", f"{e}_id", "line_id")
       for e in ("credit_memo", "sales_receipt", "refund_receipt", "journal_entry")},
    "security_user_client_map": ("user_email", "client_id"),
    "report_rows": ("client_id", "report_table", "start_period", "end_period", "row_ord"),
}


def primary_key(table: str) -> list[str]:
    """Key columns of a table; tables outside the catalog are keyed by (client_id, id)."""
    return list(PRIMARY_KEYS.get(table, ("client_id", "id")))


def columns(table: str) -> list[tuple[str, str]]:
    """(name, type) pairs of a table in declared order."""
    pairs, depth, field = [], 0, ""
    for char in TABLES[table] + ",":
        if char == "," and depth == 0:
            name, dtype = field.split(None, 1)
            pairs.append((name, dtype.strip()))
            field = ""
            continue
        depth += (char in "(<") - (char in ")>")
        field += char
    return pairs
