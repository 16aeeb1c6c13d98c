"""JSON layouts of source records and the mapping of their fields to warehouse columns.

A raw row is (client_id, source_name, ord, record): `record` is the JSON text of one entity,
`ord` orders the versions of an entity, later ones last. Scalars are parsed as text; typing is
left to the coercion step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.coerce import coerce
from ..functions.parsing import is_damaged, with_parsed
from ..schemas import BOOKED, ENTITY_TABLES, GENERIC_TABLES, LINE_TABLES, columns
from .quality import coerce_columns

# Record layouts. `ref` stands for a reference object.
_REF = "struct<value:string,name:string,type:string>"
_LINKED = "array<struct<TxnId:string,TxnType:string>>"
_SALES = (
    "struct<ItemRef:ref,ItemAccountRef:ref,Qty:string,UnitPrice:string,TaxCodeRef:ref,"
    "ServiceDate:string>"
)
_ITEM_EXPENSE = (
    "struct<ItemRef:ref,Qty:string,UnitPrice:string,BillableStatus:string,TaxCodeRef:ref,"
    "CustomerRef:ref>"
)
_ACCOUNT_EXPENSE = "struct<AccountRef:ref,BillableStatus:string,TaxCodeRef:ref,CustomerRef:ref>"
_LINE_HEAD = "Id:string,LineNum:string,Description:string,Amount:string,DetailType:string"
_SALES_LINE = (
    f"Line array<struct<{_LINE_HEAD},SalesItemLineDetail:{_SALES},LinkedTxn:{_LINKED}>>"
)
_EXPENSE_LINE = (
    f"Line array<struct<{_LINE_HEAD},ItemBasedExpenseLineDetail:{_ITEM_EXPENSE},"
    f"AccountBasedExpenseLineDetail:{_ACCOUNT_EXPENSE}>>"
)
_PAYMENT_LINE = (
    f"Line array<struct<Amount:string,LinkedTxn:{_LINKED},"
    "LineEx:struct<`any`:array<struct<value:struct<Name:string,Value:string>>>>>>"
)
_CONTACT = "PrimaryEmailAddr struct<Address:string>, PrimaryPhone struct<FreeFormNumber:string>"

LAYOUTS = {
    "Account": """Id string, Name string, FullyQualifiedName string, Classification string,
        AccountType string, AccountSubType string, SubAccount string, ParentRef ref,
        Active string, CurrentBalance string, CurrencyRef ref""",
    "Customer": f"""Id string, DisplayName string, CompanyName string, GivenName string,
        FamilyName string, {_CONTACT},
        BillAddr struct<City:string,CountrySubDivisionCode:string,PostalCode:string>,
        Job string, Active string, Balance string, ParentRef ref""",
    "Vendor": f"""Id string, DisplayName string, CompanyName string, {_CONTACT},
        Vendor1099 string, Active string, Balance string""",
    "Item": """Id string, Name string, Description string, Type string, UnitPrice string,
        PurchaseCost string, Active string, IncomeAccountRef ref, ExpenseAccountRef ref,
        TrackQtyOnHand string, QtyOnHand string""",
    "Employee": """Id string, DisplayName string, GivenName string, FamilyName string,
        HiredDate string, Active string""",
    "Invoice": f"""Id string, DocNumber string, TxnDate string, DueDate string, CustomerRef ref,
        TotalAmt string, Balance string, TxnTaxDetail struct<TotalTax:string>,
        EmailStatus string, PrintStatus string, {_SALES_LINE}""",
    "Bill": f"""Id string, TxnDate string, DueDate string, VendorRef ref, TotalAmt string,
        Balance string, {_EXPENSE_LINE}""",
    "Payment": f"""Id string, TxnDate string, TotalAmt string, CustomerRef ref,
        DepositToAccountRef ref, PaymentMethodRef ref, UnappliedAmt string, {_PAYMENT_LINE}""",
    "Purchase": f"""Id string, TxnDate string, PaymentType string, TotalAmt string,
        AccountRef ref, EntityRef ref, Credit string, DocNumber string, {_EXPENSE_LINE}""",
    "Estimate": f"""Id string, DocNumber string, TxnDate string, CustomerRef ref,
        TotalAmt string, TxnStatus string, LinkedTxn {_LINKED}, {_SALES_LINE}""",
}
_GENERIC_LAYOUT = "Id string, Name string, FullyQualifiedName string, Active string"
_BOOKED_LAYOUT = f"{_GENERIC_LAYOUT}, DocNumber string, TxnDate string, CustomerRef ref, TotalAmt string"
_JOURNAL = "JournalEntryLineDetail:struct<PostingType:string,AccountRef:ref>"
LAYOUTS |= {
    **{e: f"{_BOOKED_LAYOUT}, {_SALES_LINE}" for e in ("CreditMemo", "SalesReceipt", "RefundReceipt")},
    "JournalEntry": f"{_BOOKED_LAYOUT}, Line array<struct<{_LINE_HEAD},{_JOURNAL}>>",
}
SALES = ("Invoice", "Estimate", "CreditMemo", "SalesReceipt", "RefundReceipt")

# Warehouse column -> field path, or (field path, default for a missing field).
FIELDS: dict[str, dict[str, str | tuple[str, str]]] = {
    "Account": {
        "account_id": "Id", "account_name": "Name", "fully_qualified_name": "FullyQualifiedName",
        "classification": "Classification", "account_type": "AccountType",
        "account_sub_type": "AccountSubType", "is_sub_account": ("SubAccount", "false"),
        "parent_account_id": "ParentRef.value", "is_active": ("Active", "true"),
        "current_balance": ("CurrentBalance", "0"),
        "currency_code": ("CurrencyRef.value", "USD"),
    },
    "Customer": {
        "customer_id": "Id", "display_name": "DisplayName", "company_name": "CompanyName",
        "given_name": "GivenName", "family_name": "FamilyName",
        "email": "PrimaryEmailAddr.Address", "phone": "PrimaryPhone.FreeFormNumber",
        "billing_city": "BillAddr.City", "billing_state": "BillAddr.CountrySubDivisionCode",
        "billing_postal_code": "BillAddr.PostalCode", "is_job": ("Job", "false"),
        "is_active": ("Active", "true"), "balance": ("Balance", "0"),
        "parent_customer_id": "ParentRef.value",
    },
    "Vendor": {
        "vendor_id": "Id", "display_name": "DisplayName", "company_name": "CompanyName",
        "email": "PrimaryEmailAddr.Address", "phone": "PrimaryPhone.FreeFormNumber",
        "is_1099": ("Vendor1099", "false"), "is_active": ("Active", "true"),
        "balance": ("Balance", "0"),
    },
    "Item": {
        "item_id": "Id", "item_name": "Name", "description": "Description", "item_type": "Type",
        "unit_price": "UnitPrice", "purchase_cost": "PurchaseCost",
        "is_active": ("Active", "true"), "income_account_id": "IncomeAccountRef.value",
        "expense_account_id": "ExpenseAccountRef.value",
        "track_qty": ("TrackQtyOnHand", "false"), "qty_on_hand": "QtyOnHand",
    },
    "Employee": {
        "employee_id": "Id", "display_name": "DisplayName", "given_name": "GivenName",
        "family_name": "FamilyName", "hired_date": "HiredDate", "is_active": ("Active", "true"),
    },
    "Invoice": {
        "invoice_id": "Id", "doc_number": "DocNumber", "txn_date": "TxnDate",
        "due_date": "DueDate", "customer_id": "CustomerRef.value", "total_amount": "TotalAmt",
        "balance": "Balance", "total_tax": ("TxnTaxDetail.TotalTax", "0"),
        "email_status": "EmailStatus", "print_status": "PrintStatus",
    },
    "Bill": {
        "bill_id": "Id", "txn_date": "TxnDate", "due_date": "DueDate",
        "vendor_id": "VendorRef.value", "total_amount": "TotalAmt", "balance": "Balance",
    },
    "Payment": {
        "payment_id": "Id", "txn_date": "TxnDate", "total_amount": "TotalAmt",
        "customer_id": "CustomerRef.value", "deposit_to_account_id": "DepositToAccountRef.value",
        "payment_method_id": "PaymentMethodRef.value", "unapplied_amount": ("UnappliedAmt", "0"),
    },
    "Purchase": {
        "purchase_id": "Id", "txn_date": "TxnDate", "payment_type": "PaymentType",
        "total_amount": "TotalAmt", "account_id": "AccountRef.value",
        "vendor_id": "EntityRef.value", "vendor_type": "EntityRef.type",
        "is_credit": ("Credit", "false"), "doc_number": "DocNumber",
    },
    "Estimate": {
        "estimate_id": "Id", "doc_number": "DocNumber", "txn_date": "TxnDate",
        "customer_id": "CustomerRef.value", "total_amount": "TotalAmt",
        "txn_status": "TxnStatus",
    },
}

# Why a record is refused.
DAMAGED, KEYLESS = "damaged", "no id"

# Fields of lines, line types that only sum up, names of payment notes.
_LINE_COMMON = {
    "line_id": "Id", "line_num": "LineNum", "description": "Description", "amount": "Amount",
}
_SALES_FIELDS = {
    **_LINE_COMMON, "quantity": "SalesItemLineDetail.Qty",
    "unit_price": "SalesItemLineDetail.UnitPrice", "item_id": "SalesItemLineDetail.ItemRef.value",
    "item_name": "SalesItemLineDetail.ItemRef.name",
    "account_id": "SalesItemLineDetail.ItemAccountRef.value",
    "account_name": "SalesItemLineDetail.ItemAccountRef.name",
    "tax_code_ref": "SalesItemLineDetail.TaxCodeRef.value",
    "service_date": "SalesItemLineDetail.ServiceDate",
}
# Fields of the detail object that an expense line's type selects.
_EXPENSE_FIELDS = {
    "ItemBasedExpenseLineDetail": {
        "quantity": "Qty", "unit_price": "UnitPrice", "item_id": "ItemRef.value",
        "item_name": "ItemRef.name", "billable_status": "BillableStatus",
        "tax_code_ref": "TaxCodeRef.value", "customer_id": "CustomerRef.value",
        "customer_name": "CustomerRef.name",
    },
    "AccountBasedExpenseLineDetail": {
        "account_id": "AccountRef.value", "account_name": "AccountRef.name",
        "billable_status": "BillableStatus", "tax_code_ref": "TaxCodeRef.value",
        "customer_id": "CustomerRef.value", "customer_name": "CustomerRef.name",
    },
}
SUMMARY_LINES = ("SubTotalLineDetail", "DiscountLineDetail")
DOCUMENT_KEYS = {
    "Invoice": "invoice_id", "Bill": "bill_id", "Purchase": "purchase_id",
    "Payment": "payment_id", "Estimate": "estimate_id", "CreditMemo": "credit_memo_id",
    "SalesReceipt": "sales_receipt_id", "RefundReceipt": "refund_receipt_id",
    "JournalEntry": "journal_entry_id",
}
# Names of the notes of a payment line.
PAYMENT_NOTES = {
    "original_open_balance": "txnOpenBalance", "invoice_doc_number": "txnReferenceNumber",
}


def layout(entity: str) -> str:
    """Schema of an entity's records. Entities without their own layout use the generic one."""
    text = LAYOUTS.get(entity, _GENERIC_LAYOUT)
    return text.replace(" ref", f" {_REF}").replace(":ref", f":{_REF}")


def target_table(entity: str) -> str:
    if entity not in ENTITY_TABLES:
        raise ValueError(f"no warehouse table for entity {entity!r}")
    return ENTITY_TABLES[entity]


def parsed_once(raw: DataFrame, entity: str) -> DataFrame:
    """Records of one entity as struct `r` beside the reason why a record is refused, and the text of
    refused ones. Written once, it stands for `raw` in all functions below, which then parse nothing."""
    return _read(raw, entity).withColumn("record", F.when(F.col("reason").isNotNull(), F.col("record")))


def _read(raw: DataFrame, entity: str) -> DataFrame:
    chosen = raw.where(F.col("source_name") == entity)
    if "reason" in raw.columns:
        return chosen
    return with_parsed(chosen, "r", "record", layout(entity)).withColumn(
        "reason", F.when(is_damaged("r"), F.lit(DAMAGED))
        .when(F.coalesce(F.trim("r.Id"), F.lit("")) == "", F.lit(KEYLESS)))


def parse(raw: DataFrame, entity: str) -> DataFrame:
    """Records of one entity as struct `r`. A record is accepted or refused as a whole: header
    and lines are read with the same layout. `quarantine` returns the refused ones."""
    return _read(raw, entity).where("reason is null").drop("reason")


def quarantine(raw: DataFrame, entity: str) -> DataFrame:
    """Records of one entity that are not valid JSON of its layout or lack their id, with the
    reason."""
    return _read(raw, entity).where("reason is not null").drop("r")


def _field(row: str, rule: str | tuple[str, str]) -> Column:
    if isinstance(rule, str):
        return F.col(f"{row}.{rule}")
    path, default = rule
    return F.coalesce(F.col(f"{row}.{path}"), F.lit(default))


def map_records(raw: DataFrame, entity: str) -> DataFrame:
    """Header columns of an entity, typed as its warehouse table, beside client_id and ord."""
    mapped = _header(entity)
    text = parse(raw, entity).select(
        "client_id", "ord", *(c.alias(n) for n, c in mapped.items()))
    return coerce_columns(text, dict(columns(target_table(entity))))


def _header(entity: str) -> dict[str, Column]:
    """Header columns as text, from struct `r`."""
    target_table(entity)
    if entity in GENERIC_TABLES:
        mapped = {
            "id": F.col("r.Id"), "name": F.col("r.Name"),
            "fully_qualified_name": F.coalesce("r.FullyQualifiedName", "r.Name"),
            "is_active": F.coalesce("r.Active", F.lit("true")),
        }
        if entity in BOOKED:
            mapped |= {
                "doc_number": F.col("r.DocNumber"), "txn_date": F.col("r.TxnDate"),
                "customer_id": F.col("r.CustomerRef.value"), "total_amount": F.col("r.TotalAmt"),
            }
    else:
        mapped = {name: _field("r", rule) for name, rule in FIELDS[entity].items()}
    if entity == "Estimate":
        billed = F.filter("r.LinkedTxn", lambda t: t.TxnType == "Invoice")
        mapped["linked_invoice_id"] = F.get(billed, F.lit(0)).TxnId
    return mapped


def flatten_lines(raw: DataFrame, entity: str, header: tuple[str, ...] = ()) -> DataFrame:
    """One row per line of an entity's Line array, typed as its line table, beside ord.

    `ord` of a line extends the record's with the line's position. Columns of the record's own header that are
    asked for come along as struct `header`.
    """
    key = DOCUMENT_KEYS[entity]
    kinds = dict(columns(target_table(entity)))
    own = [F.struct(*(coerce(_header(entity)[c], kinds[c]).alias(c) for c in header)).alias("header")] if header else []
    carried = ["header"] if header else []
    arrays = parse(raw, entity).select(
        "client_id", "ord", F.col("r.Id").alias(key), *own, F.col("r.Line").alias("lines"))
    exploded = arrays.select(
        "client_id", "ord", key, *carried, F.posexplode("lines").alias("line_pos", "line"))
    kind = F.coalesce("line.DetailType", F.lit(""))
    if entity in SALES:
        exploded = exploded.where(~kind.isin(*SUMMARY_LINES))
        mapped = {name: _field("line", rule) for name, rule in _SALES_FIELDS.items()}
        mapped["detail_type"] = kind
        first = F.get("line.LinkedTxn", F.lit(0))
        mapped |= {"linked_txn_id": first.TxnId, "linked_txn_type": first.TxnType}
    elif entity == "JournalEntry":
        exploded = exploded.where(kind == "JournalEntryLineDetail")
        mapped = {name: _field("line", rule) for name, rule in _LINE_COMMON.items()}
        detail = F.col("line.JournalEntryLineDetail")
        mapped |= {
            "posting_type": detail.PostingType, "account_id": detail.AccountRef.value,
            "account_name": detail.AccountRef["name"], "detail_type": kind,
        }
    elif entity in ("Bill", "Purchase"):
        exploded = exploded.where(kind.isin(*_EXPENSE_FIELDS))
        mapped = {name: _field("line", rule) for name, rule in _LINE_COMMON.items()}
        mapped["detail_type"] = kind
        for detail, fields in _EXPENSE_FIELDS.items():
            for name, path in fields.items():
                chosen = F.when(kind == detail, F.col(f"line.{detail}.{path}"))
                mapped[name] = F.coalesce(mapped[name], chosen) if name in mapped else chosen
    else:
        first = F.get("line.LinkedTxn", F.lit(0))
        mapped = {
            "amount": F.col("line.Amount"), "linked_invoice_id": first.TxnId,
            "line_num": (F.col("line_pos") + 1).cast("string"),
            "linked_txn_type": first.TxnType,
        }
        for name, note in PAYMENT_NOTES.items():
            mapped[name] = last_note(F.col("line.LineEx.any"), note)
    types = dict(columns(LINE_TABLES[entity]))
    text = exploded.select(
        "client_id", F.struct("ord", "line_pos").alias("ord"), key, *carried,
        *(c.alias(n) for n, c in mapped.items() if n in types),
    )
    return coerce_columns(text, types)


def last_note(bag: Column, name: str) -> Column:
    """Value of the last entry with this name in a name/value bag; null without one."""
    match = F.try_element_at(F.filter(bag, lambda x: x.value.Name == name), F.lit(-1))
    return F.when(match.isNotNull(), F.coalesce(match.value.Value, F.lit("")))
