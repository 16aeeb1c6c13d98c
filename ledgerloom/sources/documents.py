"""Source records built from the star tables, in the JSON layouts of the landed files.

The Line array of one transaction is cut into records of at most `LINES_PER_RECORD` line
numbers. Each part repeats the header: keep-last reduces the headers to one, and lines are keyed
by their own id, so the parts load exactly like one record and no array grows without bound.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from .star import StarTables

LINES_PER_RECORD = 500
PULLED_AT = dt.datetime(2001, 8, 1, 11, 0, 0)


def ref(value, name=None, kind=None) -> Column:
    fields = [F.col(value).alias("value") if isinstance(value, str) else value.alias("value")]
    if name is not None:
        fields.append(F.col(name).alias("name"))
    if kind is not None:
        fields.append(F.lit(kind).alias("type"))
    return F.struct(*fields)


def iso(date: str) -> Column:
    return F.col(date).cast("string")


def record(df: DataFrame, entity: str, *fields: Column, ts: dt.datetime = PULLED_AT) -> DataFrame:
    """Raw rows: (client_id, source_name, ord, record)."""
    order = F.struct(
        F.lit(ts).cast("timestamp_ntz").alias("ts"), F.lit(0).cast("bigint").alias("block"),
        F.lit(0).cast("bigint").alias("pos"), F.lit(0).alias("item"),
    )
    return df.select(
        "client_id", F.lit(entity).alias("source_name"), order.alias("ord"),
        F.to_json(F.struct(*fields)).alias("record"),
    )


# The order of a document's lines, by which they and the headers lie together already.
ORDER = "l_orderkey"


def line_arrays(lines: DataFrame, key: str, line: Column, subtotal: bool) -> DataFrame:
    """Lines of each document in number order, at most LINES_PER_RECORD per row, closed by a
    subtotal line when asked. Lines that come with their order lie by it and are collected where they lie;
    others are dealt by document before. Either way the arrays meet their headers without another shuffle."""
    keys = ["client_id", key]
    if ORDER in lines.columns:
        keys.insert(1, ORDER)
    else:
        lines = lines.repartition(*keys)
    part = F.floor(F.col("line_num") / LINES_PER_RECORD).alias("part")
    numbered = F.struct(F.col("line_num").alias("n"), line.alias("line"))
    grouped = lines.groupBy(*keys, part).agg(
        F.sort_array(F.collect_list(numbered)).alias("numbered"), F.sum("amount").alias("total"),
    )
    array = F.transform("numbered", lambda x: x.line)
    if subtotal:
        known = {"Amount": F.col("total"), "DetailType": F.lit("SubTotalLineDetail")}
        fields = grouped.select(array.alias("a")).schema["a"].dataType.elementType.fields
        summary = F.struct(*(
            known.get(f.name, F.lit(None)).try_cast(f.dataType).alias(f.name) for f in fields))
        array = F.concat(array, F.array(summary))
    return grouped.select(*keys, array.alias("Line"))


def with_lines(headers: DataFrame, arrays: DataFrame, key: str) -> DataFrame:
    """Headers, with their order in column ORDER, beside the arrays of their lines. Both lie by the order, which
    is one of the columns that they are joined by."""
    headers.sparkSession.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return headers.join(arrays, ["client_id", ORDER, key], "left")


def invoices(star: StarTables, lines: bool = True, surcharge: int = 0,
             ts: dt.datetime = PULLED_AT) -> DataFrame:
    """Invoice records; `surcharge` builds a stale version with a different total."""
    headers = star.table("fact_invoice", beside=("o_orderkey",) if lines else ())
    fields = [
        F.col("invoice_id").alias("Id"), F.col("doc_number").alias("DocNumber"),
        iso("txn_date").alias("TxnDate"), iso("due_date").alias("DueDate"),
        ref("customer_id").alias("CustomerRef"),
        (F.col("total_amount") + surcharge).alias("TotalAmt"), F.col("balance").alias("Balance"),
        F.when(F.col("total_tax") != 0, F.struct(F.col("total_tax").alias("TotalTax")))
        .alias("TxnTaxDetail"),
        F.col("email_status").alias("EmailStatus"), F.col("print_status").alias("PrintStatus"),
    ]
    if lines:
        headers = with_lines(
            headers.withColumnRenamed("o_orderkey", ORDER), _sales_lines(star, "fact_invoice_line", "invoice_id"), "invoice_id")
        fields.append("Line")
    return record(headers, "Invoice", *map(_col, fields), ts=ts)


def estimates(star: StarTables, lines: bool = True) -> DataFrame:
    headers = star.table("fact_estimate", beside=("o_orderkey",) if lines else ())
    def linked(kind):
        return F.struct(F.col("linked_invoice_id").alias("TxnId"), F.lit(kind).alias("TxnType"))
    fields = [
        F.col("estimate_id").alias("Id"), F.col("doc_number").alias("DocNumber"),
        iso("txn_date").alias("TxnDate"), ref("customer_id").alias("CustomerRef"),
        F.col("total_amount").alias("TotalAmt"), F.col("txn_status").alias("TxnStatus"),
        F.when(
            F.col("linked_invoice_id").isNotNull(),
            F.array(
                F.struct(F.lit("0").alias("TxnId"), F.lit("PurchaseOrder").alias("TxnType")),
                linked("Invoice"), F.struct(F.lit("1").alias("TxnId"), F.lit("Invoice").alias("TxnType")),
            ),
        ).alias("LinkedTxn"),
    ]
    if lines:
        headers = with_lines(
            headers.withColumnRenamed("o_orderkey", ORDER), _sales_lines(star, "fact_estimate_line", "estimate_id"), "estimate_id")
        fields.append("Line")
    return record(headers, "Estimate", *map(_col, fields))


def _sales_lines(star: StarTables, table: str, key: str) -> DataFrame:
    lines = star.table(table, beside=(ORDER,))
    service = F.col("service_date") if "service_date" in lines.columns else F.lit(None)
    line = F.struct(
        F.col("line_id").alias("Id"), F.col("line_num").alias("LineNum"),
        F.col("item_name").alias("Description"), F.col("amount").alias("Amount"),
        F.col("detail_type").alias("DetailType"),
        F.struct(
            ref("item_id", "item_name").alias("ItemRef"),
            ref("account_id", "account_name").alias("ItemAccountRef"),
            F.col("quantity").alias("Qty"), F.col("unit_price").alias("UnitPrice"),
            ref(F.lit("TAX")).alias("TaxCodeRef"),
            service.cast("string").alias("ServiceDate"),
        ).alias("SalesItemLineDetail"),
    )
    return line_arrays(lines, key, line, subtotal=True)


def _expense_lines(star: StarTables, flag: str, key: Column) -> DataFrame:
    """Even line numbers are item based, odd ones account based."""
    wanted = {"item_name", "account_id"}
    lines = star.tenant_lines(wanted, flag).withColumns({
        "id": key, "line_num": F.col("l_linenumber"), "item_id": F.col("l_partkey").cast("string"),
        "account_id": F.concat(F.lit("EXP-"), "p_type"),
        "buyer": F.col("o_custkey").cast("string"), "kind_item": F.col("l_linenumber") % 2 == 0,
    })
    billing = (
        F.lit("NotBillable").alias("BillableStatus"), ref(F.lit("TAX")).alias("TaxCodeRef"),
        ref("buyer", "buyer").alias("CustomerRef"),
    )
    line = F.struct(
        F.col("line_num").cast("string").alias("Id"), F.col("line_num").alias("LineNum"),
        F.col("p_name").alias("Description"), F.col("amount").alias("Amount"),
        F.when(F.col("kind_item"), "ItemBasedExpenseLineDetail")
        .otherwise("AccountBasedExpenseLineDetail").alias("DetailType"),
        F.when(F.col("kind_item"), F.struct(
            ref("item_id", "p_name").alias("ItemRef"), F.col("quantity").alias("Qty"),
            F.col("unit_price").alias("UnitPrice"), *billing,
        )).alias("ItemBasedExpenseLineDetail"),
        F.when(~F.col("kind_item"), F.struct(
            ref("account_id", "p_type").alias("AccountRef"), *billing,
        )).alias("AccountBasedExpenseLineDetail"),
    )
    return line_arrays(lines, "id", line, subtotal=True)


def bills(star: StarTables, lines: bool = True) -> DataFrame:
    headers = star.table("fact_bill", beside=(ORDER,) if lines else ())
    fields = [
        F.col("bill_id").alias("Id"), iso("txn_date").alias("TxnDate"),
        iso("due_date").alias("DueDate"), ref("vendor_id").alias("VendorRef"),
        F.col("total_amount").alias("TotalAmt"), F.col("balance").alias("Balance"),
    ]
    if lines:
        key = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_suppkey").cast("string"))
        arrays = _expense_lines(star, "A", key).withColumnRenamed("id", "bill_id")
        headers = with_lines(headers, arrays, "bill_id")
        fields.append("Line")
    return record(headers, "Bill", *map(_col, fields))


def purchases(star: StarTables, lines: bool = True) -> DataFrame:
    headers = star.table("fact_purchase", beside=(ORDER,) if lines else ())
    fields = [
        F.col("purchase_id").alias("Id"), iso("txn_date").alias("TxnDate"),
        F.col("payment_type").alias("PaymentType"), F.col("total_amount").alias("TotalAmt"),
        ref("account_id").alias("AccountRef"),
        ref("vendor_id", kind="Vendor").alias("EntityRef"), F.col("is_credit").alias("Credit"),
        F.col("doc_number").alias("DocNumber"),
    ]
    if lines:
        key = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
        arrays = _expense_lines(star, "R", key).withColumnRenamed("id", "purchase_id")
        headers = with_lines(headers, arrays, "purchase_id")
        fields.append("Line")
    return record(headers, "Purchase", *map(_col, fields))


def payments(star: StarTables) -> DataFrame:
    """Each payment has one line linked to its invoice; the open balance is noted twice, the
    valid one last."""
    headers = star.table("fact_payment").join(
        star.table("fact_payment_line", "client_id", "payment_id", "amount", "linked_invoice_id",
                   "original_open_balance", "invoice_doc_number"),
        ["client_id", "payment_id"],
    )
    def note(name, value):
        return F.struct(F.struct(F.lit(name).alias("Name"), value.alias("Value")).alias("value"))
    line = F.struct(
        F.col("amount").alias("Amount"),
        F.array(F.struct(
            F.col("linked_invoice_id").alias("TxnId"), F.lit("Invoice").alias("TxnType"),
        )).alias("LinkedTxn"),
        F.struct(F.array(
            note("txnId", F.col("linked_invoice_id")), note("txnOpenBalance", F.lit("0")),
            note("txnReferenceNumber", F.col("invoice_doc_number")),
            note("txnOpenBalance", F.col("original_open_balance")),
        ).alias("any")).alias("LineEx"),
    )
    return record(
        headers, "Payment", F.col("payment_id").alias("Id"), iso("txn_date").alias("TxnDate"),
        F.col("total_amount").alias("TotalAmt"), ref("customer_id").alias("CustomerRef"),
        ref("deposit_to_account_id").alias("DepositToAccountRef"),
        F.col("unapplied_amount").alias("UnappliedAmt"), F.array(line).alias("Line"),
    )


def accounts(star: StarTables) -> DataFrame:
    df = star.table("dim_account")
    parent = F.when(F.col("parent_account_id").isNotNull(), ref("parent_account_id"))
    return record(
        df, "Account", F.col("account_id").alias("Id"), F.col("account_name").alias("Name"),
        F.col("fully_qualified_name").alias("FullyQualifiedName"),
        F.col("classification").alias("Classification"),
        F.col("account_type").alias("AccountType"),
        F.when(F.col("is_sub_account"), True).alias("SubAccount"), parent.alias("ParentRef"),
        F.col("current_balance").alias("CurrentBalance"),
    )


def customers(star: StarTables) -> DataFrame:
    df = star.table("dim_customer")
    return record(
        df, "Customer", F.col("customer_id").alias("Id"),
        F.col("display_name").alias("DisplayName"), F.col("company_name").alias("CompanyName"),
        F.struct(F.concat("customer_id", F.lit("@x")).alias("Address")).alias("PrimaryEmailAddr"),
        F.struct(F.col("billing_state").alias("CountrySubDivisionCode")).alias("BillAddr"),
        F.col("balance").alias("Balance"),
    )


def vendors(star: StarTables) -> DataFrame:
    df = star.table("dim_vendor")
    return record(
        df, "Vendor", F.col("vendor_id").alias("Id"), F.col("display_name").alias("DisplayName"),
        F.struct(F.col("vendor_id").alias("FreeFormNumber")).alias("PrimaryPhone"),
        (F.col("vendor_id").cast("int") % 2 == 0).alias("Vendor1099"),
        F.col("balance").alias("Balance"),
    )


def items(star: StarTables) -> DataFrame:
    df = star.table("dim_item")
    return record(
        df, "Item", F.col("item_id").alias("Id"), F.col("item_name").alias("Name"),
        F.col("item_type").alias("Type"), F.col("unit_price").alias("UnitPrice"),
        ref("income_account_id").alias("IncomeAccountRef"),
        ref("expense_account_id").alias("ExpenseAccountRef"),
    )


def employees(star: StarTables) -> DataFrame:
    """Supplier contacts as employees of their region's tenant."""
    df = star.source("supplier").join(
        star.tenants(), F.col("s_nationkey") == F.col("n_nationkey")
    )
    hired = F.date_add(F.lit(dt.date(1995, 1, 1)), (F.col("s_suppkey") % 1000).cast("int"))
    return record(
        df, "Employee", F.col("s_suppkey").cast("string").alias("Id"),
        F.col("s_name").alias("DisplayName"),
        F.substring_index("s_name", "#", 1).alias("GivenName"),
        F.substring_index("s_name", "#", -1).alias("FamilyName"),
        hired.cast("string").alias("HiredDate"), (F.col("s_suppkey") % 7 != 0).alias("Active"),
    )


def classes(star: StarTables) -> DataFrame:
    """Customers as classes: odd keys have a qualified name, every fifth is inactive, and every
    third leaves the flag out."""
    key = F.col("customer_id").cast("bigint")
    df = star.table("dim_customer")
    return record(
        df, "Class", F.col("customer_id").alias("Id"), F.col("display_name").alias("Name"),
        F.when(key % 2 == 1, F.concat_ws(":", "company_name", "display_name"))
        .alias("FullyQualifiedName"),
        F.when(key % 3 != 0, key % 5 != 0).alias("Active"),
    )


def pages(raw: DataFrame, size: int = 1000) -> DataFrame:
    """Documents of at most `size` records with numeric ids, cut by id range and alternating
    compact and indented arrays."""
    page = F.floor(F.get_json_object("record", "$.Id").cast("bigint") / size).alias("page")
    grouped = raw.groupBy("client_id", "source_name", F.col("ord.ts").alias("ts"), page).agg(
        F.sort_array(F.collect_list("record")).alias("records"))
    compact = F.concat(F.lit("["), F.array_join("records", ","), F.lit("]"))
    bodies = F.transform("records", lambda r: F.regexp_replace(r, r"^\{|\}$", ""))
    indented = F.concat(
        F.lit("[\n  {\n    "), F.array_join(bodies, "\n  },\n  {\n    "), F.lit("\n  }\n]"),
    )
    return grouped.select(
        "client_id", "source_name", "ts",
        F.when(F.col("page") % 2 == 0, compact).otherwise(indented).alias("document"),
    )


def aged_receivables(star: StarTables, name: str = "AgedReceivables", year: int | None = None,
                     prefix: str = "report_") -> DataFrame:
    """One nested report document per tenant: nation sections, market segment sections inside
    them, a data row per order status, and a summary at every level. A document has at most
    a few hundred rows, whatever the number of orders."""
    orders = star.orders()
    if year is not None:
        orders = orders.where(F.year("order_date") == year)
    details = star.customers().select(
        F.col("c_custkey").alias("o_custkey"), "n_name", "c_mktsegment")
    cells = orders.join(details, "o_custkey").groupBy(
        "client_id", "n_name", "c_mktsegment", "o_orderstatus"
    ).agg(F.count(F.lit(1)).alias("n"), F.sum("total").alias("total"))

    def coldata(label, n="n", total="total"):
        values = (F.col(label), F.col(n).cast("string"), F.col(total).cast("string"))
        return F.array(*(F.struct(v.alias("value")) for v in values)).alias("ColData")

    def section(df, label, keys):
        grouped = df.groupBy(*keys).agg(
            F.sort_array(F.collect_list("node")).alias("Row"), F.sum("n").alias("n"),
            F.sum("total").alias("total"))
        node = F.struct(
            F.lit("Section").alias("type"),
            F.struct(F.array(F.struct(F.col(label).alias("value"))).alias("ColData"))
            .alias("Header"),
            F.struct("Row").alias("Rows"),
            F.struct(coldata("sum_label")).alias("Summary"),
        )
        return grouped.withColumn("sum_label", F.concat(F.lit("Total "), label)).select(
            *keys, "n", "total", node.alias("node"))

    leaves = cells.withColumn(
        "node", F.struct(F.lit("Data").alias("type"), coldata("o_orderstatus")))
    segments = section(leaves, "c_mktsegment", ["client_id", "n_name", "c_mktsegment"])
    nations = section(segments, "n_name", ["client_id", "n_name"])
    documents = nations.groupBy("client_id").agg(
        F.sort_array(F.collect_list("node")).alias("Row"))
    first, last = (f"{year}-01-01", f"{year}-12-31") if year else ("1995-01-01", "2001-08-01")
    titles = F.array(*(
        F.struct(F.lit(t).alias("ColTitle")) for t in ("Status", "Invoices", "Total")))
    source = f"{prefix}{name}" + (f"_{year}" if year else "")
    return record(
        documents, source,
        F.struct(
            F.lit(name).alias("ReportName"), F.lit(first).alias("StartPeriod"),
            F.lit(last).alias("EndPeriod"),
        ).alias("Header"),
        F.struct(titles.alias("Column")).alias("Columns"), F.struct("Row").alias("Rows"),
    )


def monthly_sales(star: StarTables, year: int) -> DataFrame:
    """One nested report document per tenant: a section per nation, a data row per market segment, and a
    column for each month in which the tenant sold. A tenant's sales of every fifth month are left out, so
    columns differ by tenant; the total stands twice, the second time with the number of orders, and a
    last cell is beyond the titles."""
    orders = star.orders().where((F.year("order_date") == year) & (F.month("order_date") % 5 != F.length("client_id") % 5)).join(
        star.customers().select(F.col("c_custkey").alias("o_custkey"), "n_name", "c_mktsegment"), "o_custkey")
    month = F.date_format("order_date", "MMM yyyy")
    sums = orders.groupBy("client_id", "n_name", "c_mktsegment", F.month("order_date").alias("n"), month.alias("month")).agg(
        F.sum("total").alias("total"), F.count(F.lit(1)).alias("orders"))
    months = sums.groupBy("client_id").agg(F.array_sort(F.collect_set(F.struct("n", "month"))).alias("months"))

    def values(*columns):
        return F.transform(F.concat(*columns), lambda v: F.struct(v.alias("value")))

    def one(column):
        return F.array(column.cast("string"))

    by_segment = sums.groupBy("client_id", "n_name", "c_mktsegment").agg(
        F.map_from_entries(F.collect_list(F.struct("month", F.col("total").cast("string")))).alias("cells"),
        F.sum("total").alias("total"), F.sum("orders").alias("orders"))
    cells = F.transform("months.month", lambda m: F.coalesce(F.element_at("cells", m), F.lit("")))
    rows = by_segment.join(months, "client_id").select(
        "client_id", "n_name", "months", "total", F.struct(F.lit("Data").alias("type"), values(
            one(F.col("c_mktsegment")), cells, one(F.col("total")), one(F.col("orders")), one(F.lit("beyond"))).alias("ColData")).alias("row"))
    sections = rows.groupBy("client_id", "n_name", "months").agg(F.sort_array(F.collect_list("row")).alias("Row"), F.sum("total").alias("total"))
    node = F.struct(
        F.lit("Section").alias("type"), F.struct(values(one(F.col("n_name"))).alias("ColData")).alias("Header"), F.struct("Row").alias("Rows"),
        F.struct(values(one(F.concat(F.lit("Total "), "n_name")), F.transform("months", lambda m: F.lit("")), one(F.lit("")),
                        one(F.col("total"))).alias("ColData")).alias("Summary"))
    documents = sections.select("client_id", "months", node.alias("node")).groupBy("client_id", "months").agg(
        F.sort_array(F.collect_list("node")).alias("Row"))
    titles = F.concat(one(F.lit("Segment")), F.col("months.month"), F.array(F.lit("Total"), F.lit("Total")))
    return record(
        documents.withColumn("titles", F.transform(titles, lambda t: F.struct(t.alias("ColTitle")))), f"report_ProfitAndLossCash_{year}",
        F.struct(F.lit("MonthlySales").alias("ReportName"), F.lit(f"{year}-01-01").alias("StartPeriod"), F.lit(f"{year}-12-31").alias("EndPeriod"))
        .alias("Header"), F.struct(F.col("titles").alias("Column")).alias("Columns"), F.struct("Row").alias("Rows"))


def journal_entries(star: StarTables) -> DataFrame:
    """A journal entry per payment: the bank is debited and receivables are credited, and a
    remark closes the entry."""
    payments = star.table("fact_payment", "client_id", "payment_id", "txn_date", "total_amount", "deposit_to_account_id")

    def line(number, kind, account, amount=F.col("total_amount")):
        return F.struct(
            F.lit(str(number)).alias("Id"), F.lit(number).alias("LineNum"), amount.alias("Amount"),
            F.lit("JournalEntryLineDetail").alias("DetailType"),
            F.struct(F.lit(kind).alias("PostingType"), ref(account).alias("AccountRef")).alias("JournalEntryLineDetail"))

    remark = F.struct(
        F.lit("3").alias("Id"), F.lit(3).alias("LineNum"), F.lit(None).cast("decimal(18,2)").alias("Amount"),
        F.lit("DescriptionOnly").alias("DetailType"),
        F.struct(F.lit(None).cast("string").alias("PostingType"), ref(F.lit(None).cast("string")).alias("AccountRef"))
        .alias("JournalEntryLineDetail"))
    return record(
        payments, "JournalEntry", F.col("payment_id").alias("Id"), iso("txn_date").alias("TxnDate"),
        F.array(line(1, "Debit", "deposit_to_account_id"), line(2, "Credit", F.lit("AR")), remark).alias("Line"))


def _col(field) -> Column:
    return F.col(field) if isinstance(field, str) else field


BUILDERS = {
    "Account": accounts, "Customer": customers, "Vendor": vendors, "Item": items,
    "Employee": employees, "Invoice": invoices, "Bill": bills, "Payment": payments,
    "Purchase": purchases, "Estimate": estimates, "Class": classes,
}
