"""Stored partial aggregates, from which measures and reports are read at any grain.

One pass over each fact writes three tables:

* activity: lines by tenant, kind, day, account, party and item, with amounts and line counts;
* documents: headers by tenant, kind, day and party, with totals and counts;
* customers: the tenant's invoiced customers per day, as bitmaps over customer numbers.

Sums and counts of any longer period are sums of theirs; distinct customers of any period come from the
union of its days' bitmaps and are exact. A `Rollup` is a model: the measures and reports take it like
the tables themselves and read these three tables in place of the facts.

Defined cases: lines without a header have a blank day and party; a blank customer counts as one more;
a line's amount is never lost to a missing account or item.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.merge import union
from ..sources.warehouse import materialize

KEYS = ["client_id", "kind", "txn_date"]


# Headers that are put together from lines are read for the lines' days and parties, for the documents and
# for the customers: written once.
HEADERS = {
    "fact_invoice": ("client_id", "invoice_id", "txn_date", "customer_id", "total_amount", "total_tax"),
    "fact_bill": ("client_id", "bill_id", "txn_date", "vendor_id", "total_amount"),
}


class Held:
    """A model of which some tables are held as written copies of the columns needed."""

    def __init__(self, model, **tables: DataFrame):
        self.model, self.tables = model, tables

    def table(self, name: str, *wanted: str) -> DataFrame:
        return self.tables[name].select(*wanted) if name in self.tables else self.model.table(name, *wanted)


def document_lines(model, line: str, header: str, key: str, party: str, flag: str | None = None) -> DataFrame:
    """Lines with their header's day and party; those of documents whose flag is set are left out, a missing
    flag counts as not set. Lines and headers are dealt and sorted by document once; `first` is set in one
    line of each document, day and party. The document's number comes first, as it tells rows apart sooner."""
    keys = [key, "client_id"]
    lines = model.table(line, *keys, "account_id", "item_id", "amount").repartition(*keys)
    first_line = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys)) == 1
    flagged = F.coalesce(F.col(flag), F.lit(False)) if flag else F.lit(False)
    headers = model.table(header, *keys, "txn_date", party, *filter(None, [flag])).withColumn("flagged", flagged).repartition(*keys)
    alike = Window.partitionBy(*keys, "txn_date", party, "flagged").orderBy(*keys)
    joined = lines.withColumn("first_line", first_line).join(
        headers.withColumn("copy", F.row_number().over(alike)), keys, "left").where(~F.coalesce("flagged", F.lit(False)))
    return joined.select(
        "client_id", "txn_date", F.col(party).alias("party_id"), "account_id", "item_id", "amount",
        (F.col("first_line") & (F.coalesce("copy", F.lit(1)) == 1)).cast("int").alias("first"))


def build(model) -> "Rollup":
    """Writes the aggregates of a model."""
    held = Held(model, **{name: materialize(model.table(name, *columns), name) for name, columns in HEADERS.items()})
    lines = union([df.withColumn("kind", F.lit(kind)) for kind, df in (
        ("revenue", document_lines(held, "fact_invoice_line", "fact_invoice", "invoice_id", "customer_id")),
        ("bill", document_lines(held, "fact_bill_line", "fact_bill", "bill_id", "vendor_id")),
        ("purchase", document_lines(held, "fact_purchase_line", "fact_purchase", "purchase_id", "vendor_id", "is_credit")))])
    activity = materialize(lines.groupBy(*KEYS, "account_id", "party_id", "item_id").agg(
        F.sum("amount").cast("decimal(38,2)").alias("amount"), F.count(F.lit(1)).alias("lines"), F.sum("first").alias("documents")), "activity")

    # One row per header, and the documents begun in a row of activity; summed in one grouping.
    def row(kind, party, total, documents, priced, tax, with_lines) -> list[Column]:
        return ["client_id", kind.alias("kind"), "txn_date", F.col(party).alias("party_id"), total.cast("decimal(18,2)").alias("total_amount"),
                documents.cast("long").alias("documents"), priced.cast("long").alias("priced"), tax.cast("decimal(18,2)").alias("total_tax"),
                with_lines.cast("long").alias("with_lines")]

    def headers(fact: str, kind: str, party: str, tax: str | None = None, flag: str | None = None) -> DataFrame:
        df = held.table(fact, "client_id", "txn_date", party, "total_amount", *filter(None, (tax, flag)))
        if flag:
            df = df.where(~F.coalesce(flag, F.lit(False)))
        total = F.col("total_amount")
        return df.select(*row(F.lit(kind), party, total, F.lit(1), total.isNotNull(), F.col(tax) if tax else F.lit(None), F.lit(None)))

    rows = union([
        headers("fact_invoice", "revenue", "customer_id", "total_tax"), headers("fact_bill", "bill", "vendor_id"),
        headers("fact_purchase", "purchase", "vendor_id", flag="is_credit"), headers("fact_payment", "payment", "customer_id"),
        activity.where("documents > 0").select(*row(F.col("kind"), "party_id", *[F.lit(None)] * 4, F.col("documents")))])
    money = {"total_amount", "total_tax"}
    documents = rows.groupBy(*KEYS, "party_id").agg(*(
        (F.sum(c).cast("decimal(38,2)") if c in money else F.sum(c)).alias(c)
        for c in ("total_amount", "documents", "priced", "total_tax", "with_lines")))
    return Rollup(model, activity, materialize(documents, "documents"), materialize(customer_days(held), "customer-days"))


def customer_days(model) -> DataFrame:
    """(client_id, txn_date, bucket, customers): bitmaps of the customers invoiced on each day. Customers
    are numbered once, those of a tenant together, so that its bitmaps are few and dense; a blank one has a row
    without a bitmap. Numbers are dealt, not bitmaps: a bitmap has 4 kB even for one customer."""
    invoiced = model.table("fact_invoice", "client_id", "txn_date", "customer_id").distinct()
    numbers = materialize(
        invoiced.where("customer_id IS NOT NULL").select("client_id", "customer_id").distinct()
        .repartitionByRange("client_id", "customer_id").withColumn("number", F.monotonically_increasing_id() + 1), "customer-numbers")
    numbered = invoiced.join(numbers, ["client_id", "customer_id"], "left")
    groups = ["client_id", "txn_date", "bucket"]
    return numbered.withColumn("bucket", F.bitmap_bucket_number("number")).repartition(*groups).groupBy(*groups).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("customers"))


class Rollup:
    """Aggregates of a model; dimensions come from the model itself."""

    def __init__(self, model, activity: DataFrame, documents: DataFrame, customers: DataFrame):
        self.model, self.activity, self.documents, self.customers = model, activity, documents, customers

    def table(self, name: str, *wanted: str) -> DataFrame:
        if name.startswith("fact_"):
            raise ValueError(f"{name} is not held by the aggregates")
        return self.model.table(name, *wanted)

    def amounts(self, *kinds: str) -> DataFrame:
        """(client_id, kind, txn_date, amount): revenue and bills by their lines, purchases and payments
        by their totals."""
        lines = self.activity.where(F.col("kind").isin("revenue", "bill"))
        totals = self.documents.where(F.col("kind").isin("purchase", "payment")).withColumn("amount", F.col("total_amount"))
        wanted = ("client_id", "kind", "txn_date", "amount")
        return lines.select(*wanted).unionByName(totals.select(*wanted)).where(F.col("kind").isin(*kinds))

    def distinct_customers(self, *by: Column | str) -> DataFrame:
        """Customers invoiced per tenant and `by`, exact over all days of a group."""
        keys = ["client_id", *by]
        merged = self.customers.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("customers").alias("customers"))
        names = merged.columns[: len(keys)]
        count = F.when(F.col("bucket").isNull(), 1).otherwise(F.bitmap_count("customers"))
        return merged.groupBy(*names).agg(F.sum(count).alias("customers"))


def customers_by_grain(rollup: Rollup) -> DataFrame:
    """Distinct invoiced customers per month, quarter and year."""
    return union([
        rollup.distinct_customers(F.trunc("txn_date", grain).alias("period")).withColumn("grain", F.lit(grain.lower()))
        for grain in ("MONTH", "QUARTER", "YEAR")])
