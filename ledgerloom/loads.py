"""Registered queries of the load side: sources, mappers, flatteners, quality, merge, reports.

Source documents are built by Spark from the given tables, so their volume grows with the data.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .functions import coerce as c
from .functions.dates import date_key as date_key_of, month
from .operators import records, relationships as rel, report_rows
from .operators.access import visible_to
from .operators.merge import union
from .operators.quality import add_date_key, keep_last, key_violations
from .plans import etl, reports as reports_plan
from .schemas import GENERIC_TABLES, primary_key
from .session import scratch_path
from .sources import archive, calendar, documents as docs, landing, registry, reports
from .sources.star import AS_OF, LINE_ORDER, StarTables, StoredHeaders, StoredStar
from .sources.warehouse import Warehouse, materialize, typed_scan
from .streaming import latest

EARLIER = dt.datetime(2001, 7, 31, 11, 0, 0)
REPORT_TITLES = ["Status", "Invoices", "Total"]


# -- sources ------------------------------------------------------------------------------------

def damaged(raw: DataFrame, every: int = 13) -> DataFrame:
    """Cuts the text of every n-th record in half."""
    key = F.get_json_object("record", "$.Id").cast("bigint")
    half = F.substr("record", F.lit(1), F.floor(F.length("record") / 2).cast("int"))
    return raw.withColumn("record", F.when(key % every == 0, half).otherwise(F.col("record")))


def raw_entity_scan(star: StarTables) -> DataFrame:
    pages = docs.pages(docs.invoices(star, lines=False))
    parsed = records.parse(landing.split_documents(pages), "Invoice")
    return parsed.select(
        "client_id", "source_name", F.col("r.Id").alias("id"),
        F.col("r.TotalAmt").cast("double").alias("total"),
    )


def raw_quarantine(star: StarTables) -> DataFrame:
    raw = damaged(docs.invoices(star, lines=False))
    good = records.map_records(raw, "Invoice").select(
        "client_id", F.lit(0).alias("bad"), "total_amount")
    bad = records.quarantine(raw, "Invoice").select(
        "client_id", F.lit(1).alias("bad"), F.lit(None).cast("decimal(18,2)").alias("total_amount"))
    return good.unionByName(bad).groupBy("client_id").agg(
        F.sum(1 - F.col("bad")).alias("valid"), F.sum("bad").alias("damaged"),
        F.sum("total_amount").alias("valid_total"))


def raw_object_scan(star: StarTables) -> DataFrame:
    """One object document per customer; every tenth is empty and yields no record."""
    body = F.to_json(F.struct(F.col("customer_id").alias("Id"), F.col("display_name").alias("Name")))
    documents = star.table("dim_customer", "client_id", "customer_id", "display_name").select(
        "client_id", F.lit("CompanyInfo").alias("source_name"),
        F.lit(docs.PULLED_AT).cast("timestamp_ntz").alias("ts"),
        F.when(F.col("customer_id").cast("bigint") % 10 == 0, "{}").otherwise(body)
        .alias("document"),
    )
    mapped = records.map_records(landing.split_documents(documents), "CompanyInfo")
    return mapped.select("client_id", "id", "name", "fully_qualified_name", "is_active")


def report_documents(star: StarTables) -> DataFrame:
    return union([
        docs.aged_receivables(star),
        docs.aged_receivables(star, "ProfitAndLossCash", 1998),
        docs.aged_receivables(star, "CashFlow", 1999, "backfill_report_"),
    ])


def report_scan(star: StarTables) -> DataFrame:
    return reports.scan(report_documents(star)).select(
        "client_id", "source_name", "report", "report_year", "endpoint", "report_table",
        "report_name", "start_period", "end_period", F.size("titles").alias("titles"),
        F.col("parameters")["accounting_method"].alias("accounting_method"),
    )


def raw_archive_roundtrip(star: StarTables) -> DataFrame:
    path = scratch_path(star.spark, "archive")
    archive.append(docs.invoices(star, lines=False), path)
    archive.append(docs.payments(star), path)
    total = F.get_json_object("record", "$.TotalAmt").cast("decimal(18,2)")
    return archive.read(star.spark, path).groupBy("client_id", "source_name").agg(
        F.count(F.lit(1)).alias("records"), F.sum(total).alias("total"))


def typed_scan_invoice(star: StarTables) -> DataFrame:
    """A text copy of the invoices, read back with declared types."""
    invoices = star.table("fact_invoice")
    text = invoices.select(*(F.col(x).cast("string").alias(x) for x in invoices.columns))
    return typed_scan(materialize(text, "invoice-text"), "fact_invoice").drop(
        "email_status", "print_status")


# The typed columns checked in each of the twelve tables that are read from text.
TYPED = {
    "dim_date": ("date_key", "full_date", "day_of_week", "day_of_month", "month_num", "quarter_num", "year_num", "is_weekend"),
    "dim_account": ("current_balance", "is_active", "is_sub_account"),
    "dim_customer": ("balance", "is_active"),
    "dim_vendor": ("balance", "is_active"),
    "dim_item": ("unit_price", "purchase_cost", "is_active"),
    "fact_invoice": ("txn_date", "due_date", "total_amount", "balance", "total_tax", "txn_date_key", "due_date_key"),
    "fact_invoice_line": ("line_num", "amount", "quantity", "unit_price", "service_date"),
    "fact_payment": ("txn_date", "total_amount", "unapplied_amount", "txn_date_key"),
    "fact_bill": ("txn_date", "due_date", "total_amount", "balance", "txn_date_key", "due_date_key"),
    "fact_bill_line": ("line_num", "amount"),
    "fact_purchase": ("txn_date", "total_amount", "is_credit", "txn_date_key"),
    "fact_estimate": ("txn_date", "total_amount", "txn_date_key"),
}


def typed_scan_tables(star: StarTables) -> DataFrame:
    """Text copies of twelve tables read back with declared types: per typed column, the filled cells and
    their sum (of dates as yyyymmdd, of flags the true ones)."""
    star = StoredStar(star.spark, star.path)
    out = []
    for table, typed in TYPED.items():
        source = dim_date(star) if table == "dim_date" else star.table(table)
        text = materialize(source.select(*(F.col(x).cast("string").alias(x) for x in source.columns)), "text-copy")
        df = typed_scan(text, table)
        def number(name):
            kind = df.schema[name].dataType.typeName()
            return date_key_of(F.col(name)) if kind == "date" else F.col(name).cast("int" if kind == "boolean" else df.schema[name].dataType)
        sums = df.agg(*(F.struct(
            F.lit(c).alias("column_name"), F.count(c).alias("filled"), F.sum(number(c)).cast("decimal(38,4)").alias("total")).alias(c) for c in typed))
        out.append(sums.select(F.lit(table).alias("table_name"), F.inline(F.array(*typed))))
    return union(out)


def dim_client(star: StarTables) -> DataFrame:
    """Customers registered as clients; every fourth is entered twice and the copy rejected."""
    key = F.col("c_custkey")
    entries = star.source("customer").select(
        key.cast("string").alias("client_id"), F.col("c_name").alias("client_name"),
        F.lit(None).cast("string").alias("qbo_realm_id"), F.col("c_mktsegment").alias("industry"),
        F.date_add(F.lit(dt.date(1995, 1, 1)), (key % 365).cast("int")).cast("string")
        .alias("onboarded_date"),
        F.when(key % 2 == 0, key % 3 != 0).alias("is_active"), F.lit(0).alias("pos"),
    )
    again = entries.where(F.col("client_id").cast("bigint") % 4 == 0).withColumns(
        {"client_name": F.lit("again"), "pos": F.lit(1)})
    return registry.clients(entries.unionByName(again))


def dim_date(star: StarTables) -> DataFrame:
    """Calendar over the order dates and a year beyond."""
    day = F.col("o_orderdate").cast("date")
    bounds = star.source("orders").agg(F.min(day).alias("first"), F.max(day).alias("last"))
    return calendar.over_range(bounds, F.col("first"), F.date_add("last", 365))


# -- mappers and flatteners -----------------------------------------------------------------------

def mapped(entity: str, *drop: str):
    def run(star: StarTables) -> DataFrame:
        build = docs.BUILDERS[entity]
        with_lines = entity in ("Invoice", "Bill", "Purchase", "Estimate")
        raw = build(star, lines=False) if with_lines else build(star)
        return records.map_records(raw, entity).drop("ord", *drop)
    return run


def map_generic(star: StarTables) -> DataFrame:
    """All entities without a layout of their own, each beside its table."""
    classes = docs.classes(star)
    return union([
        records.map_records(classes.withColumn("source_name", F.lit(entity)), entity)
        .select("client_id", "id", "name", "fully_qualified_name", "is_active")
        .withColumn("table_name", F.lit(table))
        for entity, table in GENERIC_TABLES.items()])


def report_latest(star: StarTables) -> DataFrame:
    """Of a report pulled on two days, each ending with its day, the one of the later day."""
    warehouse = _warehouse(star)
    latest = docs.aged_receivables(star)
    older = latest.withColumn("record", F.regexp_replace("record", "2001-08-01", "2001-07-31"))
    etl.load_reports(older.unionByName(latest), warehouse)
    return etl.latest_reports(warehouse).groupBy("client_id", "report_table", "end_period").agg(
        F.count(F.lit(1)).alias("rows"))


def resold(entity: str):
    """Lines and typed headers of a sales document, from the invoices under another name, parsed once."""
    def run(star: StarTables) -> DataFrame:
        raw = materialize(records.parsed_once(docs.invoices(star).withColumn("source_name", F.lit(entity)), entity), "resold")
        return headed_lines(raw, entity)
    return run


def headed_lines(raw: DataFrame, entity: str) -> DataFrame:
    """Lines of a booked document with date, total and party of the document's last header. `raw` should be a
    written frame of `parsed_once`. The header of a document that came in one record is that record's own, which its
    lines bring along; only lines of documents that came in several records are moved to meet the last header."""
    key = records.DOCUMENT_KEYS[entity]
    named = {"txn_date": "txn_date", "total_amount": "total_amount", "customer_id": "party_id"}
    came = records.parse(raw, entity).select("client_id", F.col("r.Id").alias(key)).where("client_id IS NOT NULL")
    several = materialize(came.groupBy("client_id", key).count().where("count > 1").drop("count"), "in-several-records")
    lines = records.flatten_lines(raw, entity, header=tuple(named)).drop("ord").where("client_id IS NOT NULL")
    own = [F.col(f"header.{c}").alias(n) for c, n in named.items()]
    columns = ["client_id", key, *(c for c in lines.columns if c not in ("client_id", key, "header"))]
    if several.isEmpty():
        return lines.select(*columns, *own)
    of_several = records.map_records(raw, entity).withColumnRenamed("id", key).join(several, ["client_id", key], "left_semi")
    headers = keep_last(of_several, ["client_id", key], [F.col("ord")]).select(
        "client_id", key, *(F.col(c).alias(n) for c, n in named.items()))
    once = lines.join(several, ["client_id", key], "left_anti").select(*columns, *own)
    met = lines.join(several, ["client_id", key], "left_semi").drop("header").join(headers, ["client_id", key])
    return once.unionByName(met)


def flatten_journal_lines(star: StarTables) -> DataFrame:
    return records.flatten_lines(docs.journal_entries(star), "JournalEntry").drop("ord")


def flattened(entity: str, *drop: str):
    def run(star: StarTables) -> DataFrame:
        return records.flatten_lines(docs.BUILDERS[entity](star), entity).drop("ord", *drop)
    return run


def report_table(rows: DataFrame) -> DataFrame:
    return report_rows.pivot(rows, REPORT_TITLES)


def scanned_rows(star: StarTables, raw: DataFrame) -> DataFrame:
    return report_rows.flatten_reports(reports.scan(raw), materialize)


def flatten_report(star: StarTables) -> DataFrame:
    """Cells in long form."""
    rows = scanned_rows(star, docs.aged_receivables(star))
    return report_rows.long_cells(rows).select(
        "client_id", "report_name", "section", "row_type", "row_ord", "col_ord", "title", "value")


def report_pivot(star: StarTables) -> DataFrame:
    rows = scanned_rows(star, docs.aged_receivables(star))
    return report_table(rows).select(
        "client_id", "report_table", "section", "row_type", "row_ord", *REPORT_TITLES)


def report_titles(star: StarTables) -> DataFrame:
    """Wide report tables with the titles of the data: two years whose month columns differ by year and
    tenant, published one after the other and read together; listed as a row per column of a row."""
    root = scratch_path(star.spark, "report-tables")
    for year in (1997, 1998):
        report_rows.publish(materialize(etl.pulled_report_rows(docs.monthly_sales(star, year)), "report-rows"), root)
    wide = report_rows.wide_table(star.spark, root, "report_profitandlosscash").drop("_row_ord")
    keys = [c for c in wide.columns if c.startswith(report_rows.MARK)]
    cells = wide.unpivot(keys, [c for c in wide.columns if c not in keys], "title", "value").where("value IS NOT NULL")
    return cells.withColumnsRenamed({k: k.removeprefix(report_rows.MARK) for k in keys})


# -- quality --------------------------------------------------------------------------------------

def messy(star: StarTables, *variants: Column) -> DataFrame:
    """Order keys with a text that cycles through the given forms."""
    pick = F.element_at(
        F.array(*variants), (F.col("o_orderkey") % len(variants) + 1).cast("int"))
    return star.source("orders").select(
        F.col("o_orderkey"), F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("n"),
        F.col("o_orderdate").cast("date").cast("string").alias("d"), "o_orderstatus",
    ).select("o_orderkey", pick.alias("text"))


def enforce_bool(star: StarTables) -> DataFrame:
    df = messy(star, *map(F.lit, ("true", "True", "TRUE", "false", "1", None)))
    return df.select("o_orderkey", c.to_flag(F.col("text")).alias("flag"))


def enforce_float(star: StarTables) -> DataFrame:
    n = F.col("n")
    df = messy(
        star, n, F.concat(F.lit("  "), n, F.lit(" ")), F.concat(F.lit("-"), n),
        F.concat(n, F.lit("e1")), F.concat(F.lit("$"), n), F.concat(F.lit("1,"), n), F.lit(""),
        F.concat(n, F.lit("d")), F.lit("nan"), F.lit(None),
    )
    return df.select("o_orderkey", F.round(c.to_float(F.col("text")), 2).alias("number"))


def enforce_int(star: StarTables) -> DataFrame:
    key = F.col("o_orderkey").cast("string")
    df = messy(
        star, key, F.concat(key, F.lit(".0")), F.concat(key, F.lit(".5")),
        F.concat(key, F.lit("e2")), F.concat(key, F.lit("x")), F.lit(None),
    )
    return df.select("o_orderkey", c.to_int(F.col("text")).alias("number"))


def enforce_date(star: StarTables) -> DataFrame:
    d = F.col("d")
    df = messy(star, d, F.substr(d, F.lit(1), F.lit(4)), F.lit("2024-02-30"), F.lit(""),
               F.concat(d, F.lit("x")), F.lit(None))
    return df.select("o_orderkey", c.to_date(F.col("text")).alias("day"))


def enforce_datetime(star: StarTables) -> DataFrame:
    d = F.col("d")
    df = messy(star, d, F.concat(d, F.lit("T10:30:00")), F.concat(d, F.lit(" 10:30:15")),
               F.concat(d, F.lit("T25:00:00")), F.lit("soon"), F.lit(None))
    stamp = c.to_datetime(F.col("text"))
    return df.select("o_orderkey", F.date_format(stamp, "yyyy-MM-dd HH:mm:ss").alias("stamp"))


def dedup_keep_last(star: StarTables) -> DataFrame:
    last = keep_last(
        star.source("lineitem"), ["l_orderkey", "l_linenumber"], [F.col(x) for x in LINE_ORDER])
    return last.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


def date_key(star: StarTables) -> DataFrame:
    d = F.col("d")
    df = messy(star, d, d, d, F.lit("2024-02-30"), F.lit(None))
    return add_date_key(df.withColumnRenamed("text", "day"), "day", "day_key").select(
        "o_orderkey", "day_key")


def clean_invoice(star: StarTables) -> DataFrame:
    """Two versions of every invoice; the later pull wins."""
    raw = docs.invoices(star, lines=False).unionByName(
        docs.invoices(star, lines=False, surcharge=1, ts=EARLIER))
    return etl.clean_headers(raw, "Invoice").drop("ord", "email_status", "print_status")


# -- loads ------------------------------------------------------------------------------------------

def upsert_merge(star: StarTables) -> DataFrame:
    """A first load of all but some invoices, then changed totals for all even keys and those."""
    warehouse = Warehouse(star.spark, scratch_path(star.spark, "warehouse"))
    invoices = star.table(
        "fact_invoice", "client_id", "invoice_id", "txn_date", "total_amount")
    key = F.col("invoice_id").cast("bigint")
    warehouse.upsert("fact_invoice", invoices.where(key % 10 != 3))
    changed = invoices.where((key % 2 == 0) | (key % 10 == 3)).withColumn(
        "total_amount", F.col("total_amount") + 1)
    warehouse.upsert("fact_invoice", changed)
    return warehouse.table("fact_invoice", "client_id", "invoice_id", "txn_date", "total_amount")


def pk_violations(star: StarTables) -> DataFrame:
    """Line keys that occur more than once before deduplication."""
    repeated = key_violations(star.source("lineitem"), ["l_orderkey", "l_linenumber"])
    orders = star.orders().select("client_id", "o_orderkey")
    return repeated.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "client_id", F.col("l_orderkey").cast("string").alias("invoice_id"),
        F.col("l_linenumber").cast("string").alias("line_id"), "rows")


def key_check(star: StarTables) -> DataFrame:
    """Rows and repeated keys of the derived facts per tenant; no key may repeat."""
    facts = ("fact_invoice", "fact_bill", "fact_purchase", "fact_payment", "fact_estimate",
             "fact_invoice_line")
    counts = [
        star.table(t, *primary_key(t)).groupBy(*primary_key(t)).agg(F.count(F.lit(1)).alias("n"))
        .groupBy("client_id").agg(
            F.sum("n").alias("rows"), F.count(F.when(F.col("n") > 1, 1)).alias("repeated"))
        .withColumn("table_name", F.lit(t))
        for t in facts
    ]
    return union(counts)


def etl_invoice(star: StarTables) -> DataFrame:
    """Archive, then load a stale pull and the current one with lines, then read the warehouse:
    revenue per tenant and month from loaded lines and headers."""
    spark = star.spark
    path = scratch_path(spark, "archive")
    archive.append(docs.invoices(star, lines=False, surcharge=1, ts=EARLIER), path)
    archive.append(docs.invoices(star), path)
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"))
    raw = archive.read(spark, path)
    etl.load_entity(raw.where(F.col("ingest_ts") == F.lit(EARLIER)), "Invoice", warehouse)
    etl.load_entity(raw.where(F.col("ingest_ts") > F.lit(EARLIER)), "Invoice", warehouse)
    lines = (
        warehouse.table("fact_invoice_line", "client_id", "invoice_id", "amount")
        .groupBy("client_id", "invoice_id").agg(F.sum("amount").alias("amount"))
    )
    headers = warehouse.table(
        "fact_invoice", "client_id", "invoice_id", "txn_date", "total_amount", "total_tax")
    return headers.join(lines, ["client_id", "invoice_id"], "left").groupBy(
        "client_id", month(F.col("txn_date")).alias("month")
    ).agg(
        F.count(F.lit(1)).alias("invoices"), F.sum("total_amount").alias("invoiced"),
        F.sum("total_tax").alias("tax"), F.sum("amount").alias("revenue"),
    )


def flagship(star: StarTables) -> DataFrame:
    """Nested invoice documents to revenue per tenant and month. The documents are built and parsed
    once; headers and lines are read from the written copy."""
    raw = materialize(records.parsed_once(docs.invoices(star), "Invoice"), "invoice-records")
    lines = etl.clean_lines(raw, "Invoice").groupBy("client_id", "invoice_id").agg(
        F.sum("amount").alias("amount"))
    headers = etl.clean_headers(raw, "Invoice").select("client_id", "invoice_id", "txn_date")
    return lines.join(headers, ["client_id", "invoice_id"]).groupBy(
        "client_id", month(F.col("txn_date")).alias("month")
    ).agg(F.sum("amount").alias("revenue"), F.count(F.lit(1)).alias("invoices"))


def etl_report(star: StarTables) -> DataFrame:
    """Two pulls of the same report: the second replaces the longer first one as a whole."""
    warehouse = _warehouse(star)
    latest = docs.aged_receivables(star)
    # the earlier pull has one more row in every section
    stale = latest.withColumn("ord", F.col("ord").withField("ts", F.lit(EARLIER).cast("timestamp_ntz"))).withColumn(
        "record", F.regexp_replace("record", '"Row":\\[', '"Row":[{"type":"Data","ColData":[{"value":"stale"}]},'))
    etl.load_reports(stale, warehouse)
    etl.load_reports(latest, warehouse)
    return report_table(warehouse.table("report_rows")).select(
        "client_id", "report_table", "section", "row_type", "row_ord", *REPORT_TITLES)


def run_summary(star: StarTables) -> DataFrame:
    raw = damaged(docs.invoices(star, lines=False)).unionByName(docs.payments(star))
    return etl.run_summary(raw).drop("last_pull")


def etl_daily(star: StarTables) -> DataFrame:
    """Two daily loads of which the second lands the first's pulls again and one more: records of
    the archive, which holds each pull once, beside the invoices of the warehouse."""
    archived, warehouse = scratch_path(star.spark, "archive"), _warehouse(star)
    first = docs.invoices(star, lines=False, surcharge=1, ts=EARLIER).unionByName(docs.payments(star))
    etl.load_new(first, archived, warehouse)
    etl.load_new(first.unionByName(docs.invoices(star, lines=False)), archived, warehouse)
    held = archive.read(star.spark, archived).groupBy("client_id", "source_name").agg(
        F.count(F.lit(1)).alias("archived"))
    totals = union([
        warehouse.table(f"fact_{s.lower()}", "client_id", "total_amount").groupBy("client_id").agg(
            F.count(F.lit(1)).alias("held"), F.sum("total_amount").alias("total"),
        ).withColumn("source_name", F.lit(s))
        for s in ("Invoice", "Payment")])
    return held.join(totals, ["client_id", "source_name"])


def etl_quarantine(star: StarTables) -> DataFrame:
    """What a load with damaged, keyless and unknown records refuses, and what it keeps."""
    invoices = damaged(docs.invoices(star, lines=False))
    key = F.get_json_object("record", "$.Id").cast("bigint")
    keyless = docs.payments(star).withColumn(
        "record", F.when(key % 7 == 0, F.regexp_replace("record", '"Id":"[^"]*",?', "")).otherwise(F.col("record")))
    unknown = docs.classes(star).withColumn("source_name", F.lit("Mystery"))
    warehouse = _warehouse(star)
    etl.load_new(union([invoices, keyless, unknown]), scratch_path(star.spark, "archive"), warehouse)
    return etl.quarantine(warehouse).groupBy("client_id", "source_name", "reason").agg(
        F.count(F.lit(1)).alias("records"))


def _warehouse(star: StarTables) -> Warehouse:
    return Warehouse(star.spark, scratch_path(star.spark, "warehouse"))


def from_warehouse(build, *entities: str):
    """A report over a warehouse into which documents of the given entities were loaded."""
    def run(star: StarTables) -> DataFrame:
        warehouse = _warehouse(star)
        etl.load_reference(warehouse)
        etl.load_new(union([docs.BUILDERS[e](star) for e in entities]), scratch_path(star.spark, "archive"), warehouse)
        return build(warehouse)
    return run


def stream_refresh(star: StarTables) -> DataFrame:
    """Three triggers of the streaming refresh: an early pull that lacks some invoices; the current one,
    which lacks others; a late one of a few invoices together with the current one again. Records by
    verdict, and the current records that the stream ends with."""
    star = StoredHeaders(star.spark, star.path, "fact_invoice")
    spark = star.spark
    place, out, progress = (scratch_path(spark, n) for n in ("archive", "judged", "progress"))
    key = F.get_json_object("record", "$.Id").cast("bigint")
    now = docs.invoices(star, lines=False).where(key % 10 != 4)
    late = docs.invoices(star, lines=False, surcharge=2, ts=EARLIER - dt.timedelta(days=1)).where((key % 10).isin(4, 5))
    for landed in (docs.invoices(star, lines=False, surcharge=1, ts=EARLIER).where(key % 10 != 3), now, late.unionByName(now)):
        archive.append(landed, place)
        latest.follow(spark, place, out, progress).awaitTermination()
    judged = latest.verdicts(spark, out)
    rows = judged.select("client_id", "verdict", "record").unionByName(
        latest.current(judged).select("client_id", F.lit("current").alias("verdict"), "record"))
    total = F.get_json_object("record", "$.TotalAmt").cast("decimal(18,2)")
    return rows.groupBy("client_id", "verdict").agg(F.count(F.lit(1)).alias("records"), F.sum(total).alias("total"))


def balances_by_pull(star: StarTables) -> DataFrame:
    """Invoices as of the day before, of and after the first of two pulls; the first lacks some, and
    has other totals."""
    path = scratch_path(star.spark, "archive")
    key = F.get_json_object("record", "$.Id").cast("bigint")
    archive.append(docs.invoices(star, lines=False, surcharge=1, ts=EARLIER).where(key % 10 != 3), path)
    archive.append(docs.invoices(star, lines=False).where(key % 10 != 4), path)
    first = EARLIER.date()
    days = star.spark.createDataFrame([(first + dt.timedelta(days=n),) for n in (-1, 0, 1)], "day date")
    return etl.balances_by_pull(archive.read(star.spark, path), "Invoice", days)


def backfill_reports(star: StarTables) -> DataFrame:
    raw = union([
        docs.aged_receivables(star, name, year, "backfill_report_")
        for name in reports.BACKFILLED for year in (1997, 1998, 1999)
    ])
    return report_table(etl.backfill(raw, 1998, 1999)).select(
        "client_id", "report_table", "report_year", "section", "row_type", *REPORT_TITLES)


# -- relationships ------------------------------------------------------------------------------------

def join_invoice_star(star: StarTables) -> DataFrame:
    """Lines with their invoice's date and customer, item and account. Lines are reduced to
    (invoice, item, account) first; header attributes join on that."""
    lines = star.table(
        "fact_invoice_line", "client_id", "invoice_id", "item_id", "account_id", "amount"
    ).groupBy("client_id", "invoice_id", "item_id", "account_id").agg(
        F.sum("amount").alias("amount"))
    df = rel.with_header(
        lines, star.table("fact_invoice"), "invoice_id", "txn_date_key", "customer_id")
    df = rel.with_date(df, dim_date(star))
    df = rel.with_dim(df, star.table("dim_customer"), "customer_id", "company_name")
    df = rel.with_dim(df, star.table("dim_item"), "item_id", "item_type")
    df = rel.with_dim(
        df, star.table("dim_account", "client_id", "account_id", "account_type"),
        "account_id", "account_type")
    return df.groupBy(
        "client_id", "year_num", "quarter_name", "company_name", "item_type", "account_type"
    ).agg(F.sum("amount").alias("amount"))


def join_due_date_role(star: StarTables) -> DataFrame:
    """Invoices by the month in which they fall due, beside the year in which they were made."""
    invoices = star.table(
        "fact_invoice", "client_id", "txn_date_key", "due_date_key", "total_amount")
    days = dim_date(star)
    df = rel.with_date(rel.with_date(invoices, days), days, "due_date_key", "due_")
    return df.groupBy("client_id", "year_num", "due_year_num", "due_month_num").agg(
        F.sum("total_amount").alias("total"), F.count(F.lit(1)).alias("invoices"))


def join_bill_star(star: StarTables) -> DataFrame:
    lines = star.table(
        "fact_bill_line", "client_id", "bill_id", "account_id", "amount"
    ).groupBy("client_id", "bill_id", "account_id").agg(F.sum("amount").alias("amount"))
    df = rel.with_header(lines, star.table("fact_bill"), "bill_id", "txn_date_key", "vendor_id")
    df = rel.with_date(df, dim_date(star))
    df = rel.with_dim(df, star.table("dim_vendor"), "vendor_id", "display_name")
    df = rel.with_dim(
        df, star.table("dim_account", "client_id", "account_id", "account_type"),
        "account_id", "account_type")
    return df.groupBy("client_id", "year_num", "display_name", "account_type").agg(
        F.sum("amount").alias("amount"))


def join_payment_star(star: StarTables) -> DataFrame:
    df = star.table("fact_payment", "client_id", "customer_id", "txn_date_key", "total_amount")
    df = rel.with_date(df, dim_date(star))
    df = rel.with_dim(df, star.table("dim_customer"), "customer_id", "billing_state")
    return df.groupBy("client_id", "year_num", "month_num", "billing_state").agg(
        F.sum("total_amount").alias("total"), F.count(F.lit(1)).alias("payments"))


def join_purchase_star(star: StarTables) -> DataFrame:
    df = star.table(
        "fact_purchase", "client_id", "vendor_id", "txn_date_key", "payment_type", "total_amount")
    df = rel.with_date(df, dim_date(star))
    df = rel.with_dim(df, star.table("dim_vendor"), "vendor_id", "display_name")
    return df.groupBy("client_id", "year_num", "display_name", "payment_type").agg(
        F.sum("total_amount").alias("total"))


def join_estimate_star(star: StarTables) -> DataFrame:
    df = star.table(
        "fact_estimate", "client_id", "customer_id", "txn_date_key", "txn_status", "total_amount")
    df = rel.with_date(df, dim_date(star))
    df = rel.with_dim(df, star.table("dim_customer"), "customer_id", "company_name")
    return df.groupBy("client_id", "year_num", "quarter_name", "company_name", "txn_status").agg(
        F.sum("total_amount").alias("total"), F.count(F.lit(1)).alias("estimates"))


def rls_semi_join(star: StarTables) -> DataFrame:
    """Invoice totals as two users see them."""
    invoices = star.table("fact_invoice", "client_id", "total_amount")
    users = star.table("security_user_client_map")
    return union([
        visible_to(invoices, users, user).groupBy("client_id").agg(
            F.count(F.lit(1)).alias("invoices"), F.sum("total_amount").alias("total")
        ).withColumn("user_email", F.lit(user))
        for user in ("user1@x", "user2@x")
    ])


LOADS = {
    "raw_entity_scan": raw_entity_scan,
    "raw_quarantine": raw_quarantine,
    "raw_object_scan": raw_object_scan,
    "report_scan": report_scan,
    "raw_archive_roundtrip": raw_archive_roundtrip,
    "typed_scan_invoice": typed_scan_invoice,
    "typed_scan_tables": typed_scan_tables,
    "dim_client": dim_client,
    "dim_date": dim_date,
    "map_account": mapped("Account"),
    "map_customer": mapped("Customer", "given_name", "family_name", "phone", "billing_city",
                           "billing_postal_code"),
    "map_vendor": mapped("Vendor", "company_name", "email"),
    "map_item": mapped("Item", "description", "purchase_cost", "qty_on_hand"),
    "map_employee": mapped("Employee"),
    "map_invoice": mapped("Invoice"),
    "map_bill": mapped("Bill"),
    "map_payment": mapped("Payment", "payment_method_id"),
    "map_purchase": mapped("Purchase"),
    "map_estimate": mapped("Estimate"),
    "map_generic": map_generic,
    "report_latest": report_latest,
    "flatten_invoice_lines": flattened("Invoice", "linked_txn_id", "linked_txn_type"),
    "flatten_bill_lines": flattened("Bill"),
    "flatten_purchase_lines": flattened("Purchase"),
    "flatten_payment_lines": flattened("Payment"),
    "flatten_estimate_lines": flattened("Estimate"),
    "flatten_credit_memo_lines": resold("CreditMemo"),
    "flatten_sales_receipt_lines": resold("SalesReceipt"),
    "flatten_refund_receipt_lines": resold("RefundReceipt"),
    "flatten_journal_lines": flatten_journal_lines,
    "flatten_report": flatten_report,
    "report_pivot": report_pivot,
    "report_titles": report_titles,
    "enforce_bool": enforce_bool,
    "enforce_float": enforce_float,
    "enforce_int": enforce_int,
    "enforce_date": enforce_date,
    "enforce_datetime": enforce_datetime,
    "dedup_keep_last": dedup_keep_last,
    "date_key": date_key,
    "clean_invoice": clean_invoice,
    "upsert_merge": upsert_merge,
    "pk_violations": pk_violations,
    "pk_check_facts": key_check,
    "etl_invoice": etl_invoice,
    "etl_report": etl_report,
    "run_summary": run_summary,
    "etl_daily": etl_daily,
    "etl_quarantine": etl_quarantine,
    "wh_exec_summary": from_warehouse(
        lambda w: reports_plan.summary_cards(w, AS_OF), "Account", "Item", "Invoice", "Bill", "Purchase"),
    "wh_pnl_matrix": from_warehouse(reports_plan.pnl_matrix, "Account", "Item", "Invoice", "Bill", "Purchase"),
    "wh_ar_aging": from_warehouse(lambda w: reports_plan.receivable_aging_by_customer(w, AS_OF), "Customer", "Invoice"),
    "stream_refresh": stream_refresh,
    "balances_by_pull": balances_by_pull,
    "backfill_reports": backfill_reports,
    "revenue_from_documents": flagship,
    "join_invoice_star": join_invoice_star,
    "join_due_date_role": join_due_date_role,
    "join_bill_star": join_bill_star,
    "join_payment_star": join_payment_star,
    "join_purchase_star": join_purchase_star,
    "join_estimate_star": join_estimate_star,
    "rls_semi_join": rls_semi_join,
}
