"""Load plans: raw records of all tenants to the warehouse, one job per table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.blank import sum_if
from ..functions.parsing import is_damaged, with_parsed
from ..operators import history, records
from ..operators.quality import add_date_key, keep_last
from ..operators.merge import union
from ..operators.report_rows import flatten_reports
from ..schemas import ENTITY_TABLES, LINE_TABLES, columns, primary_key
from ..sources import archive, calendar, files, landing, registry, reports
from ..sources.warehouse import Warehouse, conform, materialize

# One report of one tenant and period; a later pull replaces it as a whole.
REPORT_KEY = ["client_id", "report_table", "start_period", "end_period"]


def with_date_keys(df: DataFrame, table: str) -> DataFrame:
    """Adds every declared <date>_key column from its date column."""
    for name, _ in columns(table):
        if name.endswith("_date_key"):
            df = add_date_key(df, name.removesuffix("_key"), name)
    return df


def clean_headers(raw: DataFrame, entity: str) -> DataFrame:
    """Typed header rows with ord: last version per key, with date keys."""
    table = records.target_table(entity)
    mapped = records.map_records(raw, entity)
    last = keep_last(mapped, primary_key(table), [F.col("ord")])
    return with_date_keys(last, table)


def clean_lines(raw: DataFrame, entity: str) -> DataFrame:
    """Typed line rows with ord: last version per key."""
    lines = records.flatten_lines(raw, entity)
    return keep_last(lines, primary_key(LINE_TABLES[entity]), [F.col("ord")])


# The item's account that a line without an account is booked to.
ITEM_ACCOUNT = {
    **dict.fromkeys(records.SALES, "income_account_id"),
    "Bill": "expense_account_id", "Purchase": "expense_account_id",
}


def with_item_accounts(lines: DataFrame, entity: str, warehouse: Warehouse) -> DataFrame:
    """Fills the account of lines that name only an item from the item held in the warehouse. Only these
    lines meet the items; `lines` is read twice and should come from a written frame."""
    if entity not in ITEM_ACCOUNT:
        return lines
    items = warehouse.table("dim_item", "client_id", "item_id", ITEM_ACCOUNT[entity])
    held = items.withColumnRenamed(ITEM_ACCOUNT[entity], "_account")
    open_ = F.col("account_id").isNull() & F.col("item_id").isNotNull()
    filled = lines.where(open_).join(held, ["client_id", "item_id"], "left").withColumn("account_id", F.col("_account"))
    return lines.where(~open_).unionByName(filled.select(lines.columns))


def load_entity(raw: DataFrame, entity: str, warehouse: Warehouse) -> DataFrame:
    """Upserts an entity's headers and lines, and returns its records, which are parsed once and
    written. The upsert itself keeps the last version per key, so the mapped rows go in directly."""
    parsed = materialize(records.parsed_once(raw, entity), f"parsed-{entity.lower()}")
    table = records.target_table(entity)
    headers = with_date_keys(records.map_records(parsed, entity), table)
    warehouse.upsert(table, headers, [F.col("ord")], version=F.col("ord.ts"))
    if entity in LINE_TABLES:
        lines = with_item_accounts(records.flatten_lines(parsed, entity), entity, warehouse)
        warehouse.upsert(
            LINE_TABLES[entity], lines, [F.col("ord")], version=F.col("ord.ord.ts"))
    return parsed


def load_entities(raw: DataFrame, warehouse: Warehouse) -> dict[str, DataFrame]:
    """Loads every known entity that occurs in the raw rows, and returns their parsed records. `raw`
    should be a written table (an archive), since each entity scans its own part of it."""
    known = raw.where(F.col("source_name").isin(*ENTITY_TABLES))
    present = {row.source_name for row in known.select("source_name").distinct().collect()}
    return {entity: load_entity(raw, entity, warehouse) for entity in ENTITY_TABLES if entity in present}


def refused(raw: DataFrame, parsed: dict[str, DataFrame]) -> DataFrame:
    """What a load leaves out, with the reason: damaged and keyless records, damaged and unknown
    reports, unknown sources."""
    reports_like = F.col("source_name").rlike(reports.SOURCE)
    unknown = raw.where(~F.col("source_name").isin(*ENTITY_TABLES) & ~reports_like).withColumn(
        "reason", F.lit("unknown source"))
    parts = [unknown, reports.refused(raw), *(records.quarantine(p, e) for e, p in parsed.items())]
    return union([p.select("client_id", "source_name", "ord", "record", "reason") for p in parts])


def load_all(raw: DataFrame, warehouse: Warehouse, batch: str = "single") -> DataFrame:
    """Loads entities and reports of all tenants, writes what is refused to the quarantine and
    returns the run summary. Refused records do not stop others. A record is parsed once: headers,
    lines, quarantine and summary come from the same written frame."""
    parsed = load_entities(raw, warehouse)
    load_reports(raw, warehouse)
    path = f"{warehouse.root}/quarantine/batch_id={batch}"
    refused(raw, parsed).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    counts = raw.sparkSession.read.schema(QUARANTINE).parquet(path).groupBy(
        "client_id", "source_name").agg(F.count(F.lit(1)).alias("refused"))
    summaries = [run_summary(raw.where(~F.col("source_name").isin(*ENTITY_TABLES)))]
    summaries += [_summary(p, F.col("reason") == records.DAMAGED) for p in parsed.values()]
    return union(summaries).join(counts, ["client_id", "source_name"], "left").withColumn(
        "refused", F.coalesce("refused", F.lit(0)))


QUARANTINE = (
    "client_id string, source_name string, "
    "ord struct<ts:timestamp_ntz,block:bigint,pos:bigint,item:int>, record string, reason string"
)


def quarantine(warehouse: Warehouse) -> DataFrame:
    """Everything that loads have refused."""
    root = f"{warehouse.root}/quarantine"
    if not files.exists(warehouse.spark, root):
        return warehouse.spark.createDataFrame([], QUARANTINE)
    return warehouse.spark.read.schema(QUARANTINE).parquet(root)


def load_reference(
    warehouse: Warehouse, registry_file: str | None = None, users: DataFrame | None = None
) -> None:
    """Calendar (once), tenant registry and the map of users to tenants."""
    if not files.exists(warehouse.spark, warehouse.path("dim_date")):
        warehouse.replace("dim_date", calendar.dim_date(warehouse.spark))
    if registry_file:
        warehouse.replace("dim_client", registry.read(warehouse.spark, registry_file))
    if users is not None:
        warehouse.replace("security_user_client_map", users)


def load_new(landed: DataFrame, archived: str, warehouse: Warehouse) -> DataFrame:
    """Archives and loads the pulls (tenant, source, time) that no earlier load has done; returns
    their run summary. A load that failed half way is repeated as the same batch."""
    spark, started = landed.sparkSession, dt.datetime.now(dt.timezone.utc)
    done = archive.pulls(spark, archived)
    batch = f"{len(archive.batches(spark, archived)):012d}"
    new = landed.withColumn("ts", F.col("ord.ts")).join(
        done.select("client_id", "source_name", "ts"), ["client_id", "source_name", "ts"], "left_anti")
    path = f"{archived.rstrip('/')}/batch_id={batch}"
    archive.overwrite(new.drop("ts"), path)
    raw = archive.read(spark, path)
    summary = materialize(load_all(raw, warehouse, batch), "run-summary")
    archive.record(raw, archived, batch, started)
    return summary


def daily_load(
    spark: SparkSession, landed: str, archived: str, warehouse_root: str,
    registry_file: str | None = None, users: DataFrame | None = None,
) -> DataFrame:
    """Newly landed files of all tenants to archive and warehouse; returns the run summary.

    Files older than the last load are not opened, and a pull is loaded once."""
    warehouse = Warehouse(spark, warehouse_root)
    load_reference(warehouse, registry_file, users)
    since = archive.pulls(spark, archived).agg(F.max("started")).first()[0]
    return load_new(landing.scan(spark, landed, since), archived, warehouse)


def pulled_report_rows(raw: DataFrame) -> DataFrame:
    """Rows of all landed reports with their pull; of several pulls of the same report and
    period only the last is kept."""
    scanned = keep_last(reports.scan(raw), REPORT_KEY, [F.col("ord")])
    return flatten_reports(scanned, materialize)


def report_rows(raw: DataFrame) -> DataFrame:
    """Rows of all landed reports in the layout of table report_rows."""
    return conform(pulled_report_rows(raw), "report_rows")


def load_reports(raw: DataFrame, warehouse: Warehouse) -> None:
    """Replaces each landed (report, period) of a tenant as a whole, unless it is older than
    the one held."""
    warehouse.upsert(
        "report_rows", pulled_report_rows(raw), [F.col("ord")], match=REPORT_KEY,
        version=F.col("ord.ts"),
    )


def latest_reports(model) -> DataFrame:
    """Rows of the current copy of each report: of the copies of a tenant's report that begin on
    the same day, as the default window does all year, the one with the latest end."""
    held = model.table("report_rows")
    keys = ["client_id", "report_table", "start_period"]
    last = held.groupBy(*keys).agg(F.max("end_period").alias("end_period"))
    return held.join(last, [*keys, "end_period"], "left_semi")


def backfill(raw: DataFrame, first: int, last: int) -> DataFrame:
    """Rows of backfilled reports of the given years, with the year."""
    names = [f"backfill_report_{n}_{y}" for n in reports.BACKFILLED for y in range(first, last + 1)]
    return report_rows(raw.where(F.col("source_name").isin(names)))


def balances_by_pull(raw: DataFrame, entity: str, days: DataFrame) -> DataFrame:
    """Documents, open balance and total per tenant as of each of `days`, from the archived pulls of
    invoices or bills: a pulled state holds from its day until the document's next pull."""
    key = primary_key(records.target_table(entity))
    pulled = records.map_records(raw, entity).withColumn("pulled", F.to_date("ord.ts"))
    states = keep_last(pulled, [*key, "pulled"], [F.col("ord")]).select(*key, "pulled", "balance", "total_amount")
    # states of equal validity are added up before they meet the days
    held = history.intervals(states, key, "pulled").groupBy("client_id", "valid_from", "valid_to").agg(
        F.count(F.lit(1)).alias("documents"), F.sum("total_amount").alias("total"),
        sum_if(F.col("balance") > 0, F.col("balance")).alias("total_open"))
    return history.on_days(held, days).groupBy("client_id", "day").agg(
        *(F.sum(c).alias(c) for c in ("documents", "total", "total_open")))


def run_summary(raw: DataFrame) -> DataFrame:
    """Records and damaged records per tenant and source, unknown sources included, in one pass
    over the raw rows.

    A record counts as damaged when its text is not one JSON object; layout errors of single
    entities are listed by `records.quarantine`.
    """
    return _summary(with_parsed(raw, "r", "record", "Id string"), is_damaged("r"))


def _summary(rows: DataFrame, damaged: Column) -> DataFrame:
    return rows.groupBy("client_id", "source_name").agg(
        F.count(F.lit(1)).alias("records"),
        F.count(F.when(damaged, F.lit(1))).alias("damaged"),
        F.max("ord.ts").alias("last_pull"),
    )
