"""Star schema derived from order-management tables (region, nation, customer, supplier, part,
orders, lineitem).

Each region is a tenant. Nothing is materialised but by `StoredStar`: every table is a plan over the Parquet
scans, and callers name the columns they need so that unused joins are never planned. Dimension joins
carry no broadcast hint; Spark picks the strategy from measured sizes.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..functions.blank import sum_if
from ..functions.dates import date_key
from ..operators.merge import union
from ..schemas import GENERIC_TABLES, MONEY, QUANTITY, columns
from .warehouse import materialize

# Fixed values of the derivation.
AS_OF = dt.date(2001, 8, 1)
INVOICE_TERM_DAYS = 30
BILL_TERM_DAYS = 45
COST_TYPES = ("ECONOMY", "STANDARD", "PROMO")
PAYMENT_TYPES = ("Cash", "Check", "CreditCard")
ESTIMATE_PRIORITIES = ("1-URGENT", "2-HIGH")
USER_TENANTS = {"AFRICA": "user1@x", "ASIA": "user1@x", "EUROPE": "user2@x"}

# Total order of the copies of one (order, line number); the highest is the last one.
LINE_ORDER = (
    "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus",
)

# Columns of lines that come from their part.
PART_COLUMNS = {"item_name", "account_id", "account_name", "p_type"}

_SCHEMAS: dict[str, T.StructType] = {}


def text(name: str) -> Column:
    return F.col(name).cast("string")


def money(name: str) -> Column:
    return F.col(name).cast(MONEY)


class StarTables:
    """Lazy star tables over one folder of Parquet files."""

    as_of = AS_OF

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def source(self, name: str) -> DataFrame:
        """Parquet scan; the schema is read from the footers once per path and then reused."""
        path = f"{self.path}/{name}.parquet"
        if path not in _SCHEMAS:
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[path]).parquet(path)

    def table(self, name: str, *wanted: str, beside: tuple[str, ...] = ()) -> DataFrame:
        """The named star table with its declared columns, or only the wanted ones, and source columns
        `beside` them, by which its rows may lie together."""
        wanted = wanted or tuple(column for column, _ in columns(name))
        if name in GENERIC_TABLES.values():
            df = self._generic()
        else:
            df = getattr(self, "_" + name)(set(wanted))
        types = dict(columns(name))
        return df.select(
            *(
                (F.col(c) if c in df.columns else F.lit(None)).cast(types[c]).alias(c)
                for c in wanted
            ), *beside,
        )

    # -- shared pieces -------------------------------------------------------------------

    def tenants(self) -> DataFrame:
        """One row per nation with the tenant it belongs to."""
        nation, region = self.source("nation"), self.source("region")
        return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
            "n_nationkey", "n_name", F.col("r_name").alias("client_id")
        )

    def _per_tenant(self, df: DataFrame) -> DataFrame:
        """A master record is offered by every tenant; tenants are the rows of region."""
        # Of a join Spark multiplies the sizes; a generator's rows it would not count, and broadcast them
        return df.crossJoin(self.source("region").select(F.col("r_name").alias("client_id")).distinct())

    def customers(self) -> DataFrame:
        return self.source("customer").join(
            self.tenants(), F.col("c_nationkey") == F.col("n_nationkey")
        )

    def orders(self) -> DataFrame:
        """Orders with tenant, total, open balance and date."""
        total = money("o_totalprice")
        balance = (
            F.when(F.col("o_orderstatus") == "O", total)
            .when(F.col("o_orderstatus") == "P", F.round(total / 2, 2))
            .otherwise(F.lit(0))
            .cast(MONEY)
        )
        return self.source("orders").join(
            self.customers().select("c_custkey", "c_nationkey", "client_id"),
            F.col("o_custkey") == F.col("c_custkey"),
        ).select(
            "client_id", "c_nationkey", "o_orderkey", "o_custkey", "o_orderstatus",
            "o_orderpriority", total.alias("total"), balance.alias("balance"),
            F.col("o_orderdate").cast("date").alias("order_date"),
        )

    def lines(self) -> DataFrame:
        """Order lines after keep-last on (order, line number). Lines without an order belong to no tenant and
        are left out here, by the filter that joins on the order or on its text would add: whatever is joined
        then reads the same plan, which Spark deals and sorts once.

        The rank filter is applied map-side before the shuffle too, so a key that holds a
        large share of the rows sends at most one row per input partition.
        """
        last = Window.partitionBy("l_orderkey", "l_linenumber").orderBy(
            *(F.col(c).desc() for c in LINE_ORDER)
        )
        net = money("l_extendedprice") * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))
        amount = F.round(net, 2).cast(MONEY)
        price = F.round(
            money("l_extendedprice") / F.col("l_quantity").cast("decimal(10,0)"), 2
        )
        return (
            self.source("lineitem").where(F.col("l_orderkey").isNotNull() & text("l_orderkey").isNotNull())
            .withColumn("rn", F.row_number().over(last))
            .where("rn = 1")
            .select(
                "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag",
                "l_linestatus", F.col("l_shipdate").cast("date").alias("ship_date"),
                amount.alias("amount"), F.col("l_quantity").cast(QUANTITY).alias("quantity"),
                price.cast(QUANTITY).alias("unit_price"),
                F.round(amount * F.col("l_tax").cast("decimal(4,2)"), 2).cast(MONEY).alias("tax"),
            )
        )

    def tenant_lines(self, wanted: set[str], flag: str | None = None) -> DataFrame:
        """Lines with their order's tenant, and part columns when an item or account is wanted. The order
        comes last, so that lines of an order lie together."""
        lines = self.lines()
        if flag:
            lines = lines.where(F.col("l_returnflag") == flag)
        if wanted & PART_COLUMNS:
            part = self.source("part").select("p_partkey", "p_name", "p_type")
            lines = lines.join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
        return lines.join(self.orders(), F.col("l_orderkey") == F.col("o_orderkey"))

    # -- dimensions ----------------------------------------------------------------------

    def _dim_client(self, wanted) -> DataFrame:
        return self.source("region").select(
            F.col("r_name").alias("client_id"), F.col("r_name").alias("client_name"),
            F.lit(True).alias("is_active"),
        )

    def _dim_customer(self, wanted) -> DataFrame:
        return self.customers().select(
            "client_id", text("c_custkey").alias("customer_id"),
            F.col("c_name").alias("display_name"), F.col("c_mktsegment").alias("company_name"),
            F.col("n_name").alias("billing_state"), F.lit(False).alias("is_job"),
            F.lit(True).alias("is_active"), money("c_acctbal").alias("balance"),
        )

    def _dim_vendor(self, wanted) -> DataFrame:
        return self._per_tenant(self.source("supplier")).select(
            "client_id", text("s_suppkey").alias("vendor_id"),
            F.col("s_name").alias("display_name"), F.lit(False).alias("is_1099"),
            F.lit(True).alias("is_active"), money("s_acctbal").alias("balance"),
        )

    def _dim_item(self, wanted) -> DataFrame:
        return self._per_tenant(self.source("part")).select(
            "client_id", text("p_partkey").alias("item_id"), F.col("p_name").alias("item_name"),
            F.col("p_type").alias("item_type"), money("p_retailprice").alias("unit_price"),
            F.lit(True).alias("is_active"),
            F.concat(F.lit("INC-"), "p_type").alias("income_account_id"),
            F.concat(F.lit("EXP-"), "p_type").alias("expense_account_id"),
            F.lit(False).alias("track_qty"),
        )

    def _dim_account(self, wanted) -> DataFrame:
        """Income and expense accounts per part type; one bank account per nation; open
        receivables and payables; equity as the balancing figure."""
        kinds = self._per_tenant(self.source("part").select("p_type").distinct())
        def ledger(prefix, group, kind):
            return kinds.select(
                "client_id", F.concat(F.lit(prefix + "-"), "p_type").alias("account_id"),
                F.col("p_type").alias("account_name"),
                F.concat(F.lit(prefix + ":"), "p_type").alias("fully_qualified_name"),
                F.lit(group).alias("classification"), kind.alias("account_type"),
                F.lit(True).alias("is_sub_account"), F.lit(prefix).alias("parent_account_id"),
                F.lit(0).cast(MONEY).alias("current_balance"),
            )
        def single(df, account, group, kind, balance=F.lit(0)):
            return df.select(
                "client_id", F.lit(account).alias("account_id"),
                F.lit(account).alias("account_name"),
                F.lit(account).alias("fully_qualified_name"),
                F.lit(group).alias("classification"), F.lit(kind).alias("account_type"),
                F.lit(False).alias("is_sub_account"),
                F.lit(None).cast("string").alias("parent_account_id"),
                balance.cast(MONEY).alias("current_balance"),
            )
        cost = F.when(F.col("p_type").isin(*COST_TYPES), "Cost of Goods Sold")
        parts = [
            ledger("INC", "Revenue", F.lit("Income")),
            ledger("EXP", "Expense", cost.otherwise("Expense")),
            single(self._dim_client(set()), "INC", "Revenue", "Income"),
            single(self._dim_client(set()), "EXP", "Expense", "Expense"),
        ]
        bank = (
            self.customers().groupBy("client_id", "c_nationkey", "n_name")
            .agg(F.sum(money("c_acctbal")).alias("amount"))
        )
        bank_id = F.concat(F.lit("BANK-"), text("c_nationkey"))
        parts.append(
            bank.select(
                "client_id", bank_id.alias("account_id"), F.col("n_name").alias("account_name"),
                bank_id.alias("fully_qualified_name"), F.lit("Asset").alias("classification"),
                F.lit("Bank").alias("account_type"), F.lit(False).alias("is_sub_account"),
                F.lit(None).cast("string").alias("parent_account_id"),
                F.col("amount").cast(MONEY).alias("current_balance"),
            )
        )
        if "current_balance" in wanted:
            ar = self.orders().groupBy("client_id").agg(F.sum("balance").alias("amount"))
            bill = self._bill_totals().groupBy("client_id").agg(F.sum("balance").alias("amount"))
        else:
            ar = bill = self._dim_client(set()).select(
                "client_id", F.lit(0).cast(MONEY).alias("amount")
            )
        net = (
            bank.select("client_id", "amount")
            .unionByName(ar)
            .unionByName(bill.withColumn("amount", -F.col("amount")))
            .groupBy("client_id").agg(F.sum("amount").alias("amount"))
        )
        parts += [
            single(ar, "AR", "Asset", "Accounts Receivable", F.col("amount")),
            single(bill, "AP", "Liability", "Accounts Payable", F.col("amount")),
            single(net, "EQ", "Equity", "Equity", F.col("amount")),
        ]
        return union(parts).withColumns(
            {"is_active": F.lit(True), "currency_code": F.lit("USD")}
        )

    def _generic(self) -> DataFrame:
        tenants = self.tenants()
        return tenants.select(
            "client_id", text("n_nationkey").alias("id"), F.col("n_name").alias("name"),
            F.when(F.col("n_nationkey") % 2 == 1, F.concat_ws(":", "client_id", "n_name"))
            .otherwise(F.col("n_name")).alias("fully_qualified_name"),
            F.lit(True).alias("is_active"),
        )

    def _security_user_client_map(self, wanted) -> DataFrame:
        user = F.lit(None).cast("string")
        for tenant, name in USER_TENANTS.items():
            user = F.when(F.col("r_name") == tenant, F.lit(name)).otherwise(user)
        return (
            self.source("region")
            .select(user.alias("user_email"), F.col("r_name").alias("client_id"))
            .where("user_email is not null")
        )

    # -- facts ---------------------------------------------------------------------------

    def _fact_invoice(self, wanted) -> DataFrame:
        invoices = self.orders()
        tax = F.lit(0).cast(MONEY)
        if "total_tax" in wanted:
            taxes = self.lines().groupBy("l_orderkey").agg(F.sum("tax").alias("order_tax"))
            invoices = invoices.join(
                taxes, F.col("o_orderkey") == F.col("l_orderkey"), "left"
            )
            tax = F.coalesce(F.col("order_tax"), F.lit(0))
        due = F.date_add("order_date", INVOICE_TERM_DAYS)
        return invoices.select(
            "client_id", text("o_orderkey").alias("invoice_id"),
            F.concat(F.lit("INV-"), text("o_orderkey")).alias("doc_number"),
            F.col("order_date").alias("txn_date"), due.alias("due_date"),
            text("o_custkey").alias("customer_id"), F.col("total").alias("total_amount"),
            "balance", tax.alias("total_tax"), F.lit("NotSet").alias("email_status"),
            F.lit("NeedToPrint").alias("print_status"),
            date_key(F.col("order_date")).alias("txn_date_key"),
            date_key(due).alias("due_date_key"), "o_orderkey",
        )

    def _fact_invoice_line(self, wanted) -> DataFrame:
        lines = self.tenant_lines(wanted)
        return _with_account(lines, "INC-").withColumns({
            "invoice_id": text("l_orderkey"), "line_id": text("l_linenumber"),
            "line_num": F.col("l_linenumber"), "item_id": text("l_partkey"),
            "service_date": F.col("ship_date"), "detail_type": F.lit("SalesItemLineDetail"),
        })

    def _paid_orders(self) -> DataFrame:
        lag = (F.col("o_orderkey") % 60).cast("int")
        return self.orders().where(F.col("o_orderstatus").isin("P", "F")).select(
            "client_id", text("o_orderkey").alias("payment_id"),
            F.date_add("order_date", lag).alias("txn_date"), "total",
            (F.col("total") - F.col("balance")).alias("total_amount"),
            text("o_custkey").alias("customer_id"),
            F.concat(F.lit("BANK-"), text("c_nationkey")).alias("deposit_to_account_id"),
        )

    def _fact_payment(self, wanted) -> DataFrame:
        return self._paid_orders().withColumns({
            "unapplied_amount": F.lit(0), "txn_date_key": date_key(F.col("txn_date")),
        })

    def _fact_payment_line(self, wanted) -> DataFrame:
        return self._paid_orders().withColumns({
            "amount": F.col("total_amount"), "linked_invoice_id": F.col("payment_id"),
            "linked_txn_type": F.lit("Invoice"), "original_open_balance": text("total"),
            "invoice_doc_number": F.concat(F.lit("INV-"), "payment_id"), "line_num": F.lit(1),
        })

    def _bill_totals(self) -> DataFrame:
        """One bill per (order, supplier). Lines are reduced to their bill before the join
        that brings in the tenant."""
        bills = self.lines().where("l_returnflag = 'A'").groupBy("l_orderkey", "l_suppkey").agg(
            F.min("ship_date").alias("txn_date"), F.sum("amount").alias("total_amount"),
            F.coalesce(sum_if(F.col("l_linestatus") == "O", F.col("amount")), F.lit(0))
            .alias("balance"),
        )
        tenants = self.orders().select("client_id", "o_orderkey")
        return bills.join(tenants, F.col("l_orderkey") == F.col("o_orderkey"))

    def _fact_bill(self, wanted) -> DataFrame:
        due = F.date_add("txn_date", BILL_TERM_DAYS)
        return self._bill_totals().withColumns({
            "bill_id": _bill_id(), "due_date": due, "vendor_id": text("l_suppkey"),
            "txn_date_key": date_key(F.col("txn_date")), "due_date_key": date_key(due),
        })

    def _fact_bill_line(self, wanted) -> DataFrame:
        lines = _with_account(self.tenant_lines(wanted, "A"), "EXP-")
        keep = [c for c in lines.columns if c not in ("quantity", "unit_price", "item_name")]
        return lines.select(*keep).withColumns({
            "bill_id": _bill_id(), "line_id": text("l_linenumber"),
            "line_num": F.col("l_linenumber"),
            "detail_type": F.lit("AccountBasedExpenseLineDetail"),
            "billable_status": F.lit("NotBillable"), "customer_id": text("o_custkey"),
        })

    def _fact_purchase(self, wanted) -> DataFrame:
        kind = F.element_at(
            F.array(*map(F.lit, PAYMENT_TYPES)), (F.col("l_linenumber") % 3 + 1).cast("int")
        )
        return self.tenant_lines(set(), "R").withColumns({
            "purchase_id": _purchase_id(), "txn_date": F.col("ship_date"), "payment_type": kind,
            "total_amount": F.col("amount"),
            "account_id": F.concat(F.lit("BANK-"), text("c_nationkey")),
            "vendor_id": text("l_suppkey"), "vendor_type": F.lit("Vendor"),
            "is_credit": (F.col("l_linestatus") == "F") & (F.col("l_linenumber") == 1),
            "doc_number": F.concat(F.lit("PUR-"), _purchase_id()),
            "txn_date_key": date_key(F.col("ship_date")),
        })

    def _fact_purchase_line(self, wanted) -> DataFrame:
        lines = _with_account(self.tenant_lines(wanted, "R"), "EXP-")
        return lines.drop("item_name").withColumns({
            "purchase_id": _purchase_id(), "line_id": F.lit("1"),
            "detail_type": F.lit("AccountBasedExpenseLineDetail"),
            "billable_status": F.lit("NotBillable"), "customer_id": text("o_custkey"),
        })

    def _estimate_orders(self) -> DataFrame:
        return self.orders().where(F.col("o_orderpriority").isin(*ESTIMATE_PRIORITIES))

    def _fact_estimate(self, wanted) -> DataFrame:
        closed = F.col("o_orderstatus") == "F"
        return self._estimate_orders().withColumns({
            "estimate_id": text("o_orderkey"),
            "doc_number": F.concat(F.lit("EST-"), text("o_orderkey")),
            "txn_date": F.col("order_date"), "customer_id": text("o_custkey"),
            "total_amount": F.col("total"),
            "txn_status": F.when(closed, "Closed").otherwise("Pending"),
            "linked_invoice_id": F.when(closed, text("o_orderkey")),
            "txn_date_key": date_key(F.col("order_date")),
        })

    def _fact_estimate_line(self, wanted) -> DataFrame:
        lines = self.tenant_lines(wanted).where(
            F.col("o_orderpriority").isin(*ESTIMATE_PRIORITIES)
        )
        return _with_account(lines, "INC-").withColumns({
            "estimate_id": text("l_orderkey"), "line_id": text("l_linenumber"),
            "line_num": F.col("l_linenumber"), "item_id": text("l_partkey"),
            "detail_type": F.lit("SalesItemLineDetail"),
        })


def _numbered(df: DataFrame, key: str, copy: str) -> DataFrame:
    """Rows with their number among those of equal key; any of them may be the first."""
    return df.withColumn(copy, F.row_number().over(Window.partitionBy(key).orderBy(key)))


class StoredStar(StarTables):
    """Star tables for work that reads many facts: orders, and lines with their order and part, are written
    once. The facts of lines are then scans of one copy, without ranking the lines and joining both again.

    Repeated orders and parts repeat their lines, as in the joins; the numbers of the copies tell the lines
    themselves. Without `details` the names of items, quantities and prices are not written.
    """

    DETAILS = ("item_name", "quantity", "unit_price")

    def __init__(self, spark: SparkSession, path: str, details: bool = True):
        super().__init__(spark, path)
        self.details = details

    def table(self, name: str, *wanted: str, beside: tuple[str, ...] = ()) -> DataFrame:
        if not self.details and name.endswith("_line") and set(wanted or self.DETAILS) & set(self.DETAILS):
            raise ValueError(f"details of {name} are not stored")
        return super().table(name, *wanted, beside=beside)

    @cached_property
    def _orders(self) -> DataFrame:
        return materialize(super().orders(), "orders")

    @cached_property
    def _order_lines(self) -> DataFrame:
        orders = _numbered(self._orders, "o_orderkey", "order_copy")
        part = _numbered(self.source("part").select("p_partkey", "p_name", "p_type"), "p_partkey", "part_copy")
        joined = super().lines().join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
            part, F.col("l_partkey") == F.col("p_partkey"), "left")
        spared = () if self.details else ("quantity", "unit_price", "p_name", "total", "balance", "o_orderstatus", "o_orderpriority", "order_date")
        return materialize(joined.drop("o_orderkey", "p_partkey", *spared), "order-lines")

    def orders(self) -> DataFrame:
        return self._orders

    def lines(self) -> DataFrame:
        """Lines that have an order, each once."""
        lines = self._order_lines.where("order_copy = 1 AND coalesce(part_copy, 1) = 1")
        return lines.select([c for c in lines.columns if c.startswith("l_") or c in ("ship_date", "amount", "quantity", "unit_price", "tax")])

    def tenant_lines(self, wanted: set[str], flag: str | None = None) -> DataFrame:
        lines = self._order_lines.withColumn("o_orderkey", F.col("l_orderkey"))
        if flag:
            lines = lines.where(F.col("l_returnflag") == flag)
        if wanted & PART_COLUMNS:
            return lines
        return lines.where("coalesce(part_copy, 1) = 1").drop("p_name", "p_type")


class StoredHeaders(StarTables):
    """Star tables of which the named ones are written once, for work that builds several pulls from them."""

    def __init__(self, spark: SparkSession, path: str, *names: str):
        super().__init__(spark, path)
        self.names, self.held = names, {}

    def table(self, name: str, *wanted: str, beside: tuple[str, ...] = ()) -> DataFrame:
        if name not in self.names or beside:
            return super().table(name, *wanted, beside=beside)
        if name not in self.held:
            self.held[name] = materialize(super().table(name), name)
        return self.held[name].select(*wanted) if wanted else self.held[name]


class PartAccounts:
    """A model with one income account per part, in a deep tree: a part's account is below that of half
    its number. Some have an unknown parent, and some are below their own child."""

    def __init__(self, star: StarTables):
        self.star = star

    def table(self, name: str, *wanted: str) -> DataFrame:
        if name == "dim_account":
            number = F.col("item_id").cast("bigint")
            above = F.when(number % 40 == 7, "P-unknown").when(
                number % 40 == 9, F.concat(F.lit("P-"), (number * 2).cast("string"))).when(
                number > 1, F.concat(F.lit("P-"), F.floor(number / 2).cast("string")))
            return self.star.table("dim_item", "client_id", "item_id", "item_name").select(
                "client_id", F.concat(F.lit("P-"), "item_id").alias("account_id"), above.alias("parent_account_id"),
                F.col("item_name").alias("account_name"), F.lit("Revenue").alias("classification")).select(*wanted)
        if name == "fact_invoice_line":
            columns = [c for c in wanted if c != "account_id"]
            return self.star.table(name, *dict.fromkeys([*columns, "item_id"])).withColumn(
                "account_id", F.concat(F.lit("P-"), "item_id")).select(*wanted)
        return self.star.table(name, *wanted)


def _bill_id() -> Column:
    return F.concat_ws("-", text("l_orderkey"), text("l_suppkey"))


def _purchase_id() -> Column:
    return F.concat_ws("-", text("l_orderkey"), text("l_linenumber"))


def _with_account(lines: DataFrame, prefix: str) -> DataFrame:
    if "p_type" not in lines.columns:
        return lines
    named = {"item_name": F.col("p_name")} if "p_name" in lines.columns else {}
    return lines.withColumns({
        **named, "account_id": F.concat(F.lit(prefix), "p_type"), "account_name": F.col("p_type"),
    })
