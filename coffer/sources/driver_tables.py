"""Ledger tables and dirty sheets derived from the order tables in ``sf_dir``.

Orders play the money events, customers (folded to 97 groups) the accounts, regions
the categories and nations the subcategories.  Every derivation runs over the whole
tables.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coffer.session import materialise

ACCOUNT_GROUPS = 97
IDLE_ACCOUNT = 1000

# Column expressions shared by the ledger tables and the sheets.
_DAY = "cast(o_orderdate AS date)"
_PLAN_ID = f"year({_DAY}) * 100 + month({_DAY})"
_ACCOUNT_ID = f"cast(o_custkey % {ACCOUNT_GROUPS} AS int)"
_TYPE = """CASE o_orderkey % 20
    WHEN 0 THEN 'income' WHEN 1 THEN 'transfer_out' WHEN 2 THEN 'transfer_in' WHEN 3 THEN 'credit_payment'
    WHEN 4 THEN 'loan_given' WHEN 5 THEN 'loan_received'
    WHEN 6 THEN 'loan_repayment_in' WHEN 7 THEN 'loan_repayment_out'
    WHEN 8 THEN 'credit_purchase' WHEN 9 THEN 'credit_purchase' WHEN 10 THEN 'credit_purchase'
    ELSE 'expense' END"""
_SPENDING = """CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'extra'
    WHEN o_orderpriority <> '5-LOW' THEN 'fixed' END"""
_PAYMENT = """CASE o_orderkey % 5
    WHEN 0 THEN 'cash' WHEN 1 THEN 'bank_transfer' WHEN 2 THEN 'credit_card' WHEN 3 THEN 'momo' END"""
_NOTE = "CASE WHEN o_orderkey % 13 <> 0 THEN concat('note ', o_orderkey % 1000) END"
_HAS_CATEGORY = "o_orderkey % 41 <> 0"
_HAS_SUBCATEGORY = "o_orderkey % 41 <> 0 AND o_orderkey % 7 <> 0"

# Declared column types, so that opening a table reads no file footer.
_COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


def orders_with_nation(spark: SparkSession, sf_dir: str, names: bool = False) -> DataFrame:
    """Orders with the nation of their customer, on request with nation and region names.

    The joins carry no hint: Spark broadcasts a side whose files are under its
    threshold (nations and regions always are) and shuffles a larger customer
    table, where adaptive execution splits the partition of a hot customer.
    """
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    if names:
        region = read_table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
        nation = read_table(spark, sf_dir, "nation").join(region, "n_regionkey")
    orders = read_table(spark, sf_dir, "orders")
    placed = orders.join(customer, orders.o_custkey == customer.c_custkey).drop("c_custkey")
    return placed.join(nation, "n_nationkey")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One money event per order.  Some repayments link to an order that does not exist."""
    return orders_with_nation(spark, sf_dir).selectExpr(
        "o_orderkey AS transaction_id",
        f"{_DAY} AS transaction_date",
        f"{_ACCOUNT_ID} AS account_id",
        f"{_PLAN_ID} AS plan_id",
        f"CASE WHEN {_HAS_CATEGORY} THEN n_regionkey END AS category_id",
        f"CASE WHEN {_HAS_SUBCATEGORY} THEN n_nationkey END AS subcategory_id",
        f"{_TYPE} AS transaction_type",
        f"{_SPENDING} AS spending_type",
        "cast(floor(o_totalprice) AS decimal(15, 0)) AS amount",
        f"{_PAYMENT} AS payment_method",
        f"{_NOTE} AS note",
        """CASE WHEN o_orderkey % 100 = 3 THEN -o_orderkey
                WHEN o_orderkey % 20 = 3 THEN o_orderkey - 3
                WHEN o_orderkey % 20 IN (6, 7) THEN o_orderkey - 2 END AS related_transaction_id""",
        "o_orderstatus = 'P' AS is_regretted",
        "if(o_orderkey % 2 = 0, 'python', 'nodejs') AS source_data",
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The account groups in use and one idle account."""
    used = read_table(spark, sf_dir, "customer").selectExpr(f"cast(c_custkey % {ACCOUNT_GROUPS} AS int) AS account_id")
    idle = spark.range(1).selectExpr(f"{IDLE_ACCOUNT} AS account_id")
    return (
        used.distinct()
        .unionByName(idle)
        .selectExpr(
            "account_id",
            "concat('Account ', account_id) AS account_name",
            "CASE account_id % 3 WHEN 0 THEN 'credit' WHEN 1 THEN 'expense' ELSE 'savings' END AS account_type",
            "'VND' AS currency",
            "cast(NULL AS string) AS note",
        )
    )


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "region").selectExpr(
        "r_regionkey AS category_id",
        "r_name AS category_name",
        "'expense' AS category_type",
        "cast(NULL AS string) AS color_hex",
        "cast(r_regionkey AS tinyint) AS sort_order",
    )


def subcategories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "nation").selectExpr(
        "n_nationkey AS subcategory_id", "n_regionkey AS category_id", "n_name AS subcategory_name"
    )


def _plan_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "orders").selectExpr(f"{_PLAN_ID} AS plan_id").distinct()


def monthly_plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One plan per month; the budget equals its items except in every fifth plan."""
    return _plan_ids(spark, sf_dir).selectExpr(
        "plan_id",
        "cast(plan_id div 100 AS smallint) AS plan_year",
        "cast(plan_id % 100 AS tinyint) AS plan_month",
        "cast(6000000 + (plan_id % 7) * 1250000 + if(plan_id % 5 = 0, 1, 0) AS decimal(15, 0)) AS fixed_budget",
        "cast(2000000 + (plan_id % 7) * 500000 AS decimal(15, 0)) AS savings_target",
        "concat('plan ', plan_id) AS note",
    )


def _plans_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every plan with every region: each plan row unfolds the five regions there are at any scale."""
    regions = read_table(spark, sf_dir, "region").agg(F.array_sort(F.collect_list(F.struct("r_regionkey", "r_name"))))
    return _plan_ids(spark, sf_dir).select("plan_id", F.inline(regions.scalar()))


def monthly_plan_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plans_by_region(spark, sf_dir).selectExpr(
        "cast(plan_id AS bigint) * 10 + r_regionkey AS item_id",
        "plan_id",
        "r_regionkey AS category_id",
        "cast(1000000 + (plan_id % 7) * 250000 + r_regionkey * 100000 AS decimal(15, 0)) AS budgeted",
        "cast(NULL AS string) AS note",
    )


class OrderLedger:
    """The six ledger tables over ``sf_dir``; each is planned when first asked for.

    ``written=True`` writes accounts and plans once to the shared folder: plans that
    look them up several times then read small tables, not customers and orders.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, written: bool = False):
        self._source = spark, sf_dir
        self._keep = materialise if written else lambda df, name: df

    @cached_property
    def accounts(self) -> DataFrame:
        return self._keep(accounts(*self._source), "accounts")

    @cached_property
    def categories(self) -> DataFrame:
        return categories(*self._source)

    @cached_property
    def subcategories(self) -> DataFrame:
        return subcategories(*self._source)

    @cached_property
    def monthly_plans(self) -> DataFrame:
        return self._keep(monthly_plans(*self._source), "plans")

    @cached_property
    def monthly_plan_items(self) -> DataFrame:
        return monthly_plan_items(*self._source)

    @cached_property
    def transactions(self) -> DataFrame:
        return transactions(*self._source)


# ---------------------------------------------------------------------------
# Dirty sheets: all text, as a spreadsheet export gives them.
# ---------------------------------------------------------------------------


_SHEET_DATE = f"""CASE o_orderkey % 10
    WHEN 0 THEN 'n/a'
    WHEN 1 THEN concat('  ', {_DAY}, ' ')
    ELSE concat(month({_DAY}), '/', day({_DAY}), '/', year({_DAY})) END"""
_WITH_COMMA = (
    "concat(cast(floor(o_totalprice) AS bigint) div 1000, ',', "
    "lpad(cast(cast(floor(o_totalprice) AS bigint) % 1000 AS string), 3, '0'))"
)
_SHEET_AMOUNT = f"""CASE o_orderkey % 6
    WHEN 0 THEN '' WHEN 1 THEN 'abc' WHEN 2 THEN concat('(', {_WITH_COMMA}, ')') ELSE {_WITH_COMMA} END"""


def expense_sheet(spark: SparkSession, sf_dir: str, revised: bool = False) -> DataFrame:
    """The money events as a dirty sheet, ``_row_idx`` being the order key.

    ``revised=True`` gives the sheet as exported a second time: orders with status
    F carry an edited note and orders with status P an edited account.
    """
    account, note = f"concat('Account ', {_ACCOUNT_ID})", f"coalesce({_NOTE}, '')"
    if revised:
        account = f"if(o_orderstatus = 'P', 'Account 0', {account})"
        note = f"if(o_orderstatus = 'F', concat({note}, ' (revised)'), {note})"
    return orders_with_nation(spark, sf_dir, names=True).selectExpr(
        f"{_SHEET_DATE} AS DATE",
        f"if(o_orderkey % 3 = 0, upper({account}), concat(' ', {account})) AS Account",
        f"{_TYPE} AS Transaction_Type",
        f"coalesce({_SPENDING}, '') AS Spending_Type",
        f"coalesce({_PAYMENT}, '') AS Type_Payment",
        f"if({_HAS_CATEGORY}, concat(lower(r_name), '  '), '') AS Category",
        f"if({_HAS_SUBCATEGORY}, n_name, '') AS SUB_CATEGORY",
        f"{_SHEET_AMOUNT} AS Amount",
        f"concat({note}, ' ') AS ` Note `",
        """CASE o_orderkey % 5
                WHEN 0 THEN 'yes' WHEN 1 THEN ' TRUE' WHEN 2 THEN '1' WHEN 3 THEN 'no' ELSE '' END AS Regret""",
        "'0' AS Input",
        "'0' AS `Total  Extra Using`",
        "o_orderkey AS _row_idx",
    )


def untidy_sheet(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The expense sheet as an export without header row gives it: columns ``0``, ``1``, ...

    The first row, which holds the header, and all rows after it.  Every 17th row is blank and
    every 19th ends after three cells; the last column has no name.
    """
    rows = expense_sheet(spark, sf_dir)
    names = [c for c in rows.columns if c != "_row_idx"]
    cells = [
        F.when(F.col("_row_idx") % 17 == 0, F.lit("")).when((F.col("_row_idx") % 19 == 0) & F.lit(i > 2), F.lit(None))
        .otherwise(F.col(f"`{c}`"))
        .alias(str(i))
        for i, c in enumerate(names)
    ]
    stray = F.when(F.col("_row_idx") % 17 == 0, F.lit("")).otherwise(F.lit("stray")).alias(str(len(names)))
    header = [F.lit(c).alias(str(i)) for i, c in enumerate([*names, ""])]
    return spark.range(1).select(*header), rows.select(*cells, stray)


def plan_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plan revisions: every month twice (the later row counts), and the month seven years on."""
    return (
        _plan_ids(spark, sf_dir)
        .selectExpr("plan_id", "explode(array(0, 1, 7)) AS v")
        .selectExpr(
            "cast(plan_id div 100 + if(v = 7, 7, 0) AS string) AS Year",
            "cast(plan_id % 100 AS string) AS Month",
            "concat(2000 + plan_id % 11 + v, ',000') AS Fixed_Budget",
            "if(v = 1, '', '750,000') AS Savings_Target",
            "if(v = 0, '', concat('v', v)) AS Note",
            "cast(plan_id AS bigint) * 10 + v AS _row_idx",
        )
    )


def plan_item_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item revisions, among them months without a plan, blank months and an unknown category."""
    return _plans_by_region(spark, sf_dir).selectExpr(
        "cast(plan_id div 100 + if(plan_id % 100 = 12 AND r_regionkey = 0, 50, 0) AS string) AS Year",
        "if(plan_id % 100 = 11 AND r_regionkey = 1, '', cast(plan_id % 100 AS string)) AS Month",
        "if(plan_id % 100 = 10 AND r_regionkey = 2, 'Nowhere', concat(' ', lower(r_name))) AS Category",
        "concat(900 + plan_id % 13 + r_regionkey, ',500') AS Budgeted",
        "'' AS Note",
        "cast(plan_id AS bigint) * 10 + r_regionkey AS _row_idx",
    )
