"""Ledger tables: types, accepted values and seed rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

MONEY = T.DecimalType(15, 0)

# ---------------------------------------------------------------------------
# They must equal the ledger's own for results to match.
# ---------------------------------------------------------------------------

ACCOUNT_TYPES = ("savings", "expense", "credit")
CATEGORY_TYPES = ("expense", "income", "transfer", "debt")
TRANSACTION_TYPES = (
    "income",
    "expense",
    "transfer_out",
    "transfer_in",
    "credit_purchase",
    "credit_payment",
    "loan_given",
    "loan_received",
    "loan_repayment_in",
    "loan_repayment_out",
)
SPENDING_TYPES = ("fixed", "extra")
PAYMENT_METHODS = ("cash", "bank_transfer", "credit_card", "momo")
SOURCE_VALUES = ("nodejs", "python")

SPEND_TYPES = ("expense", "credit_purchase")
CASH_IN_TYPES = ("income", "transfer_in", "loan_received", "loan_repayment_in")
CASH_OUT_TYPES = ("expense", "transfer_out", "credit_payment", "loan_given", "loan_repayment_out")

STAGING_KEYS = ("date", "account", "transaction_type", "amount", "type_payment", "category", "sub_category")
ARTEFACT_COLUMNS = (
    "input",
    "output",
    "amount_balance",
    "total_expense_monthly",
    "total_extra_using",
    "total_renting_expense",
)
TRUE_WORDS = ("true", "1", "yes")
UNIQUE_NOTE_PREFIX = 200

SEED_ACCOUNTS = (
    ("savings (SC Bank)", "savings", "Receives salary; source for monthly transfer"),
    ("expense (ACB)", "expense", "Day-to-day spending; funded at start of month"),
    ("credit (SC Credit)", "credit", "Pay later; track via credit_purchase / credit_payment"),
)
# name, type, colour, sort order, subcategories
SEED_CATEGORIES = (
    ("Food & Drinks", "expense", "#a855f7", 1, ("Daily meals", "Eating out", "Coffee/Drinks", "Snacks")),
    ("Housing & Bills", "expense", "#f87171", 2, ("Rent", "Electricity", "Water", "Internet/Phone", "Others")),
    ("Transportation", "expense", "#facc15", 3, ("Fuel", "Grab/Taxi", "Parking", "Others")),
    ("Personal Care", "expense", "#dc2626", 4, ("Gym Membership", "Haircut", "Medicine", "Others")),
    ("Entertainment", "expense", "#4ade80", 5, ("Movies", "Hobbies", "Badminton", "Games", "Others")),
    ("Education", "expense", "#713f12", 6, ("Tuition", "Courses", "Books", "Degree")),
    ("Shopping", "expense", "#fb923c", 7, ("Clothes", "Electronics", "Others")),
    ("Dating", "expense", "#f9a8d4", 8, ("Dinner", "Gifts", "Activities", "Others")),
    ("Family", "expense", "#93c5fd", 9, ("Mom Allowance", "Family Extra", "Others")),
    ("Miscellaneous", "expense", "#d1d5db", 10, ("Others",)),
    (
        "Debt",
        "debt",
        "#166534",
        11,
        ("Lend to Friends", "Borrow from Others", "Repay (Momo)", "Repay (Bank)", "Credit Card Bill", "Others"),
    ),
    ("Savings & Investing", "transfer", "#6d28d9", 12, ("Emergency Fund", "Stocks", "Monthly Transfer")),
    ("Income", "income", "#1d4ed8", 13, ("Salary", "Freelance", "From Mom", "Others")),
)

# ---------------------------------------------------------------------------
# Table types.  Transaction ids are 64-bit: the fact table outgrows 32 bits.
# ---------------------------------------------------------------------------

ACCOUNTS = T.StructType(
    [
        T.StructField("account_id", T.IntegerType(), False),
        T.StructField("account_name", T.StringType(), False),
        T.StructField("account_type", T.StringType(), False),
        T.StructField("currency", T.StringType(), False),
        T.StructField("note", T.StringType()),
    ]
)
CATEGORIES = T.StructType(
    [
        T.StructField("category_id", T.IntegerType(), False),
        T.StructField("category_name", T.StringType(), False),
        T.StructField("category_type", T.StringType(), False),
        T.StructField("color_hex", T.StringType()),
        T.StructField("sort_order", T.ByteType(), False),
    ]
)
SUBCATEGORIES = T.StructType(
    [
        T.StructField("subcategory_id", T.IntegerType(), False),
        T.StructField("category_id", T.IntegerType(), False),
        T.StructField("subcategory_name", T.StringType(), False),
    ]
)
MONTHLY_PLANS = T.StructType(
    [
        T.StructField("plan_id", T.IntegerType()),
        T.StructField("plan_year", T.ShortType()),
        T.StructField("plan_month", T.ByteType()),
        T.StructField("fixed_budget", MONEY),
        T.StructField("savings_target", MONEY),
        T.StructField("note", T.StringType()),
    ]
)
MONTHLY_PLAN_ITEMS = T.StructType(
    [
        T.StructField("item_id", T.LongType()),
        T.StructField("plan_id", T.IntegerType()),
        T.StructField("category_id", T.IntegerType()),
        T.StructField("budgeted", MONEY),
        T.StructField("note", T.StringType()),
    ]
)
TRANSACTIONS = T.StructType(
    [
        T.StructField("transaction_id", T.LongType()),
        T.StructField("transaction_date", T.DateType()),
        T.StructField("account_id", T.IntegerType()),
        T.StructField("plan_id", T.IntegerType()),
        T.StructField("category_id", T.IntegerType()),
        T.StructField("subcategory_id", T.IntegerType()),
        T.StructField("transaction_type", T.StringType()),
        T.StructField("spending_type", T.StringType()),
        T.StructField("amount", MONEY),
        T.StructField("payment_method", T.StringType()),
        T.StructField("note", T.StringType()),
        T.StructField("related_transaction_id", T.LongType()),
        T.StructField("is_regretted", T.BooleanType()),
        T.StructField("source_data", T.StringType()),
    ]
)


@dataclass(frozen=True)
class Ledger:
    """The six tables of the star schema, as DataFrames.

    Plans read only these attributes, so any object that has them will do.
    """

    accounts: DataFrame
    categories: DataFrame
    subcategories: DataFrame
    monthly_plans: DataFrame
    monthly_plan_items: DataFrame
    transactions: DataFrame


def seed_dimensions(spark: SparkSession) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Seed accounts, categories and subcategories, ids in listed order from 1."""
    accounts = [(i, n, t, "VND", note) for i, (n, t, note) in enumerate(SEED_ACCOUNTS, 1)]
    categories = [(i, n, t, c, s) for i, (n, t, c, s, _) in enumerate(SEED_CATEGORIES, 1)]
    pairs = [(cat_id, name) for cat_id, row in enumerate(SEED_CATEGORIES, 1) for name in row[4]]
    subcategories = [(i, cat_id, name) for i, (cat_id, name) in enumerate(pairs, 1)]
    return (
        spark.createDataFrame(accounts, ACCOUNTS),
        spark.createDataFrame(categories, CATEGORIES),
        spark.createDataFrame(subcategories, SUBCATEGORIES),
    )


def empty_ledger(spark: SparkSession) -> Ledger:
    """Seeded dimensions with no plans, items or transactions yet."""
    accounts, categories, subcategories = seed_dimensions(spark)
    return Ledger(
        accounts,
        categories,
        subcategories,
        spark.createDataFrame([], MONTHLY_PLANS),
        spark.createDataFrame([], MONTHLY_PLAN_ITEMS),
        spark.createDataFrame([], TRANSACTIONS),
    )
