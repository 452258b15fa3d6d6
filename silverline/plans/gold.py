"""Gold tables: two dimensions and one fact with stable hashed keys.

The inputs are silver tables, which hold one row per key; no further distinct is
needed, so none is paid for. ``hot_*`` arguments take the result of
:func:`silverline.operators.joins.hot_keys` and split heavy keys in the joins. ``keys`` has the lists
of :func:`silverline.operators.keyring.resolve_collisions` by id column, for ids whose hash is another's key.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverline import functions as fn
from silverline.operators.joins import lookup_join, unmatched_row_count
from silverline.operators.keyring import add_key
from silverline.operators.shape import column_or_null


Keys = Mapping[str, DataFrame | None]


def _keyed(df: DataFrame, key: str, keys: Keys | None) -> DataFrame:
    """``df`` with the surrogate key of one of its ids."""
    return add_key(df, key, key.removesuffix("_id") + "_sk", (keys or {}).get(key))


def dim_customers(customers: DataFrame, as_of: date | Column | None = None, keys: Keys | None = None) -> DataFrame:
    texts = ("gender", "province", "income_band", "segment")
    return _keyed(customers, "customer_id", keys).select(
        "customer_sk",
        F.col("customer_id").cast("string").alias("customer_id"),
        *[column_or_null(customers, name, "string") for name in texts],
        column_or_null(customers, "risk_score", "int"),
        column_or_null(customers, "kyc_status", "string"),
        fn.age_band(F.col("dob"), as_of).alias("age_band"),
    )


def dim_accounts(
    accounts: DataFrame, customers: DataFrame, hot_customers: DataFrame | None = None, keys: Keys | None = None
) -> DataFrame:
    """Accounts of known customers. Only existence matters, hence the semi join."""
    known = lookup_join(
        accounts,
        customers.select("customer_id"),
        "customer_id",
        "left_semi",
        hot=hot_customers,
        spread_by="account_id",
    )
    return _keyed(known, "account_id", keys).select(
        "account_sk",
        *[column_or_null(known, n, "string") for n in ("account_id", "customer_id")],
        *[column_or_null(known, n, "string") for n in ("account_type", "account_status")],
        column_or_null(known, "account_open_date", "date").alias("open_date"),
        *[column_or_null(known, n, "string") for n in ("product_tier", "digital_channel")],
        *[column_or_null(known, n, "decimal(18,2)") for n in ("credit_limit", "current_balance")],
        column_or_null(known, "last_activity_date", "date"),
    )


def fact_transactions(
    transactions: DataFrame,
    accounts: DataFrame,
    customers: DataFrame | None = None,
    hot_accounts: DataFrame | None = None,
    hot_customers: DataFrame | None = None,
    keys: Keys | None = None,
) -> DataFrame:
    """Transactions of known accounts of known customers.

    A customer's key is a function of its id, which the accounts carry, and
    :func:`dim_accounts` keeps accounts of known customers only: the accounts alone
    are enough. Give ``customers`` where the two dimensions may not belong together;
    accounts of other customers are then left out first, on narrow columns, so that
    the fact is shuffled for a join once in either case.
    """
    linked = account_links(accounts, customers, hot_customers, keys)
    joined = lookup_join(
        transactions, linked, "account_id", hot=hot_accounts, spread_by="transaction_id"
    )
    return fact_rows(joined, keys)


def account_links(
    accounts: DataFrame,
    customers: DataFrame | None = None,
    hot_customers: DataFrame | None = None,
    keys: Keys | None = None,
) -> DataFrame:
    """What the fact takes from an account: its id, its key and its customer's key."""
    linked = accounts.select("account_id", "account_sk", "customer_id")
    if customers is not None:
        linked = lookup_join(
            linked, customers.select("customer_id"), "customer_id", "left_semi", hot=hot_customers, spread_by="account_id"
        )
    return _keyed(linked, "customer_id", keys).select("account_id", "account_sk", "customer_sk")


def fact_rows(joined: DataFrame, keys: Keys | None = None) -> DataFrame:
    """The fact from transactions that have met their :func:`account_links`, however they were joined."""
    texts = ("transaction_type", "merchant_category", "merchant_subcategory")
    return _keyed(joined, "transaction_id", keys).select(
        "transaction_sk",
        F.col("transaction_id").cast("string").alias("transaction_id"),
        "account_sk",
        "customer_sk",
        column_or_null(joined, "transaction_date", "date"),
        column_or_null(joined, "transaction_timestamp", "timestamp"),
        *[column_or_null(joined, name, "string") for name in texts],
        column_or_null(joined, "amount", "decimal(18,2)"),
        column_or_null(joined, "currency", "string"),
        column_or_null(joined, "channel", "string"),
        column_or_null(joined, "location_province", "string").alias("province"),
        column_or_null(joined, "dq_flag", "string"),
        column_or_null(joined, "ingestion_timestamp", "timestamp"),
    )


def orphaned_transactions(transactions: DataFrame, accounts: DataFrame) -> DataFrame:
    """One row: transactions whose account is not in the dimension (NULL included)."""
    return unmatched_row_count(transactions, accounts, "account_id", "orphan_count")
