"""The three report queries and ordered samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverline.functions import share_of
from silverline.operators.joins import lookup_join, unmatched_row_count


def volume_by_type(fact: DataFrame) -> DataFrame:
    """Rows, amount and share of all rows per transaction type.

    The total is a one-row subquery over the rows per type, whose shuffle it reuses: it
    sums both columns, so that it is the same plan down to the fact.
    """
    per_type = fact.groupBy("transaction_type").agg(
        F.count(F.lit(1)).alias("record_count"), F.sum("amount").alias("total_amount")
    )
    totals = per_type.agg(
        F.struct(F.sum("record_count").alias("records"), F.sum("total_amount").alias("amount")).alias("totals")
    )
    everything = totals.scalar()["records"]
    return per_type.withColumn("pct_of_total", share_of(F.col("record_count"), everything)).orderBy(
        "transaction_type"
    )


def unlinked_accounts(accounts: DataFrame, customers: DataFrame) -> DataFrame:
    """One row: account rows whose customer is not in the dimension."""
    return unmatched_row_count(accounts, customers, "customer_id", "unlinked_accounts")


def located_accounts(
    accounts: DataFrame, customers: DataFrame, hot_customers: DataFrame | None = None
) -> DataFrame:
    """Accounts with the province of their customer."""
    return lookup_join(
        accounts.select("account_id", "customer_id"),
        customers.select("customer_id", "province"),
        "customer_id",
        hot=hot_customers,
        spread_by="account_id",
    )


def province_distribution(
    accounts: DataFrame, customers: DataFrame, hot_customers: DataFrame | None = None
) -> DataFrame:
    """Distinct accounts per province of their customer."""
    return (
        located_accounts(accounts, customers, hot_customers)
        .groupBy("province")
        .agg(F.countDistinct("account_id").alias("account_count"))
        .orderBy("province")
    )


def sample_records(df: DataFrame, key: str, limit: int = 5) -> DataFrame:
    """The first ``limit`` rows by key: the same rows in every run."""
    return df.orderBy(key).limit(limit)
