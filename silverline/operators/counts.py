"""Counts over whole tables. Every function returns a DataFrame, usually of one row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the count reported for a column the table does not have.
MISSING_COLUMN = -1


def _nulls(df: DataFrame, name: str) -> Column:
    counted = F.count_if(F.col(name).isNull()) if name in df.columns else F.lit(MISSING_COLUMN)
    return counted.cast("bigint")


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs of several columns in one pass; -1 for a column that is missing."""
    return df.agg(*[_nulls(df, name).alias(name) for name in columns])


def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many key groups hold more than one row; -1 if a key column is missing.

    A NULL key is one group. Rows are counted per key before the shuffle.
    """
    if not set(keys) <= set(df.columns):
        return df.sparkSession.range(1).select(F.lit(MISSING_COLUMN).cast("bigint").alias("duplicate_groups"))
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return per_key.agg(F.count_if(F.col("_rows") > 1).alias("duplicate_groups"))


def amount_summary(df: DataFrame, column: str = "amount") -> DataFrame:
    """Count, sum, mean, minimum and maximum of one decimal column, as doubles."""
    summaries = {
        "total_amount": F.sum(column),
        "average_amount": F.avg(column),
        "minimum_amount": F.min(column),
        "maximum_amount": F.max(column),
    }
    return df.agg(
        F.count(F.lit(1)).alias("transaction_count"),
        *[value.cast("double").alias(name) for name, value in summaries.items()],
    )


def figure_columns(df: DataFrame, null_columns: Sequence[str] = (), amount: str | None = None) -> dict[str, Column]:
    """The figures of :func:`table_profile` but the duplicates, as aggregates that can be observed while a table is written."""
    n = F.count(F.lit(1))
    figures = {"rows": n}
    for name in null_columns:
        figures[f"nulls_{name}"] = F.count_if(F.col(name).isNull()) if name in df.columns else n * 0 + MISSING_COLUMN
    if amount is not None and amount in df.columns:
        value = F.col(amount)
        mean = F.try_divide(F.sum(value).cast("decimal(38,6)"), F.count(value).cast("decimal(18,0)"))
        figures |= {
            "amount_total": F.sum(value).cast("double"),
            "amount_average": F.round(mean, 6).cast("double"),
            "amount_minimum": F.min(value).cast("double"),
            "amount_maximum": F.max(value).cast("double"),
        }
    return figures


def table_profile(
    df: DataFrame,
    key: str | None = None,
    null_columns: Sequence[str] = (),
    amount: str | None = None,
) -> DataFrame:
    """Rows, duplicate keys, NULLs and amount figures of a table in one pass.

    One row with ``rows``, ``duplicates`` (if ``key`` is given), ``nulls_<column>``
    and ``amount_<figure>``. Subtotals are taken per key before the shuffle, so
    the duplicate count comes from the same scan and shuffle as everything else.
    """
    with_amount = amount is not None and amount in df.columns
    partial = [F.count(F.lit(1)).alias("rows")]
    final = [F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("rows")]
    for name in null_columns:
        label = f"nulls_{name}"
        if name in df.columns:
            partial.append(_nulls(df, name).alias(label))
            final.append(F.coalesce(F.sum(label), F.lit(0)).cast("bigint").alias(label))
        else:
            final.append(F.lit(MISSING_COLUMN).cast("bigint").alias(label))
    if with_amount:
        value = F.col(amount)
        partial += [
            F.sum(value).alias("amount_sum"),
            F.count(value).alias("amount_values"),
            F.min(value).alias("amount_min"),
            F.max(value).alias("amount_max"),
        ]
        total = F.sum("amount_sum")
        # try_divide: NULL when there is no value, as avg() gives.
        mean = F.try_divide(total.cast("decimal(38,6)"), F.sum("amount_values").cast("decimal(18,0)"))
        final += [
            total.cast("double").alias("amount_total"),
            F.round(mean, 6).cast("double").alias("amount_average"),
            F.min("amount_min").cast("double").alias("amount_minimum"),
            F.max("amount_max").cast("double").alias("amount_maximum"),
        ]
    if key is None:
        return df.agg(*partial).agg(*final)
    if key not in df.columns:
        final.append(F.lit(MISSING_COLUMN).cast("bigint").alias("duplicates"))
        return df.agg(*partial).agg(*final)
    final.append(F.count_if(F.col("rows") > 1).alias("duplicates"))
    return df.groupBy(key).agg(*partial).agg(*final)
