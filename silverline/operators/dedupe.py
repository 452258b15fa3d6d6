"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from silverline.functions.keys import is_present


def present_keys(df: DataFrame, key: str) -> DataFrame:
    """Rows whose key is neither NULL nor blank."""
    return df.where(is_present(F.col(key)))


def latest_per_key(
    df: DataFrame,
    key: str,
    newest_first: Sequence[str] = ("ingestion_timestamp",),
    ties: Sequence[str] | None = None,
) -> DataFrame:
    """The row of every present key that is newest by ``newest_first`` (NULL is oldest).

    Ties are settled by ``ties``, ascending with NULL first; by default all other
    columns, so the kept row depends on the data alone and not on partitioning
    or retries.

    Spark turns "row number = 1" into a group limit that runs before the
    shuffle: each map task sends at most one row per key, so a key that holds a
    third of the table still reaches its reducer as one row per map task.
    """
    if ties is None:
        ties = [name for name in df.columns if name != key and name not in newest_first]
    window = Window.partitionBy(key).orderBy(*[F.desc_nulls_last(name) for name in newest_first], *ties)
    ranked = present_keys(df, key).withColumn("_rank", F.row_number().over(window))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def one_per_key(df: DataFrame, key: str) -> DataFrame:
    """One row per key, NULL being a key: the first in column order."""
    others = [name for name in df.columns if name != key]
    window = Window.partitionBy(key).orderBy(*(others or [key]))
    ranked = df.withColumn("_rank", F.row_number().over(window))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of one column, NULL included."""
    return df.select(column).distinct()
