"""Lookups against a table that has one row per key, safe when a key is hot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of one key that a task should get at most.
ROWS_PER_TASK = 1_000_000
# A key is hot when it has more than 1 / HOT_KEYS of all rows, so there are fewer hot keys than that.
HOT_KEYS = 100_000
# Places of the count vector that finds them: about ten for every hot key that there can be.
BUCKETS = 1 << 20


def bucket_counts(df: DataFrame, key: str, buckets: int = BUCKETS) -> DataFrame:
    """Rows with a key by the key's ``_bucket``, a hash of it: at most ``buckets`` rows of two numbers, from every task, too."""
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    known = df.select(key).where(F.col(key).isNotNull())
    return known.groupBy(bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_rows"))


def hot_keys(
    df: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK, most: int = HOT_KEYS, buckets: int = BUCKETS
) -> DataFrame:
    """The hot keys of ``df`` and the number of parts (``_parts``) each is split into.

    A key is hot above ``max(rows_per_task, rows of df / most)`` rows. Every such key is
    listed, and by arithmetic there are fewer than ``most`` of them, so the result may be
    broadcast whatever the size of ``df``. A key that is not listed is either smaller than
    a task or smaller than one of ``most`` equal tasks.

    Two passes over one column (and a count) find them without moving every key. The first counts rows
    per bucket of the key's hash; a hot key's bucket is above the bound itself, and fewer than
    ``most`` buckets are. The second counts exactly, but only keys in such buckets. The number of
    buckets decides how many keys are counted for nothing, never the result.
    """
    known = df.select(key).where(F.col(key).isNotNull())
    bound = known.agg(F.greatest(F.lit(rows_per_task), F.count(F.lit(1)) / most).alias("bound")).scalar()
    full = bucket_counts(df, key, buckets).where(F.col("_rows") > bound).select("_bucket")
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    suspects = known.join(F.broadcast(full), bucket == F.col("_bucket"), "left_semi")
    exact = suspects.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    return exact.where(F.col("_rows") > bound).select(
        key, F.ceil(F.col("_rows") / rows_per_task).cast("int").alias("_parts")
    )


def lookup_join(
    left: DataFrame,
    lookup: DataFrame,
    key: str,
    how: str = "inner",
    hot: DataFrame | None = None,
    spread_by: str | None = None,
) -> DataFrame:
    """Equi-join ``left`` with ``lookup`` (one row per key) on ``key``.

    Without ``hot`` this is a plain join. With it (see :func:`hot_keys`), rows of
    a hot key are spread over several parts by a hash of ``spread_by``, and only
    the lookup rows of hot keys are repeated, once per part. The part follows
    from the row, so a retried task sends every row where it went before. The
    result is that of the plain join whichever keys are listed as hot.
    """
    if hot is None:
        return left.join(lookup, key, how)
    if spread_by is None:
        raise ValueError("spread_by is needed to split hot keys")
    hot = F.broadcast(hot)
    parts = F.coalesce(F.col("_parts"), F.lit(1))
    split_left = left.join(hot, key, "left").withColumn(
        "_part", F.pmod(F.xxhash64(F.col(spread_by)), parts).cast("int")
    )
    split_lookup = lookup.join(hot, key, "left").withColumn(
        "_part", F.explode(F.sequence(F.lit(0), parts - 1))
    )
    joined = split_left.drop("_parts").join(split_lookup.drop("_parts"), [key, "_part"], how)
    return joined.drop("_part")


def unmatched_keys(left: DataFrame, right: DataFrame, key: str, ignore_null: bool = False) -> DataFrame:
    """Distinct keys of ``left`` that ``right`` lacks (NULL counts unless ignored)."""
    keys = left.select(key)
    if ignore_null:
        keys = keys.where(F.col(key).isNotNull())
    return keys.distinct().join(right.select(key).distinct(), key, "left_anti")


def unmatched_counts(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One row: ``rows`` of ``left`` whose key ``right`` lacks (NULL included), and their distinct ``keys`` (NULL not)."""
    per_key = left.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    missing = per_key.join(right.select(key), key, "left_anti")
    return missing.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).cast("bigint").alias("rows"), F.count(key).alias("keys")
    )


def unmatched_row_count(left: DataFrame, right: DataFrame, key: str, name: str) -> DataFrame:
    """One row: how many rows of ``left`` have a key that ``right`` lacks.

    Rows are counted per key before the join, so the join sees each key once
    and a hot key costs no more than any other.
    """
    return unmatched_counts(left, right, key).select(F.col("rows").alias(name))
