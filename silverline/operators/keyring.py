"""Surrogate keys that stay unique: ids of equal hash are found, and all but one get another key.

A key is a hash of its id, so it can be computed anywhere without a lookup. With 10^10 ids a few
pairs share a hash. Those are found by one shuffle of hashes, and the ids that have to give way
are listed with the key they get instead: a hash with a seed, the first that nothing else has.
The list is short, kept from run to run, and read wherever a key is computed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silverline.functions.keys import KEY_MODULUS, surrogate_key
from silverline.sources import materialised

# Rows of a list that is sent to every task; a longer one is joined, however Spark judges its size.
SENT = 100_000
# Seeds that are tried; with less than half of all keys in use, each settles most of what is left.
ATTEMPTS = 64


def id_text(value: Column) -> Column:
    """An id as hashes see it: NULL is the empty text."""
    return F.coalesce(value.cast("string"), F.lit(""))


def seeded_key(value: Column, attempt: int, modulus: int = KEY_MODULUS) -> Column:
    """The key of an id at an attempt; the first, 0, is its surrogate key."""
    if attempt == 0 and modulus == KEY_MODULUS:
        return surrogate_key(value)
    seed = [F.lit(attempt)] if attempt else []
    return F.pmod(F.xxhash64(id_text(value), *seed), F.lit(modulus)).cast("bigint")


def _sent(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= SENT else _moved(df)


def _moved(df: DataFrame) -> DataFrame:
    """A list that is joined by a shuffle. Working lists of ids are: a broadcast of texts takes the driver 64 MB at least."""
    return df.hint("merge")


def key_faults(df: DataFrame, key: str, sk: str) -> DataFrame:
    """One row: ``repeated`` groups of rows with one key and one id, and ``collided`` groups with several ids.

    Counts and extremes are taken per key before the shuffle. A group that has both faults counts in both;
    NULL keys are one group.
    """
    value = id_text(F.col(key))
    per_id = df.groupBy(sk, value.alias("_id")).agg(F.count(F.lit(1)).alias("_rows"))
    per_key = per_id.groupBy(sk).agg(F.count(F.lit(1)).alias("_ids"), F.max("_rows").alias("_most"))
    return per_key.agg(
        F.count_if(F.col("_most") > 1).alias("repeated"), F.count_if(F.col("_ids") > 1).alias("collided")
    )


def shared_hashes(ids: DataFrame, key: str, modulus: int = KEY_MODULUS) -> DataFrame:
    """The hashes (``sk``) that different ids of ``ids`` share. One shuffle, with two ids per hash and task at most."""
    value = id_text(F.col(key))
    hashed = ids.select(value.alias("id"), seeded_key(value, 0, modulus).alias("sk"))
    extremes = hashed.groupBy("sk").agg(F.min("id").alias("least"), F.max("id").alias("most"))
    return extremes.where(F.col("least") != F.col("most")).select("sk")


def most_per_hash(ids: DataFrame, key: str, modulus: int = KEY_MODULUS) -> int:
    """The most rows that any hash of ``ids`` has: with one, no two ids share a hash. Hashes and counts move, ids do not."""
    hashed = ids.select(seeded_key(F.col(key), 0, modulus).alias("sk"))
    per_hash = hashed.groupBy("sk").agg(F.count(F.lit(1)).alias("_rows"))
    return per_hash.agg(F.coalesce(F.max("_rows"), F.lit(0)).alias("most")).first().most


def resolve_collisions(
    ids: DataFrame,
    key: str,
    earlier: DataFrame | None = None,
    owners: DataFrame | None = None,
    modulus: int = KEY_MODULUS,
) -> DataFrame | None:
    """Ids that do not have the key that their hash gives, as ``id`` and ``sk``, or ``None`` if there are none.

    ``earlier`` is the list of the run before: what is on it stays on it. ``owners`` has ids and keys
    (columns ``key`` and ``sk``) that are in use from earlier runs: among ids of one hash the one that
    has this key keeps it, else the least id does. So a key that was given never changes, and with
    :func:`add_key` different ids have different keys, provided that there are more keys than ids.
    """
    spark = ids.sparkSession
    value = id_text(F.col(key))
    hashed = ids.select(value.alias("id"), seeded_key(value, 0, modulus).alias("sk"))
    resolved = None if earlier is None else materialised(earlier.select("id", "sk").distinct(), "keys")
    listed = 0 if resolved is None else resolved.count()
    if not listed and most_per_hash(ids, key, modulus) <= 1:
        return None
    clash = shared_hashes(ids, key, modulus)
    if listed:
        # A hash that was given away as a key has no room for an id either.
        clash = clash.unionByName(hashed.join(_sent(resolved.select("sk"), listed), "sk", "left_semi").select("sk"))
    if clash.isEmpty():
        return resolved if listed else None
    clash = materialised(clash.distinct(), "keys")
    clashes = clash.count()
    members = hashed.join(_sent(clash, clashes), "sk", "left_semi").distinct()
    if listed:
        members = members.join(_moved(resolved.select("id")), "id", "left_anti")
        given = resolved.select("sk").distinct().withColumn("given", F.lit(True))
        members = members.join(_sent(given, listed), "sk", "left")
    else:
        members = members.withColumn("given", F.lit(None).cast("boolean"))
    members = materialised(members, "keys")
    if owners is None:
        members = members.withColumn("owns", F.lit(False))
    else:
        used = owners.select(id_text(F.col(key)).alias("id"), F.col("sk")).join(
            _sent(clash, clashes), "sk", "left_semi"
        )
        members = members.join(_moved(used.distinct().withColumn("owns", F.lit(True))), ["id", "sk"], "left")
    first = Window.partitionBy("sk").orderBy(F.desc_nulls_last("owns"), "id")
    ranked = members.withColumn("place", F.row_number().over(first))
    losers = materialised(ranked.where((F.col("place") > 1) | F.col("given")).select("id"), "keys")
    if resolved is None:
        resolved = spark.createDataFrame([], "id string, sk long")
    for attempt in range(1, ATTEMPTS + 1):
        left = losers.count()
        if not left:
            return resolved if resolved.count() else None
        proposed = losers.select("id", seeded_key(F.col("id"), attempt, modulus).alias("sk"))
        taken = (
            hashed.select("sk").unionByName(resolved.select("sk"))
            .join(_sent(proposed.select("sk"), left), "sk", "left_semi")
            .distinct()
        )
        free = proposed.join(_sent(taken, left), "sk", "left_anti").groupBy("sk").agg(F.min("id").alias("id"))
        resolved = materialised(resolved.unionByName(free.select("id", "sk")), "keys")
        losers = materialised(losers.join(_moved(resolved.select("id")), "id", "left_anti"), "keys")
    raise ValueError(f"{losers.count()} ids have no key after {ATTEMPTS} attempts: {modulus} keys are too few")


def add_key(
    df: DataFrame, key: str, name: str, resolved: DataFrame | None = None, modulus: int = KEY_MODULUS
) -> DataFrame:
    """``df`` with the key of ``key`` as column ``name``: what ``resolved`` says of an id, else the id's hash."""
    plain = seeded_key(F.col(key), 0, modulus)
    if resolved is None:
        return df.withColumn(name, plain)
    rows = resolved.count()
    if not rows:
        return df.withColumn(name, plain)
    listed = resolved.select(F.col("id").alias("_id"), F.col("sk").alias("_sk"))
    joined = df.join(_sent(listed, rows), id_text(F.col(key)) == F.col("_id"), "left")
    return joined.withColumn(name, F.coalesce("_sk", plain)).drop("_id", "_sk")
