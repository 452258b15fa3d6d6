"""Tables laid out by a join key, so that tables of the same layout join without moving their rows.

Below its folder such a table has

* ``buckets`` - rows of ordinary keys, in a fixed number of buckets of the key's hash, sorted by the key,
* ``apart``   - rows without a key and rows of hot keys, in as many files as they need: a bucket is read by one task,
* ``keys``    - the hot keys, fewer than :data:`silverline.operators.joins.HOT_KEYS`,
* ``layout``  - key, number of buckets, columns and number of hot keys.

Spark knows of buckets through the session's catalog. A table is entered there when it is written
and again by whoever opens the folder, under a name that follows from its layout; with the default catalog only
the own session sees the entry, which is why the folder says what it needs.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverline.operators.joins import lookup_join

# Hot keys whose lookup rows may be broadcast; with more of them they are split and shuffled.
BROADCAST_KEYS = 10_000


@dataclass(frozen=True)
class ByKey:
    """An opened table: its ordinary rows, those kept apart, the hot keys and how many they are."""

    key: str
    buckets: int
    ordinary: DataFrame
    apart: DataFrame
    hot: DataFrame
    n_hot: int

    def rows(self) -> DataFrame:
        """All rows of the table."""
        return self.ordinary.unionByName(self.apart)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _entered(spark: SparkSession, path: str, key: str, buckets: int, columns: str) -> str:
    """The catalog's name of the buckets at ``path``, entered if need be."""
    layout = "\n".join((path, key, str(buckets), columns))
    name = f"by_key_{hashlib.sha256(layout.encode()).hexdigest()[:32]}"
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"create table if not exists {name} ({columns}) using parquet clustered by ({_quoted(key)}) "
        f"sorted by ({_quoted(key)}) into {buckets} buckets location '{place}/buckets'"
    )
    return name


def write_by_key(df: DataFrame, path: str, key: str, buckets: int, hot: DataFrame | None = None) -> None:
    """Write ``df`` laid out by ``key``; ``hot`` has the hot keys (see ``hot_keys``) and their ``_parts``.

    One shuffle of the ordinary rows; a task writes one file for each of its buckets. Rows of hot keys and rows without a
    key are not shuffled. ``df`` is read three times: write one that is dear to compute first. Give tables that are to be joined the same number of buckets, so large that a bucket fits a task.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in df.schema.fields)
    if hot is None:
        hot = df.select(key).where("false").withColumn("_parts", F.lit(1))
    hot.write.mode("overwrite").parquet(f"{path}/keys")
    hot = spark.read.schema(hot.schema).parquet(f"{path}/keys")
    # Fewer than HOT_KEYS rows, by the arithmetic of ``hot_keys``.
    keys = F.broadcast(hot.select(key))
    as_given = [F.col(_quoted(c)) for c in df.columns]
    present = df.where(F.col(_quoted(key)).isNotNull())
    apart = df.where(F.col(_quoted(key)).isNull()).unionByName(present.join(keys, key, "left_semi").select(*as_given))
    apart.write.mode("overwrite").parquet(f"{path}/apart")

    ordinary = present.join(keys, key, "left_anti").select(*as_given).repartition(buckets, F.col(_quoted(key)))
    name = _entered(spark, path, key, buckets, columns)
    ordinary.write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key).option(
        "path", f"{path}/buckets"
    ).saveAsTable(name)
    said = [(key, buckets, columns, hot.count())]
    spark.createDataFrame(said, "key string, buckets int, columns string, n_hot long").coalesce(1).write.mode(
        "overwrite"
    ).json(f"{path}/layout")


def open_by_key(spark: SparkSession, path: str) -> ByKey:
    """The table that :func:`write_by_key` wrote, in this session or another."""
    path = path.rstrip("/")
    schema = "key string, buckets int, columns string, n_hot long"
    said = spark.read.schema(schema).json(f"{path}/layout").first()
    name = _entered(spark, path, said.key, said.buckets, said.columns)
    spark.catalog.refreshTable(name)
    ordinary = spark.table(name)
    return ByKey(
        said.key,
        said.buckets,
        ordinary,
        spark.read.schema(ordinary.schema).parquet(f"{path}/apart"),
        spark.read.parquet(f"{path}/keys"),
        said.n_hot,
    )


def join_by_key(left: ByKey, lookup: ByKey, how: str, spread_by: str, broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """Join two tables of one layout; ``lookup`` has one row per key and no hot keys.

    ``how`` is inner, left, left_semi or left_anti. Ordinary rows are joined bucket by bucket, without an exchange.
    Rows kept apart stay where they are and meet the lookup rows of the hot keys, which are broadcast up to ``broadcast_keys``
    of them and beyond that are split by a hash of ``spread_by``. The result is that of the plain join.
    """
    if (left.key, left.buckets) != (lookup.key, lookup.buckets):
        raise ValueError("the tables are laid out differently")
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"{how} is no join of a table with its lookup")
    key = left.key
    ordinary = left.ordinary.join(lookup.ordinary, key, how)
    wanted = lookup.ordinary.join(F.broadcast(left.hot.select(key)), key, "left_semi")
    if left.n_hot <= broadcast_keys:
        return ordinary.unionByName(left.apart.join(F.broadcast(wanted), key, how))
    return ordinary.unionByName(lookup_join(left.apart, wanted, key, how, left.hot, spread_by))
