"""Records that a layer does not take, or takes with a value missing: each with its code and as it came.

What the handling of an issue calls quarantine, reject or report is a table here. Every record of
a raw table is either the source of a silver row or among the rejected records, and every silver
row is in gold or among them; ``copies`` says how many equal records a row stands for, so that
the figures add up. Reported records are in the next layer, without the value that could not be read.

Columns: ``table_name``, ``layer`` that did not take the record (or its value), ``issue_code``,
``handling_action``, ``kept`` (true for reported ones), ``record_key``, ``record`` (JSON with all
columns of the layer before), ``copies`` and ``hits`` (values concerned; 1 for a record as a whole).
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silverline import functions as fn
from silverline.fixed_values import ISSUE_HANDLING
from silverline.functions.keys import is_present
from silverline.operators.dedupe import latest_per_key
from silverline.operators.joins import hot_keys, lookup_join
from silverline.plans.issues import count_hits, row_tests
from silverline.plans.silver import clean, prepare, tie_breakers
from silverline.spec import TableSpec

# Codes for what has none among the issues of the summary.
UNLINKED, MALFORMED = "UNLINKED_ACCOUNT", "MALFORMED_RECORD"
HANDLING = {
    **ISSUE_HANDLING,
    UNLINKED: "quarantine_from_gold_dim_and_report",
    MALFORMED: "read_what_is_there_and_report",
}
# The column that readers put lines into that do not fit (see ``corrupt`` of the readers).
CORRUPT = "_corrupt_record"


def as_record(df: DataFrame) -> Column:
    """All columns of a row as JSON, NULLs included."""
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})


def _noted(
    df: DataFrame, table: str, layer: str, code: Column | str, kept: bool, copies: Column | int = 1, hits: Column | int = 1
) -> DataFrame:
    """Rows with ``record_key`` and ``record`` in the common form."""
    code = F.lit(code) if isinstance(code, str) else code
    action = F.create_map(*[F.lit(x) for pair in HANDLING.items() for x in pair])[code]
    number = lambda value: (F.lit(value) if isinstance(value, int) else value).cast("bigint")
    return df.select(
        F.lit(table).alias("table_name"),
        F.lit(layer).alias("layer"),
        code.alias("issue_code"),
        action.alias("handling_action"),
        F.lit(kept).alias("kept"),
        F.col("record_key").cast("string"),
        "record",
        number(copies).alias("copies"),
        number(hits).alias("hits"),
    )


def silver_rejects(raw: DataFrame, spec: TableSpec, hot: DataFrame | None = None) -> DataFrame:
    """Raw records without a row in silver: without a key (NULL_REQUIRED), or not the latest of theirs (DUPLICATE_DEDUPED).

    Records are moved once, as they came, to the others of their key; only those of repeated keys are cleaned and spelt
    as JSON. ``hot`` has the hot keys of the table (``record_key``), counted here if it is not given: their
    records are counted by key and record first, and split.
    """
    prepared = prepare(raw, spec)
    key = "_record_key"
    while any(c.lower().startswith(key) for c in prepared.columns):
        key = "_" + key
    copies = f"{key}_copies"
    noted = prepared.withColumn(key, fn.trimmed_key(F.col(f"`{spec.key}`")))
    known = F.coalesce(is_present(F.col(key)), F.lit(False))
    nameless = noted.where(~known).withColumns({"record": as_record(prepared), "record_key": F.col(key)})
    nameless = _noted(nameless, spec.name, "silver", "NULL_REQUIRED", kept=False)

    present = noted.where(known)
    if hot is None:
        hot = hot_keys(present.select(F.col(key).alias("record_key")), "record_key")
    listed = F.broadcast(hot.select(F.col("record_key").alias(key)))

    def cleaned(rows: DataFrame) -> DataFrame:
        """Silver columns beside the record; ``key`` stays the column by which the rows lie."""
        return clean(rows.withColumn("record", as_record(prepared)), spec, carry=("record", key))

    # The silver row's choice; records that it cannot tell apart are ordered by themselves.
    order = [*tie_breakers(spec), "record"]
    newest = [F.desc_nulls_last(name) for name in spec.newest_first]
    of_key = Window.partitionBy(key)
    ordinary = present.join(listed, key, "left_anti").withColumn(copies, F.count(F.lit(1)).over(of_key))
    ranked = cleaned(ordinary.where(F.col(copies) > 1)).withColumn("_place", F.row_number().over(of_key.orderBy(*newest, *order)))
    superseded = ranked.where("_place > 1").groupBy(F.col(key).alias("record_key"), "record").agg(
        F.count(F.lit(1)).alias("left")
    )

    several = cleaned(present.join(listed, key, "left_semi")).drop(spec.key).withColumnRenamed(key, "record_key")
    latest = latest_per_key(several, "record_key", spec.newest_first, order)
    latest = latest.select("record_key", F.col("record").alias("latest"))
    counted = several.groupBy("record_key", "record").agg(F.count(F.lit(1)).alias("n"))
    compared = lookup_join(counted, latest, "record_key", "inner", hot, spread_by="record")
    left = F.col("n") - F.when(F.col("record") == F.col("latest"), 1).otherwise(0)
    split = compared.select("record_key", "record", left.alias("left")).where("left > 0")
    return nameless.unionByName(
        _noted(superseded.unionByName(split), spec.name, "silver", "DUPLICATE_DEDUPED", kept=False, copies=F.col("left"))
    )


def reported_records(raw: DataFrame, spec: TableSpec) -> DataFrame:
    """Raw records with values that could not be read or were spelt otherwise, one row per record and code.

    ``hits`` is how many values; malformed lines are here when the reader kept them.
    """
    prepared = prepare(raw, spec)
    noted = prepared.withColumns({"record": as_record(prepared), "record_key": fn.trimmed_key(F.col(spec.key))})
    tests = {code: count_hits(found) for code, found in row_tests(prepared, spec).items() if found}
    if CORRUPT in prepared.columns:
        tests[MALFORMED] = F.when(F.col(CORRUPT).isNotNull(), 1).otherwise(0)
    if not tests:
        return _noted(noted.limit(0), spec.name, "silver", MALFORMED, kept=True)
    found = F.array(*[F.struct(F.lit(code).alias("code"), hits.alias("hits")) for code, hits in tests.items()])
    rows = noted.select("record_key", "record", F.explode(F.filter(found, lambda f: f["hits"] > 0)).alias("f"))
    return _noted(rows, spec.name, "silver", F.col("f.code"), kept=True, hits=F.col("f.hits"))


def gold_rejects(
    silver: DataFrame, parents: DataFrame, spec: TableSpec, parent_key: str, code: str, hot: DataFrame | None = None
) -> DataFrame:
    """Silver rows whose ``parent_key`` is not among ``parents`` (NULL included), which therefore are not in gold."""
    lost = lookup_join(silver, parents.select(parent_key), parent_key, "left_anti", hot, spread_by=spec.key)
    noted = lost.withColumns({"record": as_record(silver), "record_key": F.col(spec.key)})
    return _noted(noted, spec.name, "gold", code, kept=False)


def balance(counts: Mapping[str, tuple[DataFrame, DataFrame, DataFrame]]) -> DataFrame:
    """For each named step of (what came, what was kept, rejected records): the three counts, and whether they add up."""

    def one(name: str, came: DataFrame, kept: DataFrame, rejected: DataFrame) -> DataFrame:
        n = F.count(F.lit(1))
        sides = {
            "n_came": came.agg(n.alias("n")),
            "n_kept": kept.agg(n.alias("n")),
            "n_rejected": rejected.where(~F.col("kept")).agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("n")),
        }
        row = came.sparkSession.range(1).select(F.lit(name).alias("step"), *[s.scalar().alias(c) for c, s in sides.items()])
        return row.withColumn("balanced", F.col("n_came") == F.col("n_kept") + F.col("n_rejected"))

    return reduce(DataFrame.unionByName, [one(name, *tables) for name, tables in counts.items()])
