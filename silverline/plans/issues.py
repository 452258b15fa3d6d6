"""Data-quality issues: per-row tests, counts per table, the six-code summary."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silverline import functions as fn
from silverline.fixed_values import HOME_CURRENCY, ISSUE_HANDLING
from silverline.functions.keys import is_present
from silverline.functions.times import flexible_date
from silverline.spec import TableSpec


def _unreadable(value: Column, parsed: Column) -> Column:
    """True when there is a value and it could not be read; not true otherwise."""
    return (F.trim(value.cast("string")) != F.lit("")) & parsed.isNull()


def unreadable_numbers(prepared: DataFrame, spec: TableSpec) -> list[Column]:
    """One test per numeric column: present but no number of the wanted type."""
    return [
        _unreadable(F.col(name), read(F.col(name)))
        for name, read in spec.numbers.items()
        if name in prepared.columns
    ]


def unreadable_dates(prepared: DataFrame, spec: TableSpec) -> list[Column]:
    """One test per date column: present but in no supported format."""
    picked = [next((n for n in names if n in prepared.columns), None) for names in spec.dates]
    return [_unreadable(F.col(n), flexible_date(F.col(n))) for n in picked if n is not None]


def currency_variants(prepared: DataFrame, spec: TableSpec) -> list[Column]:
    """At most one test: the home currency, spelled otherwise than by its code."""
    if spec.currency is None or spec.currency not in prepared.columns:
        return []
    raw = F.col(spec.currency)
    return [(raw != F.lit(HOME_CURRENCY)) & (fn.currency(raw) == F.lit(HOME_CURRENCY))]


def count_hits(tests: list[Column]) -> Column:
    """How many of the tests are true for a row."""
    return reduce(add, [F.when(test, 1).otherwise(0) for test in tests], F.lit(0))


def row_tests(prepared: DataFrame, spec: TableSpec) -> dict[str, list[Column]]:
    """The tests of a row's values by issue code, in the order of their weight."""
    return {
        "CURRENCY_VARIANT": currency_variants(prepared, spec),
        "TYPE_MISMATCH": unreadable_numbers(prepared, spec),
        "DATE_FORMAT": unreadable_dates(prepared, spec),
    }


def row_issue(prepared: DataFrame, spec: TableSpec) -> Column:
    """First issue code of a row: currency, then type, then date; NULL if clean."""
    tests = row_tests(prepared, spec)
    return F.coalesce(
        *[F.when(reduce(or_, found), code) for code, found in tests.items() if found], F.lit(None).cast("string")
    )


COUNTED = ("DUPLICATE_DEDUPED", "TYPE_MISMATCH", "DATE_FORMAT", "CURRENCY_VARIANT", "NULL_REQUIRED")


def table_issue_counts(prepared: DataFrame, spec: TableSpec, codes: Sequence[str] = COUNTED) -> DataFrame:
    """One row of counts of the given issue codes for one prepared raw table.

    All codes together take one scan and one shuffle of per-key subtotals: the counts
    are summed per key before the shuffle, and the surplus rows per key are the duplicates.
    Without the duplicates no key is needed and nothing is shuffled but one row per task;
    a code that no column of the table can have counts 0 without reading it.
    """
    key = fn.trimmed_key(F.col(spec.key))
    tests = {
        **row_tests(prepared, spec),
        "NULL_REQUIRED": [~F.coalesce(is_present(key), F.lit(False))],
    }
    zero = F.lit(0).cast("bigint")
    counts = {code: F.sum(count_hits(tests[code])) for code in codes if tests.get(code)}
    if "DUPLICATE_DEDUPED" in codes:
        per_key = prepared.groupBy(key.alias("_key")).agg(
            F.count(F.lit(1)).alias("rows"), *[count.alias(code) for code, count in counts.items()]
        )
        prepared, counts = per_key, {code: F.sum(code) for code in counts}
        counts["DUPLICATE_DEDUPED"] = F.sum(F.when(is_present(F.col("_key")), F.col("rows") - 1))
    if not counts:
        return prepared.sparkSession.range(1).select(*[zero.alias(code) for code in codes])
    return prepared.agg(
        *[F.coalesce(counts.get(code, zero), F.lit(0)).cast("bigint").alias(code) for code in codes]
    )


def as_code_rows(counts: DataFrame) -> DataFrame:
    """One row per issue code from a one-row table with a column per code."""
    return counts.unpivot([], counts.columns, "issue_code", "record_count")


def issue_summary(counts: DataFrame, compute: bool = True) -> DataFrame:
    """The six codes in fixed order with count, handling and the total.

    ``counts`` has ``issue_code`` and ``record_count``; several rows per code are
    added up, unknown codes are ignored, absent codes count 0. With ``compute``
    off only orphans keep their count and the other codes report 0.
    """
    spark = counts.sparkSession
    codes = spark.createDataFrame(
        [(i, code, action) for i, (code, action) in enumerate(ISSUE_HANDLING.items(), 1)],
        "issue_order int, issue_code string, handling_action string",
    )
    if not compute:
        counts = counts.where(F.col("issue_code") == "ORPHANED_ACCOUNT")
    summed = counts.groupBy("issue_code").agg(F.sum("record_count").alias("record_count"))
    rows = codes.join(summed, "issue_code", "left").withColumn(
        "record_count", F.coalesce("record_count", F.lit(0)).cast("bigint")
    )
    # A window over exactly six rows.
    total = F.sum("record_count").over(Window.partitionBy()).cast("bigint")
    return rows.select(
        "issue_order",
        "issue_code",
        "record_count",
        "handling_action",
        total.alias("total_flagged_records"),
    ).orderBy("issue_order")
