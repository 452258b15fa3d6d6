"""Silver tables: renamed, typed, standardised, one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverline.operators.dedupe import latest_per_key
from silverline.operators.shape import normalise_columns, rename_aliases, require_columns
from silverline.plans.issues import row_issue
from silverline.spec import ACCOUNTS, CUSTOMERS, TRANSACTIONS, TableSpec


def prepare(raw: DataFrame, spec: TableSpec) -> DataFrame:
    """Raw values under the names the spec uses."""
    named = rename_aliases(normalise_columns(raw), spec.aliases)
    return require_columns(named, spec.required, spec.name)


def clean(
    prepared: DataFrame, spec: TableSpec, flag_issues: bool = False, carry: Sequence[str] = ()
) -> DataFrame:
    """All silver columns, before deduplication, and those of ``carry`` as they are.

    Columns that follow from other silver columns come in a second projection,
    so that what they follow from (the event time) is parsed only once.
    """
    columns = {f.name: f.expression(prepared) for f in spec.fields if f.after is None}
    if flag_issues and "dq_flag" in columns:
        columns["dq_flag"] = row_issue(prepared, spec).alias("dq_flag")
    cleaned = prepared.select(*columns.values(), *carry)
    if len(columns) == len(spec.fields):
        return cleaned
    return cleaned.select(
        *[F.col(f.name) if f.after is None else f.expression(cleaned) for f in spec.fields], *carry
    )


def tie_breakers(spec: TableSpec) -> list[str]:
    """The columns that settle which of equally new records is kept: those that do not follow from others."""
    return [f.name for f in spec.fields if f.after is None and f.name not in (spec.key, *spec.newest_first)]


def build(raw: DataFrame, spec: TableSpec, flag_issues: bool = False) -> DataFrame:
    """Silver table of ``spec`` from raw or bronze records."""
    cleaned = clean(prepare(raw, spec), spec, flag_issues)
    return latest_per_key(cleaned, spec.key, spec.newest_first, tie_breakers(spec))


def silver_customers(raw: DataFrame) -> DataFrame:
    return build(raw, CUSTOMERS)


def silver_accounts(raw: DataFrame) -> DataFrame:
    return build(raw, ACCOUNTS)


def silver_transactions(raw: DataFrame, flag_issues: bool = False) -> DataFrame:
    """Silver transactions; ``dq_flag`` stays NULL unless ``flag_issues`` is set."""
    return build(raw, TRANSACTIONS, flag_issues)
