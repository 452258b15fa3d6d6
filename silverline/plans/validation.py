"""Validation of the nine layer tables as a DataFrame of check rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from silverline.fixed_values import LINK_CHECKS, PROVINCES, RECONCILED, TRANSACTION_TYPES, UNLINKED_CHECK
from silverline.operators.counts import MISSING_COLUMN, duplicate_groups, table_profile
from silverline.operators.joins import unmatched_counts, unmatched_keys
from silverline.plans.reports import located_accounts


@dataclass(frozen=True)
class Checked:
    """What is checked on one table: a unique key, NULL-free columns, an amount."""

    key: str | None = None
    not_null: Sequence[str] = ()
    amount: str | None = None


CHECKED = {
    "bronze_accounts": Checked(),
    "bronze_customers": Checked(),
    "bronze_transactions": Checked(),
    "silver_accounts": Checked("account_id", ("account_id",)),
    "silver_customers": Checked("customer_id", ("customer_id",)),
    "silver_transactions": Checked("transaction_id", ("transaction_id", "account_id")),
    "gold_dim_accounts": Checked("account_sk", ("account_sk",)),
    "gold_dim_customers": Checked("customer_sk", ("customer_sk",)),
    "gold_fact_transactions": Checked(
        "transaction_sk", ("transaction_sk", "account_sk", "customer_sk"), "amount"
    ),
}

# Groups whose value decides the status, with the values that are healthy.
HEALTHY = {
    "missing_tables": (0,),
    "duplicates": (0, MISSING_COLUMN),
    "null_critical_keys": (0, MISSING_COLUMN),
    "referential_integrity": (0,),
    "unlinked_accounts": (0,),
    "domains": (0,),
}

Tables = Mapping[str, DataFrame | None]


# A check row before it is judged: group, name and the SQL of its value.
Row = tuple[str, str, str]


def _rows(df: DataFrame, rows: Sequence[Row]) -> DataFrame:
    """Turn a one-row table of figures into check rows."""
    structs = [
        F.struct(
            F.lit(group).alias("check_group"), F.lit(name).alias("check_name"), F.expr(f"double({value})").alias("value")
        )
        for group, name, value in rows
    ]
    return df.select(F.inline(F.array(*structs)))


def _profile_rows(name: str, tables: Tables, observed: DataFrame | None = None) -> DataFrame:
    """The check rows of one table, from figures of its write (then only its key is read) or from a scan."""
    checked = CHECKED[name]
    if observed is None:
        profile = table_profile(tables[name], checked.key, checked.not_null, checked.amount)
    elif checked.key is None:
        profile = observed
    else:
        profile = observed.withColumn("duplicates", duplicate_groups(tables[name], [checked.key]).scalar())
    rows = [("row_counts", name, "rows")]
    if checked.key is not None:
        rows.append(("duplicates", f"{name}_duplicate_{checked.key}", "duplicates"))
    rows += [("null_critical_keys", f"{name}_null_{c}", f"nulls_{c}") for c in checked.not_null]
    if "amount_total" in profile.columns:
        rows.append(("amount_summary", "transaction_count", "rows"))
        rows += [
            ("amount_summary", f"{figure}_amount", f"amount_{figure}")
            for figure in ("total", "average", "minimum", "maximum")
        ]
    # Each side of a difference contributes its part; the parts are added below.
    for label, (minuend, subtrahend) in RECONCILED.items():
        if tables.get(minuend) is not None and tables.get(subtrahend) is not None:
            if name == minuend:
                rows.append(("reconciliation", label, "rows"))
            elif name == subtrahend:
                rows.append(("reconciliation", label, "-rows"))
    return _rows(profile, rows)


def row_counts(tables: Tables) -> DataFrame:
    """Rows of every table."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
        if df is not None
    ]
    return reduce(DataFrame.unionByName, counted)


def reconciliation(counts: DataFrame) -> DataFrame:
    """Differences of layer row counts, from the rows of :func:`row_counts`."""
    sides = [
        F.struct(F.lit(label).alias("delta_name"), F.lit(table).alias("side"), F.lit(sign).alias("sign"))
        for label, pair in RECONCILED.items()
        for table, sign in zip(pair, (1, -1), strict=True)
    ]
    parts = counts.select("row_count", "table_name", F.inline(F.array(*sides))).where(
        F.col("side") == F.col("table_name")
    )
    return parts.groupBy("delta_name").agg(
        F.sum(F.col("row_count") * F.col("sign")).cast("bigint").alias("delta")
    )


def foreign_key_gaps(child: DataFrame, parent: DataFrame, key: str, ignore_null: bool = False) -> DataFrame:
    """One row: how many distinct keys of ``child`` do not exist in ``parent``."""
    return unmatched_keys(child, parent, key, ignore_null).agg(
        F.count(F.lit(1)).alias("orphan_keys")
    )


def domain_check(values: DataFrame, column: str, expected: Sequence[str], domain: str) -> DataFrame:
    """Compare the set of values with the expected set, NULL being a value.

    One row per value with ``verdict`` ok, missing (expected only) or unexpected.
    Values are reduced to distinct ones before the shuffle; no join is needed.
    """
    spark: SparkSession = values.sparkSession
    wanted = spark.createDataFrame([(name, True, False) for name in expected], "value string, e boolean, a boolean")
    found = values.select(
        F.col(column).cast("string").alias("value"), F.lit(False).alias("e"), F.lit(True).alias("a")
    )
    sides = wanted.unionByName(found).groupBy("value").agg(
        F.bool_or("e").alias("in_expected"), F.bool_or("a").alias("in_actual")
    )
    verdict = (
        F.when(F.col("in_expected") & F.col("in_actual"), "ok")
        .when(F.col("in_expected"), "missing")
        .otherwise("unexpected")
    )
    return sides.select(
        F.lit(domain).alias("domain"), "value", "in_expected", "in_actual", verdict.alias("verdict")
    )


def type_domain(fact: DataFrame) -> DataFrame:
    return domain_check(fact, "transaction_type", sorted(TRANSACTION_TYPES), "transaction_type")


def province_domain(accounts: DataFrame, customers: DataFrame, hot_customers: DataFrame | None = None) -> DataFrame:
    """Provinces in which accounts are held, against the expected provinces."""
    held = located_accounts(accounts, customers, hot_customers)
    return domain_check(held, "province", sorted(PROVINCES), "province")


def domain_values(tables: Tables, hot_customers: DataFrame | None = None) -> dict[str, DataFrame]:
    """The compared values of each domain, where the tables it needs are present."""
    fact = tables.get("gold_fact_transactions")
    accounts = tables.get("gold_dim_accounts")
    customers = tables.get("gold_dim_customers")
    domains = {}
    if fact is not None:
        domains["transaction_type"] = type_domain(fact)
    if accounts is not None and customers is not None:
        domains["province"] = province_domain(accounts, customers, hot_customers)
    return domains


def findings(values: DataFrame) -> DataFrame:
    """What is wrong in compared values: a row with a message for each missing or unexpected one."""
    value = F.coalesce("value", F.lit("NULL"))
    message = F.concat("domain", F.lit(": "), "verdict", F.lit(" value '"), value, F.lit("'"))
    return values.where(F.col("verdict") != "ok").select("domain", "value", "verdict", message.alias("message"))


def failure_messages(report: DataFrame) -> DataFrame:
    """A message for each check of a report that did not pass."""
    message = F.concat(
        "check_group", F.lit(": "), "check_name", F.lit(" is "), F.col("value").cast("bigint").cast("string")
    )
    return report.where(~F.col("passed")).select("check_group", "check_name", "value", message.alias("message"))


def _cross_table_rows(tables: Tables, domains: Mapping[str, DataFrame]) -> list[DataFrame]:
    """Checks that need two tables; those with a missing table are left out."""
    fact = tables.get("gold_fact_transactions")
    accounts = tables.get("gold_dim_accounts")
    customers = tables.get("gold_dim_customers")
    account_link, customer_link, owner_link = LINK_CHECKS
    links = (
        (account_link, fact, accounts, "account_sk"),
        (customer_link, fact, customers, "customer_sk"),
    )
    checks = [
        _rows(foreign_key_gaps(child, parent, key), [("referential_integrity", name, "orphan_keys")])
        for name, child, parent, key in links
        if child is not None and parent is not None
    ]
    if accounts is not None and customers is not None:
        # Rows and distinct ids without a customer come from one join.
        gaps = unmatched_counts(accounts, customers, "customer_id")
        checks.append(
            _rows(gaps, [("referential_integrity", owner_link, "keys"), ("unlinked_accounts", UNLINKED_CHECK, "rows")])
        )
    for domain, verdicts in domains.items():
        kinds = ("missing", "unexpected")
        wrong = verdicts.agg(*[F.count_if(F.col("verdict") == kind).alias(kind) for kind in kinds])
        checks.append(_rows(wrong, [("domains", f"{domain}_{kind}_values", kind) for kind in kinds]))
    return checks


def validation_report(
    tables: Tables,
    hot_customers: DataFrame | None = None,
    domains: Mapping[str, DataFrame] | None = None,
    figures: Mapping[str, DataFrame | None] | None = None,
) -> DataFrame:
    """All checks as rows, each with the status of the whole report.

    A table that is ``None`` is missing: it gives a failed row, the checks that
    need it are left out and the status is FAIL. Otherwise the status is WARN if
    any deciding check failed, else PASS. ``passed`` is NULL for figures that
    decide nothing.

    Each table is scanned once for all its own checks, or, where ``figures`` has the one row of figures
    observed when it was written, only its key is, for duplicates. The number of report rows
    is fixed by the list of checks and does not grow with the data, which is why
    a window over all of them is safe.
    """
    present = [name for name in CHECKED if tables.get(name) is not None]
    spark = next((df.sparkSession for df in tables.values() if df is not None), None) or SparkSession.active()
    existence = spark.createDataFrame(
        [("missing_tables", name, 0.0 if name in present else 1.0) for name in CHECKED],
        "check_group string, check_name string, value double",
    )
    branches = [existence, *[_profile_rows(name, tables, (figures or {}).get(name)) for name in present]]
    branches += _cross_table_rows(tables, domain_values(tables, hot_customers) if domains is None else domains)
    parts = reduce(DataFrame.unionByName, branches)
    checks = parts.groupBy("check_group", "check_name").agg(F.sum("value").alias("value"))

    passed = F.coalesce(
        *[
            F.when(F.col("check_group") == group, F.col("value").isin(*[float(v) for v in healthy]))
            for group, healthy in HEALTHY.items()
        ]
    )
    judged = checks.withColumn("passed", passed)
    whole = Window.partitionBy()
    failed = ~F.col("passed")
    status = (
        F.when(F.max(failed & (F.col("check_group") == "missing_tables")).over(whole), "FAIL")
        .when(F.max(failed).over(whole), "WARN")
        .otherwise("PASS")
    )
    return judged.withColumn("report_status", status).orderBy("check_group", "check_name")
