"""Runs the layers one after another; each is written before the next reads it.

A layer that is on disk is never computed twice, and losing executors costs at
most the stage that is running.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date, datetime
from functools import partial, reduce
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverline.fixed_values import SOURCE_LABELS
from silverline.functions.keys import trimmed_key
from silverline.operators.counts import figure_columns
from silverline.operators.joins import hot_keys
from silverline.operators.keyring import key_faults, resolve_collisions
from silverline.operators.shape import add_load_metadata
from silverline.plans import gold, quarantine, reports
from silverline.plans.issues import as_code_rows, issue_summary, table_issue_counts
from silverline.plans.silver import build, prepare
from silverline.plans.validation import CHECKED, domain_values, failure_messages, findings, validation_report
from silverline.sources import (
    json_fields,
    open_tables,
    read_csv_text,
    read_json_lines,
    read_json_records,
    read_table,
    write_json,
    write_table,
)
from silverline.spec import SPECS, raw_names


T = TypeVar("T")


def side_by_side(spark: SparkSession, steps: Sequence[Callable[[], T]]) -> list[T]:
    """The results of steps that do not need each other, run at the same time; the longest should come first.

    The last tasks of a job leave most cores idle, and so does a small table: meanwhile the other jobs go on.
    All steps have ended when the first error, if any, is raised.
    """
    with ThreadPoolExecutor(max(1, len(steps))) as pool:
        return [done.result() for done in [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]]


@dataclass(frozen=True)
class Layout:
    """Where the layers live: one folder per table below ``root``."""

    root: str

    def table(self, name: str) -> str:
        layer, _, table = name.partition("_")
        return f"{self.root.rstrip('/')}/{layer}/{table}"

    def hot(self, key: str) -> str:
        """Where the hot values of a join key are kept."""
        return f"{self.root.rstrip('/')}/hot/{key}"

    def figures(self, name: str) -> str:
        """Where the figures are that were observed when a table was written."""
        return f"{self.root.rstrip('/')}/figures/{name}"

    def keys(self, key: str) -> str:
        """Where the ids are listed that have another key than their hash."""
        return f"{self.root.rstrip('/')}/keys/{key}"

    def quarantine(self, name: str) -> str:
        """Where the records are kept that a table did not take, or took with a value missing."""
        return f"{self.root.rstrip('/')}/quarantine/{name}"

    def report(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/reports/{name}"

    def paths(self) -> dict[str, str]:
        return {name: self.table(name) for name in CHECKED}


def read_sources(
    spark: SparkSession,
    customers: str,
    accounts: str,
    transactions: str,
    transaction_schema: str | None = None,
    keep_malformed: bool = False,
    one_pass: bool = False,
) -> dict[str, DataFrame]:
    """The three raw inputs: two CSV files (or folders, whose files may differ in their headers) and one of JSON lines.

    With ``keep_malformed``, lines that do not fit their header or are no JSON come along as they are. With ``one_pass``
    transactions are scanned once: the columns that silver knows, under any of their names, and the line itself.
    """
    corrupt = quarantine.CORRUPT if keep_malformed else None
    if one_pass:
        records = read_json_records(spark, transactions)
        if keep_malformed:
            records = records.withColumn(corrupt, F.when(F.col("record").isNull(), F.col("line")))
        keep = ["line", corrupt] if keep_malformed else ["line"]
        found = json_fields(records, raw_names(SPECS["transactions"]), keep)
    else:
        found = read_json_lines(spark, transactions, transaction_schema, corrupt)
    return {
        "customers": read_csv_text(spark, customers, SPECS["customers"].aliases, corrupt),
        "accounts": read_csv_text(spark, accounts, SPECS["accounts"].aliases, corrupt),
        "transactions": found,
    }


def write_layer(df: DataFrame, layout: Layout, name: str, partition_by: Sequence[str] = ()) -> None:
    """Write a table of a layer and, beside it, what the validation wants to know of its rows."""
    checked = CHECKED[name]
    columns = figure_columns(df, checked.not_null, checked.amount)
    observed = write_table(df, layout.table(name), partition_by=partition_by, figures=columns)
    schema = ", ".join(f"{c} {'double' if c.startswith('amount_') else 'long'}" for c in columns)
    row = df.sparkSession.createDataFrame([tuple(observed[c] for c in columns)], schema)
    write_table(row.coalesce(1), layout.figures(name))


def table_figures(spark: SparkSession, layout: Layout) -> dict[str, DataFrame | None]:
    """The observed figures of each table, ``None`` where none were written."""
    return open_tables(spark, {name: layout.figures(name) for name in CHECKED})


# The order in which tables are begun.
LARGEST_FIRST = ("transactions", "accounts", "customers")


def load_bronze(sources: Mapping[str, DataFrame], layout: Layout, ingested_at: datetime | None = None) -> None:
    def load(name: str) -> None:
        loaded = add_load_metadata(sources[name], SOURCE_LABELS[name], ingested_at)
        write_layer(loaded, layout, f"bronze_{name}")

    steps = [partial(load, name) for name in sorted(sources, key=LARGEST_FIRST.index)]
    if steps:
        side_by_side(next(iter(sources.values())).sparkSession, steps)


def load_silver(spark: SparkSession, layout: Layout, flag_issues: bool = False) -> None:
    def load(name: str) -> None:
        bronze = read_table(spark, layout.table(f"bronze_{name}"))
        write_layer(build(bronze, SPECS[name], flag_issues), layout, f"silver_{name}")

    side_by_side(spark, [partial(load, name) for name in LARGEST_FIRST])


def _hot(spark: SparkSession, layout: Layout, name: str) -> DataFrame | None:
    """The hot keys that :func:`load_gold` has written, if it has."""
    return open_tables(spark, {name: layout.hot(name)})[name]


# The gold table, id and surrogate key of each silver table.
KEYED = {
    "customers": ("gold_dim_customers", "customer_id", "customer_sk"),
    "accounts": ("gold_dim_accounts", "account_id", "account_sk"),
    "transactions": ("gold_fact_transactions", "transaction_id", "transaction_sk"),
}


def resolve_keys(spark: SparkSession, layout: Layout) -> dict[str, DataFrame | None]:
    """The ids of each silver table that cannot have their hash as key; the lists are written for the next run.

    Keys of the gold tables that are there from an earlier run stay as they are.
    """
    def resolve(name: str) -> tuple[str, DataFrame | None]:
        gold_table, key, sk = KEYED[name]
        ids = read_table(spark, layout.table(f"silver_{name}"))
        earlier, used = open_tables(spark, {"list": layout.keys(key), "gold": layout.table(gold_table)}).values()
        owners = None if used is None else used.select(key, F.col(sk).alias("sk"))
        listed = resolve_collisions(ids, key, earlier, owners)
        if listed is not None:
            write_table(listed, layout.keys(key))
        return key, listed

    return dict(side_by_side(spark, [partial(resolve, name) for name in LARGEST_FIRST]))


def load_gold(
    spark: SparkSession,
    layout: Layout,
    as_of: date | None = None,
    partition_by: Sequence[str] = (),
    unique_keys: bool = True,
) -> None:
    """Dimensions and fact; ``partition_by`` lays the fact out by the values of some columns.

    Hot keys are counted once and written, for these joins and for the reports. With ``unique_keys`` ids
    of equal hash are found first (one shuffle of hashes per table) and get different keys.
    """
    silver = {name: read_table(spark, layout.table(f"silver_{name}")) for name in SPECS}

    def list_hot(name: str, key: str) -> None:
        write_table(hot_keys(silver[name], key), layout.hot(key))

    keys, *_ = side_by_side(
        spark,
        [
            partial(resolve_keys, spark, layout) if unique_keys else dict,
            partial(list_hot, "transactions", "account_id"),
            partial(list_hot, "accounts", "customer_id"),
        ],
    )
    hot_customers, hot_accounts = (read_table(spark, layout.hot(key)) for key in ("customer_id", "account_id"))

    write_layer(gold.dim_customers(silver["customers"], as_of, keys), layout, "gold_dim_customers")
    customers = read_table(spark, layout.table("gold_dim_customers"))
    write_layer(gold.dim_accounts(silver["accounts"], customers, hot_customers, keys), layout, "gold_dim_accounts")
    accounts = read_table(spark, layout.table("gold_dim_accounts"))
    fact = gold.fact_transactions(silver["transactions"], accounts, hot_accounts=hot_accounts, keys=keys)
    write_layer(fact, layout, "gold_fact_transactions", partition_by)


# The gold table that the rows of a silver table become, the column that names the parent, its table and the code.
PARENTS = {
    "accounts": ("gold_dim_accounts", "customer_id", "gold_dim_customers", quarantine.UNLINKED),
    "transactions": ("gold_fact_transactions", "account_id", "gold_dim_accounts", "ORPHANED_ACCOUNT"),
}


def write_quarantine(spark: SparkSession, layout: Layout) -> None:
    """Keep the records that silver and gold did not take, and those with values that could not be read.

    ``quarantine/silver_...`` and ``quarantine/gold_...`` hold rejected records, ``quarantine/reported_...`` the
    others; ``reports/quarantine_balance`` says for each step that what was kept and what was rejected is all that came.
    """
    steps = {}
    for name, spec in SPECS.items():
        bronze, kept = (read_table(spark, layout.table(f"{layer}_{name}")) for layer in ("bronze", "silver"))
        hot = hot_keys(prepare(bronze, spec).select(trimmed_key(F.col(spec.key)).alias("record_key")), "record_key")
        parts = {
            f"silver_{name}": quarantine.silver_rejects(bronze, spec, hot),
            f"reported_{name}": quarantine.reported_records(bronze, spec),
        }
        tables = {f"silver_{name}": (bronze, kept)}
        if name in PARENTS:
            gold_table, key, parents, code = PARENTS[name]
            parents = read_table(spark, layout.table(parents))
            parts[gold_table] = quarantine.gold_rejects(kept, parents, spec, key, code, _hot(spark, layout, key))
            tables[gold_table] = (kept, read_table(spark, layout.table(gold_table)))
        for part, rows in parts.items():
            write_table(rows, layout.quarantine(part))
        steps |= {
            step: (came, taken, read_table(spark, layout.quarantine(step))) for step, (came, taken) in tables.items()
        }
    write_json(quarantine.balance(steps), layout.report("quarantine_balance"))


def issue_counts(spark: SparkSession, layout: Layout) -> DataFrame:
    """Issue counts of the written layers, one row per table and code."""
    bronze = [
        as_code_rows(table_issue_counts(prepare(read_table(spark, layout.table(f"bronze_{name}")), spec), spec))
        for name, spec in SPECS.items()
    ]
    orphans = gold.orphaned_transactions(
        read_table(spark, layout.table("silver_transactions")),
        read_table(spark, layout.table("gold_dim_accounts")),
    ).select(F.lit("ORPHANED_ACCOUNT").alias("issue_code"), F.col("orphan_count").alias("record_count"))
    return reduce(DataFrame.unionByName, [*bronze, orphans])


def write_issue_summary(spark: SparkSession, layout: Layout, compute: bool = True) -> None:
    write_json(issue_summary(issue_counts(spark, layout), compute), layout.report("dq_summary"))


def validate(spark: SparkSession, layout: Layout) -> DataFrame:
    """Check rows over whatever tables exist below the layout's root."""
    hot, figures = _hot(spark, layout, "customer_id"), table_figures(spark, layout)
    return validation_report(open_tables(spark, layout.paths()), hot, figures=figures)


def write_validation(spark: SparkSession, layout: Layout) -> None:
    """Write the check rows, what is wrong in them, the two grouped reports and the samples as JSON.

    ``key_faults`` tells repeated rows of a key from different ids that share one; ``findings`` has a row for each missing or unexpected value of a domain, ``messages``
    one for each failed check.
    """
    tables = open_tables(spark, layout.paths())
    hot = _hot(spark, layout, "customer_id")
    domains = domain_values(tables, hot)
    for name, values in domains.items():
        write_json(values, layout.report(f"domain_{name}"))
    # The checks count the written values, so that each domain is computed once.
    written = {
        name: spark.read.schema(values.schema).json(layout.report(f"domain_{name}")) for name, values in domains.items()
    }
    report = validation_report(tables, hot, written, table_figures(spark, layout))
    write_json(report, layout.report("validation"))
    if written:
        write_json(reduce(DataFrame.unionByName, map(findings, written.values())), layout.report("findings"))
    checked = spark.read.schema(report.schema).json(layout.report("validation"))
    write_json(failure_messages(checked), layout.report("messages"))
    faults = [
        key_faults(tables[name], key, sk).select(F.lit(name).alias("table_name"), "repeated", "collided")
        for name, key, sk in KEYED.values()
        if tables[name] is not None
    ]
    if faults:
        write_json(reduce(DataFrame.unionByName, faults), layout.report("key_faults"))
    fact, accounts, customers = (
        tables[f"gold_{name}"] for name in ("fact_transactions", "dim_accounts", "dim_customers")
    )
    samples = {"account_id": accounts, "customer_id": customers, "transaction_id": fact}
    for key, table in samples.items():
        if table is not None:
            write_json(reports.sample_records(table, key), layout.report(f"sample_by_{key}"))
    if fact is not None:
        write_json(reports.volume_by_type(fact), layout.report("volume_by_type"))
    if accounts is not None and customers is not None:
        write_json(reports.province_distribution(accounts, customers, hot), layout.report("province_distribution"))


# The stages in their order.
STAGES = ("bronze", "silver", "gold", "quarantine", "quality", "validate")


def run(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    layout: Layout,
    ingested_at: datetime | None = None,
    as_of: date | None = None,
    flag_issues: bool = False,
    partition_by: Sequence[str] = (),
    compute_issues: bool = True,
    stages: Sequence[str] = STAGES,
) -> None:
    """Raw inputs to gold, then rejected records, the data-quality summary and the validation report.

    ``stages`` picks some of them; each reads what earlier ones have written. ``sources`` are
    needed by bronze only.
    """
    steps = {
        "bronze": lambda: load_bronze(sources, layout, ingested_at),
        "silver": lambda: load_silver(spark, layout, flag_issues),
        "gold": lambda: load_gold(spark, layout, as_of, partition_by),
        "quarantine": lambda: write_quarantine(spark, layout),
        "quality": lambda: write_issue_summary(spark, layout, compute_issues),
        "validate": lambda: write_validation(spark, layout),
    }
    for stage in STAGES:
        if stage in stages:
            steps[stage]()
