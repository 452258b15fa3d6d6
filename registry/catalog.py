"""One entry per operator: a plan over the given tables.

Results are rendered for comparison by :func:`portable`: dates and timestamps as
ISO text, decimals as doubles, because two engines hand these types to Python
differently. The library itself returns the native types.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registry import lens
from silverline import functions as fn
from silverline.fixed_values import RECONCILED
from silverline.operators.counts import amount_summary, duplicate_groups, null_counts, table_profile
from silverline.operators.dedupe import distinct_values, latest_per_key, one_per_key, present_keys
from silverline.operators.joins import hot_keys, lookup_join
from silverline.operators.keyring import add_key, key_faults, resolve_collisions
from silverline.operators.shape import (
    add_load_metadata,
    conform,
    distinct_columns,
    nested_text,
    normalise_columns,
    rename_aliases,
)
from silverline.plans import gold, issues, layers, quarantine, reports, silver, validation
from silverline.sources import (
    join_by_key,
    json_fields,
    materialised,
    open_by_key,
    read_csv_text,
    read_json_lines,
    read_json_records,
    read_table,
    scratch_folder,
    write_by_key,
    write_json,
    write_table,
)
from silverline.spec import ACCOUNTS, CUSTOMERS, SPECS, TRANSACTIONS

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def portable(df: DataFrame) -> DataFrame:
    def render(field: T.StructField) -> str:
        if isinstance(field.dataType, T.DecimalType):
            return f"double({field.name}) as {field.name}"
        if isinstance(field.dataType, T.DateType | T.TimestampType | T.TimestampNTZType):
            return f"string({field.name}) as {field.name}"
        return field.name

    return df.selectExpr(*[render(f) for f in df.schema.fields])


def registered(name: str) -> Callable[[Query], Query]:
    def register(query: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return portable(query(spark, sf_dir))

        QUERIES[name] = run
        return query

    return register


# --- inputs shared by several queries ---------------------------------------


class Layered:
    """The layers over the given tables; only what a query asks for is planned."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._at = (spark, sf_dir)

    @cached_property
    def raw_customers(self) -> DataFrame:
        return add_load_metadata(lens.raw_customers(*self._at), "customers_csv", lens.INGESTED_AT)

    @cached_property
    def raw_accounts(self) -> DataFrame:
        return add_load_metadata(lens.raw_accounts(*self._at), "accounts_csv", lens.INGESTED_AT)

    @cached_property
    def raw_transactions(self) -> DataFrame:
        return add_load_metadata(lens.raw_transactions(*self._at), "transactions_jsonl", lens.INGESTED_AT)

    @cached_property
    def hot_accounts(self) -> DataFrame:
        return hot_keys(self.raw_transactions.selectExpr("trim(account_id) as account_id"), "account_id")

    @cached_property
    def hot_customers(self) -> DataFrame:
        return hot_keys(self.raw_accounts.selectExpr("trim(customer_ref) as customer_id"), "customer_id")

    @cached_property
    def silver_customers(self) -> DataFrame:
        return silver.silver_customers(self.raw_customers)

    @cached_property
    def silver_accounts(self) -> DataFrame:
        return silver.silver_accounts(self.raw_accounts)

    @cached_property
    def silver_transactions(self) -> DataFrame:
        return silver.silver_transactions(self.raw_transactions)

    @cached_property
    def customers(self) -> DataFrame:
        return gold.dim_customers(self.silver_customers, lens.AS_OF)

    @cached_property
    def accounts(self) -> DataFrame:
        return gold.dim_accounts(self.silver_accounts, self.customers, self.hot_customers)

    @cached_property
    def fact(self) -> DataFrame:
        return gold.fact_transactions(self.silver_transactions, self.accounts, hot_accounts=self.hot_accounts)

    def written(self, *names: str) -> Layered:
        """These tables written once, in the order given, for queries that read them several times."""
        for name in names:
            setattr(self, name, materialised(getattr(self, name), name))
        return self

    def tables(self) -> dict[str, DataFrame]:
        """All nine tables; only those of :meth:`written` are written."""
        return {
            "bronze_accounts": self.raw_accounts,
            "bronze_customers": self.raw_customers,
            "bronze_transactions": self.raw_transactions,
            "silver_accounts": self.silver_accounts,
            "silver_customers": self.silver_customers,
            "silver_transactions": self.silver_transactions,
            "gold_dim_accounts": self.accounts,
            "gold_dim_customers": self.customers,
            "gold_fact_transactions": self.fact,
        }


def rekeyed(df: DataFrame, key: str, sk: str, dangling: str) -> DataFrame:
    """All rows, those that meet the condition under an id that nothing refers to."""
    changed = df.withColumn(key, F.when(F.expr(dangling), F.concat(F.lit("X"), key)).otherwise(F.col(key)))
    return changed.withColumn(sk, fn.surrogate_key(F.col(key)))


def rekeyed_customers(customers: DataFrame) -> DataFrame:
    return rekeyed(customers, "customer_id", "customer_sk", "customer_id like '%0'")


def rekeyed_accounts(accounts: DataFrame) -> DataFrame:
    return rekeyed(accounts, "account_id", "account_sk", "account_status = 'P'")


def without_keys(df: DataFrame) -> DataFrame:
    """Drop hashed keys, which SQL engines do not compute alike."""
    return df.drop(*[name for name in df.columns if name.endswith("_sk")])


def written_layers(spark: SparkSession, sf_dir: str) -> layers.Layout:
    """All three layers written below a new scratch folder."""
    layout = layers.Layout(scratch_folder(spark, "layers"))
    sources = {
        "customers": lens.raw_customers(spark, sf_dir),
        "accounts": lens.raw_accounts(spark, sf_dir),
        "transactions": lens.raw_transactions(spark, sf_dir),
    }
    layers.load_bronze(sources, layout, lens.INGESTED_AT)
    layers.load_silver(spark, layout)
    layers.load_gold(spark, layout, lens.AS_OF)
    return layout


# --- reports -----------------------------------------------------------------


@registered("report_volume_by_type")
def report_volume_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.volume_by_type(Layered(spark, sf_dir).fact)


@registered("report_unlinked_accounts")
def report_unlinked_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = Layered(spark, sf_dir)
    return reports.unlinked_accounts(g.silver_accounts, g.customers)


@registered("report_province_distribution")
def report_province_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = Layered(spark, sf_dir)
    return reports.province_distribution(g.accounts, g.customers, g.hot_customers)


# --- column functions ----------------------------------------------------------


@registered("standardise_txn_type")
def standardise_txn_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = lens.raw_transactions(spark, sf_dir)
    typed = raw.select("transaction_type", fn.transaction_type(F.col("transaction_type")).alias("standard"))
    return typed.groupBy("transaction_type", "standard").agg(F.count(F.lit(1)).alias("n"))


@registered("standardise_province")
def standardise_province(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = lens.raw_customers(spark, sf_dir)
    named = raw.select("province", fn.province(F.col("province")).alias("standard"))
    return named.groupBy("province", "standard").agg(F.count(F.lit(1)).alias("n"))


@registered("standardise_currency")
def standardise_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = lens.raw_transactions(spark, sf_dir)
    coded = raw.select("currency", fn.currency(F.col("currency")).alias("standard"))
    return coded.groupBy("currency", "standard").agg(F.count(F.lit(1)).alias("n"))


@registered("parse_dates")
def parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = lens.raw_transactions(spark, sf_dir)
    parsed = raw.select("transaction_date", fn.flexible_date(F.col("transaction_date")).alias("parsed_date"))
    return parsed.groupBy("transaction_date", "parsed_date").agg(F.count(F.lit(1)).alias("n"))


@registered("combine_date_time")
def combine_date_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = lens.raw_transactions(spark, sf_dir)
    day, time = F.col("transaction_date"), F.col("transaction_time")
    combined = raw.select("transaction_date", "transaction_time", fn.date_and_time(day, time).alias("event_time"))
    return combined.groupBy("transaction_date", "transaction_time", "event_time").agg(
        F.count(F.lit(1)).alias("n")
    )


@registered("resolve_event_time")
def resolve_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records with a timestamp column, with date and time, with a date, with neither."""
    raw = lens.raw_transactions(spark, sf_dir).select("transaction_date", "transaction_time")
    stamped = raw.selectExpr("*", "trim(transaction_date) || coalesce(' ' || transaction_time, '') as timestamp")
    cases = {
        "timestamp": stamped,
        "date_and_time": raw,
        "date_only": raw.drop("transaction_time"),
        "neither": raw.drop("transaction_date"),
    }
    resolved = [
        df.select(F.lit(case).alias("source"), fn.event_time(df.columns).alias("event_time"))
        for case, df in cases.items()
    ]
    return (
        reduce(DataFrame.unionByName, resolved)
        .groupBy("source", F.to_date("event_time").alias("event_date"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("event_time").alias("first_event"),
            F.max("event_time").alias("last_event"),
        )
    )


@registered("tolerant_casts")
def tolerant_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Risk scores as int and balances as decimal, for every account."""
    risk = lens.raw_customers(spark, sf_dir).select(
        F.lit("risk_score").alias("column_name"),
        F.col("risk_score").alias("raw"),
        fn.tolerant_int(F.col("risk_score")).cast("double").alias("value"),
    )
    balance = lens.raw_accounts(spark, sf_dir).select(
        F.lit("current_balance").alias("column_name"),
        F.col("current_balance").alias("raw"),
        fn.tolerant_decimal(F.col("current_balance")).cast("double").alias("value"),
    )
    return risk.unionByName(balance).groupBy("column_name", "raw", "value").agg(F.count(F.lit(1)).alias("n"))


@registered("age_band")
def age_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = lens.raw_customers(spark, sf_dir)
    dated = raw.select("dob", fn.age_band(fn.flexible_date(F.col("dob")), lens.AS_OF).alias("age_band"))
    return dated.groupBy("dob", "age_band").agg(F.count(F.lit(1)).alias("n"))


@registered("surrogate_keys")
def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Properties of the keys: none negative, none NULL, one per distinct id."""
    raw = lens.raw_customers(spark, sf_dir)
    per_id = raw.groupBy(fn.trimmed_key(F.col("customer_id")).alias("id")).agg(F.count(F.lit(1)).alias("rows"))
    keyed = per_id.select("rows", fn.surrogate_key(F.col("id")).alias("sk"))
    per_key = keyed.groupBy("sk").agg(F.sum("rows").alias("rows"))
    return per_key.agg(
        F.sum("rows").cast("bigint").alias("n_rows"),
        F.count("sk").alias("n_keys"),
        F.count_if(F.col("sk").isNull()).alias("n_null"),
        F.count_if(F.col("sk") < 0).alias("n_negative"),
    )


# --- keys and deduplication ------------------------------------------------------


@registered("filter_nonblank_key")
def filter_nonblank_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = present_keys(lens.raw_transactions(spark, sf_dir), "transaction_id")
    return kept.groupBy(fn.trimmed_key(F.col("account_id")).alias("account_id")).agg(F.count(F.lit(1)).alias("n"))


@registered("dedupe_latest")
def dedupe_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = lens.table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line_id"),
        F.col("l_shipdate").cast("timestamp").alias("shipped"),
        "l_partkey",
        "l_suppkey",
        "l_returnflag",
    )
    return latest_per_key(li, "line_id", ["shipped"])


@registered("distinct_keys")
def distinct_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per account with the least of its types, and one per distinct segment."""
    raw = lens.raw_accounts(spark, sf_dir)
    kept = one_per_key(raw.select(fn.trimmed_key(F.col("account_id")).alias("account_id"), "account_type"), "account_id")
    segments = distinct_values(lens.raw_customers(spark, sf_dir), "segment")
    return kept.select(F.lit("account").alias("kind"), "account_id", "account_type").unionByName(
        segments.select(F.lit("segment").alias("kind"), F.col("segment").alias("account_id")),
        allowMissingColumns=True,
    )


# --- shape -----------------------------------------------------------------------


@registered("normalise_columns")
def normalised_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Awkward names, two of which become the same: the first column stays."""
    o = lens.table(spark, sf_dir, "orders")
    awkward = o.toDF(" Order Key", "Cust-Key", "order.status", "Order  Key ", "Order/Date", "Order - . Priority")
    return normalise_columns(awkward)


@registered("alias_rename")
def alias_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = lens.raw_transactions(spark, sf_dir).select("transaction_id", "account_id", "transaction_type", "amount")
    drifted = raw.toDF("txn_id", "account_ref", "type", "txn_amount").withColumn("acct_id", F.col("account_ref"))
    return rename_aliases(drifted, TRANSACTIONS.aliases)


@registered("dedupe_columns")
def dedupe_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = lens.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    return distinct_columns(o.toDF("key", " key ", "status", "status"))


@registered("coerce_schema")
def coerce_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = lens.raw_accounts(spark, sf_dir).select("account_id", "credit_limit", "last_activity_date", "mobile_number")
    return conform(raw, ACCOUNTS.schema)


@registered("nested_extract")
def nested_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = lens.raw_transactions(spark, sf_dir)
    found = raw.select(
        nested_text(raw, "location", "province").alias("location_province"),
        nested_text(raw, "amount", "province").alias("no_struct"),
    )
    return found.groupBy("location_province", "no_struct").agg(F.count(F.lit(1)).alias("n"))


# --- sources and sinks -------------------------------------------------------------


@registered("bronze_metadata")
def bronze_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_load_metadata(lens.raw_accounts(spark, sf_dir), "accounts_csv", lens.INGESTED_AT)


@registered("scan_csv_strings")
def scan_csv_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark, "csv")
    # Quoting everything keeps blanks apart from NULL and leading spaces intact.
    writer = lens.raw_accounts(spark, sf_dir).write.mode("overwrite").option("header", True)
    writer.option("quoteAll", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(folder)
    return read_csv_text(spark, folder)


@registered("scan_csv_drift")
def scan_csv_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers from one folder whose files have three headers: other orders, other names, a late extra column."""
    folder = scratch_folder(spark, "csv-drift")
    raw = lens.raw_customers(spark, sf_dir).select("customer_id", "id_number", "dob", "province", "risk_score")
    third = lambda n: raw.where(f"int(substr(id_number, 3)) % 3 = {n}")
    renamed = third(1).selectExpr(
        "province", "risk_score as `Risk Rating`", "id_number as `ID-Number`", "customer_id as cust_id", "dob as `date.of.birth`"
    )
    late = third(2).selectExpr("dob", "customer_id", "'R' || id_number as referrer", "id_number", "risk_score", "province")
    for part in (third(0), renamed, late):
        writer = part.write.mode("append").option("header", True).option("quoteAll", True)
        writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(folder)
    read = rename_aliases(normalise_columns(read_csv_text(spark, folder, CUSTOMERS.aliases)), CUSTOMERS.aliases)
    return read.select("customer_id", "id_number", "dob", "province", "risk_score", "referrer")


# A packed file is read by one task: lines of a file, about 200 MB unpacked.
LINES_PER_FILE = 500_000


def written_lines(spark: SparkSession, sf_dir: str) -> str:
    """The folder of the raw transactions as packed JSON lines."""
    folder = scratch_folder(spark, "jsonl")
    write_json(lens.raw_transactions(spark, sf_dir), folder, compression="gzip", lines_per_file=LINES_PER_FILE)
    return folder


@registered("scan_jsonl_nested")
def scan_jsonl_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = read_json_lines(spark, written_lines(spark, sf_dir))
    return read.select(
        "transaction_id",
        "account_id",
        "transaction_date",
        "amount",
        "currency",
        F.col("location.province").alias("province"),
        F.col("location.city").alias("city"),
        F.col("metadata.retry_flag").alias("retry_flag"),
    )


@registered("scan_jsonl_one_pass")
def scan_jsonl_one_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records in one scan, without discovering their fields."""
    folder = written_lines(spark, sf_dir)
    plain = ("transaction_id", "account_id", "transaction_date", "amount", "currency")
    nested = {"province": ["location.province"], "city": ["location.city"], "retry_flag": ["metadata.retry_flag"]}
    return json_fields(read_json_records(spark, folder), {n: [n] for n in plain} | nested)


@registered("scan_parquet_counts")
def scan_parquet_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("customer", "orders", "lineitem", "nation", "region", "events")
    return validation.row_counts({name: read_table(spark, f"{sf_dir}/{name}.parquet") for name in names})


@registered("parquet_roundtrip")
def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark, "parquet")
    write_table(Layered(spark, sf_dir).silver_customers, folder)
    return read_table(spark, folder)


@registered("clustered_scans")
def clustered_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions clustered by day and account, read back by either: the last quarter of the days, one range of accounts."""
    folder = scratch_folder(spark, "clustered")
    write_table(Layered(spark, sf_dir).silver_transactions, folder, cluster_by=["transaction_date", "account_id"])
    rows = read_table(spark, folder)
    scans = {
        "all": F.lit(True),
        "days": F.col("transaction_date") >= F.lit("1998-01-01").cast("date"),
        "accounts": F.col("account_id").between("A1", "A2"),
    }
    found = [
        rows.where(condition).agg(
            F.lit(name).alias("scan"),
            F.count(F.lit(1)).alias("n"),
            F.count("transaction_date").alias("n_days"),
            F.sum("amount").alias("total_amount"),
        )
        for name, condition in scans.items()
    ]
    return reduce(DataFrame.unionByName, found)


# --- layers --------------------------------------------------------------------------


@registered("silver_customers")
def silver_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Layered(spark, sf_dir).silver_customers


@registered("silver_accounts")
def silver_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Layered(spark, sf_dir).silver_accounts


@registered("silver_transactions")
def silver_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Layered(spark, sf_dir).silver_transactions


@registered("silver_transactions_flagged")
def silver_transactions_flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = silver.silver_transactions(Layered(spark, sf_dir).raw_transactions, flag_issues=True)
    return flagged.groupBy("dq_flag").agg(F.count(F.lit(1)).alias("n"))


@registered("join_accounts_customers")
def join_accounts_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = Layered(spark, sf_dir)
    customers = g.silver_customers.select("customer_id")
    joined = lookup_join(
        g.silver_accounts, customers, "customer_id", "left_semi", g.hot_customers, spread_by="account_id"
    )
    return joined.select("account_id", "customer_id", "account_status", "current_balance")


@registered("dim_customers")
def dim_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_keys(Layered(spark, sf_dir).customers)


@registered("dim_accounts")
def dim_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_keys(Layered(spark, sf_dir).accounts)


@registered("fact_build")
def fact_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_keys(Layered(spark, sf_dir).fact)


@registered("split_join")
def split_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with the priority of their order, with tasks so small that keys of four rows are split."""
    lines = lens.table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey as k", "l_linenumber", "l_partkey", "l_orderkey || '-' || l_partkey as line"
    )
    lookup = one_per_key(lens.table(spark, sf_dir, "orders").selectExpr("o_orderkey as k", "o_orderpriority"), "k")
    # As many hot keys as there can be keys: every key above the bound is split.
    hot = hot_keys(lines, "k", rows_per_task=3, most=10**9)
    joined = lookup_join(lines, lookup, "k", "inner", hot, spread_by="line")
    counted = joined.join(hot.withColumnRenamed("_parts", "parts"), "k", "left")
    return counted.groupBy("o_orderpriority", F.coalesce("parts", F.lit(1)).alias("parts")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_partkey").alias("sum_partkey"), F.sum("l_linenumber").alias("sum_line")
    )


# Buckets of the registered layouts; what a cluster needs follows from rows per task.
BUCKETS = 16


def laid_out(spark: SparkSession, g: Layered) -> tuple:
    """Transactions and account links laid out by account; keys of more than six rows are kept apart.

    Both are written before, as finding the hot keys and laying out read them six times.
    """
    folder = scratch_folder(spark, "by-account")
    transactions = g.written("silver_transactions").silver_transactions
    hot = hot_keys(transactions, "account_id", rows_per_task=6, most=10**9)
    write_by_key(transactions, f"{folder}/transactions", "account_id", BUCKETS, hot)
    links = materialised(gold.account_links(g.accounts), "links")
    write_by_key(links, f"{folder}/accounts", "account_id", BUCKETS)
    return open_by_key(spark, f"{folder}/transactions"), open_by_key(spark, f"{folder}/accounts")


@registered("fact_by_key")
def fact_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact from two tables of one layout, joined bucket by bucket."""
    transactions, links = laid_out(spark, Layered(spark, sf_dir))
    return without_keys(gold.fact_rows(join_by_key(transactions, links, "inner", "transaction_id")))


@registered("orphans_by_key")
def orphans_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions without an account, by type, from the same layout; hot keys split instead of broadcast."""
    transactions, links = laid_out(spark, Layered(spark, sf_dir))
    orphans = join_by_key(transactions, links, "left_anti", "transaction_id", broadcast_keys=0)
    return orphans.groupBy("transaction_type").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("account_id").alias("n_accounts")
    )


@registered("key_counts")
def key_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct hashed keys of the gold tables: as many as distinct ids."""
    g = Layered(spark, sf_dir)
    keys = {
        "dim_customers": (g.customers, ("customer_sk",)),
        "dim_accounts": (g.accounts, ("account_sk",)),
        "fact_transactions": (g.fact, ("transaction_sk", "account_sk", "customer_sk")),
    }
    counted = [
        distinct_values(df, key).agg(F.count(key).alias("n")).select(
            F.lit(name).alias("table_name"), F.lit(key).alias("key"), "n"
        )
        for name, (df, listed) in keys.items()
        for key in listed
    ]
    return reduce(DataFrame.unionByName, counted)


@registered("resolved_keys")
def resolved_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys from so short a hash that many ids share one: all are distinct, and those of a first load stay in the second."""
    every = lens.raw_accounts(spark, sf_dir).select(fn.trimmed_key(F.col("account_id")).alias("id")).where("id <> ''")
    modulus = 8 * every.distinct().count() + 1009
    first = every.where("length(id) % 2 = 0 or id like '%3'")
    moved = resolve_collisions(first, "id", modulus=modulus)
    known = add_key(first.distinct(), "id", "sk", moved, modulus)
    moved = resolve_collisions(every, "id", moved, known, modulus)
    keyed = add_key(every, "id", "sk", moved, modulus)
    both = keyed.distinct().join(known.withColumnRenamed("sk", "first_sk"), "id", "left")
    counted = both.agg(
        F.countDistinct("id").alias("n_ids"),
        F.countDistinct("sk").alias("n_keys"),
        F.count("first_sk").alias("n_kept"),
        F.count_if(F.col("sk") != F.col("first_sk")).alias("n_changed"),
        F.count_if(F.col("sk").isNull() | (F.col("sk") < 0) | (F.col("sk") >= modulus)).alias("n_out_of_range"),
    )
    faults = key_faults(keyed, "id", "sk")
    return counted.select("*", *[faults.select(name).scalar().alias(name) for name in ("repeated", "collided")])


# --- integrity and counts ----------------------------------------------------------------


@registered("orphaned_transactions")
def orphaned_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = Layered(spark, sf_dir)
    return gold.orphaned_transactions(g.silver_transactions, g.accounts)


@registered("ri_fact_account")
def ri_fact_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = Layered(spark, sf_dir)
    return validation.foreign_key_gaps(g.fact, rekeyed_accounts(g.accounts), "account_sk")


@registered("ri_fact_customer")
def ri_fact_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = Layered(spark, sf_dir)
    return validation.foreign_key_gaps(g.fact, rekeyed_customers(g.customers), "customer_sk")


@registered("ri_account_customer")
def ri_account_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = Layered(spark, sf_dir)
    return validation.foreign_key_gaps(g.silver_accounts, g.customers, "customer_id", ignore_null=True)


@registered("row_counts")
def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.row_counts(Layered(spark, sf_dir).tables())


@registered("null_counts")
def nulls_by_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = lens.raw_accounts(spark, sf_dir)
    columns = ("account_id", "customer_ref", "digital_channel", "last_activity_date", "no_such_column")
    return null_counts(raw, columns)


@registered("duplicate_key_groups")
def duplicate_key_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = lens.raw_transactions(spark, sf_dir)
    checks = {
        "transaction_id": ("transaction_id",),
        "account_and_type": ("account_id", "transaction_type"),
        "missing": ("no_such_column",),
    }
    counted = [
        duplicate_groups(raw, keys).select(F.lit(name).alias("key"), "duplicate_groups")
        for name, keys in checks.items()
    ]
    return reduce(DataFrame.unionByName, counted)


@registered("amount_summary")
def fact_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return amount_summary(Layered(spark, sf_dir).fact)


@registered("table_profile")
def transaction_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, duplicate ids, NULLs and amount figures of the raw transactions in one pass."""
    raw = lens.raw_transactions(spark, sf_dir)
    typed = raw.select("transaction_id", "currency", fn.tolerant_decimal(F.col("amount")).alias("amount"))
    return table_profile(typed, "transaction_id", ("transaction_id", "currency", "absent"), "amount")


@registered("reconciliation")
def reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    compared = {name for pair in RECONCILED.values() for name in pair}
    tables = {n: t for n, t in Layered(spark, sf_dir).tables().items() if n in compared}
    return validation.reconciliation(validation.row_counts(tables))


@registered("domain_check")
def domain_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = Layered(spark, sf_dir)
    return validation.type_domain(g.fact).unionByName(
        validation.province_domain(g.accounts, g.customers, g.hot_customers)
    )


@registered("validation_findings")
def validation_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The values that make the domain checks fail, with a message each."""
    g = Layered(spark, sf_dir)
    tables = {n: t for n, t in g.tables().items() if n.startswith("gold_")}
    domains = validation.domain_values(tables, g.hot_customers)
    return reduce(DataFrame.unionByName, map(validation.findings, domains.values()))


@registered("validation_report")
def validation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers.validate(spark, written_layers(spark, sf_dir))


# --- data quality -----------------------------------------------------------------------


def _issue_counts(g: Layered, codes: Sequence[str] = issues.COUNTED) -> dict[str, DataFrame]:
    """One row of issue counts per table."""
    sources = {"customers": g.raw_customers, "accounts": g.raw_accounts, "transactions": g.raw_transactions}
    return {
        name: issues.table_issue_counts(silver.prepare(sources[name], spec), spec, codes)
        for name, spec in SPECS.items()
    }


def _one_code(code: str) -> Query:
    """Counts of one code."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        counted = [
            counts.select(F.lit(name).alias("table_name"), F.col(code).alias("record_count"))
            for name, counts in _issue_counts(Layered(spark, sf_dir), [code]).items()
        ]
        return reduce(DataFrame.unionByName, counted)

    return query


# Query name and the issue code it counts.
for _name, _code in {
    "dq_duplicates": "DUPLICATE_DEDUPED",
    "dq_type_mismatch": "TYPE_MISMATCH",
    "dq_date_format": "DATE_FORMAT",
    "dq_currency_variant": "CURRENCY_VARIANT",
    "dq_null_required": "NULL_REQUIRED",
}.items():
    registered(_name)(_one_code(_code))


@registered("dq_summary")
def dq_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = Layered(spark, sf_dir)
    orphans = gold.orphaned_transactions(g.silver_transactions, g.accounts).select(
        F.lit("ORPHANED_ACCOUNT").alias("issue_code"), F.col("orphan_count").alias("record_count")
    )
    counts = [issues.as_code_rows(counts) for counts in _issue_counts(g).values()]
    return issues.issue_summary(reduce(DataFrame.unionByName, [*counts, orphans]))


def _rejects(g: Layered) -> dict[str, DataFrame]:
    """Rejected records of every silver table and of the gold tables that have a parent."""
    raw = {"customers": g.raw_customers, "accounts": g.raw_accounts, "transactions": g.raw_transactions}
    found = {f"silver_{name}": quarantine.silver_rejects(raw[name], spec) for name, spec in SPECS.items()}
    found["gold_dim_accounts"] = quarantine.gold_rejects(
        g.silver_accounts, g.customers, ACCOUNTS, "customer_id", quarantine.UNLINKED, g.hot_customers
    )
    found["gold_fact_transactions"] = quarantine.gold_rejects(
        g.silver_transactions, g.accounts, TRANSACTIONS, "account_id", "ORPHANED_ACCOUNT", g.hot_accounts
    )
    return found


@registered("quarantined_records")
def quarantined_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rejected record, by its key: how many, and whether the record holds its key."""
    g = Layered(spark, sf_dir).written("silver_customers", "silver_accounts", "customers")
    rows = reduce(DataFrame.unionByName, _rejects(g).values())
    by = ("table_name", "layer", "issue_code", "handling_action", "record_key")
    names = F.col("record").contains(F.coalesce("record_key", F.lit("null")))
    return rows.groupBy(*by).agg(
        F.sum("copies").alias("n_records"), F.sum(F.when(names, F.col("copies")).otherwise(0)).alias("n_named")
    )


@registered("quarantine_balance")
def quarantine_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept and rejected records are all that came, for each step."""
    g = Layered(spark, sf_dir)
    g.written("silver_customers", "silver_accounts", "silver_transactions", "customers", "accounts")
    tables = g.tables()
    came = {
        **{f"silver_{name}": f"bronze_{name}" for name in SPECS},
        "gold_dim_accounts": "silver_accounts",
        "gold_fact_transactions": "silver_transactions",
    }
    return quarantine.balance({s: (tables[came[s]], tables[s], rows) for s, rows in _rejects(g).items()})


@registered("reported_records")
def reported_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values that could not be read, or were spelt otherwise, counted from the records that are kept of them."""
    g = Layered(spark, sf_dir)
    raw = {"customers": g.raw_customers, "accounts": g.raw_accounts, "transactions": g.raw_transactions}
    rows = [quarantine.reported_records(raw[name], spec) for name, spec in SPECS.items()]
    return reduce(DataFrame.unionByName, rows).groupBy("table_name", "issue_code").agg(F.sum("hits").alias("record_count"))


@registered("sample_records")
def sample_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_keys(reports.sample_records(Layered(spark, sf_dir).fact, "transaction_id"))
