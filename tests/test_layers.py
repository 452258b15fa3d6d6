"""Raw files to gold and reports; silver, gold, issue and validation rules."""

import json
import subprocess
import sys
from collections import Counter
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from silverline import __main__ as command_line
from silverline import sources
from silverline.fixed_values import ISSUE_HANDLING, TRANSACTION_TYPES
from silverline.functions import categories
from silverline.operators import keyring
from silverline.operators.joins import hot_keys
from silverline.plans import gold, issues, layers, reports, silver, validation
from silverline.spec import ACCOUNTS, CUSTOMERS, SPECS, TRANSACTIONS

LOADED = datetime(2024, 6, 1)
AS_OF = date(2024, 6, 30)

CUSTOMERS_CSV = """Customer ID,date-of-birth,Province,risk_rating,first_name,id_number
C1,2000-02-29,gp,5.7,Ann,1
 C2 ,31/12/1950,KWAZULU_NATAL,n/a,Ben,2
C2,1950-12-31,kzn,7,Ben,2
C3,946684800,Elsewhere,3,Cem,3
,2000-01-01,gp,1,Nil,4
"""
ACCOUNTS_CSV = """account_id,customer_ref,open_date,credit_limit,current_balance,account_type
A1,C1,2020-01-01,100.005,"1,000",SAVINGS
A2,C2,01/02/2020,,-5.5,LOAN
A3,C9,bad,1,2,LOAN
A4,,2020-01-01,1,2,LOAN
"""
TRANSACTIONS_JSONL = [
    {"txn_id": "T1", "account_id": "A1", "transaction_date": "2024-01-05", "transaction_time": "10:00:00",
     "transaction_type": "cr", "amount": 12.345, "currency": "R", "location": {"province": "wc"}},
    {"txn_id": " T1", "account_id": "A1", "transaction_date": "2024-01-04", "transaction_time": "10:00:00",
     "transaction_type": "debit", "amount": "1", "currency": "ZAR", "location": {"province": "wc"}},
    {"txn_id": "T2", "account_id": "A2", "transaction_date": "05/01/2024", "transaction_type": "FEES",
     "amount": "junk", "currency": "usd"},
    {"txn_id": "T3", "account_id": "A3", "transaction_date": "soon", "transaction_type": "rev", "amount": 1},
    {"txn_id": "  ", "account_id": "A1", "transaction_date": "2024-01-05", "transaction_type": "dr"},
    {"account_id": "A1", "transaction_type": "dr"},
]


@pytest.fixture(scope="module")
def layout(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("run")
    (root / "customers.csv").write_text(CUSTOMERS_CSV)
    (root / "accounts.csv").write_text(ACCOUNTS_CSV)
    (root / "transactions.jsonl").write_text("\n".join(map(json.dumps, TRANSACTIONS_JSONL)))
    raw = layers.read_sources(
        spark, str(root / "customers.csv"), str(root / "accounts.csv"), str(root / "transactions.jsonl")
    )
    layout = layers.Layout(str(root / "out"))
    layers.run(spark, raw, layout, LOADED, AS_OF, flag_issues=True)
    return layout


def table(spark, layout, name):
    return sources.read_table(spark, layout.table(name))


def json_rows(path):
    return [json.loads(line) for part in sorted(Path(path).glob("part-*")) for line in part.read_text().splitlines()]


def test_bronze_keeps_the_records_as_text(spark, layout):
    bronze = table(spark, layout, "bronze_customers")
    assert bronze.count() == 5
    assert set(bronze.columns) == {
        "Customer ID", "date-of-birth", "Province", "risk_rating", "first_name", "id_number", "source_system",
        "ingestion_timestamp",
    }
    assert {t for n, t in bronze.dtypes if n != "ingestion_timestamp"} == {"string"}
    transactions = table(spark, layout, "bronze_transactions")
    assert "12.345" in {r.amount for r in transactions.select("amount").collect()}
    assert {r.source_system for r in transactions.select("source_system").collect()} == {"transactions_jsonl"}


def test_silver_customers(spark, layout):
    silver_table = table(spark, layout, "silver_customers")
    assert silver_table.schema.names == CUSTOMERS.schema.names
    assert [f.dataType for f in silver_table.schema] == [f.dataType for f in CUSTOMERS.schema]
    found = {r.customer_id: (r.dob, r.province, r.risk_score, r.gender) for r in silver_table.collect()}
    assert found == {
        "C1": (date(2000, 2, 29), "Gauteng", 5, None),
        "C2": (date(1950, 12, 31), "KwaZulu-Natal", None, None),
        "C3": (None, "Elsewhere", 3, None),
    }


def test_silver_transactions(spark, layout):
    silver_table = table(spark, layout, "silver_transactions")
    assert [f.dataType for f in silver_table.schema] == [f.dataType for f in TRANSACTIONS.schema]
    found = {r.transaction_id: r for r in silver_table.collect()}
    assert set(found) == {"T1", "T2", "T3"}
    first = found["T1"]
    assert first.transaction_timestamp == datetime(2024, 1, 5, 10)
    assert (first.amount, first.currency, first.transaction_type) == (Decimal("12.35"), "ZAR", "CREDIT")
    assert (first.location_province, first.transaction_date) == ("Western Cape", date(2024, 1, 5))
    assert found["T2"].transaction_timestamp == datetime(2024, 1, 5)
    assert {k: r.dq_flag for k, r in found.items()} == {
        "T1": "CURRENCY_VARIANT",
        "T2": "TYPE_MISMATCH",
        "T3": "DATE_FORMAT",
    }


def test_gold(spark, layout):
    accounts = table(spark, layout, "gold_dim_accounts")
    assert {r.account_id for r in accounts.collect()} == {"A1", "A2"}
    assert accounts.columns == [
        "account_sk", "account_id", "customer_id", "account_type", "account_status", "open_date",
        "product_tier", "digital_channel", "credit_limit", "current_balance", "last_activity_date",
    ]
    customers = table(spark, layout, "gold_dim_customers")
    assert {r.customer_id: r.age_band for r in customers.collect()} == {"C1": "18-25", "C2": "65+", "C3": None}
    fact = table(spark, layout, "gold_fact_transactions")
    assert fact.columns == [
        "transaction_sk", "transaction_id", "account_sk", "customer_sk", "transaction_date",
        "transaction_timestamp", "transaction_type", "merchant_category", "merchant_subcategory", "amount",
        "currency", "channel", "province", "dq_flag", "ingestion_timestamp",
    ]
    assert {r.transaction_id for r in fact.collect()} == {"T1", "T2"}
    linked = fact.join(accounts, "account_sk").join(customers, "customer_sk")
    assert linked.count() == 2
    # Nothing is lost silently: fact rows and orphans make up silver.
    transactions = table(spark, layout, "silver_transactions")
    orphans = gold.orphaned_transactions(transactions, accounts).first().orphan_count
    assert fact.count() + orphans == transactions.count()


def test_issue_summary_file(layout):
    found = json_rows(layout.report("dq_summary"))
    assert [r["issue_code"] for r in sorted(found, key=lambda r: r["issue_order"])] == list(ISSUE_HANDLING)
    assert {r["issue_code"]: r["record_count"] for r in found} == {
        "ORPHANED_ACCOUNT": 1,
        "DUPLICATE_DEDUPED": 2,
        "TYPE_MISMATCH": 3,
        "DATE_FORMAT": 3,
        "CURRENCY_VARIANT": 1,
        "NULL_REQUIRED": 3,
    }
    assert {r["total_flagged_records"] for r in found} == {13}
    assert {r["issue_code"]: r["handling_action"] for r in found} == ISSUE_HANDLING


def test_validation_files(layout):
    checks = {r["check_name"]: r for r in json_rows(layout.report("validation"))}
    assert {r["report_status"] for r in checks.values()} == {"WARN"}
    assert checks["gold_fact_transactions"]["value"] is not None
    assert checks["silver_transactions_to_gold_fact_delta"]["value"] == 1
    assert checks["bronze_to_silver_transactions_delta"]["value"] == 3
    assert checks["province_missing_values"]["value"] == 7
    assert checks["transaction_type_missing_values"]["value"] == 2
    assert checks["total_amount"]["value"] == 12.35
    assert len(json_rows(layout.report("sample_by_transaction_id"))) == 2
    by_type = {r["transaction_type"]: r for r in json_rows(layout.report("volume_by_type"))}
    assert by_type["FEE"]["pct_of_total"] == 50.0
    assert len(json_rows(layout.report("province_distribution"))) == 2


def test_missing_tables_give_fail_and_not_an_error(spark, layout):
    tables = sources.open_tables(spark, {**layout.paths(), "gold_dim_customers": layout.table("gold_nowhere")})
    assert tables["gold_dim_customers"] is None
    found = validation.validation_report(tables).collect()
    assert {r.report_status for r in found} == {"FAIL"}
    failed = {r.check_name for r in found if r.check_group == "missing_tables" and not r.passed}
    assert failed == {"gold_dim_customers"}
    nothing = validation.validation_report(dict.fromkeys(layout.paths())).collect()
    assert len(nothing) == 9
    assert {(r.passed, r.report_status) for r in nothing} == {(False, "FAIL")}


def gold_tables(spark):
    """Two customers per province, one transaction of each type per account: nothing to complain about."""
    from silverline.fixed_values import PROVINCES, TRANSACTION_TYPES

    names = [(f"C{i}", p) for i, p in enumerate(sorted(PROVINCES) * 2)]
    customers = silver.silver_customers(
        spark.createDataFrame([(c, p, LOADED) for c, p in names], "customer_id string, province string, ingestion_timestamp timestamp")
    )
    accounts = silver.silver_accounts(
        spark.createDataFrame(
            [(f"A{c}", c, LOADED) for c, _ in names], "account_id string, customer_id string, ingestion_timestamp timestamp"
        )
    )
    transactions = silver.silver_transactions(
        spark.createDataFrame(
            [(f"T{c}{t}", f"A{c}", t, LOADED) for c, _ in names for t in TRANSACTION_TYPES],
            "transaction_id string, account_id string, type string, ingestion_timestamp timestamp",
        )
    )
    dim_customers = gold.dim_customers(customers, AS_OF)
    dim_accounts = gold.dim_accounts(accounts, dim_customers)
    fact = gold.fact_transactions(transactions, dim_accounts, dim_customers)
    return {
        "bronze_accounts": accounts,
        "bronze_customers": customers,
        "bronze_transactions": transactions,
        "silver_accounts": accounts,
        "silver_customers": customers,
        "silver_transactions": transactions,
        "gold_dim_accounts": dim_accounts,
        "gold_dim_customers": dim_customers,
        "gold_fact_transactions": fact,
    }


@pytest.fixture(scope="module")
def clean_tables(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("clean")
    for name, df in gold_tables(spark).items():
        sources.write_table(df, f"{root}/{name}")
    return {name: sources.read_table(spark, f"{root}/{name}") for name in validation.CHECKED}


def failed_checks(tables):
    found = validation.validation_report(tables).collect()
    assert len({r.report_status for r in found}) == 1
    return found[0].report_status, {r.check_name for r in found if r.passed is False}


def test_clean_tables_pass(clean_tables):
    assert failed_checks(clean_tables) == ("PASS", set())


def test_each_damage_is_found(clean_tables):
    accounts, customers = clean_tables["gold_dim_accounts"], clean_tables["gold_dim_customers"]
    fact = clean_tables["gold_fact_transactions"]
    fewer = {**clean_tables, "gold_dim_customers": customers.where("customer_id <> 'C3'")}
    assert failed_checks(fewer) == (
        "WARN",
        {"fact_customer_sk_not_in_dim_customers", "dim_account_customer_id_not_in_dim_customers", "unlinked_accounts"},
    )
    doubled = {**clean_tables, "gold_dim_accounts": accounts.unionByName(accounts)}
    assert failed_checks(doubled) == ("WARN", {"gold_dim_accounts_duplicate_account_sk"})
    blanked = {**clean_tables, "gold_fact_transactions": fact.withColumn("account_sk", F.lit(None).cast("bigint"))}
    assert failed_checks(blanked) == (
        "WARN",
        {"gold_fact_transactions_null_account_sk", "fact_account_sk_not_in_dim_accounts"},
    )
    odd = {**clean_tables, "gold_fact_transactions": fact.withColumn("transaction_type", F.lit(None).cast("string"))}
    assert failed_checks(odd) == (
        "WARN",
        {"transaction_type_missing_values", "transaction_type_unexpected_values"},
    )
    # A column that is not there counts -1 and decides nothing.
    absent = {**clean_tables, "silver_customers": clean_tables["silver_customers"].drop("customer_id")}
    assert failed_checks(absent) == ("PASS", set())


def test_domain_check_treats_null_as_a_value(spark):
    values = spark.createDataFrame([("a",), ("a",), (None,), ("x",)], "v string")
    found = {r.value: r.verdict for r in validation.domain_check(values, "v", ["a", "b"], "d").collect()}
    assert found == {"a": "ok", "b": "missing", None: "unexpected", "x": "unexpected"}


def test_required_columns_are_checked_while_planning(spark):
    df = spark.createDataFrame([(1,)], ["amount"])
    for spec in SPECS.values():
        with pytest.raises(ValueError, match=spec.name):
            silver.build(df, spec)


def test_absent_columns_become_typed_nulls_and_currency_its_default(spark):
    raw = spark.createDataFrame([("T1", "A1")], "transaction_id string, account_id string")
    row = silver.silver_transactions(raw).first()
    assert row.currency == "ZAR"
    assert row.asDict() == {
        **dict.fromkeys(TRANSACTIONS.schema.names),
        "transaction_id": "T1",
        "account_id": "A1",
        "currency": "ZAR",
    }


def test_nested_province_wins_and_flat_one_is_kept(spark):
    ddl = "transaction_id string, account_id string, location_province string"
    flat = spark.createDataFrame([("T1", "A1", "gp")], ddl)
    assert silver.silver_transactions(flat).first().location_province == "Gauteng"
    nested = flat.withColumn("location", F.struct(F.lit("wc").alias("province")))
    assert silver.silver_transactions(nested).first().location_province == "Western Cape"
    no_struct = flat.withColumn("location", F.lit("wc"))
    assert silver.silver_transactions(no_struct).first().location_province is None


def test_silver_does_not_depend_on_partitioning(spark):
    raw = spark.range(2000).selectExpr(
        "string(id % 300) as account_id",
        "'C' || (id % 7) as customer_id",
        "string(id % 11) as credit_limit",
        "timestamp'2024-06-01' as ingestion_timestamp",
    )
    results = [Counter(map(tuple, silver.silver_accounts(raw.repartition(n)).collect())) for n in (1, 5, 16)]
    assert results[0] == results[1] == results[2]
    again = silver.silver_accounts(silver.silver_accounts(raw))
    assert Counter(map(tuple, again.collect())) == results[0]


def test_gold_with_hot_keys_equals_gold_without(spark):
    customers = silver.silver_customers(spark.range(20).selectExpr("'C' || id as customer_id"))
    accounts = silver.silver_accounts(
        spark.range(600).selectExpr("'A' || id as account_id", "'C' || if(id % 3 = 0, 0, id % 25) as customer_id")
    )
    transactions = silver.silver_transactions(
        spark.range(3000).selectExpr("'T' || id as transaction_id", "'A' || if(id % 3 = 0, 6, id % 650) as account_id")
    )
    dims = gold.dim_customers(customers, AS_OF)
    hot_customers = hot_keys(accounts, "customer_id", rows_per_task=50)
    hot_accounts = hot_keys(transactions, "account_id", rows_per_task=100)
    assert hot_customers.count() == 1
    assert hot_accounts.count() == 1
    plain_accounts = gold.dim_accounts(accounts, dims)
    plain = gold.fact_transactions(transactions, plain_accounts, dims)
    split_accounts = gold.dim_accounts(accounts, dims, hot_customers)
    split = gold.fact_transactions(transactions, split_accounts, dims, hot_accounts, hot_customers)
    assert Counter(map(tuple, split.collect())) == Counter(map(tuple, plain.collect()))
    by_province = reports.province_distribution(plain_accounts, dims).collect()
    assert reports.province_distribution(split_accounts, dims, hot_customers).collect() == by_province


def test_issue_summary_ignores_unknown_codes_and_can_report_zeros(spark):
    counted = spark.createDataFrame(
        [("DATE_FORMAT", 2), ("DATE_FORMAT", 3), ("ODD", 9), ("ORPHANED_ACCOUNT", 4)],
        "issue_code string, record_count bigint",
    )
    found = issues.issue_summary(counted).collect()
    assert [(r.issue_code, r.record_count) for r in found if r.record_count] == [
        ("ORPHANED_ACCOUNT", 4),
        ("DATE_FORMAT", 5),
    ]
    assert {r.total_flagged_records for r in found} == {9}
    assert [r.record_count for r in issues.issue_summary(counted, compute=False).collect()] == [4, 0, 0, 0, 0, 0]


def test_issue_counts_per_table(spark):
    raw = spark.createDataFrame(
        [("A1", "C", "x", "2020-01-01"), (" A1", "C", "1", "2020"), (" ", "C", " ", None), (None, "C", "1", "junk")],
        "account_id string, customer_id string, credit_limit string, open_date string",
    )
    prepared = silver.prepare(raw, ACCOUNTS)
    assert issues.table_issue_counts(prepared, ACCOUNTS).first().asDict() == {
        "DUPLICATE_DEDUPED": 1,
        "TYPE_MISMATCH": 1,
        "DATE_FORMAT": 2,
        "CURRENCY_VARIANT": 0,
        "NULL_REQUIRED": 2,
    }
    empty = issues.table_issue_counts(prepared.limit(0), ACCOUNTS).first().asDict()
    assert set(empty.values()) == {0}


def test_partitioned_write_and_compression(spark, tmp_path):
    df = spark.range(100).selectExpr("id", "id % 4 as part")
    sources.write_table(df, f"{tmp_path}/t", partition_by=["part"], compression="uncompressed")
    assert sorted(p.name for p in (tmp_path / "t").glob("part=*")) == [f"part={i}" for i in range(4)]
    assert not list((tmp_path / "t").rglob("*.snappy.parquet"))
    assert sources.read_table(spark, f"{tmp_path}/t").count() == 100


def test_json_lines_with_a_schema_need_no_discovery(spark, tmp_path):
    (tmp_path / "t.jsonl").write_text('{"a": 1.50, "s": {"b": true}}\nbroken\n')
    found = sources.read_json_lines(spark, f"{tmp_path}/t.jsonl", "a string, s struct<b: string>").collect()
    assert [tuple(r) for r in found] == [("1.50", ("true",)), (None, None)]
    discovered = sources.read_json_lines(spark, f"{tmp_path}/t.jsonl")
    assert set(discovered.columns) == {"a", "s", "_corrupt_record"}


def test_scratch_folder_is_below_the_shared_folder():
    def session(**settings):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda name, default: settings.get(name, default)))

    shared = session(**{"spark.checkpoint.dir": "hdfs://shared/dir/", "spark.master": "yarn"})
    one, two = (sources.scratch_folder(shared, "x") for _ in range(2))
    assert one.startswith("hdfs://shared/dir/x-")
    assert one != two
    with pytest.raises(ValueError, match="share"):
        sources.scratch_folder(session(**{"spark.master": "yarn"}), "x")
    assert Path(sources.scratch_folder(session(**{"spark.master": "local[2]"}), "x")).exists()


def test_command_line_help():
    done = subprocess.run(
        [sys.executable, "-m", "silverline", "--help"],
        cwd=Path(__file__).resolve().parent.parent,
        capture_output=True,
        text=True,
        check=True,
    )
    assert "--transactions" in done.stdout


def plan_of(df, **settings):
    """The physical plan under some settings, without adaptive execution."""
    spark = df.sparkSession
    wanted = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", **settings}
    before = {name: spark.conf.get(name) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        return df.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_fact_from_raw_needs_two_joins(spark):
    tables = gold_tables(spark)
    accounts = gold.dim_accounts(tables["silver_accounts"], tables["gold_dim_customers"])
    fact = gold.fact_transactions(tables["silver_transactions"], accounts)
    assert plan_of(fact).count("SortMergeJoin") == 2
    both = gold.fact_transactions(tables["silver_transactions"], accounts, tables["gold_dim_customers"])
    assert Counter(map(tuple, fact.collect())) == Counter(map(tuple, both.collect()))
    orphans = gold.orphaned_transactions(tables["silver_transactions"], accounts.where("account_id <> 'AC3'")).first()[0]
    linked = gold.fact_transactions(tables["silver_transactions"], accounts.where("account_id <> 'AC3'")).count()
    assert orphans > 0 and linked + orphans == tables["silver_transactions"].count()


def test_volume_by_type_plans_the_fact_once(clean_tables):
    fact = gold.fact_transactions(clean_tables["silver_transactions"], clean_tables["gold_dim_accounts"])
    report = reports.volume_by_type(fact)
    plan = plan_of(report)
    assert "Window" not in plan and "ReusedExchange" in plan
    assert plan.count("SortMergeJoin") == 1
    assert sum(r.pct_of_total for r in report.collect()) == pytest.approx(100, abs=0.05)


def test_single_issue_codes_need_no_key_shuffle(spark):
    raw = spark.createDataFrame(
        [("A1", "C", "x"), (" A1", "C", "1"), (" ", "C", " "), (None, "C", "1")],
        "account_id string, customer_id string, credit_limit string",
    )
    prepared = silver.prepare(raw, ACCOUNTS)
    expected = {"TYPE_MISMATCH": 1, "DATE_FORMAT": 0, "CURRENCY_VARIANT": 0, "NULL_REQUIRED": 2}
    for code, count in expected.items():
        counts = issues.table_issue_counts(prepared, ACCOUNTS, [code])
        assert counts.collect() == [(count,)]
        assert "hashpartitioning" not in plan_of(counts)
    assert issues.table_issue_counts(prepared, ACCOUNTS, ["DUPLICATE_DEDUPED"]).collect() == [(1,)]


def test_findings_and_messages_name_what_is_wrong(clean_tables):
    fact = clean_tables["gold_fact_transactions"].withColumn("transaction_type", F.lit("it's odd"))
    tables = {**clean_tables, "gold_fact_transactions": fact}
    found = {tuple(r) for r in validation.findings(validation.domain_values(tables)["transaction_type"]).collect()}
    assert ("transaction_type", "it's odd", "unexpected", "transaction_type: unexpected value 'it's odd'") in found
    assert {r[2] for r in found} == {"missing", "unexpected"} and len(found) == 1 + len(TRANSACTION_TYPES)
    messages = {r.message for r in validation.failure_messages(validation.validation_report(tables)).collect()}
    assert messages == {
        f"domains: transaction_type_missing_values is {len(TRANSACTION_TYPES)}",
        "domains: transaction_type_unexpected_values is 1",
    }


def test_spellings_and_check_names_may_have_quotes(spark):
    one = spark.range(1)
    looked = one.select(categories.canonical(F.lit("O'K"), {"it's": ["O'K"]}, F.lit("?")).alias("v"))
    assert looked.first().v == "it's"
    assert validation._rows(one, [("g", "it's", "3")]).first().check_name == "it's"


def test_stages_from_the_command_line(spark, tmp_path):
    (tmp_path / "c.csv").write_text("customer_id,province,dob\nC1,GP,1980-01-01\nC2,Nowhere,1990-01-01\n")
    (tmp_path / "a.csv").write_text("account_id,customer_ref\nA1,C1\nA2,C2\nA3,C9\n")
    (tmp_path / "t.jsonl").write_text(
        "".join(
            f'{{"transaction_id": "T{i}", "account_id": "A{i}", "transaction_type": "credit", "channel": "APP", "transaction_date": "2024-01-0{i}", "amount": "1"}}\n'
            for i in (1, 2, 3)
        )
    )
    out = f"{tmp_path}/out"
    inputs = [f"--customers={tmp_path}/c.csv", f"--accounts={tmp_path}/a.csv", f"--transactions={tmp_path}/t.jsonl"]
    # The command line takes the session that is there.
    command_line.main([*inputs, f"--output={out}", "--stages", "bronze", "--ingested-at", "2024-06-01"])
    assert not Path(f"{out}/silver").exists()
    command_line.main([f"--output={out}", "--stages", "silver", "gold", "--as-of", "2024-06-30", "--partition-by", "channel"])
    fact = sources.read_table(spark, f"{out}/gold/fact_transactions")
    assert fact.count() == 2 and list(Path(f"{out}/gold/fact_transactions").glob("channel=*"))
    assert not Path(f"{out}/reports").exists()
    command_line.main([f"--output={out}", "--stages", "quality", "validate", "--orphans-only"])
    summary = {r.issue_code: r.record_count for r in spark.read.json(f"{out}/reports/dq_summary").collect()}
    assert summary["ORPHANED_ACCOUNT"] == 1
    found = {(r.domain, r["value"], r.verdict) for r in spark.read.json(f"{out}/reports/findings").collect()}
    assert ("province", "Nowhere", "unexpected") in found
    messages = {r.message for r in spark.read.json(f"{out}/reports/messages").collect()}
    assert "domains: province_unexpected_values is 1" in messages
    with pytest.raises(SystemExit):
        command_line.options([f"--output={out}"])


def test_layers_with_colliding_hashes(spark, tmp_path, monkeypatch):
    """With 97 hashes for 24 ids the layers still join rightly, and a second load changes no key."""
    hashed = keyring.seeded_key
    monkeypatch.setattr(keyring, "seeded_key", lambda value, attempt, modulus=0: hashed(value, attempt, 97))
    layout = layers.Layout(str(tmp_path / "out"))

    def load(n):
        customers = spark.range(n).selectExpr("'C' || id as customer_id", "'gp' as province")
        accounts = spark.range(n).selectExpr("'A' || id as account_id", "'C' || id as customer_id")
        transactions = spark.range(n).selectExpr(
            "'T' || id as transaction_id", "'A' || id as account_id", "'2024-01-05' as transaction_date", "'1' as amount"
        )
        raw = {"customers": customers, "accounts": accounts, "transactions": transactions}
        layers.run(spark, raw, layout, LOADED, AS_OF, stages=("bronze", "silver", "gold", "validate"))
        fact = table(spark, layout, "gold_fact_transactions")
        owners = {r.customer_sk: r.customer_id for r in table(spark, layout, "gold_dim_customers").collect()}
        holders = {r.account_sk: r.account_id for r in table(spark, layout, "gold_dim_accounts").collect()}
        found = {r.transaction_id: (r.transaction_sk, owners[r.customer_sk], holders[r.account_sk]) for r in fact.collect()}
        assert {k: v[1:] for k, v in found.items()} == {f"T{i}": (f"C{i}", f"A{i}") for i in range(n)}
        assert len({v[0] for v in found.values()}) == len(owners) == len(holders) == n
        faults = json_rows(layout.report("key_faults"))
        assert len(faults) == 3 and all((r["repeated"], r["collided"]) == (0, 0) for r in faults)
        return owners, holders, {v[0]: k for k, v in found.items()}

    for before, after in zip(load(12), load(24), strict=True):
        assert before.items() <= after.items()
    assert table(spark, layout, "gold_dim_customers").where("customer_sk >= 97").count() == 0
