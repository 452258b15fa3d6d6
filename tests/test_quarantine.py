"""Nothing is lost between the layers: what is not kept is in quarantine, as it came."""

import json
import random
from collections import Counter
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from silverline import sources
from silverline.operators.joins import hot_keys
from silverline.plans import layers, quarantine, silver
from silverline.spec import CUSTOMERS, TRANSACTIONS

LOADED = datetime(2024, 6, 1)


def raw_customers(spark, rows):
    schema = "customer_id string, dob string, risk_score string, ingestion_timestamp timestamp, note string"
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("split", [False, True])
def test_the_silver_row_and_the_rejected_records_are_all_that_came(spark, split):
    """Random records with repeated keys, equal records, records that differ outside silver only, and a hot key."""
    draw = random.Random(7)
    rows = []
    for _ in range(600):
        key = draw.choice([None, "", "  ", "C1", " C1 ", "C1", *(f"C{i}" for i in range(2, 60))])
        loaded = draw.choice([None, datetime(2024, 1, 1), datetime(2024, 1, 2)])
        rows.append((key, draw.choice(["2000-01-01", "bad", None]), draw.choice(["5", "x"]), loaded, draw.choice("ab")))
    raw = raw_customers(spark, rows)
    hot = None
    if split:
        keys = raw.select(F.trim("customer_id").alias("record_key"))
        hot = hot_keys(keys, "record_key", rows_per_task=10)
        assert hot.count() >= 1
    rejected = quarantine.silver_rejects(raw, CUSTOMERS, hot).collect()
    kept = {r.customer_id for r in silver.silver_customers(raw).collect()}
    assert sum(r.copies for r in rejected) + len(kept) == len(rows)
    # Per key, one of the records is missing from the rejected ones: the one that silver took.
    as_tuple = lambda record: (record.get("customer_id"), record["dob"], record["risk_score"], record.get("note"))
    came = Counter((k, d, s, n) for k, d, s, _, n in rows)
    lost = Counter()
    for r in rejected:
        lost[as_tuple(json.loads(r.record))] += r.copies
    missing = came - lost
    assert not lost - came and sorted(k.strip() for k, *_ in missing.elements()) == sorted(kept)
    taken = {r.customer_id: (r.dob, r.risk_score) for r in silver.silver_customers(raw).collect()}
    read = {"2000-01-01": date(2000, 1, 1), "bad": None, None: None}
    for key, dob, score, _ in missing.elements():
        assert taken[key.strip()] == (read[dob], 5 if score == "5" else None)
    codes = Counter()
    for r in rejected:
        codes[r.issue_code] += r.copies
        assert (r.kept, r.layer, r.table_name) == (False, "silver", "customers")
    assert codes["NULL_REQUIRED"] == sum(not (k or "").strip() for k, *_ in rows)


def test_equal_records_are_one_row_with_copies(spark):
    same = ("C1", "2000-01-01", "1", LOADED, "a")
    rejected = quarantine.silver_rejects(raw_customers(spark, [same] * 500), CUSTOMERS).collect()
    assert [(r.issue_code, r.record_key, r.copies) for r in rejected] == [("DUPLICATE_DEDUPED", "C1", 499)]
    assert rejected[0].handling_action == "deduplicate_keep_latest_and_report"
    assert quarantine.silver_rejects(raw_customers(spark, [same]), CUSTOMERS).count() == 0
    assert quarantine.silver_rejects(raw_customers(spark, []), CUSTOMERS).count() == 0


def test_values_that_could_not_be_read_are_kept_with_their_record(spark):
    raw = raw_customers(spark, [("C1", "bad", "x", LOADED, "a"), ("C2", "2000-01-01", "1", LOADED, None), (None, "bad", None, None, None)])
    reported = {(r.issue_code, r.record_key): json.loads(r.record) for r in quarantine.reported_records(raw, CUSTOMERS).collect()}
    assert set(reported) == {("TYPE_MISMATCH", "C1"), ("DATE_FORMAT", "C1"), ("DATE_FORMAT", None)}
    assert reported["TYPE_MISMATCH", "C1"]["risk_score"] == "x" and reported["DATE_FORMAT", None]["note"] is None


def test_gold_rejects_hold_rows_without_a_parent(spark):
    rows = [("T1", "A1"), ("T2", "A9"), ("T3", None), *((f"H{i}", "A8") for i in range(40))]
    came = spark.createDataFrame(rows, "transaction_id string, account_id string")
    parents = spark.createDataFrame([("A1",)], "account_id string")
    for hot in (None, hot_keys(came, "account_id", rows_per_task=5)):
        lost = quarantine.gold_rejects(came, parents, TRANSACTIONS, "account_id", "ORPHANED_ACCOUNT", hot)
        assert sorted(r.record_key for r in lost.collect()) == sorted(t for t, a in rows if a != "A1")


def optimised(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_records_are_read_once_with_a_key_and_once_without(spark, tmp_path):
    raw_customers(spark, [("C1", "2000-01-01", "1", LOADED, "a")]).write.parquet(f"{tmp_path}/raw")
    no_hot = spark.sql("select '' as record_key, 1 as _parts where false")
    plan = optimised(quarantine.silver_rejects(spark.read.parquet(f"{tmp_path}/raw"), CUSTOMERS, no_hot))
    assert plan.count("Relation [") == 2


def test_a_raw_column_may_have_any_name(spark):
    rows = [("C1", "2000-01-01", 1, "x"), ("C1", "2000-01-01", 2, "x"), (None, None, 3, "y")]
    raw = spark.createDataFrame(rows, "customer_id string, dob string, _record_key_copies int, _Record_Key string")
    raw = raw.withColumn("ingestion_timestamp", F.lit(LOADED))
    found = [(r.record_key, json.loads(r.record)) for r in quarantine.silver_rejects(raw, CUSTOMERS).collect()]
    assert sorted((k or "", r["_record_key_copies"], r["_record_key"]) for k, r in found) == [("", 3, "y"), ("C1", 2, "x")]


def test_only_lost_rows_are_spelt_as_json(spark):
    came = spark.range(5).selectExpr("'T' || id as transaction_id", "'A' || id as account_id")
    parents = spark.range(3).selectExpr("'A' || id as account_id")
    plan = optimised(quarantine.gold_rejects(came, parents, TRANSACTIONS, "account_id", "ORPHANED_ACCOUNT"))
    assert plan.count(" AS record#") == 1 and plan.index(" AS record#") < plan.index("Join LeftAnti")


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    """Layers from files with lines that do not fit."""
    root = tmp_path_factory.mktemp("in")
    (root / "customers").mkdir()
    (root / "customers" / "a.csv").write_text("customer_id,dob,province\nC1,2000-01-01,gp\nC2\nC1,1999-01-01,gp\n")
    (root / "customers" / "b.csv").write_text("province,cust_id,dob\nwc,C3,bad\nwc,,2000-01-01,more\n")
    (root / "accounts.csv").write_text("account_id,customer_ref\nA1,C1\nA2,C7\nA3\n")
    lines = ['{"txn_id": "T1", "account_id": "A1", "amount": "1.50"}', '{"txn_id": "T2", "acc', '{"txn_id": "T3", "account_id": "A2"}',
             '{"txn_id": "T1", "account_id": "A1", "amount": "x", "transaction_date": "2024-01-05"}']
    (root / "transactions.jsonl").write_text("\n".join(lines))
    paths = [str(root / n) for n in ("customers", "accounts.csv", "transactions.jsonl")]
    layout = layers.Layout(str(root / "out"))
    layers.run(spark, layers.read_sources(spark, *paths, keep_malformed=True), layout, LOADED, date(2024, 6, 30))
    return layout


def kept_of(spark, layout, name):
    return [r.asDict() for r in sources.read_table(spark, layout.quarantine(name)).collect()]


def test_every_step_is_balanced(spark, written):
    steps = {r["step"]: r for r in map(json.loads, spark.read.text(written.report("quarantine_balance")).toPandas()["value"])}
    counts = {s: (r["n_came"], r["n_kept"], r["n_rejected"]) for s, r in steps.items()}
    assert counts == {
        "silver_customers": (5, 3, 2),
        "silver_accounts": (3, 3, 0),
        "silver_transactions": (4, 2, 2),
        "gold_dim_accounts": (3, 1, 2),
        "gold_fact_transactions": (2, 1, 1),
    }
    assert all(r["balanced"] for r in steps.values())


def test_rejected_and_reported_records_of_the_layers(spark, written):
    codes = lambda name: sorted((r["issue_code"], r["record_key"] or "") for r in kept_of(spark, written, name))
    assert codes("silver_customers") == [("DUPLICATE_DEDUPED", "C1"), ("NULL_REQUIRED", "")]
    assert codes("reported_customers") == [("DATE_FORMAT", "C3"), ("MALFORMED_RECORD", ""), ("MALFORMED_RECORD", "C2")]
    assert codes("gold_dim_accounts") == [("UNLINKED_ACCOUNT", "A2"), ("UNLINKED_ACCOUNT", "A3")]
    assert codes("reported_accounts") == [("MALFORMED_RECORD", "A3")]
    assert codes("silver_transactions") == [("DUPLICATE_DEDUPED", "T1"), ("NULL_REQUIRED", "")]
    assert codes("gold_fact_transactions") == [("ORPHANED_ACCOUNT", "T3")]
    broken = [r for r in kept_of(spark, written, "reported_transactions") if r["issue_code"] == "MALFORMED_RECORD"]
    assert [json.loads(r["record"])["_corrupt_record"] for r in broken] == ['{"txn_id": "T2", "acc']
    superseded = [r for r in kept_of(spark, written, "silver_transactions") if r["issue_code"] == "DUPLICATE_DEDUPED"]
    assert json.loads(superseded[0]["record"])["amount"] == "1.50"
