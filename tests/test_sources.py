"""Readers over folders whose files do not agree."""

from collections import Counter
from pathlib import Path

import pytest

from pyspark.sql import functions as F

from registry import catalog
from silverline import sources
from silverline.operators.shape import normalise_columns, shared_spelling
from silverline.plans import layers, silver
from silverline.spec import ACCOUNTS


def write(folder, files):
    for name, text in files.items():
        path = Path(folder) / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
    return str(folder)


def rows(df):
    return Counter(tuple(sorted(r.asDict().items())) for r in df.collect())


def test_columns_are_found_by_name_whatever_their_place(spark, tmp_path):
    folder = write(
        tmp_path / "in",
        {
            "a.csv": "customer_id,gender\nC1,F\nC2,M\n",
            "b.csv": "gender,customer_id\nM,C3\n",
            "c.csv": "customer_id,gender,referrer\nC4,F,C1\n",
            "d.csv": "customer_id,gender\nC5,\n",
        },
    )
    read = sources.read_csv_text(spark, folder)
    assert read.columns == ["customer_id", "gender", "referrer"]
    assert {tuple(r) for r in read.collect()} == {
        ("C1", "F", None), ("C2", "M", None), ("C3", "M", None), ("C4", "F", "C1"), ("C5", None, None),
    }
    assert [len(files) for files in sources.csv_headers(spark, folder).values()] == [2, 1, 1]


def test_spellings_and_aliases_of_a_column_meet(spark, tmp_path):
    folder = write(
        tmp_path,
        {
            "1.csv": "account_id,customer_ref,Open Date\nA1,C1,d1\n",
            "2.csv": "OPEN-DATE,cust_id,account_id\nd2,C2,A2\n",
            "3.csv": "customer_id,customer_ref,account_id\nC3,other,A3\n",
        },
    )
    read = sources.read_csv_text(spark, folder, ACCOUNTS.aliases)
    assert read.columns == ["account_id", "customer_ref", "Open Date", "customer_ref_2"]
    assert {tuple(r) for r in read.collect()} == {
        ("A1", "C1", "d1", None), ("A2", "C2", "d2", None), ("A3", "C3", None, "other"),
    }


def test_odd_files(spark, tmp_path):
    """Blanks, patterns and percent signs in names, a byte order mark, Windows line ends, empty files, folders with values."""
    folder = write(
        tmp_path / "x",
        {
            "day=1/a b%20[1].csv": "﻿id,v\r\n1,x\r\n",
            "day=1/{c}.csv": "id,v\n2,y\n",
            "day=2/d*.csv": 'v,id\n"a, b",3\n',
            "day=2/empty.csv": "",
            "day=2/only-a-header.csv": "w,id\n",
        },
    )
    read = normalise_columns(sources.read_csv_text(spark, folder))
    found = {(r["id"], r["v"], str(r["day"])) for r in read.collect()}
    assert found == {("1", "x", "1"), ("2", "y", "1"), ("3", "a, b", "2")}
    assert set(read.columns) == {"id", "v", "w", "day"}


def test_one_header_takes_one_scan(spark, tmp_path):
    folder = write(tmp_path, {f"{i}.csv": f"a,b\n{i},{i}\n" for i in range(5)})
    read = sources.read_csv_text(spark, folder)
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1 and "Union" not in plan
    assert read.count() == 5
    single = sources.read_csv_text(spark, f"{folder}/0.csv")
    assert [tuple(r) for r in single.collect()] == [("0", "0")]
    listed = sources.read_csv_text(spark, [f"{folder}/0.csv", f"{folder}/3.csv"])
    assert sorted(tuple(r) for r in listed.collect()) == [("0", "0"), ("3", "3")]


def test_a_large_file_is_not_read_for_its_header(spark, tmp_path):
    """Splits behind the first have no header, and a task sees one line of its split."""
    lines = "".join(f"{i},{'x' * 90}\n" for i in range(60_000))
    folder = write(tmp_path, {"big.csv": "id,v\n" + lines, "small.csv": "v,id\ny,60000\n"})
    before, opening = (spark.conf.get(f"spark.sql.files.{c}") for c in ("maxPartitionBytes", "openCostInBytes"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        groups = sources.csv_headers(spark, folder)
        read = sources.read_csv_text(spark, folder)
        assert list(groups) == ["id,v", "v,id"] and [len(f) for f in groups.values()] == [1, 1]
        assert read.selectExpr("sum(cast(id as bigint))").first()[0] == sum(range(60_001))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert spark.conf.get("spark.sql.files.openCostInBytes") == opening


@pytest.mark.parametrize("drift", [False, True])
def test_records_of_a_wrong_width_are_told(spark, tmp_path, drift):
    files = {"a.csv": "id,v\n1,x\n2\n3,y,z\n", "b.csv": "v,id\nw\n" if drift else "id,v\n4\n"}
    read = sources.read_csv_text(spark, write(tmp_path, files), corrupt="broken")
    found = {r["id"]: r["broken"] for r in read.collect() if r["id"]}
    assert found["1"] is None and found["2"] == "2" and found["3"] == "3,y,z"
    # Asking for one column does not change which records are broken.
    assert len(read.where("broken is not null").select("id").collect()) == 3


def test_shared_spelling_keeps_columns_apart():
    spelling = {}
    assert shared_spelling(["Id", "ID ", "x"], spelling, {}) == ["Id", "Id_2", "x"]
    assert shared_spelling(["id", "X", "id_2"], spelling, {}) == ["Id", "x", "id_2"]


def test_json_fields_of_one_scan(spark, tmp_path):
    lines = [
        '{"id": "1", "amount": 1.50, "location": {"province": "wc", "x": [1]}, "flag": true}',
        '{"txn": "2", "amount": "2.50", "location": "wc", "flag": null}',
        '{"id": 3, "new field": "n", "a.b": 1}',
        "{broken",
        "[1, 2]",
        '"text"',
        "null",
        "   ",
        "",
    ]
    (tmp_path / "t.jsonl").write_text("\n".join(lines))
    records = sources.read_json_records(spark, str(tmp_path / "t.jsonl"))
    assert [r.line for r in records.where("record is null").select("line").collect()] == lines[3:7]
    wanted = {"id": ["id", "txn"], "amount": ["amount"], "province": ["location.province"], "flag": ["flag"], "n": ["new field"]}
    read = sources.json_fields(records.where("record is not null"), wanted, ["line"])
    assert {tuple(r)[1:] for r in read.collect()} == {
        ("1", "1.5", "wc", "true", None), ("2", "2.50", None, None, None), ("3", None, None, None, "n"),
    }
    assert [r.line for r in read.where("id = '1'").collect()] == lines[:1]  # 1.50 is in the line
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_layers_read_transactions_in_one_pass(spark, tmp_path):
    """A field renamed in the middle of a file loses no value; what silver does not know stays in the line."""
    (tmp_path / "c.csv").write_text("customer_id\nC1\n")
    (tmp_path / "a.csv").write_text("account_id,customer_id\nA1,C1\n")
    lines = ['{"txn_id": "T1", "account_id": "A1", "txn_amount": 1.5, "date": "2024-01-05", "location": {"province": "gp"}}',
             '{"transaction_id": "T2", "acct_id": "A1", "amount": "2", "transaction_date": "2024-01-06", "extra": 1}', "{bad"]
    (tmp_path / "t.jsonl").write_text("\n".join(lines))
    paths = [str(tmp_path / n) for n in ("c.csv", "a.csv", "t.jsonl")]
    raw = layers.read_sources(spark, *paths, keep_malformed=True, one_pass=True)["transactions"]
    assert sorted(r.line for r in raw.collect()) == sorted(lines)
    assert [r["_corrupt_record"] for r in raw.where("_corrupt_record is not null").collect()] == ["{bad"]
    found = {r.transaction_id: r for r in silver.silver_transactions(raw.withColumn("ingestion_timestamp", F.current_timestamp())).collect()}
    assert {k: (str(r.amount), r.account_id, r.location_province) for k, r in found.items()} == {
        "T1": ("1.50", "A1", "Gauteng"), "T2": ("2.00", "A1", None),
    }


def test_json_lines_are_packed_into_files_of_bounded_length(spark, tmp_path):
    sources.write_json(spark.range(0, 25, 1, 1), f"{tmp_path}/packed", compression="gzip", lines_per_file=10)
    files = list((tmp_path / "packed").glob("part-*"))
    assert len(files) == 3 and all(f.name.endswith(".json.gz") for f in files)
    assert rows(sources.read_json_lines(spark, f"{tmp_path}/packed")) == rows(spark.range(25).selectExpr("string(id) as id"))


@pytest.mark.parametrize("query", ["scan_jsonl_nested", "scan_jsonl_one_pass"])
def test_registered_scans_write_packed_lines(spark, tmp_path, monkeypatch, query):
    lines = spark.range(3000).selectExpr(
        "id as l_orderkey", "id * 7 as l_partkey", "id as l_suppkey", "1 as l_linenumber", "double(id) as l_extendedprice",
        "'N' as l_returnflag", "'O' as l_linestatus", "timestamp'1998-01-01' as l_shipdate",
    )
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(catalog, "scratch_folder", lambda _, purpose: f"{tmp_path}/{purpose}")
    assert catalog.QUERIES[query](spark, str(tmp_path)).count() == 3000
    written = sum(f.stat().st_size for f in (tmp_path / "jsonl").glob("part-*"))
    assert written < 3000 * 100  # about 400 bytes a record unpacked
