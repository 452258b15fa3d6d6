"""Layouts: buckets that join without an exchange, and row groups that are skipped by either column."""

from collections import Counter
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from registry import catalog

from silverline.operators.joins import hot_keys
from silverline.operators.zorder import BITS, clustered, with_zorder
from silverline.sources import join_by_key, open_by_key, read_table, write_by_key, write_table, writers

JOINS = ("inner", "left", "left_semi", "left_anti")


def rows(df):
    return Counter(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def tables(spark):
    """A fact with a third of its rows under one key and some without, and a lookup that lacks some keys."""
    fact = spark.range(3000).selectExpr(
        "case when id % 3 = 0 then 'hot' when id % 101 = 0 then null else 'k' || (id % 97) end as k", "id as n"
    )
    lookup = spark.range(90).selectExpr("if(id = 0, 'hot', 'k' || id) as k", "id * 10 as v")
    return fact, lookup


@pytest.fixture(scope="module")
def laid_out(spark, tables, tmp_path_factory):
    folder = tmp_path_factory.mktemp("by_key")
    fact, lookup = tables
    write_by_key(fact, f"{folder}/fact", "k", 8, hot_keys(fact, "k", rows_per_task=500, most=100))
    write_by_key(lookup, f"{folder}/lookup", "k", 8)
    return open_by_key(spark, f"{folder}/fact"), open_by_key(spark, f"{folder}/lookup")


@pytest.mark.parametrize("how", JOINS)
@pytest.mark.parametrize("broadcast_keys", [0, 100])
def test_join_by_key_is_the_plain_join(tables, laid_out, how, broadcast_keys):
    fact, lookup = tables
    found = join_by_key(*laid_out, how, "n", broadcast_keys)
    assert rows(found) == rows(fact.join(lookup, "k", how))


def test_ordinary_rows_meet_without_an_exchange(spark, laid_out):
    fact, lookup = laid_out
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for how in JOINS:
            joined = fact.ordinary.join(lookup.ordinary, "k", how)
            plan = joined._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Exchange" not in plan
            # Rows kept apart meet a broadcast of the hot keys' rows: nothing is hashed anywhere.
            plan = join_by_key(fact, lookup, how, "n")._jdf.queryExecution().executedPlan().toString()
            assert "Exchange hashpartitioning" not in plan and "BroadcastExchange" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_rows_and_rows_without_a_key_are_kept_apart(tables, laid_out):
    fact, _ = laid_out
    assert {r.k for r in fact.apart.select("k").distinct().collect()} == {"hot", None}
    assert fact.n_hot == 1 and [r.k for r in fact.hot.collect()] == ["hot"]
    assert rows(fact.rows()) == rows(tables[0])


def test_a_layout_is_opened_from_its_folder_alone(spark, tables, tmp_path):
    path = f"{tmp_path}/it's here"
    write_by_key(tables[1], path, "k", 4)
    for entry in spark.catalog.listTables():
        spark.sql(f"drop table if exists {entry.name}")
    opened = open_by_key(spark, path)
    assert (opened.key, opened.buckets) == ("k", 4) and rows(opened.rows()) == rows(tables[1])
    # Written again with other rows, columns and buckets.
    other = tables[1].select("v", "k", (F.col("v") + 1).alias("odd `name")).where("v > 300")
    write_by_key(other, path, "k", 6)
    opened = open_by_key(spark, path)
    assert opened.buckets == 6 and rows(opened.rows()) == rows(other)
    assert opened.ordinary.columns == other.columns


def test_edges_of_layouts(spark, laid_out, tmp_path):
    empty = spark.createDataFrame([], "k string, n long")
    write_by_key(empty, f"{tmp_path}/empty", "k", 8)
    opened = open_by_key(spark, f"{tmp_path}/empty")
    assert opened.rows().count() == 0
    assert join_by_key(opened, laid_out[1], "left", "n").count() == 0
    with pytest.raises(ValueError, match="laid out differently"):
        write_by_key(empty, f"{tmp_path}/other", "k", 4)
        join_by_key(open_by_key(spark, f"{tmp_path}/other"), laid_out[1], "left", "n")
    with pytest.raises(ValueError, match="no join"):
        join_by_key(*laid_out, "full", "n")


def numbered(df):
    """``df`` with a window in its plan, which is what a silver table costs."""
    return df.selectExpr("*", "row_number() over (partition by account_id order by account_id) as place")


def optimised(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_registered_layouts_compute_their_tables_once(spark, monkeypatch):
    g = catalog.Layered(spark, "none")
    g.silver_transactions = numbered(spark.range(40).selectExpr("'A' || id % 5 as account_id", "id"))
    g.accounts = numbered(spark.range(5).selectExpr("'A' || id as account_id", "id as account_sk", "'C1' as customer_id")).where("place = 1")
    plans = []

    def noted(df, *rest):
        plans.append(optimised(df))
        write_by_key(df, *rest)

    monkeypatch.setattr(catalog, "write_by_key", noted)
    transactions, links = catalog.laid_out(spark, g)
    assert len(plans) == 2 and not any("Window" in plan for plan in plans)
    assert transactions.rows().count() == 40 and transactions.n_hot == 5 and links.rows().count() == 5


# --- clustering --------------------------------------------------------------------------


def brute_key(ranks):
    """Bits of the ranks in turn, highest first."""
    bits = "".join(str(r >> b & 1) for b in reversed(range(BITS)) for r in ranks)
    return int(bits, 2)


def test_key_interleaves_ranks(spark):
    n = 1 << BITS
    df = spark.range(n).selectExpr("id as a", f"int(id * 37 % {n}) as b", "date_add(date'2020-01-01', int(id * 11 % 1024)) as c")
    found = with_zorder(df, ["a", "b", "c"], "z").collect()
    first = min(r.c for r in found)
    for r in found:
        exact = brute_key([r.a, r.b, (r.c - first).days])
        assert r.z == exact


def test_text_ranks_follow_bytes(spark):
    texts = [f"A{i}" for i in range(500)] + ["A", "Aé", "A中", "B" * 40]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = {r.t: r.z for r in with_zorder(df, ["t"], "z").collect()}
    ordered = sorted(texts, key=lambda t: t.encode())
    assert all(found[a] <= found[b] for a, b in zip(ordered, ordered[1:], strict=False))
    assert len(set(found.values())) > 450


def group_ranges(folder, column):
    ranges = []
    for file in sorted(Path(folder).glob("*.parquet")):
        meta = pq.read_metadata(file)
        at = meta.schema.names.index(column)
        for i in range(meta.num_row_groups):
            s = meta.row_group(i).column(at).statistics
            ranges.append((s.min, s.max))
    return ranges


def test_row_groups_are_skipped_by_either_column(spark, tmp_path):
    """64 files: a plain sort skips by its first column alone, the clustered layout by both."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(200_000).selectExpr("int(xxhash64(id) & 1023) as day", "'A' || (xxhash64(id, 7) & 65535) as account", "id")
        sorted_by_day = df.repartitionByRange(64, "day", "id").sortWithinPartitions("day")
        write_table(sorted_by_day, f"{tmp_path}/sorted")
        write_table(clustered(df, ["day", "account"], 64), f"{tmp_path}/clustered")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    share = {}
    for layout in ("sorted", "clustered"):
        probes = {"day": range(5, 1024, 50), "account": [f"A{i}" for i in range(1000, 65000, 3000)]}
        for column, values in probes.items():
            ranges = group_ranges(tmp_path / layout, column)
            read = [sum(low <= value <= high for low, high in ranges) / len(ranges) for value in values]
            share[layout, column] = sum(read) / len(read)
    print({" ".join(k): round(v, 3) for k, v in share.items()})
    # 64 files are 8 by 8 cells: an eighth at best, about two of them where a file's range crosses a cell's edge.
    assert share["sorted", "account"] > 0.9
    assert share["clustered", "day"] <= 0.3 and share["clustered", "account"] <= 0.3
    assert rows(read_table(spark, f"{tmp_path}/clustered").agg(F.count("id"), F.sum("id"), F.countDistinct("id"))) == rows(
        df.agg(F.count("id"), F.sum("id"), F.countDistinct("id"))
    )


def test_what_is_clustered_is_computed_once(spark, tmp_path, monkeypatch):
    df, plans = numbered(spark.range(100).selectExpr("'A' || id % 7 as account_id", "id")), []

    def noted(rows, columns):
        plans.append(optimised(rows))
        return clustered(rows, columns)

    monkeypatch.setattr(writers, "clustered", noted)
    write_table(df, f"{tmp_path}/t", cluster_by=["account_id", "id"])
    assert len(plans) == 1 and "Window" not in plans[0]
    assert rows(read_table(spark, f"{tmp_path}/t")) == rows(df)


def test_one_value_of_a_third_of_the_rows_is_divided(spark):
    df = spark.range(30_000).selectExpr("if(id % 3 = 0, 5, int(id % 1000)) as a", "if(id % 3 = 0, 'x', 'y' || id) as t", "id")
    sizes = clustered(df, ["a", "t"], 16).groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) < 30_000 / 5


@pytest.mark.parametrize("kind", ["string", "date", "timestamp", "decimal(18,2)", "double", "boolean", "int"])
def test_edges_of_clustering(spark, kind):
    empty = spark.createDataFrame([], f"v {kind}, _zorder int, m map<string,int>")
    assert clustered(empty, ["v"]).columns == ["v", "_zorder", "m"] and clustered(empty, ["v"]).count() == 0
    nulls = spark.range(3).selectExpr(f"cast(null as {kind}) as v", "1 as _tie")
    assert rows(clustered(nulls, ["v", "_tie"])) == rows(nulls)
    same = spark.range(5).selectExpr(f"cast({'1' if kind not in ('date', 'timestamp') else repr('2024-01-05')} as {kind}) as v")
    assert rows(clustered(same, ["v"])) == rows(same)


def test_what_cannot_be_clustered(spark, tmp_path):
    df = spark.range(2).selectExpr("id", "array(id) as list")
    with pytest.raises(TypeError, match="list"):
        with_zorder(df, ["list"], "z")
    with pytest.raises(ValueError, match="bits"):
        with_zorder(df, [], "z")
    with pytest.raises(ValueError, match="not both"):
        write_table(df, str(tmp_path / "t"), partition_by=["id"], cluster_by=["id"])
