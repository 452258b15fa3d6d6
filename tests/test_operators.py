"""Shape, deduplication, joins and counts on small tables."""

import random
from collections import Counter
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverline.operators import counts, dedupe, joins, shape


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_normalise_columns_keeps_the_first_of_a_clash(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], [" A B", "a_b", "Date-of.Birth", "x / _ y_"])
    out = shape.normalise_columns(df)
    assert out.columns == ["a_b", "date_of_birth", "x_y_"]
    assert out.first() == (1, 3, 4)


def test_distinct_columns_handles_exact_repeats(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["a", "a", " a "])
    assert shape.distinct_columns(df).collect() == [(1,)]


def test_rename_aliases(spark):
    aliases = {"id": ("ref", "key")}
    both = spark.createDataFrame([(1, 2)], ["key", "ref"])
    assert shape.rename_aliases(both, aliases).columns == ["key", "id"]
    present = spark.createDataFrame([(1, 2)], ["id", "ref"])
    assert shape.rename_aliases(present, aliases).columns == ["id", "ref"]
    none = spark.createDataFrame([(1,)], ["other"])
    assert shape.rename_aliases(none, aliases).columns == ["other"]


def test_require_columns(spark):
    df = spark.createDataFrame([(1,)], ["a"])
    assert shape.require_columns(df, ["a"], "t") is df
    with pytest.raises(ValueError, match="t has no column"):
        shape.require_columns(df, ["a", "b"], "t")


def test_conform_adds_casts_orders_and_drops(spark):
    schema = T.StructType(
        [T.StructField("n", T.IntegerType()), T.StructField("new", T.DateType()), T.StructField("d", T.DecimalType(18, 2))]
    )
    df = spark.createDataFrame([("1.005", "7", "x"), ("junk", "junk", "y")], ["d", "n", "extra"])
    out = shape.conform(df, schema)
    assert out.schema.names == ["n", "new", "d"]
    assert [f.dataType for f in out.schema] == [f.dataType for f in schema]
    assert rows(out) == Counter([(7, None, Decimal("1.01")), (None, None, None)])


def test_nested_text(spark):
    df = spark.createDataFrame([(("GP", 1), "text")], "location struct<province: string, n: int>, flat string")
    picked = df.select(
        shape.nested_text(df, "location", "province").alias("a"),
        shape.nested_text(df, "location", "n").alias("b"),
        shape.nested_text(df, "location", "absent").alias("c"),
        shape.nested_text(df, "flat", "province").alias("d"),
    )
    assert picked.first() == ("GP", "1", None, None)


def test_load_metadata(spark):
    at = datetime(2024, 1, 2, 3)
    df = shape.add_load_metadata(spark.range(3), "src", at)
    assert {(r.source_system, r.ingestion_timestamp) for r in df.collect()} == {("src", at)}
    now = shape.add_load_metadata(spark.range(0, 1000, 1, 8), "src")
    assert now.select("ingestion_timestamp").distinct().count() == 1


def test_present_keys_drops_null_and_blank_only(spark):
    df = spark.createDataFrame([("a",), (" ",), ("",), (None,), ("\t",)], "k string")
    assert rows(dedupe.present_keys(df, "k")) == Counter([("a",), ("\t",)])


DUPLICATES = [
    ("a", datetime(2024, 1, 1), "old"),
    ("a", datetime(2024, 1, 2), "new y"),
    ("a", datetime(2024, 1, 2), "new x"),
    ("a", None, "undated"),
    ("b", None, "z"),
    ("b", None, "y"),
    (" ", datetime(2024, 1, 1), "blank"),
    (None, datetime(2024, 1, 1), "null"),
]


def test_latest_per_key_breaks_ties_by_the_other_columns(spark):
    df = spark.createDataFrame(DUPLICATES, "k string, t timestamp, v string")
    expected = Counter([("a", datetime(2024, 1, 2), "new x"), ("b", None, "y")])
    for parts in (1, 3, 8):
        out = dedupe.latest_per_key(df.repartition(parts), "k", ["t"])
        assert rows(out) == expected
        assert rows(dedupe.latest_per_key(out, "k", ["t"])) == expected


def test_latest_per_key_limits_groups_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 k", "id t", "timestamp_seconds(id) ingestion_timestamp")
    plan = dedupe.latest_per_key(df, "k")._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in before_shuffle
    assert plan.count("Exchange") == 1


def test_one_per_key_keeps_null_as_a_key(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), (None, 4), (None, 3)], "k string, v int")
    assert rows(dedupe.one_per_key(df, "k")) == Counter([("a", 1), (None, 3)])
    assert rows(dedupe.distinct_values(df, "k")) == Counter([("a",), (None,)])


@pytest.fixture(scope="module")
def skewed(spark):
    """Key 'hot' holds a third of all rows; some keys are NULL, some have no match."""
    left = spark.range(3000).selectExpr(
        "id",
        "case when id % 3 = 0 then 'hot' when id % 50 = 1 then null else 'k' || (id % 40) end as k",
    )
    lookup = spark.range(30).selectExpr("'k' || id as k", "id * 10 as v").union(
        spark.createDataFrame([("hot", -1), ("unused", -2)], "k string, v long")
    )
    return left, lookup


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_split_join_equals_plain_join(skewed, how):
    left, lookup = skewed
    hot = joins.hot_keys(left, "k", rows_per_task=100)
    plain = joins.lookup_join(left, lookup, "k", how)
    split = joins.lookup_join(left, lookup, "k", how, hot, spread_by="id")
    assert split.columns == plain.columns
    assert rows(split) == rows(plain)
    # Whatever is listed as hot, the result stays.
    one = joins.hot_keys(left, "k", rows_per_task=10).limit(1)
    assert rows(joins.lookup_join(left, lookup, "k", how, one, spread_by="id")) == rows(plain)


def test_hot_keys_are_split_into_even_parts(skewed):
    left, _ = skewed
    hot = joins.hot_keys(left, "k", rows_per_task=100)
    assert rows(hot) == Counter([("hot", 10)])
    parts = left.where("k = 'hot'").selectExpr("pmod(xxhash64(id), 10) p").groupBy("p").count().collect()
    assert len(parts) == 10
    assert max(r["count"] for r in parts) < 200
    assert joins.hot_keys(left, "k").count() == 0


def test_every_key_above_the_bound_is_hot(spark):
    # Twenty keys of 50 rows, 400 keys of one: with a share of 1 / 40 the bound is 35 rows.
    big = spark.range(1000).selectExpr("string(id % 20) as k", "id")
    small = spark.range(400).selectExpr("'s' || id as k", "id + 5000 as id")
    left = big.unionByName(small)
    hot = joins.hot_keys(left, "k", rows_per_task=10, most=40)
    assert rows(hot) == Counter((str(i), 5) for i in range(20))
    assert joins.hot_keys(left, "k", rows_per_task=10, most=20).count() == 0  # 70 rows are a twentieth
    lookup = left.select("k").distinct().selectExpr("k", "length(k) as v")
    split = joins.lookup_join(left, lookup, "k", "inner", hot, spread_by="id")
    assert rows(split) == rows(joins.lookup_join(left, lookup, "k"))
    plan = hot._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "Limit" not in plan


@pytest.mark.parametrize("buckets", [1, 3, 64, joins.BUCKETS])
@pytest.mark.parametrize(("rows_per_task", "most"), [(5, 1000), (40, 10), (1, 10**9)])
def test_hot_keys_equal_a_count_of_every_key(spark, buckets, rows_per_task, most):
    """Whatever shares a bucket, the list is that of counting all keys; NULL is no key, an empty table has none."""
    draw = random.Random(buckets + most)
    keys = [None if i % 17 == 0 else f"k{int(draw.paretovariate(0.7)) % 300}" for i in range(3000)]
    left = spark.createDataFrame([(k,) for k in keys], "k string")
    counts = Counter(k for k in keys if k is not None)
    bound = max(rows_per_task, counts.total() / most)
    expected = Counter((k, -(-n // rows_per_task)) for k, n in counts.items() if n > bound)
    assert rows(joins.hot_keys(left, "k", rows_per_task, most, buckets)) == expected
    assert joins.hot_keys(left.limit(0), "k", rows_per_task, most, buckets).count() == 0


def test_hot_keys_move_buckets_and_suspects_only(spark, tmp_path):
    """No exchange by the key but behind the join that leaves keys of full buckets only."""
    spark.range(20_000).selectExpr("if(id % 4 = 0, 'hot', 'k' || id) as k").write.parquet(str(tmp_path / "t"))
    left = spark.read.parquet(str(tmp_path / "t"))
    hot = joins.hot_keys(left, "k", rows_per_task=1000)
    plan = hot._jdf.queryExecution().executedPlan().toString()
    by_key = plan.index("Exchange hashpartitioning(k#")
    assert plan.count("hashpartitioning(k#") == 1
    assert by_key < plan.index("LeftSemi") and "BroadcastHashJoin" in plan
    assert "SortMergeJoin" not in plan
    assert rows(hot) == Counter([("hot", 5)])
    assert plan.count("Exchange hashpartitioning") == 2  # buckets, and keys of full buckets
    counted = joins.bucket_counts(left, "k")
    assert counted.agg(F.sum("_rows")).first()[0] == 20_000
    assert joins.bucket_counts(left, "k", 8).count() <= 8


def test_split_join_needs_a_spread_column(skewed):
    left, lookup = skewed
    with pytest.raises(ValueError, match="spread_by"):
        joins.lookup_join(left, lookup, "k", hot=joins.hot_keys(left, "k"))


def test_unmatched_counts(spark, skewed):
    left, lookup = skewed
    known = {r.k for r in lookup.collect()}
    keys = [r.k for r in left.collect()]
    missing = [k for k in keys if k not in known]
    assert joins.unmatched_row_count(left, lookup, "k", "n").first().n == len(missing)
    assert joins.unmatched_keys(left, lookup, "k").count() == len(set(missing))
    assert joins.unmatched_keys(left, lookup, "k", ignore_null=True).count() == len(set(missing) - {None})
    empty = left.limit(0)
    assert joins.unmatched_row_count(empty, lookup, "k", "n").first().n == 0


def test_counts(spark):
    df = spark.createDataFrame(
        [("a", 1, "1.10"), ("a", None, "2.20"), (None, None, None), (None, 4, "0.05"), ("b", 5, None)],
        "k string, n int, t string",
    ).withColumn("amount", F.col("t").cast("decimal(18,2)"))
    assert counts.row_count(df).first() == (5,)
    assert counts.null_counts(df, ["k", "n", "zz"]).first() == (2, 2, -1)
    assert counts.duplicate_groups(df, ["k"]).first() == (2,)
    assert counts.duplicate_groups(df, ["k", "n"]).first() == (0,)
    assert counts.duplicate_groups(df, ["zz"]).first() == (-1,)
    assert counts.amount_summary(df).first() == (5, 3.35, 1.116667, 0.05, 2.2)
    profile = counts.table_profile(df, "k", ["k", "n", "zz"], "amount").first().asDict()
    assert profile == {
        "rows": 5,
        "nulls_k": 2,
        "nulls_n": 2,
        "nulls_zz": -1,
        "amount_total": 3.35,
        "amount_average": 1.116667,
        "amount_minimum": 0.05,
        "amount_maximum": 2.2,
        "duplicates": 2,
    }
    assert counts.table_profile(df, "zz").first().asDict() == {"rows": 5, "duplicates": -1}


def test_counts_of_an_empty_table(spark):
    df = spark.createDataFrame([], "k string, amount decimal(18,2)")
    profile = counts.table_profile(df, "k", ["k"], "amount").first().asDict()
    assert profile["rows"] == 0
    assert profile["duplicates"] == 0
    assert profile["nulls_k"] == 0
    assert profile["amount_average"] is None
    assert counts.duplicate_groups(df, ["k"]).first() == (0,)
