"""Figures observed while a table is written: the same report, without reading the tables for them."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from silverline import sources
from silverline.operators.counts import figure_columns, table_profile
from silverline.plans import layers, validation

LOADED = datetime(2024, 6, 1)


def amounts(spark, rows):
    return spark.createDataFrame(rows, "k string, v string, amount decimal(18,2)")


@pytest.mark.parametrize(
    "rows",
    [
        [],
        [("a", None, Decimal("1.10")), (None, "x", None), ("a", "x", Decimal("-2.25")), ("b", None, Decimal("3.00"))],
        [("a", "x", None)],
    ],
)
@pytest.mark.parametrize("partition_by", [(), ("v",)])
def test_observed_figures_equal_the_profile(spark, tmp_path, rows, partition_by):
    df = amounts(spark, rows)
    observed = sources.write_table(
        df, str(tmp_path / "t"), partition_by=partition_by, figures=figure_columns(df, ("k", "absent"), "amount")
    )
    expected = table_profile(df, None, ("k", "absent"), "amount").first().asDict()
    assert observed == expected
    if rows or not partition_by:  # an empty table laid out by values has no files
        assert sources.read_table(spark, str(tmp_path / "t")).count() == len(rows)
    assert sources.write_table(df, str(tmp_path / "u")) is None


@pytest.fixture(scope="module")
def layout(spark, tmp_path_factory):
    layout = layers.Layout(str(tmp_path_factory.mktemp("figures")))
    n = 40
    raw = {
        "customers": spark.range(n).selectExpr("'C' || (id % 30) as customer_id", "'gp' as province"),
        "accounts": spark.range(n).selectExpr("'A' || id as account_id", "'C' || id as customer_id"),
        "transactions": spark.range(n).selectExpr(
            "if(id % 9 = 0, null, 'T' || id) as transaction_id", "'A' || (id % 35) as account_id",
            "'2024-01-05' as transaction_date", "if(id % 7 = 0, 'x', string(id / 4)) as amount", "'cr' as transaction_type",
        ),
    }
    layers.run(spark, raw, layout, LOADED, date(2024, 6, 30), stages=("bronze", "silver", "gold"))
    return layout


def test_the_report_is_the_same_without_those_scans(spark, layout):
    tables = sources.open_tables(spark, layout.paths())
    figures = layers.table_figures(spark, layout)
    assert all(figures[name] is not None for name in tables)
    read = validation.validation_report(tables)
    observed = layers.validate(spark, layout)
    assert sorted(map(tuple, read.collect())) == sorted(map(tuple, observed.collect()))
    scans = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    for name in ("bronze_customers", "bronze_accounts", "bronze_transactions"):
        columns = set(tables[name].columns) - {"ingestion_timestamp", "source_system"}
        assert columns and f"/{name.replace('_', '/', 1)}" not in locations(observed)
    assert scans(observed).count("Relation") < scans(read).count("Relation") + len(tables)


def locations(df):
    """The folders that a report reads its rows from."""
    return "\n".join(df.inputFiles())


def test_a_table_without_figures_is_read(spark, layout):
    tables = sources.open_tables(spark, layout.paths())
    figures = dict(layers.table_figures(spark, layout), silver_accounts=None)
    mixed = validation.validation_report(tables, figures=figures)
    assert sorted(map(tuple, mixed.collect())) == sorted(map(tuple, validation.validation_report(tables).collect()))
    assert "/silver/accounts" in locations(mixed)


def test_figures_are_those_of_the_last_write(spark, layout, tmp_path):
    other = layers.Layout(str(tmp_path))
    for n in (5, 3):
        layers.load_bronze({"customers": spark.range(n).select(F.col("id").cast("string").alias("customer_id"))}, other, LOADED)
        assert layers.table_figures(spark, other)["bronze_customers"].first().rows == n
