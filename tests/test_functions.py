"""Column functions on literal edge values, under ANSI mode and without it."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from silverline import functions as fn
from silverline.fixed_values import CURRENCIES, PROVINCES, TRANSACTION_TYPES


@pytest.fixture(params=["true", "false"], ids=["ansi", "lenient"])
def either_mode(spark, request):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield spark
    spark.conf.set("spark.sql.ansi.enabled", before)


def applied(spark, function, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    return [r.out for r in df.select("i", function(F.col("v")).alias("out")).orderBy("i").collect()]


def check(spark, function, expected):
    assert dict(zip(expected, applied(spark, function, list(expected)), strict=True)) == expected


def test_flexible_date(either_mode):
    day = date(2024, 1, 5)
    check(
        either_mode,
        fn.flexible_date,
        {
            "2024-01-05": day,
            " 2024-01-05 ": day,
            "05/01/2024": day,
            "5/1/2024": None,
            "2024-1-5": None,
            "2024-02-30": None,
            "2024-02-29": date(2024, 2, 29),
            "2023-02-29": None,
            "32/01/2024": None,
            "01/13/2024": None,
            "1704412800": day,
            "1704412800123": day,
            "1704499199999": day,
            "170441280": None,
            "17044128001": None,
            "0000000000": date(1970, 1, 1),
            "2024-01-05 10:00:00": None,
            "2024-01-05T10:00:00": None,
            "12024-01-05": None,
            "2024/01/05": None,
            "\t2024-01-05": None,
            "2024-01-05\n": None,
            "n/a": None,
            "-": None,
            "": None,
            None: None,
        },
    )


def test_date_and_time(either_mode):
    rows = {
        ("2024-01-05", "10:00:00"): datetime(2024, 1, 5, 10),
        ("05/01/2024", " 23:59:59 "): datetime(2024, 1, 5, 23, 59, 59),
        ("1704412800", None): datetime(2024, 1, 5),
        ("2024-01-05", ""): None,
        ("2024-01-05", "9:00:00"): None,
        ("2024-01-05", "10:00"): None,
        ("2024-01-05", "24:00:00"): None,
        ("2024-01-05", "10:60:00"): None,
        ("2024-01-05", "10:00:00\n"): None,
        (None, "10:00:00"): None,
        ("junk", "10:00:00"): None,
        (None, None): None,
    }
    df = either_mode.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, d string, t string")
    out = df.select("i", fn.date_and_time(F.col("d"), F.col("t")).alias("out")).orderBy("i").collect()
    assert [r.out for r in out] == list(rows.values())


def test_event_time_precedence(spark):
    df = spark.createDataFrame(
        [("2024-01-01 09:00:00", "2024-02-02", "10:00:00"), ("junk", "03/02/2024", None)],
        "datetime string, txn_date string, time string",
    )
    cases = {
        ("datetime", "txn_date", "time"): [datetime(2024, 1, 1, 9), None],
        ("txn_date", "time"): [datetime(2024, 2, 2, 10), datetime(2024, 2, 3)],
        ("txn_date",): [datetime(2024, 2, 2), datetime(2024, 2, 3)],
        ("time",): [None, None],
    }
    for columns, expected in cases.items():
        found = df.select(fn.event_time(columns).alias("out")).collect()
        assert [r.out for r in found] == expected, columns


def test_first_existing_column():
    from silverline.functions.times import first_existing

    assert first_existing(["b", "c"], ["a", "c", "b"], "x") == "c"
    with pytest.raises(ValueError, match="tried"):
        first_existing(["b"], ["a"], "x")


@pytest.mark.parametrize(
    ("function", "table"),
    [(fn.transaction_type, TRANSACTION_TYPES), (fn.currency, CURRENCIES), (fn.province, PROVINCES)],
)
def test_every_listed_spelling(spark, function, table):
    spellings = {s: name for name, listed in table.items() for s in listed}
    variants = {v: name for s, name in spellings.items() for v in (s, s.lower(), f"  {s.title()} ")}
    check(spark, function, variants)
    check(spark, function, {name: name for name in table})


def test_unlisted_spellings(spark):
    check(spark, fn.transaction_type, {" transfer ": "TRANSFER", "": "", None: None, "\tcr": "\tCR"})
    check(spark, fn.currency, {" usd": "USD", "ZAR ": "ZAR", None: None})
    check(
        spark,
        fn.province,
        {
            " eastern__cape ": "Eastern Cape",
            "KWAZULU_NATAL": "KwaZulu-Natal",
            "kwazulu \t natal": "KwaZulu-Natal",
            "\twc\n": "Western Cape",
            " Some_Where ": "Some_Where",
            None: None,
        },
    )


def test_tolerant_int(either_mode):
    check(
        either_mode,
        fn.tolerant_int,
        {
            "5": 5,
            " 5 ": 5,
            "+5": 5,
            "-5": -5,
            "5.7": 5,
            "5.999": 5,
            "-5.7": -5,
            ".5": 0,
            "-.5": 0,
            "5.": 5,
            ".": 0,
            "1e3": None,
            "1,000": None,
            "5.7x": None,
            "5.7.1": None,
            "abc": None,
            "-": None,
            "2147483647": 2147483647,
            "2147483648": None,
            "99999999999.5": None,
            "": None,
            None: None,
        },
    )


def test_tolerant_decimal(either_mode):
    check(
        either_mode,
        fn.tolerant_decimal,
        {
            "12.345": Decimal("12.35"),
            "-12.345": Decimal("-12.35"),
            " 5 ": Decimal("5.00"),
            "1e3": Decimal("1000.00"),
            "1,000": None,
            "9999999999999999.99": Decimal("9999999999999999.99"),
            "99999999999999999.99": None,
            "abc": None,
            "": None,
            None: None,
        },
    )


def test_age_band(spark):
    as_of = date(2024, 6, 30)
    born = {
        date(2006, 7, 1): None,
        date(2006, 6, 30): "18-25",
        date(1998, 7, 1): "18-25",
        date(1998, 6, 30): "26-35",
        date(1988, 6, 30): "36-45",
        date(1978, 6, 30): "46-55",
        date(1968, 7, 1): "46-55",
        date(1968, 6, 30): "56-65",
        date(1959, 7, 1): "56-65",
        date(1959, 6, 30): "65+",
        date(2030, 1, 1): None,
        None: None,
    }
    df = spark.createDataFrame(list(enumerate(born)), "i int, dob date")
    found = df.select("i", fn.age_band(F.col("dob"), as_of).alias("out")).orderBy("i").collect()
    assert [r.out for r in found] == list(born.values())


def test_age_band_counts_month_ends_and_defaults_to_today(spark):
    df = spark.createDataFrame([(date(2000, 2, 29),)], "dob date")
    on_the_28th = fn.age_band(F.col("dob"), date(2018, 2, 28))
    assert df.select(on_the_28th.alias("out")).first().out == "18-25"
    assert df.select(fn.age_band(F.add_months(F.current_date(), -18 * 12)).alias("out")).first().out == "18-25"


def test_surrogate_key(spark):
    df = spark.createDataFrame([("a", "b"), ("ab", ""), ("ab", None), (None, None), ("", "")], "a string, b string")
    keys = [r.k for r in df.select(fn.surrogate_key(F.col("a"), F.col("b")).alias("k")).collect()]
    assert keys[0] != keys[1]
    assert keys[1] == keys[2]
    assert keys[3] == keys[4]
    assert all(0 <= k <= 2**63 - 2 for k in keys)
    # The value itself: xxhash64 of the texts modulo 2^63 - 1.
    expected = df.selectExpr("pmod(xxhash64(a, b), 9223372036854775807) k").first().k
    assert keys[0] == expected


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=" _\tabcECeczarRND/-.0159", max_size=12), min_size=1, max_size=40))
def test_standardisers_are_idempotent(spark, values):
    for function in (fn.transaction_type, fn.currency, fn.province):
        once = applied(spark, function, values)
        assert applied(spark, function, once) == once
