"""Keys are checked by their hashes alone, columns are read without needless patterns, independent steps run at the same time."""

import threading

import pytest
from pyspark.sql import functions as F

from silverline import functions as fn
from silverline.fixed_values import PROVINCES
from silverline.functions.categories import canonical
from silverline.functions.times import CLOCK
from silverline.operators import keyring
from silverline.plans import layers


def customers(spark, ids):
    return spark.createDataFrame([(value,) for value in ids], "customer_id string")


def test_provinces_are_folded_as_by_the_pattern(spark):
    texts = [f"{a}{b}{c}" for a in ("", " ", "\t", "_") for b in ("KwaZulu", "nw", "x", "\u00a0") for c in ("", "_", "  ", *"\t\n\x0b\f\r\x1f")]
    texts = [None, "", *texts, *(t + "natal" for t in texts), *(t.strip() + " Natal" for t in texts)]
    text = F.col("customer_id")
    pattern = canonical(F.upper(F.trim(F.regexp_replace(text, r"[\s_]+", " "))), PROVINCES, F.trim(text))
    rows = customers(spark, texts).select(fn.province(text).alias("found"), pattern.alias("expected")).collect()
    assert len(rows) == len(texts) and all(r.found == r.expected for r in rows)
    assert {"KwaZulu-Natal", "North West", None} <= {r.found for r in rows}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_a_time_is_that_of_the_date_that_is_read_alone(spark, zone):
    days = [None, "", "x", "2024-02-30", "30/02/2024", " 10/03/2024 ", "2024-03-10", "0000-01-01", "-0044-03-15", "15/03/-0044", "+12345-01-02"]
    days += ["1/2/2024", "2024-1-2", "1700000000", "1700000000123", "170000000", "01/01/2024x", "2024-01-01T00", "01/01/2024\n", "-290309-01-01"]
    clocks = [None, "02:30:00", " 02:30:00 ", "24:00:00", "9:00", "23:59:59", ""]
    rows = spark.createDataFrame([(d, c) for d in days for c in clocks], "d string, c string")
    clock = F.coalesce(F.trim("c"), F.lit("00:00:00"))
    stamp = F.concat(fn.flexible_date(F.col("d")).cast("string"), F.lit(" "), clock)
    expected = F.when(clock.rlike(CLOCK), stamp).try_cast("timestamp")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        found = rows.select(fn.date_and_time(F.col("d"), F.col("c")).cast("string").alias("found"), expected.cast("string").alias("expected"))
        differ = found.where(~F.col("found").eqNullSafe(F.col("expected"))).collect()
        assert not differ and found.where("found is not null").count() > 20
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_ids_are_compared_only_where_a_hash_is_repeated(spark, monkeypatch):
    ids = customers(spark, [f"C{i}" for i in range(50)])
    assert keyring.most_per_hash(ids, "customer_id") == 1
    assert keyring.most_per_hash(ids.limit(0), "customer_id") == 0
    assert keyring.most_per_hash(ids, "customer_id", 7) > 1 and keyring.resolve_collisions(ids, "customer_id", modulus=499)
    monkeypatch.setattr(keyring, "shared_hashes", None)
    assert keyring.resolve_collisions(ids, "customer_id") is None


def test_independent_steps_run_at_the_same_time_and_errors_are_raised(spark):
    meet = threading.Barrier(3, timeout=20)
    assert len(layers.side_by_side(spark, [meet.wait] * 3)) == 3
    assert layers.side_by_side(spark, []) == []
    ended = []
    with pytest.raises(ZeroDivisionError):
        layers.side_by_side(spark, [lambda: 1 / 0, lambda: ended.append(1)])
    assert ended == [1]
