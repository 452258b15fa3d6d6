"""Keys stay unique where hashes do not, and stay the same from run to run."""

import random

import pytest
from pyspark.sql import functions as F

from silverline import functions as fn
from silverline.operators import keyring


def table(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "id string")


def keys(df, resolved, modulus):
    return {r["id"]: r["sk"] for r in keyring.add_key(df, "id", "sk", resolved, modulus).collect()}


@pytest.mark.parametrize(("n", "modulus"), [(300, 1009), (300, 400), (50, 53), (300, 2**31 - 1)])
def test_short_hashes_give_distinct_keys(spark, n, modulus):
    ids = table(spark, [f"C{i}" for i in range(n)] * 2)
    resolved = keyring.resolve_collisions(ids, "id", modulus=modulus)
    found = keys(ids, resolved, modulus)
    assert len(found) == n == len(set(found.values())) and all(0 <= k < modulus for k in found.values())
    plain = keys(ids, None, modulus)
    assert (resolved is None) == (len(set(plain.values())) == n)
    # As many ids keep their hash as there are hashes.
    assert sum(found[i] == plain[i] for i in found) >= len(set(plain.values())) - (resolved.count() if resolved else 0)
    if resolved is not None:
        assert {r["id"] for r in resolved.collect()} >= {i for i in found if found[i] != plain[i]}
    faults = keyring.key_faults(keyring.add_key(ids, "id", "sk", resolved, modulus), "id", "sk").first()
    assert (faults.repeated, faults.collided) == (n, 0)


def test_given_keys_never_change(spark):
    modulus, draw = 211, random.Random(3)
    ids = [f"K{i}" for i in range(160)]
    draw.shuffle(ids)
    resolved = owners = None
    known = {}
    for size in (40, 90, 91, 160):
        now = table(spark, ids[:size])
        resolved = keyring.resolve_collisions(now, "id", resolved, owners, modulus)
        owners = keyring.add_key(now, "id", "sk", resolved, modulus)
        found = {r["id"]: r["sk"] for r in owners.collect()}
        assert len(set(found.values())) == size
        assert {i: found[i] for i in known} == known
        known = found
    # An id stays where it was put when the one it gave way to is gone.
    moved = {r["id"] for r in resolved.collect()}
    alone = table(spark, sorted(moved))
    again = keyring.resolve_collisions(alone, "id", resolved, None, modulus)
    assert keys(alone, again, modulus) == {i: known[i] for i in moved}


def test_real_hashes_need_no_list(spark):
    ids = table(spark, [None, "", "C1", " C1", "C2"])
    assert keyring.resolve_collisions(ids.where("id is not null"), "id") is None
    plain = keyring.add_key(ids, "id", "sk").withColumn("own", fn.surrogate_key(F.col("id")))
    assert plain.where("sk <> own").count() == 0
    assert keyring.resolve_collisions(ids, "id") is None  # NULL and the empty text are one id
    assert keyring.resolve_collisions(table(spark, []), "id", modulus=7) is None


def test_too_few_keys_are_told(spark, monkeypatch):
    monkeypatch.setattr(keyring, "ATTEMPTS", 3)
    with pytest.raises(ValueError, match="too few"):
        keyring.resolve_collisions(table(spark, map(str, range(20))), "id", modulus=7)


@pytest.mark.parametrize("sent", [0, 10**6])
def test_a_long_list_is_joined_instead_of_sent(spark, monkeypatch, sent):
    monkeypatch.setattr(keyring, "SENT", sent)
    ids = table(spark, [f"C{i}" for i in range(100)])
    resolved = keyring.resolve_collisions(ids, "id", modulus=211)
    keyed = keyring.add_key(ids, "id", "sk", resolved, 211)
    assert keyed.select("sk").distinct().count() == 100
    logical = keyed._jdf.queryExecution().optimizedPlan().toString()
    assert ("strategy=broadcast" in logical) == (sent > 0)


def test_collisions_are_told_from_duplicates(spark):
    rows = [("a", 1), ("a", 1), ("b", 2), ("c", 2), ("d", 3), ("e", 4), ("e", 4), ("f", 4), (None, 5), ("", 5)]
    faults = keyring.key_faults(spark.createDataFrame(rows, "id string, sk long"), "id", "sk").first()
    assert (faults.repeated, faults.collided) == (3, 2)  # 1, 4 and 5; 2 and 4


def test_lists_above_the_bound_are_not_sent_to_the_driver(spark, monkeypatch):
    """However small Spark finds them: written lists are below its own threshold for a broadcast."""
    modulus, plans = 211, []
    ids = table(spark, [f"K{i}" for i in range(160)])
    expected = keys(ids, keyring.resolve_collisions(ids, "id", modulus=modulus), modulus)
    written = keyring.materialised

    def noted(df, purpose):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return written(df, purpose)

    monkeypatch.setattr(keyring, "SENT", 0)
    monkeypatch.setattr(keyring, "materialised", noted)
    resolved = keyring.resolve_collisions(ids, "id", modulus=modulus)
    plans.append(keyring.add_key(ids, "id", "sk", resolved, modulus)._jdf.queryExecution().executedPlan().toString())
    assert len(plans) > 4 and not any("BroadcastExchange" in plan for plan in plans)
    assert keys(ids, resolved, modulus) == expected
