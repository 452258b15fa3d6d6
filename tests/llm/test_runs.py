"""Periodic runs against brute force: as a function, over odd rows, and the registered query."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from silverline.llm import runs
from silverline.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_force(words, length=24, repeats=3):
    n, found = len(words), []
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            end = i
            while end + q < n and words[end] == words[end + q]:
                end += 1
            if end + q - i >= max(length, repeats * q):
                own = words[i : end + q]
                if all(own[d:] != own[:-d] for d in range(1, q)):
                    found.append((i, end + q - i, q))
            i = max(end, i + 1)
    return sorted(found)


def dropped(found):
    return {i for start, length, q in found for i in range(start + q, start + length)}


@pytest.mark.parametrize(("length", "repeats"), [(24, 3), (6, 2), (1, 2), (9, 3), (5, 4)])
def test_runs_match_brute_force(length, repeats):
    draw = random.Random(length)
    for _ in range(300):
        n, letters = draw.randint(0, 70), draw.choice([1, 2, 3, 6])
        words = [draw.randrange(letters) for _ in range(n)]
        if n and draw.random() < 0.6:
            a = draw.randrange(n)
            p = 1 + (n - a) // draw.randint(2, 9)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        found = runs.find_runs(np.array([*words, -1]), length, repeats)
        assert found == brute_force(words, length, repeats)
        assert np.flatnonzero(~runs.kept_words(n, found)).tolist() == sorted(dropped(found))


def test_ties_of_the_strongest_run():
    assert runs.strongest([]) is None
    assert runs.strongest([(0, 30, 3), (5, 20, 2), (9, 50, 5)]) == (0, 30, 3)
    assert runs.strongest([(0, 30, 3), (5, 21, 2)]) == (5, 21, 2)


def test_one_period_is_no_run():
    with pytest.raises(ValueError, match="two periods"):
        runs.find_runs(np.array([1, 1, 2]), 1, 1)


def test_odd_rows(docs, none):
    clash = docs.withColumns({"runs": F.lit("old"), "N_WORDS": F.lit(-1), "start": F.lit(7), "_runs": F.lit("mine")})
    rows = runs.periodic_runs(clash).collect()
    assert len(rows) == docs.count()
    for row in rows:
        words = WORD.findall(row["text"] or "")
        assert row["n_words"] == len(words) and (row["start"], row["_runs"]) == (7, "mine")
        if len(words) < 1000:
            expected = brute_force(words)
            assert [tuple(r) for r in row["runs"]] == expected
            out = dropped(expected)
            assert row["collapsed"] == " ".join(w for i, w in enumerate(words) if i not in out)
    # The very long text is one loop of five words.
    long = next(r for r in rows if r["doc_id"] == 7)
    assert [tuple(r) for r in long["runs"]] == [(0, 40000, 5)] and tuple(long["strongest"]) == (0, 40000, 5)
    assert long["collapsed"] == "one two three four five"
    assert runs.periodic_runs(none).collect() == []


def test_texts_sorted_together_do_not_meet(spark, monkeypatch):
    monkeypatch.setattr(runs, "TOGETHER", 50)
    loop = "a b c " * 10
    docs = spark.createDataFrame([(i, loop) for i in range(20)], "doc_id long, text string").coalesce(1)
    rows = runs.periodic_runs(docs).collect()
    assert all([tuple(x) for x in r["runs"]] == [(0, 30, 3)] for r in rows) and len(rows) == 20


def planted(doc_id, text):
    words = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def test_registered_query_matches_brute_force(spark, tables):
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{tables}/documents.parquet").collect()}
    rows = QUERIES["op11_periodic_runs"](spark, tables).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    assert any(r["n_runs"] for r in rows)
    for row in rows:
        words = planted(row["doc_id"], texts[row["doc_id"]])
        expected = brute_force(words)
        assert row["n_runs"] == len(expected)
        best = runs.strongest(expected) or (None, None, None)
        assert (row["start"], row["length"], row["period"]) == best
        assert row["exponent_milli"] == (best[0] if best[0] is None else 1000 * best[1] // best[2])
        assert row["runs_sha256"] == sha("".join(f"{s},{n},{q}\n" for s, n, q in expected))
        out = dropped(expected)
        assert row["collapsed_sha256"] == sha(" ".join(w for i, w in enumerate(words) if i not in out))
