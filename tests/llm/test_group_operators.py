"""Operators that bring rows together: shards, fingerprints, urls, preferences, co-training; and the pipeline."""

import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from silverline.llm import cotraining, decontaminate, langid, preference, quality, sharding, simhash, tokens, urls
from silverline.llm.oracle import SQL
from silverline.llm.queries import QUERIES

# Shards


def check_shards(rows, shards):
    counts = Counter(r["shard"] for r in rows)
    sizes = [counts.get(s, 0) for s in range(shards)]
    assert sum(sizes) == len(rows) and max(sizes) - min(sizes) <= 1
    for s in range(shards):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sizes[s]))


def test_shards_of_odd_rows(docs, none):
    clash = docs.withColumns({"slot": F.lit("old"), "_rank": F.lit(1), "rows": F.lit(2)})
    rows = sharding.interleaved_shards(clash, 5).collect()
    check_shards(rows, 5)
    assert Counter((r["doc_id"], r["text"]) for r in rows) == Counter((r["doc_id"], r["text"]) for r in docs.collect())
    assert {r["_rank"] for r in rows} == {1}
    assert sharding.interleaved_shards(none, 5).count() == 0


def test_shards_match_the_mixture_and_the_definition(spark):
    n = 3000  # a third from one source
    rows = [(i, f"text {i}", None if i % 7 == 0 else "hot" if i % 3 == 0 else f"s{i % 5}") for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = sharding.interleaved_shards(docs, 8, cells=16).collect()
    check_shards(found, 8)
    again = sharding.interleaved_shards(docs.repartition(5), 8, cells=16).collect()
    place = lambda rows: {r["doc_id"]: (r["shard"], r["slot"]) for r in rows}
    assert place(found) == place(again)
    assert place(found) != place(sharding.interleaved_shards(docs, 8, seed=1, cells=16).collect())
    # In sequence, every prefix holds each source in its proportion, to one row.
    sequence = [r["source"] for r in sorted(found, key=lambda r: (r["shard"], r["slot"]))]
    of = Counter(sequence)
    seen = Counter()
    for i, source in enumerate(sequence, 1):
        seen[source] += 1
        assert all(abs(seen[s] - of[s] * i / n) <= len(of) for s in of)


def test_registered_shards(spark, tables):
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in spark.read.parquet(f"{tables}/documents.parquet").collect()}
    rows = QUERIES["op1_interleaved_shards"](spark, tables).collect()
    check_shards(rows, 24)
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in rows} == {k: (len(t) + 8, zlib.crc32(t)) for k, t in texts.items()}
    assert all(r["law"] == "rows" and r["grown_shard"] is None for r in rows)


# Fingerprints


def brute_fingerprint(text):
    words = [w for w in (text or "").translate({c: c + 32 for c in range(65, 91)}).replace("\x0b", " ").split(" ") if w]
    words = [w for part in words for w in part.replace("\t", "\n").replace("\r", "\n").replace("\f", "\n").split("\n") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def brute_groups(values):
    """The least index that each is linked with, over any number of links."""
    group = list(range(len(values)))
    for i, a in enumerate(values):
        for j in range(i):
            if (a ^ values[j]).bit_count() <= 3 and group[i] != group[j]:
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = [new if g == old else g for g in group]
    return group


def test_fingerprints(docs):
    rows = simhash.fingerprints(docs.withColumn("fingerprint", F.lit("old"))).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r["fingerprint"] % (1 << 64) == brute_fingerprint(r["text"])


@pytest.mark.parametrize("cell", [2048, 7])
def test_components_match_brute_force(spark, cell):
    rng = np.random.default_rng(2)
    values = [0, (1 << 64) - 1]
    for _ in range(25):  # chains of links, and dense balls
        value = int(rng.integers(0, 1 << 63)) * 2
        for _ in range(int(rng.integers(1, 12))):
            values.append(value)
            for bit in rng.integers(0, 64, int(rng.integers(1, 6))):
                value ^= 1 << int(bit)
    centre = int(rng.integers(0, 1 << 62))
    values += [centre ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 64, (120, 2)) if a != b]
    keys = [None if i % 11 == 0 else i for i in range(len(values))]
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    printed = spark.createDataFrame(list(zip(keys, signed, strict=True)), "doc_id long, fingerprint long")
    found = {r["fingerprint"]: r for r in simhash.duplicate_groups(printed, cell=cell).collect()}
    groups = brute_groups(values)
    for i, group in enumerate(groups):
        members = [keys[k] for k, g in enumerate(groups) if g == group and keys[k] is not None]
        assert found[signed[i]]["component_id"] == min(members, default=None)
    assert len({found[s]["group"] for s in signed}) == len(set(groups))


def test_near_duplicates_of_odd_rows(docs, none):
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    blank = {r["doc_id"]: r["component_id"] for r in rows if r["fingerprint"] == 0}
    assert blank[3] == blank[4] == blank[5] == 3 and blank[None] == 3
    assert {r["component_id"] for r in rows if r["doc_id"] in (1, 2)} == {1}
    assert simhash.near_duplicates(none).count() == 0
    kept = simhash.one_of_each(docs.withColumn("fingerprint", F.lit("mine"))).collect()
    assert Counter(r["doc_id"] for r in kept) == Counter([1, 3, None, 7, 8, 9, 10])
    assert {r["fingerprint"] for r in kept} == {"mine"}
    assert simhash.one_of_each(none).count() == 0


def test_registered_near_duplicates(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet").orderBy("doc_id").collect()
    values = [brute_fingerprint(r["text"]) for r in docs]
    groups = brute_groups(values)
    expected = {r["doc_id"]: (format(v, "016x"), docs[g]["doc_id"]) for r, v, g in zip(docs, values, groups, strict=True)}
    rows = QUERIES["op7_pivot_simhash"](spark, tables).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows} == expected


# Urls


RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es", "block"),
         ("net", "", "allow"), (None, "/", "block"), ("example.com", "/en/", "block")]
URLS = {
    None: ("", "", None, "keep"),
    "": ("", "", None, "keep"),
    "no scheme.com/": ("", "", None, "keep"),
    "http://A.Example.COM/en/x?q#f": ("a.example.com", "/en/x", "example.com/en/", "block"),
    "http://www.example.com/en/": ("www.example.com", "/en/", "www.example.com/en/", "allow"),
    "http://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"),
    "http://example.com": ("example.com", "", None, "keep"),
    "http://example.com?x=/en/": ("example.com", "", None, "keep"),
    "x://y://z.com/": ("y:", "//z.com/", None, "keep"),
    "http://a.net/estate": ("a.net", "/estate", "net/es", "block"),
    "http://net": ("net", "", "net", "allow"),
    "http://com:80/": ("com:80", "/", None, "keep"),
    "http://é.com/\n/": ("é.com", "/\n/", "com/", "allow"),
    "http://" + "a." * 3000 + "com/" + "b/" * 3000: ("a." * 3000 + "com", "/" + "b/" * 3000, "com/", "allow"),
}


def test_urls(spark):
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    rows = [(i % 3 or None, u) for i, u in enumerate([*URLS, *URLS])]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumns({"rule": F.lit(1), "_row": F.lit("mine")})
    found = urls.judge_urls(pages, rules, default="keep").collect()
    assert len(found) == len(rows)
    for r in found:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == URLS[r["url"]], r["url"]
        assert r["_row"] == "mine"
    assert urls.judge_urls(pages.where("false"), rules).count() == 0
    assert {r["verdict"] for r in urls.judge_urls(pages, rules.where("false")).collect()} == {"allow"}


# Preferences

TURNS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "hello"), (1, 2, "user", "ok"), (1, 3, "assistant", "bye"),
    (2, 0, "user", "hi"), (2, 1, "assistant", "hello"), (2, 2, "user", "no"),
    (3, 0, "user", "hi"), (3, 1, None, "x"), (3, 1, None, "x"),
    (4, 0, "user", None), (4, 1, "assistant", ""),
    (5, 0, "user", None), (5, 1, "assistant", ""),
    (6, 2, "system", "only"), (None, 0, "user", "lost"), (7, None, "user", "no number"),
]


def preference_rows(df):
    masks = {c: preference.mask_text(c) for c in ("chosen_mask", "rejected_mask")}
    return Counter(tuple(r) for r in df.withColumns(masks).collect())


def test_preferences_match_sql_and_literals(spark):
    turns = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string")
    found = preference_rows(preference.preference_examples(turns, preference.opening_pairs(turns, block=2)))
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations(conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", TURNS)
    assert found == Counter(con.sql(SQL["op9_preference_examples"]).fetchall())
    rows = {r[0]: r for r in found}
    assert rows[1][:4] == (1, 2, 2, "<|user|>\nhi<|end|>\n<|assistant|>\nhello<|end|>\n")
    assert rows[1][4:] == (
        "<|user|>\nok<|end|>\n<|assistant|>\nbye<|end|>\n", "<|user|>\nno<|end|>\n", "9x0,10x0,14x0,11x1", "9x0,10x0",
    )
    assert rows[4][1:3] == (5, 2) and rows[4][4:] == ("", "", "", "")
    assert rows[3][1] is None and rows[3][5] is None and rows[3][7] is None
    assert set(rows) == {1, 3, 4, 6, 7}
    empty = turns.where("false")
    assert preference.preference_examples(empty, preference.opening_pairs(empty)).count() == 0


def test_hot_opening_is_paired_completely(spark):
    rows = [(i, t, "user" if t % 2 == 0 else "assistant", "hi" if t == 0 else f"{i}") for i in range(101) for t in range(2)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    pairs = sorted((r["chosen"], r["rejected"]) for r in preference.opening_pairs(turns, block=8).collect())
    assert pairs == [*((i, i + 1) for i in range(0, 100, 2)), (100, None)]


# Co-training


def test_co_training_learns_from_both_views(spark):
    rng = np.random.default_rng(4)
    filler = [f"w{i}" for i in range(60)]
    rows, labels = [], []
    for i in range(900):
        good = i % 3 > 0
        text = " ".join([*rng.choice(filler, 30), *(["fine", "clear"] if good else ["awful", "trash"])])
        rows.append((i, text, "en", "books" if good else "spam", 100))
        if i % 2:
            labels.append((i, int(good), 0) if i % 5 else (i, 1, int(not good)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = cotraining.learn(docs, marks, pool=300)
    found = cotraining.score(docs.withColumn("score", F.lit("old")), model).collect()
    assert len(found) == 900
    assert np.mean([r["keep"] == (r["doc_id"] % 3 > 0) for r in found]) > 0.98
    for view in ("text_score", "meta_score"):
        assert np.mean([(r[view] >= 0.5) == (r["doc_id"] % 3 > 0) for r in found]) > 0.95


def test_co_training_of_odd_rows(spark, docs, none):
    marks = spark.createDataFrame([(1, 1, 0), (1, None, 1), (None, 0, 0)], "doc_id long, quality int, toxic int")
    model = cotraining.learn(docs, marks)
    rows = cotraining.score(docs, model).collect()
    assert len(rows) == docs.count() and all(r["score"] == 0.5 and r["keep"] for r in rows)
    taught = cotraining.learn(docs, spark.createDataFrame([(1, 1, 0), (8, 0, 0), (9, 1, 1)], marks.schema))
    assert all(0 <= r["score"] <= 1 for r in cotraining.score(docs, taught).collect())
    assert cotraining.score(none, cotraining.learn(none, marks)).count() == 0


def test_marks_of_a_small_language_are_learned():
    """Toxic documents of a language of 3 % of the rows, told by words in less than 1 % of all rows."""
    rng = np.random.default_rng(6)
    small, toxic, half = rng.random(6000) < 0.03, rng.random(6000) < 0.25, rng.random(6000) < 0.5
    rows = []
    for s, t in zip(small, toxic, strict=True):
        filler = " ".join(f"{'s' if s else 'b'}{k}" for k in rng.integers(0, 3000, 40))
        marks = [] if not t else rng.choice(["klein", "kurz", "schmal", "eng"], 3, False) if s else rng.choice(["big", "wide"], 1)
        rows.append(cotraining.text_features(" ".join([filler, *marks])))
    assert (small & toxic & half).sum() < 0.01 * half.sum()
    known = np.flatnonzero(half)
    w, bias = cotraining.fit(cotraining.Rows([rows[i] for i in known]), 1.0 - toxic[known], np.ones(len(known)))
    good = cotraining.Rows(rows).dot(w) + bias >= 0
    for some in (small, ~small):
        new = ~half & some
        assert (~good)[new & toxic].mean() > 0.9
        assert good[new & ~toxic].mean() > 0.95


# Registered queries and the pipeline


@pytest.mark.parametrize("name", sorted(SQL))
def test_registered_query_matches_sql(spark, tables, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tables}/{t}.parquet'")
    expected = con.sql(SQL[name])
    df = QUERIES[name](spark, tables)
    assert Counter(tuple(r) for r in df.select(*expected.columns).collect()) == Counter(expected.fetchall())


def test_pipeline_matches_brute_force(spark, tables):
    """Every stage on its own input: what it keeps, decided by other means than the stage's own plan."""
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "quality_rules", "near_duplicates", "decontamination", "best_fit_packing"]
    columns = docs.columns
    before = docs.collect()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, spark.createDataFrame(before, docs.schema), tables)
        assert kept.columns == columns
        after = kept.collect()
        ids = {r["doc_id"] for r in after}
        assert ids <= {r["doc_id"] for r in before} and len(ids) == len(after)
        if name == "language_id":
            assert all(langid.LETTER.search(r["text"]) for r in after)
        elif name == "quality_rules":
            held = quality.measured(spark.createDataFrame(before, docs.schema)).where("not base_failed")
            assert ids <= {r["doc_id"] for r in held.select("doc_id").collect()}
        elif name == "near_duplicates":
            ordered = sorted(before, key=lambda r: r["doc_id"])
            groups = brute_groups([brute_fingerprint(r["text"]) for r in ordered])
            assert ids == {ordered[g]["doc_id"] for g in groups}
        else:
            automaton = decontaminate._automaton(
                tuple((str(r[0]), r[1]) for r in spark.read.parquet(f"{tables}/benchmark.parquet").collect()), 10
            )
            clean = {r["doc_id"] for r in before if not decontaminate.scan(automaton, decontaminate.words(r["text"]))[0]}
            assert ids == clean
        before = after
    packed = corpus_pipeline.STAGES[-1][1](spark, spark.createDataFrame(before, docs.schema), tables).collect()
    ids = tokens.encoder(tokens.public_path()).encode([r["text"] for r in before])
    assert sum(len(r["ids"]) for r in packed) == sum(len(i) + 4 for i in ids)
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in before}
    assert len(corpus_pipeline.run(spark, tables).collect()) == len(packed)
