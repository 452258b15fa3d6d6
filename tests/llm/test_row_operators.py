"""Operators that judge a document in its row: quality, decontamination, languages, tokens, packing."""

import hashlib
import re
import zlib
from collections import Counter
from math import exp, lgamma, log

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from silverline.llm import decontaminate, langid, packing, quality, simple8b, token_files, tokens

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measures(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_measures_match_brute_force(docs):
    clash = docs.withColumn("n_words", F.lit(-1)).withColumn("_words", F.lit("mine"))
    rows = quality.measured(clash).collect()
    assert len(rows) == docs.count()
    for row in rows:
        assert tuple(row[m] for m in quality.MEASURES) == measures(row["text"])
        assert row["base_failed"] == (row["n_words"] < 10 or 100 * row["n_repeat_words"] > 20 * row["n_words"])
        assert row["_words"] == "mine"


def test_measures_of_registered_table(spark, tables):
    rows = quality.measured(spark.read.parquet(f"{tables}/documents.parquet")).collect()
    assert [tuple(r[m] for m in quality.MEASURES) for r in rows] == [measures(r["text"]) for r in rows]


def tail(k, n, p):
    """P(X <= k), summed term by term; what lies above the mean is no evidence."""
    if k > n * p:
        return 1.0
    choose = lambda i: lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1)
    return sum(exp(choose(i) + i * log(p) + (n - i) * log(1 - p)) for i in range(k + 1))


@pytest.mark.parametrize(("k", "n", "p"), [(0, 10, 0.1), (3, 400, 0.01), (1, 900, 0.002), (7, 900, 0.01)])
def test_binomial_tail_is_exact(spark, k, n, p):
    found = spark.range(1).select(F.expr(quality.binomial_tail(f"{k}L", f"{n}L", p))).first()[0]
    assert found == pytest.approx(tail(k, n, p), rel=1e-9)


def labelled(spark, good_symbols, n=4000):
    """Good documents of which ``good_symbols`` have one symbol a word, and bad ones that all have."""
    text = lambda i, s: " ".join(f"word{i}{k}{s}" for k in range(12))
    rows = [(i, text(i, "$" if i < good_symbols else ""), "en", "a", 1) for i in range(n)]
    rows += [(n + i, text(i, "$"), "en", "a", 1) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, int(i < n), 0) for i in range(n + 200)], "doc_id long, quality int, toxic int")
    return docs, labels


@pytest.mark.parametrize(("good_symbols", "rejects"), [(0, True), (100, False)])
def test_cutoffs_are_used_only_when_certified(spark, good_symbols, rejects):
    docs, labels = labelled(spark, good_symbols)
    measured = quality.measured(docs)
    cutoffs = quality.certified_cutoffs(measured, labels)
    row = cutoffs.first()
    assert row["good"] == 4000
    for rule, needed in zip(quality.RULES, row["needed"], strict=True):
        level = quality.LEVEL / len(quality.RULES)
        values = [eval(rule.measure, {}, r.asDict()) for r in measured.where("doc_id < 4000").collect()]
        passing = [
            t
            for t in range(1, len(rule.cutoffs) + 1)
            if tail(sum(sum(v > c for c in rule.cutoffs) >= t for v in values), 4000, quality.ALLOWED / 5) <= level
        ]
        assert needed == min(passing, default=len(rule.cutoffs) + 1)
    kept = quality.quality_verdicts(measured, cutoffs)
    assert kept.where("doc_id >= 4000 and kept").count() == (0 if rejects else 200)


def test_quality_without_labels_keeps_what_the_base_rules_keep(docs, none, spark):
    labels = spark.createDataFrame([(None, 1, 0), (1, None, None)], "doc_id long, quality int, toxic int")
    measured = quality.measured(docs)
    rows = quality.quality_verdicts(measured, quality.certified_cutoffs(measured, labels)).collect()
    assert len(rows) == docs.count() and all(r["kept"] == (not r["base_failed"]) for r in rows)
    empty = quality.measured(none)
    assert quality.quality_verdicts(empty, quality.certified_cutoffs(empty, labels)).count() == 0


def test_joint_path_certifies_some_hundred_labels_and_falls_back(spark, tmp_path):
    """700 good documents a language: too few for five shares of the budget, enough for one path."""
    n, rows, labels = 700, [], []

    def add(lang, good, symbols):
        key = len(rows)
        rows.append((key, " ".join(f"word{key}{k}{'$$$$' if symbols else ''}" for k in range(12)), lang, "a", 1))
        if good is not None:
            labels.append((key, good, 0))

    for i in range(n):
        add("en", 1, False)
        add("fr", 1, i < 70)  # good French has symbols: no step holds
    for i in range(40):
        add("es", 1, False)  # too few labels: what all languages allow together
        add("it", 1, i < 1)
    for lang in ("en", "fr", "es", "it", None):
        for _ in range(50):
            add(lang, None, True)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    measured = quality.measured(docs)

    def lost(some):
        keys = [key for key, good, _ in labels if rows[key][2] in some]
        mine = docs.where(F.col("lang").isin(*some))
        depths = quality.joint_depths(quality.measured(mine), marks.where(F.col("doc_id").isin(keys)))
        kept = quality.joint_verdicts(measured, depths).where("kept")
        left = Counter(r["lang"] for r in kept.where(f"doc_id >= {len(labels)}").select("lang").collect())
        return {r["stratum"]: r["depth"] for r in depths.collect()}, {lang: 50 - left[lang] for lang in ("en", "fr", "es", "it", None)}

    # French speaks against symbols, for itself and for all together; English has its own depth.
    depths, gone = lost(("en", "fr", "es", "it"))
    assert depths["=fr"] == 0 and depths[None] == 0 and depths["=en"] > 20
    assert gone == {"en": 50, "fr": 0, "es": 0, "it": 0, None: 0}
    # Without French, the common depth holds for Spanish and for languages without labels ...
    depths, gone = lost(("en", "es"))
    assert "=es" not in depths and depths[None] == 22 == sum(len(r.cutoffs) for r in quality.RULES[:3])
    assert gone == {"en": 50, "fr": 50, "es": 50, "it": 50, None: 50}
    # ... but not against the labels of Italian.
    depths, gone = lost(("en", "es", "it"))
    assert depths["=it"] == 0 and depths[None] == 22 and gone == {"en": 50, "fr": 50, "es": 50, "it": 0, None: 50}
    assert quality.certified_cutoffs(measured, marks).count() == 0  # five shares certify nothing here
    # The pipeline's stage rejects them as well.
    marks.where(F.col("doc_id").isin([k for k, _, _ in labels if rows[k][2] in ("en", "es")])).write.parquet(f"{tmp_path}/labels.parquet")
    kept = corpus_pipeline.quality_rules(spark, docs, str(tmp_path))
    assert kept.where(f"doc_id >= {len(labels)}").count() == 0 and kept.where("lang = 'en'").count() == n


def test_joint_path_steps_match_brute_force(docs):
    path = [(r, c) for r in quality.RULES for c in reversed(r.cutoffs)]
    for r in quality.measured(docs).withColumn("step", quality.path_step()).collect():
        found = [i for i, (rule, c) in enumerate(path) if r["n_words"] and eval(rule.measure, {}, r.asDict()) > c]
        assert r["step"] == min(found, default=None)


# Decontamination


def normal(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def hits(text, items):
    own, marked, found = normal(text), set(), set()
    for name, body in items:
        words = normal(body)
        size = min(10, len(words))
        for k in range(len(words) - size + 1) if words else ():
            for i in range(len(own) - size + 1):
                if own[i : i + size] == words[k : k + size]:
                    marked |= set(range(i, i + size))
                    found.add("" if name is None else str(name))
    return len(own), len(marked), len(found), sorted(found)


ITEMS = [
    (1, "on the mat and the dog sat on the LOG by the old red barn!"),
    (2, "line-one"),
    (10, "一 日本語 のテキスト"),
    (3, "日本語"),
    (None, "67"),
    (4, None),
    (5, " ... "),
    (1, "cat sat on the mat"),
]


@pytest.mark.parametrize("limit", [1 << 20, 30])
def test_contamination_matches_brute_force(spark, docs, limit):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    clash = docs.withColumn("spans", F.lit("old")).withColumn("_runs", F.lit(7))
    rows = decontaminate.find_contamination(clash, items, automaton_bytes=limit).collect()
    assert len(rows) == docs.count() and {r["_runs"] for r in rows} == {7}
    for row in rows:
        if (row["n_words"] or 0) > 1000:
            assert not row["contaminated"]
            continue
        expected = hits(row["text"], ITEMS)
        assert (row["n_words"], row["n_hit"], row["n_items"], row["item_ids"]) == expected
        assert row["contaminated"] == (expected[1] > 0)
        # The spans cover the hit words in the original text.
        assert sum(len(normal(row["text"][s["begin"] : s["end"]])) for s in row["spans"]) == row["n_hit"]


def test_contamination_of_empty_tables(spark, docs, none):
    items = spark.createDataFrame([], "item_id long, text string")
    assert not any(r["contaminated"] for r in decontaminate.find_contamination(docs, items).collect())
    assert decontaminate.find_contamination(none, items).count() == 0


# Languages


def test_languages(spark, docs, none):
    en = "the of and to in that is was he for it with as his on be at by this had not are but from or have".split()
    de = "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden".split()
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(rng.choice(en if i % 2 else de, 40)), "en" if i % 2 else "de") for i in range(300)]
    model = langid.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ["de", "en"]
    found = langid.identify(docs.withColumn("score", F.lit("x")), model).collect()
    assert len(found) == docs.count()
    by_text = {r["text"]: r for r in found}
    assert by_text[ROW_EN]["lang_pred"] == "en" and by_text[None]["lang_pred"] == "und"
    assert {by_text[t]["lang_pred"] for t in ("", " \n\t ", "12345 ## $$ 67")} == {"und"}
    assert all(0 <= r["score"] <= 1 for r in found)
    assert langid.identify(none, model).count() == 0
    untaught = langid.learn(none)
    assert {r["lang_pred"] for r in langid.identify(docs, untaught).collect()} == {"und"}


ROW_EN = "the cat sat on the mat and the dog sat on the log by the old red barn"


def test_many_languages_get_codewords_apart():
    words = {langid.codeword(f"lang{i}").tobytes() for i in range(200)}
    assert len(words) == 200


def test_held_out_accuracy(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    fold = langid.fold(F.col("doc_id"))
    model = langid.learn(docs.where(fold != 0))
    rows = langid.identify(docs.where(fold == 0), model).select("lang", "lang_pred").collect()
    assert sum(r[0] == r[1] for r in rows) >= 0.95 * len(rows)
    assert all(zlib.crc32(str(r[0]).encode()) % 5 == r[1] for r in docs.select("doc_id", fold).collect())


# Tokens, coding and packing


def plain(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokens.public_path())
    return [np.array(e.ids, dtype="<u4").tobytes() for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_encoder_matches_the_library(monkeypatch):
    rng = np.random.default_rng(7)
    bits = [" ", "\n", "\t", "a", "B", "é", ".", "*", "'", "s", "1", "中", "  ", "😀", "\r\n", " \n", "ing", "<|endoftext|>",
            "́", "×", "'ll", "-", "_", "\xa0", "İ", "\x85", "\x1c", "Word", " the", "###"]
    texts = ["", " ", "\n", *("".join(rng.choice(bits, rng.integers(0, 25))) for _ in range(4000))]
    monkeypatch.setattr(tokens, "PIECES", 50)
    monkeypatch.setattr(tokens, "TOGETHER", 500)
    assert list(tokens.Encoder(tokens.public_path()).encode(texts)) == plain(texts)
    assert list(tokens.Encoder(tokens.public_path("word_bpe_49k.json")).encode(["A b", None]))[1] == b""


@pytest.mark.parametrize("n", [0, 1, 59, 60, 61, 1023, 1024, 1025, 3000])
@pytest.mark.parametrize("top", [1, 2, 300, 50257, 1 << 31, 1 << 59, 1 << 63])
def test_simple8b_round_trip(n, top):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, top, n, dtype=np.uint64)
    ids[rng.random(n) < 0.02] = np.uint64((1 << 64) - 1)
    frame = simple8b.encode(ids)
    assert (simple8b.decode(frame) == ids).all()
    for block in range(-(-n // simple8b.BLOCK)):
        part = ids[block * simple8b.BLOCK : (block + 1) * simple8b.BLOCK]
        assert (simple8b.decode_block(frame, block) == part).all()


def test_simple8b_rejects_other_bytes():
    with pytest.raises(ValueError, match="not a frame"):
        simple8b.decode(simple8b.encode(np.arange(5))[:-1])


def test_token_files_round_trip(spark, docs, none, tmp_path):
    token_files.write_token_files(docs, str(tmp_path / "t"), tokens.public_path(), 2, frame_ids=50)
    rows = sorted(token_files.read_token_files(spark, str(tmp_path / "t")).collect(), key=lambda r: r["start"])
    keys = [r["doc_id"] for r in rows]
    assert keys == sorted(keys, key=lambda k: -1 if k is None else k) and len(keys) == docs.count()
    end = np.array([2], dtype="<u4").tobytes()
    expected = sorted((r["doc_id"] or -1, ids + end) for r, ids in zip(docs.collect(), plain([r["text"] or "" for r in docs.collect()]), strict=True))
    assert sorted((r["doc_id"] or -1, bytes(r["ids"])) for r in rows) == expected
    place = 0
    for r in rows:
        assert (r["start"], 4 * r["n_tokens"]) == (place, len(r["ids"]))
        place += r["n_tokens"]
    token_files.write_token_files(none, str(tmp_path / "e"), tokens.public_path(), 2)
    assert token_files.read_token_files(spark, str(tmp_path / "e")).count() == 0


@pytest.mark.parametrize("score", ["norm", "dot"])
def test_packing_keeps_every_capacity(spark, docs, none, score):
    capacity = packing.Capacity(tokens=64, documents=3, attention=64 * 64, score=score)
    rows = packing.pack(docs, tokens.public_path(), 2, capacity, group=5).collect()
    whole = {}
    for r in rows:
        whole.setdefault(r["sequence_id"], []).append((r["offset"], len(r["ids"]) // 4))
    for pieces in whole.values():
        pieces.sort()
        assert [o for o, _ in pieces] == [sum(n for _, n in pieces[:i]) for i in range(len(pieces))]
        assert sum(n for _, n in pieces) <= 64 and len(pieces) <= 3
    end = np.array([2], dtype="<u4").tobytes()
    texts = [r["text"] or "" for r in docs.collect()]
    assert sum(len(r["ids"]) for r in rows) == sum(len(ids + end) for ids in plain(texts))
    long = sorted((r["piece"], r["start"], bytes(r["ids"])) for r in rows if r["doc_id"] == 7)
    assert b"".join(p[2] for p in long) == plain([texts[8]])[0] + end
    assert {len(p[2]) for p in long[1:]} == {256} and [p[1] for p in long][:2] == [0, len(long[0][2]) // 4]
    assert packing.pack(none, tokens.public_path(), 2).count() == 0


def test_best_fit_is_close_to_the_bound():
    lengths = np.random.default_rng(1).integers(1, 600, 3000)
    chosen, _ = packing.best_fit(lengths, packing.Capacity())
    assert chosen.max() + 1 <= 1.01 * np.ceil(lengths.sum() / 1024)
    with pytest.raises(ValueError, match="full piece"):
        packing.Capacity(attention=5).vector()


def test_registered_contamination(spark, tables):
    from silverline.llm.queries import QUERIES

    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{tables}/benchmark.parquet").collect()]
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{tables}/documents.parquet").collect()}
    windows = {}
    for name, body in items:
        words = normal(body)
        for k in range(max(1, len(words) - 9)):
            windows.setdefault(tuple(words[k : k + 10]), set()).add(str(name))
    rows = QUERIES["op4_benchmark_automaton"](spark, tables).collect()
    assert len(rows) == len(texts)
    for r in rows:
        own = normal(texts[r["doc_id"]])
        found = [windows.get(tuple(own[i : i + 10]), set()) for i in range(len(own))]
        names = sorted(set().union(*found)) if found else []
        assert r["items_sha256"] == hashlib.sha256(",".join(names).encode()).hexdigest()
        assert r["n_hit"] == len({i + k for i, f in enumerate(found) if f for k in range(10)})
