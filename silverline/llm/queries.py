"""The operators as registered queries: each over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from silverline.llm import (
    collocations,
    cotraining,
    decontaminate,
    langid,
    packing,
    preference,
    quality,
    runs,
    secret_scan,
    sharding,
    simhash,
    token_files,
    tokens,
    urls,
)
from silverline.llm.shared import cut
from silverline.sources import scratch_folder

SHARDS = 24
# host, path, verdict of the url rules of the query.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_interleaved_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    text = F.coalesce(F.col("text"), F.lit(""))
    return sharding.interleaved_shards(docs, SHARDS).select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "source",
    )


def ids_crc32() -> Column:
    return F.crc32("ids").alias("ids_crc32")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = scratch_folder(spark, "token-files")
    token_files.write_token_files(docs, path, tokens.public_path(), tokens.END_ID)
    return token_files.read_token_files(spark, path).select("doc_id", "start", "n_tokens", ids_crc32())


def op3_cotrained_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    model = cotraining.learn(docs, table(spark, sf_dir, "labels"))
    return cotraining.score(docs, model).select("doc_id", "text_score", "meta_score", "score", "keep")


def op4_benchmark_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op5_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs, tokens.public_path(), tokens.END_ID).select(
        "doc_id",
        "piece",
        "start",
        (F.octet_length("ids") / 4).cast("long").alias("length"),
        ids_crc32(),
        "sequence_id",
        "offset",
    )


def op6_certified_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    measured = cut(quality.measured(docs).drop("text"))
    cutoffs = quality.certified_cutoffs(measured, table(spark, sf_dir, "labels"))
    return quality.quality_verdicts(measured, cutoffs).drop("lang")


def op7_pivot_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs).select(
        "doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id"
    )


def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    # As SQL values, so that Spark knows the size of the table of rules.
    rows = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in URL_RULES)
    rules = spark.sql(f"SELECT * FROM VALUES {rows} AS rules(host, path, verdict)")
    return urls.judge_urls(pages, rules).drop("url")


def op9_preference_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    examples = preference.preference_examples(turns, preference.opening_pairs(turns))
    masks = {c: preference.mask_text(c) for c in ("chosen_mask", "rejected_mask")}
    return examples.withColumns(masks)


def op10_output_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    fold = langid.fold(F.col("doc_id"))
    model = langid.learn(docs.where(fold != 0))
    predicted = langid.identify(docs.select("doc_id", "text"), model)
    return predicted.select(
        "doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "lang_pred", "score", "ambiguous"
    )


def looped_text() -> Column:
    """The text of every tenth document with a loop of words in its second part, as the query's contract states it."""
    h = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8"))
    words = F.split(F.trim(F.regexp_replace("text", r"[\x20\x09-\x0D]+", " ")), " ")
    n = F.when(F.trim(F.regexp_replace("text", r"[\x20\x09-\x0D]+", " ")) != "", F.size(words)).otherwise(0)
    g = F.floor(h / 10)
    a = (g % F.greatest(n, F.lit(1))).cast("int")
    tail = n - a
    period = (1 + F.floor(tail / (3 + g % 8))).cast("int")
    loop = F.array_repeat(F.slice(words, a + 1, period), F.ceil(tail / period).cast("int"))
    looped = F.array_join(F.concat(F.slice(words, 1, a), F.slice(F.flatten(loop), 1, tail)), " ")
    return F.when((h % 10 == 0) & (n > 0), looped).otherwise(F.col("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", looped_text().alias("text"))
    line = lambda run: F.concat(run["start"], F.lit(","), run["length"], F.lit(","), run["period"], F.lit("\n"))
    best = F.col("strongest")
    return runs.periodic_runs(docs).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(F.encode(F.array_join(F.transform("runs", line), ""), "UTF-8"), 256).alias("runs_sha256"),
        F.sha2(F.encode("collapsed", "UTF-8"), 256).alias("collapsed_sha256"),
    )


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents").select("text", "lang"))


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def joined(spans: Column) -> Column:
        place = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
        return F.array_join(F.transform(spans, place), ",")

    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("secrets", lambda s: s["kind"] != "literal")
    return found.select(
        "doc_id",
        *[count(kind) for kind in ("assign", "access", "hex")],
        F.sha2(F.encode(joined(base), "UTF-8"), 256).alias("base_sha256"),
        joined(F.col("secrets")).alias("spans"),
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_interleaved_shards": op1_interleaved_shards,
    "op2_token_files": op2_token_files,
    "op3_cotrained_quality": op3_cotrained_quality,
    "op4_benchmark_automaton": op4_benchmark_automaton,
    "op5_vector_packing": op5_vector_packing,
    "op6_certified_quality": op6_certified_quality,
    "op7_pivot_simhash": op7_pivot_simhash,
    "op8_url_rules": op8_url_rules,
    "op9_preference_examples": op9_preference_examples,
    "op10_output_codes": op10_output_codes,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_collocations": op12_collocations,
    "op13_secret_scan": op13_secret_scan,
    "pipeline": pipeline,
}
