"""From raw documents to training sequences, in five stages.

Each stage takes (spark, docs, folder of the tables) and gives the documents it keeps, all
columns as they came; the last gives packed pieces. ``run`` writes every stage's result to
the shared folder and reads it again, so a stage is computed once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverline.llm import decontaminate, langid, packing, quality, simhash, tokens
from silverline.llm.shared import cut
from silverline.sources import scratch_folder


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of one clear language: neither ``und`` nor ambiguous."""
    model = langid.learn(docs.where(langid.fold(F.col("doc_id")) != 0))
    found = langid.identify(docs, model)
    return found.where((F.col("lang_pred") != langid.UNKNOWN) & ~F.col("ambiguous")).select(*docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the certified steps of the joint path of rules."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    depths = cut(quality.joint_depths(quality.measured(docs.select("doc_id", "text", "lang")).drop("text"), labels))
    return quality.joint_verdicts(quality.measured(docs), depths).where("kept").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the least id."""
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.find_contamination(docs, benchmark).where(~F.col("contaminated")).select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 1024 ids, one row per piece of a document."""
    return packing.pack(docs, tokens.public_path(), tokens.END_ID)


STAGES = [
    ("language_id", language_id),
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]

# Fingerprints, token ids and the learned model have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
