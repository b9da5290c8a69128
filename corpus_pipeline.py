"""The training-data pipeline over ``documents``: five operators, one after the other.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that ``run``
writes to the shared checkpoint folder and rereads as the next one's
documents. All but the last keep the columns of documents. Models are
trained on the labelled documents of ``sf_dir``, not on what a stage is given.

Null, empty, very long and repeated texts, null ids and empty tables pass through every
stage as its operator's docstring says; columns beyond those of documents stay, whatever their
names, up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hebdo.llm import bayes_jaccard, phrase_index, pii_surrogate, rules_quality, sentencepiece_viterbi
from hebdo.llm.common import fresh, read, small_side, stage

#: Key of the surrogates where the session does not set ``hebdo.pii.key``; public, so a deployment sets its own.
PII_KEY = "corpus-pipeline"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble does not reject (score of at least 0.3)."""
    model = rules_quality.train(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    scored = model.score(rules_quality.text_statistics("text"))
    return docs.filter(scored >= rules_quality.THRESHOLD)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicate texts."""
    return bayes_jaccard.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark does not contaminate; equal texts share their verdict."""
    found = phrase_index.contamination(phrase_index.search(phrase_index.build_index(docs), read(spark, sf_dir, "benchmark")))
    (key,) = fresh(docs, "_key")
    bad = stage(found.filter("contaminated").select(F.col("key").alias(key)).distinct(), "contaminated")
    work = docs.withColumn(key, F.coalesce(F.md5(F.col("text").cast("string")), F.lit("")))
    return work.join(small_side(bad), key, "left_anti").select(*docs.columns)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with surrogates for personal data; n_chars follows the new text."""
    out = pii_surrogate.replace(docs, spark.conf.get("hebdo.pii.key", PII_KEY))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_entities") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_ids, round_trip) of every document left."""
    out = sentencepiece_viterbi.decode(sentencepiece_viterbi.encode(docs.select("doc_id", "text")))
    return out.select("doc_id", "ids", "n_ids", F.col("text").eqNullSafe(F.col("text_back")).alias("round_trip"))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate),
          ("private", private), ("tokenize", tokenize)]

#: No SQL: the quality rules are learned and the merges iterative; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
