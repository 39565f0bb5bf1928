"""From raw documents to a training mix: five stages, each one operator.

Each stage takes what its predecessor kept, read back from Parquet. Language ID
drops documents without a recognisable language; of every group of near copies
one stays; documents that hold a passage of the benchmark go; live-looking
secrets are blanked; the mix says how often each document is taken.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.llm import decontaminate as clean
from larkspur.llm import langid, mixing, rows, secrets, simhash
from larkspur.session import cut_lineage, shared_dir


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told and not ambiguous; a null lang becomes the language found."""
    judged = langid.identify(docs, langid.fit(docs))
    kept = judged.where((F.col("_lang") != langid.UNDETERMINED) & ~F.col("_ambiguous"))
    return kept.withColumn("lang", F.coalesce("lang", "_lang")).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints linked at 4 or fewer bits of 4-word shingles: the smallest doc_id."""
    chosen = cut_lineage(simhash.representatives(simhash.near_duplicates(docs)))
    return rows.keep(docs, chosen).select(docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of the benchmark."""
    judged = clean.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return rows.drop(docs, cut_lineage(judged.where("n_hit > 0").select("id", "key"))).select(docs.columns)


def scan_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, owner-specific secrets replaced by a mark and n_chars counted anew; shared examples stay."""
    spans = F.array_sort(F.concat("live", "added")).alias("_spans")
    found = cut_lineage(secrets.scan(docs).where("size(live) + size(added) > 0").select("id", "key", spans))
    met = rows.meet(docs, found, "_spans")
    text = F.when(F.col("_spans").isNull(), F.col("text")).otherwise(secrets.redacted(F.col("text"), F.col("_spans")))
    return met.withColumn("text", text).withColumn(
        "n_chars", F.when(F.col("_spans").isNull(), F.col("n_chars")).otherwise(F.length("text"))).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mix takes, with their copies and words taken."""
    return mixing.mix(docs).where("copies > 0").withColumnRenamed("id", "doc_id")


STAGES = [
    ("language ID", language_id),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("secret scans", scan_secrets),
    ("mixing sources", mix_sources),
]

#: Language models and XXH64 have no SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents; each result but the last is written to the shared folder and read back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
    return STAGES[-1][1](spark, docs, sf_dir)
