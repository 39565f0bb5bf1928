"""Queries that apply each operator to its whole table, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.llm import alignment, decontaminate, html, knn, langid, licences, merkle, mixing, packing, repeats, secrets, simhash, toxicity
from larkspur.llm.sql import DECONTAMINATE, MERKLE, MIX, REPEATS, TOP_K


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    rows = mixing.mix(_table(spark, folder, "documents"))
    return rows.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rows = repeats.remove_repeats(_table(spark, folder, "documents"), with_text=False)
    return rows.select(F.col("id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


def op3_main_text(spark: SparkSession, folder: str) -> DataFrame:
    rows = html.extract(_table(spark, folder, "pages").select("page_id", "url", "html"))
    return rows.select("page_id", "url", F.col("_text").alias("text"), F.length("_text").cast("long").alias("n_chars"))


def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    rows = decontaminate.decontaminate(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return rows.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op5_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    rows = secrets.scan(_table(spark, folder, "documents"))

    def of(kind):
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return rows.select(
        F.col("id").alias("doc_id"), of("assign"), of("access"), of("hex"), F.sha2(secrets.listed(F.col("base")), 256).alias("base_sha256"),
        secrets.listed(F.array_sort(F.concat("base", "added"))).alias("spans"),
        F.size("live").cast("long").alias("n_live"), "n_shared")


def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents").select(
        "doc_id", "lang", "text", langid.held_out("doc_id", 3, 1).alias("held_out"))
    model = langid.fit(documents.where("not held_out"))
    return langid.identify(documents.drop("lang"), model).select(
        "doc_id", "held_out", F.col("_lang").alias("lang_pred"), F.col("_score").alias("score"),
        F.col("_ambiguous").alias("ambiguous"))


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents").select("doc_id", "text")
    labels = _table(spark, folder, "labels").where(~langid.held_out("doc_id", 5, 0))
    model = toxicity.fit(documents, labels)
    return toxicity.score(documents, model).select(
        "doc_id", langid.held_out("doc_id", 5, 0).alias("held_out"), F.col("_toxicity").alias("score"),
        (F.col("_toxicity") >= 0.5).cast("int").alias("predicted"))


def op8_top_k(spark: SparkSession, folder: str) -> DataFrame:
    rows = knn.top_k(_table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)
    return rows.select(F.col("query").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score")


def op9_licence_scan(spark: SparkSession, folder: str) -> DataFrame:
    rows = licences.scan(_table(spark, folder, "documents").select("doc_id", "text"))
    return rows.select(
        "doc_id", F.array_join(F.transform("_licences", lambda x: x["licence"]), ",").alias("licences"),
        F.array_join(F.transform("_licences", lambda x: F.concat_ws(":", x["start"], x["end"])), ",").alias("spans"),
        F.size("_sentences").cast("long").alias("n_sentences"),
        F.array_join(F.transform("_sentences", lambda x: x["identifier"]), ",").alias("identifiers"))


def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    rows = simhash.near_duplicates(_table(spark, folder, "documents"))
    return rows.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
                       F.col("component").alias("component_id"))


def op11_merkle(spark: SparkSession, folder: str) -> DataFrame:
    changed = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    rows = merkle.verify(merkle.manifest(_table(spark, folder, "documents"), changed))
    return rows.withColumnRenamed("id", "doc_id")


def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    rows = alignment.align(_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return rows.withColumnRenamed("id", "doc_id")


def op13_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    rows = packing.pack(_table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return rows.select(F.col("id").alias("doc_id"), "piece", "start", "length", F.col("crc").alias("ids_crc32"),
                       F.col("sequence").alias("sequence_id"), "offset")


QUERIES = {f.__name__: f for f in (
    op1_mix_sources, op2_substring_dedup, op3_main_text, op4_decontamination, op5_secret_scan,
    op6_language_id, op7_toxicity, op8_top_k, op9_licence_scan, op10_simhash,
    op11_merkle, op12_token_alignment, op13_best_fit_packing)}
ORACLES = {"op1_mix_sources": MIX, "op2_substring_dedup": REPEATS, "op4_decontamination": DECONTAMINATE,
           "op8_top_k": TOP_K, "op11_merkle": MERKLE}
