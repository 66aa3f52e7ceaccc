"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexicrate.llm import embedding, exact, language, mixing, negatives, packing, phrases, pii, quality, simhash, suffixes, topk, toxicity

QUERIES, ORACLES = {}, {}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f
    return add


@query("op4_exact_dedup", exact.ORACLE)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_dedup(read(spark, sf_dir, "documents"))


@query("op8_mixing", mixing.ORACLE)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"))


@query("op9_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op1_simhash")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


@query("op10_quality")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query("op6_embedding")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding.near_duplicates(read(spark, sf_dir, "embeddings"))


@query("op5_language")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(read(spark, sf_dir, "pages"), read(spark, sf_dir, "documents"))


@query("op7_pii")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    key = spark.conf.get("spark.lexicrate.pii.key", "key of the test tables")  # a secret belongs in the session's settings
    return pii.pseudonymise(docs, key=key).select("doc_id", "text", "n_replaced", F.array_join("kinds", ",").alias("kinds"))


@query("op3_toxicity")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query("op2_suffix_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffixes.remove_repeats(read(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["e"] - x["s"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


@query("op13_topk", topk.ORACLE)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read(spark, sf_dir, "embeddings"))


@query("op12_negatives", negatives.ORACLE)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(read(spark, sf_dir, "embeddings"), label=moved)


@query("op11_phrases", phrases.ORACLE)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read(spark, sf_dir, "documents"))
