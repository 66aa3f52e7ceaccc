"""A training-data pipeline over the ``documents`` table.

Each stage calls one operator of ``lexicrate.llm``; its result is written as
Parquet and reread as the next stage's documents.  All stages but the last
return the columns of the documents they were given.
"""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexicrate.llm import exact, mixing, packing, quality, simhash
from lexicrate.llm.labelled import unused
from lexicrate.session import store


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go; it learns from the labelled documents."""
    labels = spark.read.parquet(os.path.join(sf_dir, "labels.parquet"))
    name = unused("_quality", docs.columns)
    scored = quality.score(docs, quality.fit(docs, labels), score_col=name)
    return scored.where(F.col(name) >= quality.THRESHOLD).select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest id stays."""
    return exact.exact_dedup(docs, carry=True).where("kept").select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints the smallest id stays; rows of one id and different texts are judged apart."""
    groups = simhash.near_duplicates(docs, with_hash=True)
    id_name, hash_name = unused("_id", docs.columns), unused("_hash", docs.columns)
    gone = groups.where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias(id_name), F.col("text_hash").alias(hash_name))
    return docs.join(gone, (F.col("doc_id") == F.col(id_name)) & (F.xxhash64("text") == F.col(hash_name)), "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source gets its share of all words: a row for each epoch of a
    document, and one document of a source cut where the budget ends."""
    return mixing.mixed_rows(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of fixed length."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality classifier", drop_low_quality), ("exact dedup", drop_copies), ("SimHash near-dedup", drop_near_copies),
          ("mixing", mix_sources), ("packing", pack_sequences)]

#: A classifier, fingerprints and a tokenizer are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = store(out, "stage")
    return out
