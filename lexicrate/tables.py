"""Table access and the mapping of the test tables onto the corpus model.

``documents`` plays the labelled corpus: row key ``doc_id``, description
``text``, title = first line of ``text``, class (genre) ``lang``, director and
country of origin ``source``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexicrate.functions.text import first_line


# Tables whose rows carry long text: CPU-heavy per row, so a scan that yields
# too few splits is spread over the cluster before the text work starts.
TEXT_TABLES = frozenset({"documents", "pages", "conversations", "benchmark", "embeddings"})


def spread(df: DataFrame) -> DataFrame:
    """Round-robin the rows when the scan has fewer splits than the cluster has
    task slots.  Large inputs already have many splits and are left alone, so
    this never adds a shuffle of a big table."""
    spark = df.sparkSession
    slots = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < slots:
        return df.repartition(slots)
    return df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    return spread(df) if name in TEXT_TABLES else df


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in the labelled-corpus shape (row_id, title, origin, genre,
    director, description)."""
    d = table(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").alias("row_id"),
                    first_line("text").alias("title"),
                    F.col("source").alias("origin"),
                    F.col("lang").alias("genre"),
                    F.col("source").alias("director"),
                    F.col("text").alias("description"))
