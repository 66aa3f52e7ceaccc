"""Exact de-duplication by a content sort (native).

Texts are equal when they are identical after every run of ASCII white space
becomes one space.  The normalised bytes are range-partitioned by splitters
that Spark samples (beginnings of texts with a hash, so that splitters stay
small), each range is sorted externally, equal texts become neighbours, and the window compares whole neighbouring texts.  A text carried
by many rows is salted into a fixed number of runs, so that it is spread over
several ranges; the heads of its runs are combined afterwards.

Defined results: a null text is the empty text; a null id sorts after all
others, so a row without id stays only in a group without any id; of rows with
the same id and equal text one stays.  Columns other than the id and the text
are ignored, or handed through whole when ``carry`` is set.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexicrate.session import store

#: Fixed value: the white space that counts.
SPACE = r"[\x20\x09-\x0D]+"
#: At most HOT texts can hold more than a HOT-th of the rows each; they get SALTS runs.
HOT, SALTS, HOT_ROWS = 1024, 32, 64
#: Characters of a text that splitters see.
PREFIX = 16


def normalised(text: Column | str) -> Column:
    """The text with each run of ASCII white space as one space; null is empty."""
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``
    and, with ``carry``, the input row as the struct ``row``."""
    row = [F.struct(*docs.columns).alias("row")] if carry else []
    d = docs.select(F.col(id_col).alias("doc_id"), normalised(F.col(text_col)).alias("norm"), *row)
    d = d.withColumn("h", F.xxhash64("norm"))
    least = max(HOT_ROWS, docs.count() // HOT)
    hot = d.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > least).select("h", F.lit(True).alias("hot"))
    d = d.join(F.broadcast(hot), "h", "left")  # at most HOT rows: each holds over a HOT-th of all
    d = d.withColumn("salt", F.when(F.col("hot"), F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")).otherwise(0))

    # the order is by the first PREFIX characters, a hash of the text, then the text in full; the splitters
    # that the driver draws are prefixes and hashes, never texts, and texts with one beginning spread by hash
    d = d.withColumn("prefix", F.substring("norm", 1, PREFIX))
    run = Window.partitionBy("prefix", "h", "norm", "salt")
    runs = (d.repartitionByRange("prefix", "h", "salt")
            .withColumn("rn", F.row_number().over(run.orderBy(F.col("doc_id").asc_nulls_last())))
            .withColumn("head", F.min("doc_id").over(run)).withColumn("size", F.count(F.lit(1)).over(run)))
    runs = store(runs.select("doc_id", "rn", "head", "size", "hot", F.sha2("norm", 256).alias("text_sha256"),
                             F.when(F.col("hot") & (F.col("rn") == 1), F.col("norm")).alias("hot_text"),
                             *(["row"] if carry else [])), "content-sort")

    same = Window.partitionBy("hot_text")  # at most SALTS heads of each hot text
    heads = (runs.where(F.col("hot_text").isNotNull())
             .select(F.col("head").alias("run"), F.col("text_sha256").alias("sha"), F.min("head").over(same).alias("first"),
                     F.sum("size").over(same).alias("all")))
    out = runs.join(F.broadcast(heads), F.col("hot") & F.col("head").eqNullSafe(F.col("run")) & (F.col("text_sha256") == F.col("sha")), "left")
    keep = F.when(F.col("all").isNotNull(), F.col("first")).otherwise(F.col("head"))
    return out.select("doc_id", keep.alias("keep_id"), F.coalesce("all", "size").alias("group_size"),
                      ((F.col("rn") == 1) & F.col("head").eqNullSafe(keep)).alias("kept"), "text_sha256",
                      *(["row"] if carry else []))


ORACLE = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM n WINDOW w AS (PARTITION BY t)
"""
