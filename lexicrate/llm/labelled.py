"""Labelled rows for the classifiers: folds and a bounded sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bound of the labelled sample, for each class.
PER_CLASS = 2000


def held_out(id_col: Column | str = "doc_id") -> Column:
    """Rows that no model may learn from: crc32 of the id as text, modulo 3, is 1."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def unused(name: str, columns: list[str]) -> str:
    """A column name like ``name`` that no column has, whatever its case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def sample(docs: DataFrame, labels: DataFrame, label: str, id_col: str = "doc_id", text_col: str = "text",
           per_class: int = PER_CLASS) -> DataFrame:
    """``text, y``: up to ``per_class`` rows of each class in hash order of
    their ids, from labelled rows that are not held out.  The bound keeps the
    model's fit independent of the corpus size."""
    rows = labels.where(F.col(label).isin(0, 1) & ~held_out(id_col)).select(F.col(id_col).alias("_id"), F.col(label).cast("int").alias("y"))
    # a sorted limit keeps per_class rows of each task before anything moves
    first, second = (rows.where(F.col("y") == k).orderBy(F.xxhash64("_id"), "_id").limit(per_class) for k in (0, 1))
    chosen = first.union(second)
    return (docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
            .join(F.broadcast(chosen), "_id").select("text", "y", F.xxhash64("_id").alias("key")))  # at most 2 x per_class rows


def prior(labels: DataFrame, label: str, id_col: str = "doc_id") -> float:
    """Share of label 1 among the labelled rows that are not held out."""
    n, ones = labels.where(F.col(label).isin(0, 1) & ~held_out(id_col)).agg(F.count(F.lit(1)), F.sum(F.col(label).cast("int"))).first()
    return (ones or 0) / n if n else 0.5
