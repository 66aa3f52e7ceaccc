"""Profiling, value counts, top-k, exact duplicates (PR1-PR11, DD1-DD3, D1).

All operators are declarative DataFrame plans.  Grouping keys that may be
hot (one value holding a large share of rows) are only ever aggregated with
map-side partial aggregation; no operator gathers a whole group in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexicrate.operators.joins import attach_groups, free_name, row_digest, value_digest
from lexicrate.session import materialize


def table_profile(df: DataFrame) -> DataFrame:
    """Type and non-null count per column (PR1), one pass over the data."""
    aggs = [F.count(F.col(f"`{c}`")).alias(f"nn{i}") for i, c in enumerate(df.columns)]
    aggs.append(F.count(F.lit(1)).alias("n_rows"))
    one = df.agg(*aggs)
    entries = [F.struct(F.lit(f.name).alias("column_name"),
                        F.lit(f.dataType.simpleString()).alias("data_type"),
                        F.lit(i).cast("long").alias("position"),
                        F.col(f"nn{i}").alias("non_null"))
               for i, f in enumerate(df.schema.fields)]
    return (one.select(F.explode(F.array(*entries)).alias("e"), "n_rows")
            .select("e.*", "n_rows"))


def value_counts(df: DataFrame, col: str, *, normalize: bool = False) -> DataFrame:
    """Count per value, descending (PR2); ``share`` of all rows when normalize (PR6)."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    if normalize:
        total = df.select(F.count(F.lit(1))).scalar()
        counts = counts.withColumn("share", F.col("n") / total)
    return counts


def top_k(df: DataFrame, col: str, k: int, *, min_count: int = 1) -> DataFrame:
    """Most frequent values (PR3 with min_count=2, PR4); ties by value.

    ``orderBy().limit()`` plans as TakeOrderedAndProject: each task keeps
    its own k best, only those reach the final merge."""
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= min_count)
            .orderBy(F.col("n").desc(), F.col(col).asc())
            .limit(k))


def crosstab_top_k(df: DataFrame, key: str, by: str, k: int) -> DataFrame:
    """Rows whose ``key`` is among the k most frequent, counted by (key, by) (PR5).

    The top-k side has at most k rows: a left-semi join against it is
    broadcast by the planner."""
    top = top_k(df, key, k).select(key)
    return (df.join(F.broadcast(top), key, "left_semi")
            .groupBy(key, by).agg(F.count(F.lit(1)).alias("n")))


def head_rows(df: DataFrame, order_col: str, n: int) -> DataFrame:
    """First n rows by the row key (PR7)."""
    return df.orderBy(order_col).limit(n)


def fill_with_min(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Replace NULL by the column minimum (PR11).  The minimum is a one-row
    scalar sub-query, so no window gathers the rows into one task."""
    m = df.select(F.min(col)).scalar()
    return df.withColumn(out or col, F.coalesce(F.col(col), m))


def duplicate_count(df: DataFrame, cols: list[str]) -> DataFrame:
    """Number of rows that repeat an earlier row on ``cols`` (DD1)."""
    return (df.groupBy(row_digest(cols).alias("digest")).agg(F.count(F.lit(1)).alias("n"))
            .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("n_duplicates")))


def duplicate_groups(df: DataFrame, cols: list[str]) -> DataFrame:
    """Groups of rows equal on ``cols`` (NULL equals NULL) with more than one member:
    digest of the key and group size, from one partial aggregation that moves no key column."""
    return (df.groupBy(row_digest(cols).alias("digest"))
            .agg(F.count(F.lit(1)).alias("group_size"))
            .where(F.col("group_size") > 1))


def duplicate_rows(df: DataFrame, cols: list[str]) -> DataFrame:
    """Every member of a duplicate group (DD2), with the group size.

    The groups are written once and joined back on the digest of the key; rows of a
    hot group are spread over the tasks (``attach_groups``)."""
    return attach_groups(df, row_digest(cols), materialize(duplicate_groups(df, cols)),
                         key_col="digest", size_col="group_size", values=["group_size"])


def drop_duplicates_first(df: DataFrame, cols: list[str], order_col: str) -> DataFrame:
    """Keep the first row (smallest ``order_col``) of each group equal on ``cols`` (DD3).

    ``min`` is combined map-side, so a group holding a third of the data costs
    one row per task in the shuffle; the kept ids are joined back."""
    keep = df.groupBy(row_digest(cols).alias(free_name("_digest", df.columns))).agg(F.min(order_col).alias(order_col))
    return df.join(keep.select(order_col), order_col, "left_semi")


def conflicting_duplicates(df: DataFrame, key: str, target: str) -> DataFrame:
    """Rows whose ``key`` carries more than one distinct non-null ``target`` (D1), with
    ``n_targets``; a NULL key is no key.  The key itself is never shuffled as a key."""
    bad = (df.where(F.col(target).isNotNull() & F.col(key).isNotNull())
           .groupBy(value_digest(key).alias("digest"), F.col(target).alias("target")).agg(F.count(F.lit(1)).alias("n"))
           .groupBy("digest").agg(F.count(F.lit(1)).alias("n_targets"), F.sum("n").alias("n_rows"))
           .where(F.col("n_targets") > 1))
    return attach_groups(df, value_digest(key), materialize(bad), key_col="digest", size_col="n_rows", values=["n_targets"])
