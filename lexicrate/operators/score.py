"""Scoring helpers for unlabelled data (S1-S4): text overlap between two
tables, exact-text rules, agreement between model and rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexicrate.operators.joins import attach_groups, free_name, value_digest
from lexicrate.session import materialize


def overlap(a: DataFrame, b: DataFrame, col: str) -> DataFrame:
    """Distinct non-null values of ``col`` present in both tables.

    The tables meet by digest; only values found in both travel, one per task and digest."""
    d = free_name("_digest", [col])
    given = a.where(F.col(col).isNotNull()).select(value_digest(col).alias(d), col)
    other = b.where(F.col(col).isNotNull()).select(value_digest(col).alias(d))
    both = given.select(d).distinct().intersect(other.distinct())
    return given.join(both, d, "left_semi").groupBy(d).agg(F.first(col).alias(col)).select(col)


def rule_table(train: DataFrame, key_col: str, label_col: str, order_col: str) -> DataFrame:
    """Exact-key rule: digest of the key -> label of the last row (largest ``order_col``),
    with the number of rows (S2).

    ``max_by`` combines map-side, so a key repeated in a third of the rows
    still costs one row per task in the shuffle.  A NULL key makes no rule."""
    return materialize(train.where(F.col(key_col).isNotNull()).groupBy(value_digest(key_col).alias("digest"))
                       .agg(F.max_by(label_col, order_col).alias("rule_label"), F.count(F.lit(1)).alias("n_rows")))


def apply_rules(df: DataFrame, rules: DataFrame, key_col: str) -> DataFrame:
    """Attach ``rule_label`` (NULL when the key has no rule)."""
    return attach_groups(df, value_digest(key_col), rules, key_col="digest", size_col="n_rows",
                         values=["rule_label"], how="left")


def agreement(preds: DataFrame, rule_preds: DataFrame, id_col: str,
              pred_col: str = "prediction") -> DataFrame:
    """Rows whose model prediction equals the rule label (S3)."""
    return preds.join(rule_preds, id_col).where(F.col(pred_col) == F.col("rule_label"))
