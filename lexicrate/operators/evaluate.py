"""Baseline classifier and relational evaluation.

Evaluation works on a prediction table ``(label, prediction, score, ...)``
and is pure aggregation, so it scales with the prediction table and gives
exactly reproducible numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# ------------------------------------------------------------- centroid ----
def fit_centroids(train: DataFrame, features_col: str, label_col: str) -> DataFrame:
    """Mean feature vector per class (M11 fit): (label, centroid array<double>).

    The vector is summed element-wise with partial aggregation; a class can be
    huge, its centroid is still one row."""
    parts = train.select(F.col(label_col).alias("label"),
                         F.posexplode(features_col).alias("dim", "x"))
    means = parts.groupBy("label", "dim").agg(F.avg("x").alias("m"))
    return (means.groupBy("label")
            .agg(F.array_sort(F.collect_list(F.struct("dim", "m"))).alias("s"))
            .select("label", F.transform("s", lambda e: e["m"]).alias("centroid")))


def predict_centroids(df: DataFrame, features_col: str, centroids: DataFrame) -> DataFrame:
    """Nearest centroid (Euclidean) per row, ties by label (M11 predict).

    The K centroids are a small model; they reach every row through one
    scalar sub-query, so prediction is a map-only step.  ``score`` is the
    inverse-distance share of the chosen class."""
    model = centroids.select(F.array_sort(F.collect_list(F.struct("label", "centroid")))).scalar()
    with_model = df.withColumn("_model", model)
    # the row's features are repeated next to each centroid, so the lambda
    # only reads its own arguments
    dists = F.zip_with("_model", F.array_repeat(F.col(features_col), F.size("_model")), lambda c, f: F.struct(
        F.sqrt(F.aggregate(F.zip_with(f, c["centroid"], lambda a, b: (a - b) * (a - b)),
                           F.lit(0.0), lambda s, x: s + x)).alias("dist"),
        c["label"].alias("label")))
    out = with_model.withColumn("_d", dists)
    inv_total = F.aggregate("_d", F.lit(0.0), lambda s, e: s + 1.0 / (1.0 + e["dist"]))
    best = F.array_min("_d")
    return (out.withColumn("_best", best)
            .withColumn("prediction", F.col("_best.label"))
            .withColumn("score", (1.0 / (1.0 + F.col("_best.dist"))) / inv_total)
            .drop("_model", "_d", "_best"))


# ----------------------------------------------------------- evaluation ----
def accuracy(preds: DataFrame, label_col: str = "label", pred_col: str = "prediction") -> DataFrame:
    """Share of rows with prediction == label (M5)."""
    return preds.agg(F.avg((F.col(label_col) == F.col(pred_col)).cast("double")).alias("accuracy"),
                     F.count(F.lit(1)).alias("n"))


def _classes(preds: DataFrame, label_col: str, pred_col: str) -> DataFrame:
    return (preds.select(F.col(label_col).alias("cls"))
            .unionByName(preds.select(F.col(pred_col).alias("cls"))).distinct())


def classification_report(preds: DataFrame, label_col: str = "label",
                          pred_col: str = "prediction") -> DataFrame:
    """Precision, recall, F1, support per class plus macro and weighted
    averages (M6); 0 where a ratio is undefined."""
    tp = (preds.where(F.col(label_col) == F.col(pred_col)).groupBy(F.col(label_col).alias("cls"))
          .agg(F.count(F.lit(1)).alias("tp")))
    sup = preds.groupBy(F.col(label_col).alias("cls")).agg(F.count(F.lit(1)).alias("support"))
    npred = preds.groupBy(F.col(pred_col).alias("cls")).agg(F.count(F.lit(1)).alias("n_pred"))
    per = (_classes(preds, label_col, pred_col).join(tp, "cls", "left").join(sup, "cls", "left")
           .join(npred, "cls", "left").fillna(0, ["tp", "support", "n_pred"]))
    prec = F.when(F.col("n_pred") > 0, F.col("tp") / F.col("n_pred")).otherwise(F.lit(0.0))
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    per = per.select(F.col("cls").cast("string").alias("cls"), prec.alias("precision"),
                     rec.alias("recall"), F.col("support").cast("long").alias("support"))
    per = per.withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0,
                                      2 * F.col("precision") * F.col("recall")
                                      / (F.col("precision") + F.col("recall"))).otherwise(F.lit(0.0)))
    total = F.sum("support")
    avgs = per.agg(
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
        (F.sum(F.col("precision") * F.col("support")) / total).alias("wp"),
        (F.sum(F.col("recall") * F.col("support")) / total).alias("wr"),
        (F.sum(F.col("f1") * F.col("support")) / total).alias("wf"),
        total.cast("long").alias("s"))
    macro = avgs.select(F.lit("macro avg").alias("cls"), F.col("mp").alias("precision"),
                        F.col("mr").alias("recall"), F.col("s").alias("support"), F.col("mf").alias("f1"))
    weighted = avgs.select(F.lit("weighted avg").alias("cls"), F.col("wp").alias("precision"),
                           F.col("wr").alias("recall"), F.col("s").alias("support"), F.col("wf").alias("f1"))
    return per.unionByName(macro).unionByName(weighted)


def confusion_matrix(preds: DataFrame, label_col: str = "label", pred_col: str = "prediction") -> DataFrame:
    """Counts for every (actual, predicted) pair of classes, zeros included (M7).

    The class grid is built from the (small) class list attached as one
    array; the data is only aggregated."""
    counts = preds.groupBy(F.col(label_col).alias("actual"), F.col(pred_col).alias("predicted")) \
                  .agg(F.count(F.lit(1)).alias("n"))
    cls = _classes(preds, label_col, pred_col).select(F.array_sort(F.collect_list("cls")).alias("c"))
    grid = (cls.select(F.explode("c").alias("actual"), "c")
            .select("actual", F.explode("c").alias("predicted")))
    return (grid.join(counts, ["actual", "predicted"], "left")
            .select("actual", "predicted", F.coalesce("n", F.lit(0)).cast("long").alias("n")))


def confident_errors(preds: DataFrame, k: int, *, label_col: str = "label",
                     pred_col: str = "prediction", score_col: str = "score",
                     id_col: str = "row_id") -> DataFrame:
    """The k misclassified rows with the highest score (M8)."""
    return (preds.where(F.col(label_col) != F.col(pred_col))
            .orderBy(F.col(score_col).desc(), F.col(id_col).asc()).limit(k))


def errors_by_class(preds: DataFrame, label_col: str = "label", pred_col: str = "prediction") -> DataFrame:
    """Misclassified rows per true class (M9)."""
    return (preds.where(F.col(label_col) != F.col(pred_col))
            .groupBy(label_col).agg(F.count(F.lit(1)).alias("n_errors")))


def length_vs_error(preds: DataFrame, length_col: str, label_col: str = "label",
                    pred_col: str = "prediction") -> DataFrame:
    """Mean of ``length_col`` for correct and misclassified rows."""
    return (preds.withColumn("misclassified", F.col(label_col) != F.col(pred_col))
            .groupBy("misclassified").agg(F.avg(length_col).alias("mean_length"),
                                          F.count(F.lit(1)).alias("n")))
