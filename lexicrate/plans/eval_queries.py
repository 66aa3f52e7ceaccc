"""Baseline classifier, evaluation and rule-scoring queries.

The deterministic nearest-centroid model (M11) is fitted on the training
split of ``documents`` (class ``lang``) using five text statistics; its test
predictions feed the evaluation operators, so every number can be checked
exactly against SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lexicrate.functions.text import first_line
from lexicrate.operators import evaluate as EV
from lexicrate.operators import textstats as TS
from lexicrate.plans.features_queries import SPLIT_SQL, split_docs
from lexicrate.plans.registry import query
from lexicrate.plans.textstats_queries import _STATS_SQL

FEATURES = ["num_tokens_per_doc", "num_sentences_per_doc", "avg_sentence_length_per_doc",
            "num_chars_per_doc", "sentence_length_variance"]


def _featured(spark, sf):
    d = split_docs(spark, sf)
    st = TS.text_statistics(d, "text", keep=["doc_id", "lang", "split", "text"])
    return st.select("doc_id", F.col("lang").alias("label"), "split", "text", "num_chars_per_doc",
                     F.array(*[F.col(c).cast("double") for c in FEATURES]).alias("features"))


def predictions(spark, sf):
    """Test-split predictions of the centroid model.  The prediction table is
    read several times by the evaluation operators, so it is written once to
    the checkpoint folder."""
    from lexicrate.session import materialize
    # the feature table feeds both the fit (train rows) and the prediction
    # (test rows): written once, which also keeps the regex statistics from
    # being re-evaluated inside the generator of the fit
    f = materialize(_featured(spark, sf))
    cents = materialize(EV.fit_centroids(f.where(F.col("split") == "train"), "features", "label"))
    return materialize(EV.predict_centroids(f.where(F.col("split") == "test"), "features", cents))


_PRED_SQL = f"""
{_STATS_SQL},
sp AS ({SPLIT_SQL}),
f AS (SELECT st.doc_id, st.lang AS label, sp.split, num_tokens_per_doc::DOUBLE AS f0,
             num_sentences_per_doc::DOUBLE AS f1, avg_sentence_length_per_doc::DOUBLE AS f2,
             num_chars_per_doc::DOUBLE AS f3, sentence_length_variance::DOUBLE AS f4, num_chars_per_doc
      FROM st JOIN sp ON sp.doc_id = st.doc_id),
c AS (SELECT label AS cl, avg(f0) AS c0, avg(f1) AS c1, avg(f2) AS c2, avg(f3) AS c3, avg(f4) AS c4
      FROM f WHERE split = 'train' GROUP BY label),
dd AS (SELECT f.doc_id, f.label, f.num_chars_per_doc, c.cl,
              sqrt((f.f0 - c.c0) * (f.f0 - c.c0) + (f.f1 - c.c1) * (f.f1 - c.c1) + (f.f2 - c.c2) * (f.f2 - c.c2)
                   + (f.f3 - c.c3) * (f.f3 - c.c3) + (f.f4 - c.c4) * (f.f4 - c.c4)) AS dist
       FROM f, c WHERE f.split = 'test'),
rk AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY dist, cl) AS r,
              sum(1.0 / (1.0 + dist)) OVER (PARTITION BY doc_id) AS inv_total FROM dd),
preds AS (SELECT doc_id, label, cl AS prediction, (1.0 / (1.0 + dist)) / inv_total AS score, num_chars_per_doc
          FROM rk WHERE r = 1)
"""


@query("centroid_predict", oracle=f"""
WITH {_PRED_SQL} SELECT doc_id, label, prediction, round(score, 6) AS score FROM preds
""")
def centroid_predict(spark, sf):
    return predictions(spark, sf).select("doc_id", "label", "prediction", F.round("score", 6).alias("score"))


@query("accuracy", oracle=f"""
WITH {_PRED_SQL}
SELECT round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 6) AS accuracy, count(*) AS n FROM preds
""")
def accuracy(spark, sf):
    return EV.accuracy(predictions(spark, sf)).withColumn("accuracy", F.round("accuracy", 6))


@query("classification_report", oracle=f"""
WITH {_PRED_SQL},
cls AS (SELECT label AS cls FROM preds UNION SELECT prediction FROM preds),
per AS (
  SELECT cls.cls,
    coalesce((SELECT count(*) FROM preds WHERE label = cls.cls AND prediction = cls.cls), 0) AS tp,
    coalesce((SELECT count(*) FROM preds WHERE label = cls.cls), 0) AS support,
    coalesce((SELECT count(*) FROM preds WHERE prediction = cls.cls), 0) AS n_pred
  FROM cls),
m AS (SELECT cls, CASE WHEN n_pred > 0 THEN tp / n_pred ELSE 0.0 END AS precision,
             CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall, support FROM per),
m2 AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall)
                      ELSE 0.0 END AS f1 FROM m),
allr AS (
  SELECT cls, precision, recall, support, f1 FROM m2 UNION ALL
  SELECT 'macro avg', avg(precision), avg(recall), sum(support), avg(f1) FROM m2 UNION ALL
  SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
         sum(support), sum(f1 * support) / sum(support) FROM m2)
SELECT cls, round(precision, 6) AS precision, round(recall, 6) AS recall, support::BIGINT AS support,
       round(f1, 6) AS f1 FROM allr
""")
def classification_report(spark, sf):
    r = EV.classification_report(predictions(spark, sf))
    return r.select("cls", *[F.round(c, 6).alias(c) for c in ("precision", "recall")], "support",
                    F.round("f1", 6).alias("f1"))


@query("confusion_matrix", oracle=f"""
WITH {_PRED_SQL},
cls AS (SELECT label AS cls FROM preds UNION SELECT prediction FROM preds),
cnt AS (SELECT label AS actual, prediction AS predicted, count(*) AS n FROM preds GROUP BY 1, 2)
SELECT a.cls AS actual, p.cls AS predicted, coalesce(cnt.n, 0)::BIGINT AS n
FROM cls a CROSS JOIN cls p LEFT JOIN cnt ON cnt.actual = a.cls AND cnt.predicted = p.cls
""")
def confusion_matrix(spark, sf):
    return EV.confusion_matrix(predictions(spark, sf))


@query("confident_errors", oracle=f"""
WITH {_PRED_SQL}
SELECT p.doc_id, p.label, p.prediction, round(p.score, 6) AS score, split_part(d.text, chr(10), 1) AS title
FROM preds p JOIN documents d ON d.doc_id = p.doc_id
WHERE p.label <> p.prediction ORDER BY p.score DESC, p.doc_id LIMIT 5
""")
def confident_errors(spark, sf):
    p = predictions(spark, sf)
    top = EV.confident_errors(p, 5, id_col="doc_id")
    return top.select("doc_id", "label", "prediction", F.round("score", 6).alias("score"),
                      first_line("text").alias("title"))


@query("errors_by_class", oracle=f"""
WITH {_PRED_SQL} SELECT label, count(*) AS n_errors FROM preds WHERE label <> prediction GROUP BY label
""")
def errors_by_class(spark, sf):
    return EV.errors_by_class(predictions(spark, sf))


@query("length_vs_error", oracle=f"""
WITH {_PRED_SQL}
SELECT label <> prediction AS misclassified, round(avg(num_chars_per_doc), 6) AS mean_length, count(*) AS n
FROM preds GROUP BY 1
""")
def length_vs_error(spark, sf):
    return (EV.length_vs_error(predictions(spark, sf), "num_chars_per_doc")
            .withColumn("mean_length", F.round("mean_length", 6)))


@query("length_box_by_error", oracle=f"""
WITH {_PRED_SQL},
v AS (SELECT label <> prediction AS misclassified, num_chars_per_doc::DOUBLE AS value FROM preds),
q AS (SELECT misclassified, count(*) AS n, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
             quantile_cont(value, 0.75) AS q3 FROM v GROUP BY 1)
SELECT 'num_chars_per_doc' AS stat, q.misclassified, q.n, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
  round(min(CASE WHEN value >= q1 - 1.5 * (q3 - q1) THEN value END), 6) AS whisker_lo,
  round(max(CASE WHEN value <= q3 + 1.5 * (q3 - q1) THEN value END), 6) AS whisker_hi,
  count(CASE WHEN value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1) THEN 1 END) AS n_outliers
FROM v JOIN q ON q.misclassified = v.misclassified GROUP BY q.misclassified, q.n, q1, median, q3
""")
def length_box_by_error(spark, sf):
    """Box summary of the text length of right and of misclassified documents (TS5)."""
    long = predictions(spark, sf).select(F.lit("num_chars_per_doc").alias("stat"),
                                         (F.col("label") != F.col("prediction")).alias("misclassified"),
                                         F.col("num_chars_per_doc").cast("double").alias("value"))
    out = TS.box_summary(long, by=["misclassified"])
    return out.withColumns({c: F.round(c, 6) for c in ("q1", "median", "q3", "whisker_lo", "whisker_hi")})


# ------------------------------------------------------------ scoring ----
def _rules(spark, sf):
    d = split_docs(spark, sf)
    from lexicrate.operators.score import rule_table
    return d, rule_table(d.where(F.col("split") == "train"), "text", "lang", "doc_id")


_RULES_SQL = f"""
sp AS ({SPLIT_SQL}),
d AS (SELECT documents.doc_id, documents.text, sp.lang, sp.split FROM documents JOIN sp ON sp.doc_id = documents.doc_id),
rules AS (SELECT text, arg_max(lang, doc_id) AS rule_label FROM d WHERE split = 'train' GROUP BY text),
rp AS (SELECT t.doc_id, r.rule_label FROM d t LEFT JOIN rules r ON r.text = t.text WHERE t.split = 'test')
"""


@query("overlap_descriptions", oracle=f"""
WITH {_RULES_SQL}
SELECT md5(text) AS text_md5 FROM (
  SELECT DISTINCT text FROM d WHERE split = 'train' AND text IS NOT NULL
  INTERSECT SELECT DISTINCT text FROM d WHERE split = 'test' AND text IS NOT NULL)
""")
def overlap_descriptions(spark, sf):
    from lexicrate.operators.score import overlap
    d = split_docs(spark, sf)
    return overlap(d.where(F.col("split") == "train"), d.where(F.col("split") == "test"), "text") \
        .select(F.md5("text").alias("text_md5"))


@query("rule_predictions", oracle=f"WITH {_RULES_SQL} SELECT doc_id, rule_label FROM rp")
def rule_predictions(spark, sf):
    from lexicrate.operators.score import apply_rules
    d, rules = _rules(spark, sf)
    return apply_rules(d.where(F.col("split") == "test"), rules, "text").select("doc_id", "rule_label")


@query("rule_agreement", oracle=f"""
WITH {_PRED_SQL}, {_RULES_SQL.replace('sp AS (', 'sp2 AS (', 1).replace('JOIN sp ON sp.doc_id', 'JOIN sp2 sp ON sp.doc_id')}
SELECT p.doc_id, p.prediction FROM preds p JOIN rp ON rp.doc_id = p.doc_id WHERE rp.rule_label = p.prediction
""")
def rule_agreement(spark, sf):
    from lexicrate.operators.score import apply_rules, agreement
    d, rules = _rules(spark, sf)
    rp = apply_rules(d.where(F.col("split") == "test"), rules, "text").select("doc_id", "rule_label")
    return agreement(predictions(spark, sf), rp, "doc_id").select("doc_id", "prediction")
