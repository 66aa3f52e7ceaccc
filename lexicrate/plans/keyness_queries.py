"""Keyness queries (K1-K6) over ``documents`` (class = ``lang``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexicrate.functions.text import word_tokens
from lexicrate.operators import keyness as K
from lexicrate.plans import sql as S
from lexicrate.plans.registry import query
from lexicrate.tables import table

TOP_K = 500
SELECT_N = 2000


def _docs(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "lang", word_tokens("text").alias("tokens"))


def _ratios(spark, sf):
    return K.log_ratios(_docs(spark, sf), label_col="lang", tokens_col="tokens")


def _sparse(spark, sf):
    return K.sparse_ratios(_docs(spark, sf), label_col="lang", tokens_col="tokens")


# Shared oracle CTEs: K1 counts, class totals, K2 ratios over the whole vocabulary.
_RATIOS_SQL = f"""
docs AS (SELECT doc_id, lang, {S.word_tokens('text')} AS toks FROM documents),
occ AS (SELECT lang, unnest(toks) AS token FROM docs),
ct AS (SELECT lang, token, count(*) AS n FROM occ GROUP BY lang, token),
classes AS (
  SELECT c.lang, coalesce(sum(ct.n), 0) AS class_total
  FROM (SELECT DISTINCT lang FROM docs WHERE lang IS NOT NULL) c
  LEFT JOIN ct ON ct.lang = c.lang GROUP BY c.lang),
grand AS (SELECT coalesce(sum(n), 0) AS g FROM ct),
vocab AS (SELECT token, sum(n) AS total_freq FROM ct GROUP BY token),
ratios AS (
  SELECT c.lang, v.token, coalesce(ct.n, 0) AS in_freq, v.total_freq,
         log2(((coalesce(ct.n, 0) + 1)::DOUBLE / c.class_total)
              / ((v.total_freq - coalesce(ct.n, 0) + 1)::DOUBLE / (grand.g - c.class_total))) AS log_ratio
  FROM vocab v CROSS JOIN classes c CROSS JOIN grand
  LEFT JOIN ct ON ct.lang = c.lang AND ct.token = v.token)
"""


@query("class_token_counts", oracle=f"""
WITH {_RATIOS_SQL}
SELECT lang, token, n FROM ct
""")
def class_token_counts(spark, sf):
    return (K.class_token_counts(_docs(spark, sf), label_col="lang", tokens_col="tokens")
            .select(F.col("label").alias("lang"), "token", "n"))


@query("log_ratio", oracle=f"""
WITH {_RATIOS_SQL}
SELECT lang, token, in_freq, total_freq, round(log_ratio, 6) AS log_ratio FROM ratios
""")
def log_ratio(spark, sf):
    return _ratios(spark, sf).select(
        F.col("label").alias("lang"), "token", "in_freq", "total_freq",
        F.round("log_ratio", 6).alias("log_ratio"))


@query("top_keyness", oracle=f"""
WITH {_RATIOS_SQL},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang
              ORDER BY round(abs(log_ratio), 9) DESC NULLS LAST, token) AS rank
  FROM ratios)
SELECT lang, token, rank, round(log_ratio, 6) AS log_ratio, in_freq, total_freq
FROM ranked WHERE rank <= {TOP_K}
""")
def top_keyness(spark, sf):
    return (K.top_keyness(_ratios(spark, sf), k=TOP_K)
            .select(F.col("label").alias("lang"), "token", F.col("rank").cast("long").alias("rank"),
                    F.round("log_ratio", 6).alias("log_ratio"), "in_freq", "total_freq"))


def _grid_sql(step: float, max_threshold: float) -> str:
    max_index = int(round(max_threshold / step))
    return f"""
grid AS (SELECT c.lang, i AS idx, i * {step} AS threshold
         FROM classes c, range(0, {max_index + 1}) r(i)),
counts AS (
  SELECT g.lang, g.idx, g.threshold,
         (SELECT count(*) FROM ratios r WHERE r.lang = g.lang AND r.log_ratio IS NOT NULL
            AND round(abs(r.log_ratio), 9) >= round(g.threshold, 9)) AS n_tokens
  FROM grid g)
"""


@query("scree_counts", oracle=f"""
WITH {_RATIOS_SQL}, {_grid_sql(K.SCREE_STEP, K.DEFAULT_MAX_THRESHOLD)}
SELECT lang, idx, round(threshold, 6) AS threshold, n_tokens FROM counts
""")
def scree_counts(spark, sf):
    c = K.threshold_counts(_sparse(spark, sf), max_threshold=K.DEFAULT_MAX_THRESHOLD,
                           step=K.SCREE_STEP)
    return c.select(F.col("label").alias("lang"), F.col("idx").cast("long").alias("idx"),
                    F.round("threshold", 6).alias("threshold"),
                    F.col("n_tokens").cast("long").alias("n_tokens"))


@query("keyness_selection", oracle=f"""
WITH {_RATIOS_SQL}, {_grid_sql(K.DEFAULT_STEP, K.DEFAULT_MAX_THRESHOLD)},
best AS (
  SELECT lang, coalesce(min(CASE WHEN n_tokens < {SELECT_N} THEN threshold END),
                        {K.DEFAULT_MAX_THRESHOLD}) AS threshold
  FROM counts GROUP BY lang)
SELECT DISTINCT r.token FROM ratios r JOIN best b ON r.lang = b.lang
WHERE round(abs(r.log_ratio), 9) >= round(b.threshold, 9)
""")
def keyness_selection(spark, sf):
    return K.feature_selection(_sparse(spark, sf), n=SELECT_N)
