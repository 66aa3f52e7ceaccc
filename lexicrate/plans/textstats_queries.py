"""Text statistics queries over ``documents.text`` (TS1-TS8)."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from lexicrate.functions.constants import ENGLISH_STOPWORDS
from lexicrate.functions.text import vector_tokens
from lexicrate.operators import textstats as T
from lexicrate.operators.reduce import principal_axes
from lexicrate.plans import sql as S
from lexicrate.plans.registry import query
from lexicrate.tables import table


def _stats(spark, sf):
    return T.text_statistics(table(spark, sf, "documents"), "text", keep=["doc_id", "lang"])


def _stats_long(spark, sf):
    """Long (stat, value) table of the plotted statistics.  Summaries read it
    more than once, so the per-document statistics are written once."""
    from lexicrate.session import materialize
    return T.to_long(materialize(_stats(spark, sf)), T.PLOTTED_STATS)


def _rounded(df, cols, digits=6):
    return df.select(*[F.round(c, digits).alias(c) if c in cols else F.col(c) for c in df.columns])


_STATS_SQL = f"""
b AS (SELECT doc_id, lang,
        len({S.raw_word_tokens('text')})::BIGINT AS num_tokens_per_doc,
        list_transform(regexp_extract_all(coalesce(text, ''), '{S.SENTENCE}'),
                       lambda s: len(regexp_extract_all(s, '{S.WORD_OR_PUNCT}'))) AS sl,
        length(coalesce(text, ''))::BIGINT AS num_chars_per_doc
      FROM documents),
st AS (SELECT doc_id, lang, num_tokens_per_doc, len(sl)::BIGINT AS num_sentences_per_doc,
        CASE WHEN len(sl) > 0 THEN num_tokens_per_doc / len(sl) ELSE 0.0 END AS avg_sentence_length_per_doc,
        num_tokens_per_doc AS avg_doc_length, num_chars_per_doc,
        CASE WHEN len(sl) > 0 THEN list_aggregate(sl, 'var_pop') ELSE 0.0 END AS sentence_length_variance
      FROM b),
long AS (
  SELECT 'num_tokens_per_doc' AS stat, num_tokens_per_doc::DOUBLE AS value FROM st UNION ALL
  SELECT 'num_sentences_per_doc', num_sentences_per_doc::DOUBLE FROM st UNION ALL
  SELECT 'avg_sentence_length_per_doc', avg_sentence_length_per_doc::DOUBLE FROM st UNION ALL
  SELECT 'avg_doc_length', avg_doc_length::DOUBLE FROM st)
"""


@query("text_statistics", oracle=f"""
WITH {_STATS_SQL}
SELECT doc_id, lang, num_tokens_per_doc, num_sentences_per_doc,
       round(avg_sentence_length_per_doc, 6) AS avg_sentence_length_per_doc,
       avg_doc_length, num_chars_per_doc,
       round(sentence_length_variance, 6) AS sentence_length_variance
FROM st
""")
def text_statistics(spark, sf):
    return _rounded(_stats(spark, sf), ["avg_sentence_length_per_doc", "sentence_length_variance"])


_STOP_SQL = ", ".join("'" + w.replace("'", "''") + "'" for w in ENGLISH_STOPWORDS)


@query("stopword_frequency", oracle=f"""
WITH w AS (SELECT unnest({S.whitespace_tokens('text')}) AS word FROM documents)
SELECT word, count(*) AS n FROM w WHERE word IN ({_STOP_SQL}) GROUP BY word
""")
def stopword_frequency(spark, sf):
    stop = spark.createDataFrame([(w,) for w in ENGLISH_STOPWORDS], "word string")
    return T.stopword_frequency(table(spark, sf, "documents"), "text", stop)


@query("stat_histogram", oracle=f"""
WITH {_STATS_SQL},
rng AS (SELECT stat, min(value) AS lo, max(value) AS hi FROM long GROUP BY stat),
binned AS (
  SELECT l.stat, (CASE WHEN r.hi = r.lo THEN 0
                  ELSE least(floor((l.value - r.lo) / (r.hi - r.lo) * 30), 29) END)::BIGINT AS bin,
         count(*) AS n
  FROM long l JOIN rng r ON r.stat = l.stat GROUP BY 1, 2),
grid AS (SELECT stat, lo, hi, i::BIGINT AS bin FROM rng, range(0, 30) t(i))
SELECT g.stat, g.bin, round(g.lo + (g.hi - g.lo) * g.bin / 30, 6) AS bin_lo,
       round(g.lo + (g.hi - g.lo) * (g.bin + 1) / 30, 6) AS bin_hi, coalesce(b.n, 0)::BIGINT AS n
FROM grid g LEFT JOIN binned b ON b.stat = g.stat AND b.bin = g.bin
""")
def stat_histogram(spark, sf):
    long = _stats_long(spark, sf)
    return _rounded(T.histogram(long, bins=30), ["bin_lo", "bin_hi"])


@query("stat_density", oracle=f"""
WITH {_STATS_SQL},
g AS (SELECT stat, min(value) AS lo, max(value) AS hi, count(*) AS n,
             greatest(stddev_samp(value) * pow(count(*), -0.2), 1e-9) AS h FROM long GROUP BY stat),
x AS (SELECT *, lo + (hi - lo) * i / 199 AS x FROM g, range(200) r(i))
SELECT x.stat, round(x.x, 6) AS x,
       round(sum(exp(-0.5 * ((x.x - l.value) / h) * ((x.x - l.value) / h))) / (n * h * sqrt(2 * pi())), 6) AS density
FROM x JOIN long l ON l.stat = x.stat GROUP BY x.stat, x.x, n, h
""")
def stat_density(spark, sf):
    return _rounded(T.density(_stats_long(spark, sf), points=200), ["x", "density"])


@query("box_summary", oracle=f"""
WITH {_STATS_SQL},
q AS (SELECT stat, count(*) AS n, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
             quantile_cont(value, 0.75) AS q3 FROM long GROUP BY stat)
SELECT q.stat, q.n, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
  round(min(CASE WHEN value >= q1 - 1.5 * (q3 - q1) THEN value END), 6) AS whisker_lo,
  round(max(CASE WHEN value <= q3 + 1.5 * (q3 - q1) THEN value END), 6) AS whisker_hi,
  count(CASE WHEN value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1) THEN 1 END) AS n_outliers
FROM long l JOIN q ON q.stat = l.stat GROUP BY q.stat, q.n, q1, median, q3
""")
def box_summary(spark, sf):
    long = _stats_long(spark, sf)
    return _rounded(T.box_summary(long), ["q1", "median", "q3", "whisker_lo", "whisker_hi"])


_CORR_PAIRS = " UNION ALL ".join(
    f"SELECT '{a}' AS stat_a, '{b}' AS stat_b, round(corr({a}, {b}), 6) AS corr FROM st"
    for a in T.STAT_COLUMNS for b in T.STAT_COLUMNS)


@query("stat_correlation", oracle=f"WITH {_STATS_SQL} {_CORR_PAIRS}")
def stat_correlation(spark, sf):
    return _rounded(T.correlation(_stats(spark, sf), T.STAT_COLUMNS), ["corr"])


@query("pca_embeddings")
def pca_embeddings(spark, sf):
    """Embeddings centred (not scaled) and projected on two principal axes (TS7)."""
    e = table(spark, sf, "embeddings").select("vec_id", "label",
                                             array_to_vector("embedding").alias("features"))
    return principal_axes(e, "features", with_mean=True, with_std=False, id_col="vec_id")


@query("pca_tfidf")
def pca_tfidf(spark, sf):
    """TF-IDF over a 1000-term vocabulary, scaled without centring, two
    principal axes (TS8)."""
    from lexicrate.operators.features import tfidf_vectors
    d = table(spark, sf, "documents").select("doc_id", "lang", vector_tokens("text").alias("tokens"))
    normed, _ = tfidf_vectors(d, "tokens", out="features", vocab_size=1000)
    return principal_axes(normed.select("doc_id", "lang", "features"), "features",
                          with_mean=False, with_std=True, id_col="doc_id")
