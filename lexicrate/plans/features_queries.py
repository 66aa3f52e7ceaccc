"""Feature engineering queries (FE1-FE10)."""

from __future__ import annotations

from pyspark.ml.feature import IndexToString
from pyspark.sql import functions as F

from lexicrate.functions.text import first_line, vector_tokens
from lexicrate.operators import features as FE
from lexicrate.operators.reduce import truncated_svd
from lexicrate.plans import sql as S
from lexicrate.plans.registry import query
from lexicrate.tables import table

_VT = S.vector_tokens("text")


def _docs(spark, sf):
    return table(spark, sf, "documents")


@query("tfidf_weights", oracle=f"""
WITH toks AS (SELECT doc_id, unnest({_VT}) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM toks GROUP BY doc_id, term),
dfq AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
n AS (SELECT count(*) AS n FROM documents),
w AS (SELECT tf.doc_id, tf.term, tf.tf, tf.tf * (ln((n.n + 1) / (dfq.df + 1)) + 1) AS raw
      FROM tf JOIN dfq ON dfq.term = tf.term, n),
nr AS (SELECT doc_id, sqrt(sum(raw * raw)) AS norm FROM w GROUP BY doc_id)
SELECT w.doc_id, w.term, w.tf, round(w.raw / nr.norm, 6) AS weight FROM w JOIN nr ON nr.doc_id = w.doc_id
""")
def tfidf_weights(spark, sf):
    d = _docs(spark, sf).select("doc_id", vector_tokens("text").alias("tokens"))
    return FE.tfidf_long(d, "doc_id", "tokens").withColumn("weight", F.round("weight", 6))


@query("topk_vocabulary", oracle=f"""
SELECT term, count(*) AS n FROM (SELECT unnest({_VT}) AS term FROM documents)
GROUP BY term ORDER BY n DESC, term ASC LIMIT 1000
""")
def topk_vocabulary(spark, sf):
    d = _docs(spark, sf).select(vector_tokens("text").alias("tokens"))
    return FE.top_vocabulary(d, "tokens", 1000)


_TITLE_VT = S.vector_tokens(S.first_line("text"))


@query("ngram_counts", oracle=f"""
WITH t AS (SELECT {_TITLE_VT} AS t FROM documents),
g AS (
  SELECT array_to_string(t[i:i + n - 1], ' ') AS ngram
  FROM (SELECT t, n, unnest(generate_series(1, len(t) - n + 1)) AS i
        FROM t, (VALUES (2), (3), (4)) v(n) WHERE len(t) >= n))
SELECT ngram, count(*) AS n FROM g GROUP BY ngram
""")
def ngram_counts(spark, sf):
    d = _docs(spark, sf).select(vector_tokens(first_line("text")).alias("t"))
    from lexicrate.functions.text import explode_tokens
    return (explode_tokens(d, FE.word_ngrams(F.col("t"), 2, 4), keep=[], alias="ngram")
            .groupBy("ngram").agg(F.count(F.lit(1)).alias("n")))


@query("one_hot", oracle="""
SELECT doc_id, source, (dense_rank() OVER (ORDER BY source) - 1)::BIGINT AS source_idx,
       (SELECT count(DISTINCT source) + 1 FROM documents)::BIGINT AS onehot_size,
       (dense_rank() OVER (ORDER BY source) - 1)::BIGINT AS onehot_pos
FROM documents
""")
def one_hot(spark, sf):
    """The code column is the place of the one in the vector; the encoder's model has its width."""
    d, (_, encoder) = FE.one_hot(_docs(spark, sf).select("doc_id", "source"), "source", out="oh")
    code = F.col("source_idx").cast("long")
    return d.select("doc_id", "source", code.alias("source_idx"),
                    F.lit(encoder.categorySizes[0]).cast("long").alias("onehot_size"), code.alias("onehot_pos"))


def _grams_sql(x: str) -> str:
    s = f"(' ' || lower({x}) || ' ')"
    return (f"list_distinct(list_filter(flatten(list_transform(range(2, 5), lambda n: "
            f"list_transform(range(1, greatest(length({s}) - n + 1, 1) + 1), lambda i: substr({s}, i, n)))), "
            f"lambda g: length(g) >= 2))")


@query("similarity_encode", oracle=f"""
WITH v AS (SELECT DISTINCT source AS value FROM documents),
c AS (SELECT DISTINCT source AS category FROM documents WHERE source IS NOT NULL),
vg AS (SELECT value, {_grams_sql('value')} AS g FROM v),
cg AS (SELECT category, {_grams_sql('category')} AS g FROM c)
SELECT value, category,
  round(CASE WHEN len(vg.g) + len(cg.g) - len(list_intersect(vg.g, cg.g)) = 0 THEN 0.0
        ELSE len(list_intersect(vg.g, cg.g)) / (len(vg.g) + len(cg.g) - len(list_intersect(vg.g, cg.g))) END, 6)
        AS similarity
FROM vg CROSS JOIN cg
""")
def similarity_encode(spark, sf):
    d = _docs(spark, sf)
    return FE.similarity_encode(d, "source", d, "source").withColumn("similarity", F.round("similarity", 6))


@query("label_encode", oracle="""
SELECT doc_id, lang, (dense_rank() OVER (ORDER BY lang) - 1)::BIGINT AS label_idx, lang AS label_decoded
FROM documents
""")
def label_encode(spark, sf):
    d, model = FE.label_encode(_docs(spark, sf).select("doc_id", "lang"), "lang")
    back = IndexToString(inputCol="label_idx_d", outputCol="label_decoded", labels=model.labels)
    return back.transform(d.withColumn("label_idx_d", F.col("label_idx").cast("double"))) \
               .select("doc_id", "lang", "label_idx", "label_decoded")


SPLIT_SQL = """
SELECT doc_id, lang,
  CASE WHEN row_number() OVER (PARTITION BY lang ORDER BY md5(doc_id::VARCHAR || '42'), doc_id)
            <= round(0.1 * count(*) OVER (PARTITION BY lang)) THEN 'test' ELSE 'train' END AS split
FROM documents
"""


def split_docs(spark, sf):
    return FE.stratified_split(_docs(spark, sf), "doc_id", "lang", test_fraction=0.1, seed="42")


@query("stratified_split", oracle=SPLIT_SQL)
def stratified_split(spark, sf):
    return split_docs(spark, sf).select("doc_id", "lang", "split")


@query("label_join", oracle="""
SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d JOIN labels l ON l.doc_id = d.doc_id
""")
def label_join(spark, sf):
    return (_docs(spark, sf).select("doc_id", "lang")
            .join(table(spark, sf, "labels"), "doc_id").select("doc_id", "lang", "quality", "toxic"))


#: Directions of the SVD, the fewest that the reference tries.
SVD_K = 200


@query("svd_features")
def svd_features(spark, sf):
    """Truncated SVD of the TF-IDF matrix over its whole vocabulary, rows keyed by doc_id (FE4)."""
    d = _docs(spark, sf).select("doc_id", vector_tokens("text").alias("tokens"))
    out, _ = truncated_svd(FE.tfidf_long(d, "doc_id", "tokens"), "doc_id", "term", k=SVD_K)
    return out


def _tfidf_sql(name: str, tokens: str) -> str:
    """CTEs {name} (doc_id, term, weight): smoothed, L2-normalised TF-IDF."""
    return f"""
{name}_tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({tokens}) AS term FROM documents) GROUP BY ALL),
{name}_df AS (SELECT term, count(*) AS df FROM {name}_tf GROUP BY term),
{name}_w AS (SELECT t.doc_id, t.term, t.tf * (ln((n.n + 1) / (f.df + 1)) + 1) AS raw
             FROM {name}_tf t JOIN {name}_df f ON f.term = t.term, (SELECT count(*) AS n FROM documents) n),
{name} AS (SELECT doc_id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)) AS weight FROM {name}_w)
"""


_SIMILARITY_SQL = f"""
vg AS (SELECT DISTINCT source AS value, {_grams_sql('source')} AS g FROM documents),
sims AS (SELECT a.value, b.value AS category, len(list_intersect(a.g, b.g))
                / (len(a.g) + len(b.g) - len(list_intersect(a.g, b.g))) AS similarity
         FROM vg a, vg b WHERE b.value IS NOT NULL)
"""


@query("similarity_pairs", oracle=f"""
WITH v AS (SELECT value, {_grams_sql('value')} AS g FROM (SELECT DISTINCT p_name AS value FROM part)),
c AS (SELECT category, {_grams_sql('category')} AS g FROM (SELECT DISTINCT n_name AS category FROM nation)),
m AS (SELECT value, category, len(v.g) + len(c.g) AS total, len(list_intersect(v.g, c.g)) AS common FROM v, c)
SELECT value, category, round(common / (total - common), 6) AS similarity FROM m WHERE common > 0
""")
def similarity_pairs(spark, sf):
    """Each part name's similarity to the countries it shares an n-gram with (FE6, sparse form)."""
    out = FE.similarity_pairs(table(spark, sf, "part"), "p_name", table(spark, sf, "nation"), "n_name")
    return out.withColumn("similarity", F.round("similarity", 6))


@query("assemble_features", oracle=f"""
WITH {_tfidf_sql('ti', _TITLE_VT)}, {_tfidf_sql('de', _VT)}, {_SIMILARITY_SQL},
fr AS (SELECT source, count(*) / (SELECT count(*) FROM documents) AS share FROM documents GROUP BY source)
SELECT * FROM (
  SELECT doc_id, 'title' AS block, term AS name, round(weight, 6) AS value FROM ti
  UNION ALL SELECT doc_id, 'description', term, round(weight, 6) FROM de
  UNION ALL SELECT doc_id, 'origin', source, 1.0 FROM documents WHERE source IS NOT NULL
  UNION ALL SELECT d.doc_id, 'origin_similarity', s.category, round(s.similarity, 6)
            FROM documents d JOIN sims s ON s.value IS NOT DISTINCT FROM d.source WHERE s.similarity <> 0
  UNION ALL SELECT d.doc_id, 'director', 'frequency', round(fr.share, 6)
            FROM documents d JOIN fr ON fr.source = d.source)
""")
def assemble_features(spark, sf):
    """Feature union over the whole vocabularies (FE7): TF-IDF of title and
    description, origin, its similarity to each origin, director frequency."""
    d = _docs(spark, sf)
    docs = d.select("doc_id", "source")

    def tfidf(text):
        t = FE.tfidf_long(d.select("doc_id", vector_tokens(text).alias("tokens")), "doc_id", "tokens")
        return t.select("doc_id", F.col("term").alias("name"), F.col("weight").alias("value"))
    sim = (FE.similarity_pairs(d, "source", d, "source").groupBy("value")
           .agg(F.collect_list(F.struct("category", "similarity")).alias("sims")))
    similar = (docs.join(sim, docs["source"].eqNullSafe(sim["value"])).select("doc_id", F.explode("sims").alias("s"))
               .select("doc_id", F.col("s.category").alias("name"), F.col("s.similarity").alias("value")))
    share = d.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    total = d.select(F.count(F.lit(1))).scalar()
    known = docs.where(F.col("source").isNotNull())
    blocks = {"title": tfidf(first_line("text")), "description": tfidf(F.col("text")),
              "origin": known.select("doc_id", F.col("source").alias("name"), F.lit(1.0).alias("value")),
              "origin_similarity": similar,
              "director": known.join(share, "source").select("doc_id", F.lit("frequency").alias("name"),
                                                             (F.col("n") / total).alias("value"))}
    return FE.feature_union(blocks, "doc_id").withColumn("value", F.round("value", 6))


@query("ngram_tfidf", oracle=f"""
WITH tk AS (SELECT doc_id, {_TITLE_VT} AS t FROM documents),
gr AS (SELECT doc_id, array_to_string(t[i:i + n - 1], ' ') AS term
       FROM (SELECT doc_id, t, n, unnest(generate_series(1, len(t) - n + 1)) AS i
             FROM tk, (VALUES (2), (3), (4)) v(n) WHERE len(t) >= n)),
tf AS (SELECT doc_id, term, count(*) AS tf FROM gr GROUP BY ALL),
dfq AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
w AS (SELECT tf.doc_id, tf.term, tf.tf, tf.tf * (ln((n.n + 1) / (dfq.df + 1)) + 1) AS raw
      FROM tf JOIN dfq ON dfq.term = tf.term, (SELECT count(*) AS n FROM documents) n)
SELECT doc_id, term, tf, round(raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)), 6) AS weight FROM w
""")
def ngram_tfidf(spark, sf):
    """TF-IDF of the title's word 2- to 4-grams (FE3)."""
    d = _docs(spark, sf).select("doc_id", vector_tokens(first_line("text")).alias("t"))
    grams = d.select("doc_id", FE.word_ngrams(F.col("t"), 2, 4).alias("grams"))
    return FE.tfidf_long(grams, "doc_id", "grams").withColumn("weight", F.round("weight", 6))
