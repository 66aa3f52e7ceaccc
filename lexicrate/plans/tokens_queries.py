"""Token operator queries (T1-T8) over ``documents`` and the customer/nation/region tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexicrate.functions.constants import CONTRACTIONS, ENGLISH_STOPWORDS
from lexicrate.functions.text import word_tokens
from lexicrate.operators import keyness as K
from lexicrate.operators import tokens as T
from lexicrate.plans import sql as S
from lexicrate.plans.keyness_queries import SELECT_N, _RATIOS_SQL, _grid_sql
from lexicrate.plans.registry import query
from lexicrate.session import materialize
from lexicrate.tables import table

_WT = S.word_tokens("text")
_POS_SQL = f"""
toks AS (SELECT doc_id, {_WT} AS toks FROM documents),
t AS (SELECT doc_id, unnest(generate_series(0, len(toks) - 1)) AS pos, unnest(toks) AS token FROM toks)
"""


def _docs(spark, sf):
    return table(spark, sf, "documents").select("doc_id", word_tokens("text").alias("tokens"))


@query("token_table", oracle=f"WITH {_POS_SQL} SELECT doc_id, pos, token FROM t")
def token_table(spark, sf):
    return (T.token_table(table(spark, sf, "documents"), "doc_id", "text")
            .withColumn("pos", F.col("pos").cast("long")))


_LEX_SQL = ", ".join(f"('{k}', '{v}')" for k, v in sorted(CONTRACTIONS.items()))


@query("lexicon_normalise", oracle=f"""
WITH {_POS_SQL},
lex(token, replacement) AS (VALUES {_LEX_SQL}),
r AS (SELECT t.doc_id, string_agg(coalesce(l.replacement, t.token), ' ' ORDER BY t.pos) AS s
      FROM t LEFT JOIN lex l ON l.token = t.token GROUP BY t.doc_id)
SELECT d.doc_id, coalesce(r.s, '') AS text_norm FROM documents d LEFT JOIN r ON r.doc_id = d.doc_id
""")
def lexicon_normalise(spark, sf):
    d = T.lexicon_normalise(_docs(spark, sf), "tokens", CONTRACTIONS, out="norm")
    return d.select("doc_id", F.array_join("norm", " ").alias("text_norm"))


_STOP_SQL = ", ".join("'" + w.replace("'", "''") + "'" for w in ENGLISH_STOPWORDS)


@query("remove_stopwords", oracle=f"""
SELECT doc_id, array_to_string(list_filter({_WT}, lambda x: NOT list_contains([{_STOP_SQL}], x)), ' ')
       AS text_out
FROM documents
""")
def remove_stopwords(spark, sf):
    d = _docs(spark, sf)
    return d.select("doc_id", F.array_join(T.remove_stopwords(F.col("tokens"), ENGLISH_STOPWORDS), " ")
                    .alias("text_out"))


PHRASE_MIN_COUNT = 5
PHRASE_MIN_NPMI = 0.5


# Scores of adjacent pairs over a table toks (doc_id, toks)
_MINED_SQL = f"""
uni AS (SELECT w, count(*) AS nw FROM (SELECT unnest(toks) AS w FROM toks) GROUP BY w),
bg AS (SELECT toks[i] AS a, toks[i + 1] AS b
       FROM (SELECT toks, unnest(generate_series(1, len(toks) - 1)) AS i FROM toks)),
bi AS (SELECT a, b, count(*) AS n FROM bg GROUP BY a, b),
tot AS (SELECT (SELECT sum(nw) FROM uni) AS n_uni, (SELECT sum(n) FROM bi) AS n_bi),
sc AS (
  SELECT a || ' ' || b AS phrase, n,
         CASE WHEN n / n_bi >= 1.0 THEN 1.0
              ELSE ln((n / n_bi) / ((ua.nw / n_uni) * (ub.nw / n_uni))) / -ln(n / n_bi) END AS npmi
  FROM bi JOIN uni ua ON ua.w = bi.a JOIN uni ub ON ub.w = bi.b, tot
  WHERE n >= {PHRASE_MIN_COUNT}),
mined AS (SELECT phrase, n, npmi FROM sc WHERE round(npmi, 9) >= {PHRASE_MIN_NPMI})
"""


@query("mine_phrases", oracle=f"""
WITH toks AS (SELECT doc_id, {_WT} AS toks FROM documents), {_MINED_SQL}
SELECT phrase, n, round(npmi, 6) AS npmi FROM mined
""")
def mine_phrases(spark, sf):
    p = T.mine_phrases(_docs(spark, sf), "tokens", min_count=PHRASE_MIN_COUNT,
                       min_npmi=PHRASE_MIN_NPMI)
    return p.select("phrase", "n", F.round("npmi", 6).alias("npmi"))


@query("preprocess_text", oracle=f"""
WITH raw AS (SELECT doc_id, {_WT} AS toks FROM documents),
t AS (SELECT doc_id, unnest(generate_series(0, len(toks) - 1)) AS pos, unnest(toks) AS token FROM raw),
lex(token, replacement) AS (VALUES {_LEX_SQL}),
nt AS (SELECT t.doc_id, t.pos, string_split(coalesce(l.replacement, t.token), ' ') AS words
       FROM t LEFT JOIN lex l ON l.token = t.token),
nw AS (SELECT doc_id, pos, unnest(words) AS token, unnest(generate_series(1, len(words))) AS k FROM nt),
toks AS (SELECT doc_id, list(token ORDER BY pos, k) AS toks FROM nw
         WHERE NOT list_contains([{_STOP_SQL}], token) GROUP BY doc_id), {_MINED_SQL},
adj AS (SELECT doc_id, toks[i] || ' ' || toks[i + 1] AS phrase
        FROM (SELECT doc_id, toks, unnest(generate_series(1, len(toks) - 1)) AS i FROM toks)),
parts AS (SELECT doc_id, unnest(toks) AS token, 0 AS part, unnest(generate_series(1, len(toks))) AS pos FROM toks
          UNION ALL
          SELECT a.doc_id, replace(a.phrase, ' ', ''), 1, 0 FROM adj a JOIN mined m ON m.phrase = a.phrase),
firsts AS (SELECT doc_id, token, min((part, pos)) AS place FROM parts GROUP BY doc_id, token),
done AS (SELECT doc_id, string_agg(token, ' ' ORDER BY place, token) AS s FROM firsts GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(done.s, '') END AS text_pre
FROM documents d LEFT JOIN done ON done.doc_id = d.doc_id
""")
def preprocess_text(spark, sf):
    """Normalise, expand contractions, drop stop words, add mined phrases."""
    d = T.lexicon_normalise(_docs(spark, sf), "tokens", CONTRACTIONS, out="norm")
    d = d.withColumn("kept", T.remove_stopwords(F.col("norm"), ENGLISH_STOPWORDS))
    phrases = T.mine_phrases(d, "kept", min_count=PHRASE_MIN_COUNT, min_npmi=PHRASE_MIN_NPMI)
    out = T.append_phrases_join(d, "doc_id", "kept", phrases, out="final")
    return out.select("doc_id", F.array_join("final", " ").alias("text_pre"))


@query("select_tokens", oracle=f"""
WITH {_RATIOS_SQL}, {_grid_sql(K.DEFAULT_STEP, K.DEFAULT_MAX_THRESHOLD)},
best AS (
  SELECT lang, coalesce(min(CASE WHEN n_tokens < {SELECT_N} THEN threshold END),
                        {K.DEFAULT_MAX_THRESHOLD}) AS threshold
  FROM counts GROUP BY lang),
sel AS (SELECT DISTINCT r.token FROM ratios r JOIN best b ON r.lang = b.lang
        WHERE round(abs(r.log_ratio), 9) >= round(b.threshold, 9)),
{_POS_SQL},
kept AS (SELECT doc_id, string_agg(token, ' ' ORDER BY pos) AS s FROM t
         WHERE token IN (SELECT token FROM sel) GROUP BY doc_id)
SELECT d.doc_id, coalesce(k.s, '') AS selected FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id
""")
def select_tokens(spark, sf):
    # texts are split once, for the ratios and the selection
    d = materialize(table(spark, sf, "documents").select("doc_id", "lang", word_tokens("text").alias("tokens")))
    ratios = K.sparse_ratios(d, label_col="lang", tokens_col="tokens")
    vocab = K.feature_selection(ratios, n=SELECT_N)
    counts = ratios.tokens.select("token", F.col("total_freq").alias("n"))
    return T.select_tokens(d.select("doc_id", "tokens"), "doc_id", "tokens", vocab, counts=counts, keep_tokens=False).select("doc_id", "selected")


@query("region_map", oracle="""
SELECT c.c_custkey, coalesce(r.r_name, c.c_nationkey::VARCHAR) AS region
FROM customer c LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
LEFT JOIN region r ON r.r_regionkey = n.n_regionkey
""")
def region_map(spark, sf):
    """Map each customer's nation code to its region name; unknown codes pass through."""
    mapping = (table(spark, sf, "nation").join(table(spark, sf, "region"),
                                              F.col("n_regionkey") == F.col("r_regionkey"))
               .select(F.col("n_nationkey").cast("string").alias("key"), F.col("r_name").alias("value")))
    c = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").cast("string").alias("region"))
    return T.map_values(c, "region", mapping).select("c_custkey", "region")
