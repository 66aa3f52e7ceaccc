"""Profiling and exact-duplicate queries over ``documents``."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexicrate.functions.text import first_line
from lexicrate.operators import profile as P
from lexicrate.plans import sql as S
from lexicrate.plans.registry import query
from lexicrate.tables import table

DOC_COLS = ["text", "lang", "source", "n_chars"]


def _docs(spark, sf):
    return table(spark, sf, "documents")


@query("table_profile", oracle="""
SELECT column_name, data_type, position, non_null, n_rows FROM (VALUES
  ('doc_id', 'bigint', 0::BIGINT),
  ('text', 'string', 1::BIGINT),
  ('lang', 'string', 2::BIGINT),
  ('source', 'string', 3::BIGINT),
  ('n_chars', 'bigint', 4::BIGINT)) AS t(column_name, data_type, position)
JOIN (
  SELECT 'doc_id' AS c, count(doc_id) AS non_null FROM documents UNION ALL
  SELECT 'text', count(text) FROM documents UNION ALL
  SELECT 'lang', count(lang) FROM documents UNION ALL
  SELECT 'source', count(source) FROM documents UNION ALL
  SELECT 'n_chars', count(n_chars) FROM documents) nn ON nn.c = t.column_name
CROSS JOIN (SELECT count(*) AS n_rows FROM documents)
""")
def table_profile(spark, sf):
    return P.table_profile(_docs(spark, sf))


@query("value_counts", oracle="SELECT source, count(*) AS n FROM documents GROUP BY source")
def value_counts(spark, sf):
    return P.value_counts(_docs(spark, sf), "source")


@query("repeated_values", oracle=f"""
SELECT {S.first_line('text')} AS title, count(*) AS n FROM documents
GROUP BY 1 HAVING count(*) >= 2 ORDER BY n DESC, title ASC LIMIT 5
""")
def repeated_values(spark, sf):
    d = _docs(spark, sf).select(first_line("text").alias("title"))
    return P.top_k(d, "title", 5, min_count=2)


@query("topk_directors", oracle="""
SELECT source, count(*) AS n FROM documents GROUP BY source ORDER BY n DESC, source ASC LIMIT 10
""")
def topk_directors(spark, sf):
    return P.top_k(_docs(spark, sf), "source", 10)


@query("director_genre_crosstab", oracle="""
WITH top AS (SELECT source FROM documents GROUP BY source ORDER BY count(*) DESC, source LIMIT 10)
SELECT source, lang, count(*) AS n FROM documents WHERE source IN (SELECT source FROM top)
GROUP BY source, lang
""")
def director_genre_crosstab(spark, sf):
    return P.crosstab_top_k(_docs(spark, sf), "source", "lang", 10)


@query("class_distribution", oracle="""
SELECT lang, count(*) AS n, round(count(*) / (SELECT count(*) FROM documents), 6) AS share
FROM documents GROUP BY lang
""")
def class_distribution(spark, sf):
    return (P.value_counts(_docs(spark, sf), "lang", normalize=True)
            .withColumn("share", F.round("share", 6)))


@query("head_rows", oracle=f"""
SELECT doc_id, {S.first_line('text')} AS title, lang, source, n_chars
FROM documents ORDER BY doc_id LIMIT 10
""")
def head_rows(spark, sf):
    d = _docs(spark, sf).select("doc_id", first_line("text").alias("title"), "lang", "source", "n_chars")
    return P.head_rows(d, "doc_id", 10)


@query("fill_with_min", oracle="""
WITH j AS (SELECT d.doc_id, l.quality FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)
SELECT doc_id, coalesce(quality, (SELECT min(quality) FROM j)) AS quality FROM j
""")
def fill_with_min(spark, sf):
    j = (_docs(spark, sf).select("doc_id")
         .join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left"))
    return P.fill_with_min(j, "quality")


@query("duplicate_count", oracle="""
SELECT coalesce(sum(n - 1), 0)::BIGINT AS n_duplicates
FROM (SELECT count(*) AS n FROM documents GROUP BY text, lang, source, n_chars)
""")
def duplicate_count(spark, sf):
    return P.duplicate_count(_docs(spark, sf), DOC_COLS)


@query("duplicate_rows", oracle=f"""
SELECT doc_id, {S.first_line('text')} AS title, lang, source,
       count(*) OVER (PARTITION BY text, lang, source, n_chars) AS group_size
FROM documents QUALIFY group_size > 1
""")
def duplicate_rows(spark, sf):
    return (P.duplicate_rows(_docs(spark, sf), DOC_COLS)
            .select("doc_id", first_line("text").alias("title"), "lang", "source", "group_size"))


@query("drop_duplicates_first", oracle="""
SELECT doc_id, lang, source FROM documents
QUALIFY row_number() OVER (PARTITION BY text, lang, source, n_chars ORDER BY doc_id) = 1
""")
def drop_duplicates_first(spark, sf):
    return P.drop_duplicates_first(_docs(spark, sf), DOC_COLS, "doc_id").select("doc_id", "lang", "source")


@query("conflicting_duplicates", oracle="""
WITH bad AS (SELECT text, count(DISTINCT source) AS n_targets FROM documents
             WHERE source IS NOT NULL GROUP BY text HAVING count(DISTINCT source) > 1)
SELECT d.doc_id, d.source, d.lang, b.n_targets FROM documents d JOIN bad b ON b.text = d.text
""")
def conflicting_duplicates(spark, sf):
    return (P.conflicting_duplicates(_docs(spark, sf), "text", "source")
            .select("doc_id", "source", "lang", "n_targets"))
