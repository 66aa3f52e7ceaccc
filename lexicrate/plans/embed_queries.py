"""Embedding queries (E1-E4) over ``documents.text``."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexicrate.operators import embed as EM
from lexicrate.plans import sql as S
from lexicrate.plans.registry import query
from lexicrate.tables import table

STEP = EM.CHUNK_SIZE - EM.CHUNK_OVERLAP

_CHUNKS_SQL = f"""
cn AS (SELECT doc_id, text, length(coalesce(text, '')) AS n FROM documents),
ch AS (SELECT doc_id, k::BIGINT AS chunk_no, substr(text, k * {STEP} + 1, {EM.CHUNK_SIZE}) AS chunk
       FROM (SELECT doc_id, text,
                    unnest(generate_series(0, CASE WHEN n = 0 THEN -1
                           ELSE greatest(0, ceil((n - {EM.CHUNK_SIZE}) / {STEP}))::BIGINT END)) AS k
             FROM cn)),
ch2 AS (SELECT doc_id, chunk_no, chunk, length(chunk)::BIGINT AS n_chars FROM ch)
"""

_HASH_SQL = f"""
tk AS (SELECT doc_id, chunk_no, unnest({S.vector_tokens('chunk')}) AS tok FROM ch2),
hv AS (SELECT doc_id, chunk_no,
              (('0x' || substr(md5(tok), 1, 8))::BIGINT % {EM.HASH_DIMS}) AS dim,
              CASE WHEN (('0x' || substr(md5(tok), 9, 1))::BIGINT % 2) = 0 THEN 1.0 ELSE -1.0 END AS s
       FROM tk),
raw AS (SELECT doc_id, chunk_no, dim, sum(s) AS v FROM hv GROUP BY ALL),
nrm AS (SELECT doc_id, chunk_no, sqrt(sum(v * v)) AS norm FROM raw GROUP BY ALL),
enc AS (SELECT r.doc_id, r.chunk_no, r.dim, CASE WHEN n.norm > 0 THEN r.v / n.norm ELSE r.v END AS value
        FROM raw r JOIN nrm n ON n.doc_id = r.doc_id AND n.chunk_no = r.chunk_no)
"""


def _chunks(spark, sf):
    return EM.chunk_text(table(spark, sf, "documents"), "doc_id", "text")


@query("chunk_text", oracle=f"""
WITH {_CHUNKS_SQL} SELECT doc_id, chunk_no, n_chars, md5(chunk) AS chunk_md5 FROM ch2
""")
def chunk_text(spark, sf):
    return _chunks(spark, sf).select("doc_id", "chunk_no", "n_chars", F.md5("chunk").alias("chunk_md5"))


_SIZE, _OVERLAP = EM.CHUNK_SIZE, EM.CHUNK_OVERLAP
# Units, the last unit that fits behind each unit, the unit where the next chunk begins, then the chain of chunks.
_GREEDY_SQL = f"""
ul AS (SELECT doc_id, text, flatten(list_transform(regexp_extract_all(coalesce(text, ''), '{EM.SENTENCE_UNIT}'), lambda s:
         CASE WHEN length(s) <= {_SIZE} THEN [length(s)]
              ELSE flatten(list_transform(regexp_extract_all(s, '{EM.WORD_UNIT}'), lambda w:
                   list_transform(range(0, length(w), {_SIZE}), lambda k: least({_SIZE}, length(w) - k)))) END)) AS lens
       FROM documents),
uu AS (SELECT doc_id, unnest(lens) AS len, generate_subscripts(lens, 1) AS i FROM ul),
u AS (SELECT doc_id, i, e - len AS s, e FROM (SELECT doc_id, i, len,
        (sum(len) OVER (PARTITION BY doc_id ORDER BY i))::BIGINT AS e FROM uu)),
fits AS (SELECT u.doc_id, u.i, u.s, v.e, v.i AS j FROM u ASOF JOIN u v ON u.doc_id = v.doc_id AND u.s + {_SIZE} >= v.e),
need AS (SELECT f.doc_id, f.i, f.s, f.e, CASE WHEN w.e IS NOT NULL THEN greatest(f.e - {_OVERLAP}, w.e - {_SIZE}) END AS b
         FROM fits f LEFT JOIN u w ON w.doc_id = f.doc_id AND w.i = f.j + 1),
step AS (SELECT n.doc_id, n.i, n.s, n.e, k.i AS next FROM need n ASOF LEFT JOIN u k ON n.doc_id = k.doc_id AND n.b <= k.s),
chain AS (SELECT doc_id, 0::BIGINT AS chunk_no, s, e, next FROM step WHERE i = 1
          UNION ALL SELECT c.doc_id, c.chunk_no + 1, t.s, t.e, t.next FROM chain c JOIN step t ON t.doc_id = c.doc_id AND t.i = c.next)
"""


@query("chunk_greedy", oracle=f"""
WITH RECURSIVE {_GREEDY_SQL}
SELECT c.doc_id, c.chunk_no, c.s::BIGINT AS start, (c.e - c.s)::BIGINT AS n_chars,
       md5(substr(d.text, c.s + 1, c.e - c.s)) AS chunk_md5
FROM chain c JOIN documents d ON d.doc_id = c.doc_id
""")
def chunk_greedy(spark, sf):
    return EM.chunk_greedy(table(spark, sf, "documents"), "doc_id", "text").select(
        "doc_id", "chunk_no", "start", "n_chars", F.md5("chunk").alias("chunk_md5"))


def _encoded(spark, sf):
    return EM.hash_encode(_chunks(spark, sf))


@query("hash_encode", oracle=f"""
WITH {_CHUNKS_SQL}, {_HASH_SQL}
SELECT doc_id, chunk_no, dim, round(value, 6) AS value FROM enc WHERE round(value, 9) <> 0
""")
def hash_encode(spark, sf):
    e = _encoded(spark, sf)
    return (e.select("doc_id", "chunk_no", F.posexplode_outer("embedding").alias("dim", "value"))
            .where(F.round("value", 9) != 0)
            .select("doc_id", "chunk_no", F.col("dim").cast("long").alias("dim"),
                    F.round("value", 6).alias("value")))


_POOLED_SQL = f"""
{_CHUNKS_SQL}, {_HASH_SQL},
tot AS (SELECT doc_id, sum(n_chars) AS total FROM ch2 GROUP BY doc_id),
ws AS (SELECT e.doc_id, e.dim, sum(e.value * c.n_chars) AS s
       FROM enc e JOIN ch2 c ON c.doc_id = e.doc_id AND c.chunk_no = e.chunk_no GROUP BY ALL)
"""

#: Long form of the pooled vectors: components that are not zero, and one row with NULLs for a text without characters.
_POOLED_ROWS = """
SELECT ws.doc_id, ws.dim, round((ws.s / tot.total)::{type}::DOUBLE, 5) AS value
FROM ws JOIN tot ON tot.doc_id = ws.doc_id WHERE abs(ws.s / tot.total) > 1e-6
UNION ALL SELECT doc_id, NULL, NULL FROM documents WHERE coalesce(text, '') = ''
"""

MEAN_ORACLE = f"WITH {_POOLED_SQL} {_POOLED_ROWS.format(type='DOUBLE')}"
#: Document embeddings are single precision (array<float>).
POOLED_ORACLE = f"WITH {_POOLED_SQL} {_POOLED_ROWS.format(type='FLOAT')}"


def long_form(df, digits=5):
    """(doc_id, dim, value) of an ``embedding`` column."""
    return (df.select("doc_id", F.posexplode_outer("embedding").alias("dim", "value"))
            .where(F.col("value").isNull() | (F.abs("value") > 1e-6))
            .select("doc_id", F.col("dim").cast("long").alias("dim"),
                    F.round(F.col("value").cast("double"), digits).alias("value")))


@query("weighted_mean_embedding", oracle=MEAN_ORACLE)
def weighted_mean_embedding(spark, sf):
    chunks = EM.chunk_text(table(spark, sf, "documents"), "doc_id", "text", keep_empty=True)
    encoded = chunks.withColumn("embedding", F.when(F.col("chunk").isNotNull(), EM.hash_vector(F.col("chunk"))))
    return long_form(EM.weighted_mean_embedding(encoded, "doc_id"))


@query("embed_documents", oracle=POOLED_ORACLE)
def embed_documents(spark, sf):
    return long_form(EM.embed_documents(table(spark, sf, "documents"), "doc_id", "text"))
