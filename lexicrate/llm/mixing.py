"""Mixing sources to target weights (native).

Every document gets a hash-random key.  Within its source the documents are
range-sorted by that key, running token counts come from distributed prefix
sums (totals of key ranges first, then rows within a range), and each source
is cut at its exact budget.  A budget above the source's size repeats whole
epochs before the cut.

Targets: the sources in code-point order (null last) weigh 5, 2, 1 in turn and
share all tokens; a target stops at ``max_epochs`` times its source's size and
the excess goes to the others by weight until none is above.  That fixed point
is found from sorted prefix sums: sources reach their cap in order of cap per
weight.

Defined results: a null text has size 0; a null source is a source of its own;
a null id sorts first among equal keys; a source of size 0 has target 0; an
empty table gives an empty result.  Rows equal in id and text are
interchangeable.  Columns besides id, text and source are ignored, or handed
through whole in ``row`` when ``carry`` is set.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexicrate.session import store

#: A word, and the weights that repeat over the sources.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
#: Rows that one range of a source's keys aims at.
RANGE_ROWS = 4096
KEY_BITS = 60
#: Sources up to which their table of four numbers is broadcast (some 4 MB); beyond, the join is salted.
BROADCAST_SOURCES, SALTS = 1 << 16, 16


def running(df: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """``df`` with running totals (this row included) over the whole table in
    ``order``, which must be total: ranges are sorted on their own, and the
    totals of the ranges before a row's are added."""
    part = df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    part = store(part.select("*", *[c.alias(f"_{k}") for k, c in sums.items()]), "ranges")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = (part.groupBy("_part").agg(*[F.sum(f"_{k}").alias(f"_sum_{k}") for k in sums])
               .select("_part", *[F.coalesce(F.sum(f"_sum_{k}").over(before), F.lit(0)).alias(f"_off_{k}") for k in sums]))
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = part.join(offsets, "_part")
    return out.select(*df.columns, *[(F.sum(f"_{k}").over(inside) + F.col(f"_off_{k}")).alias(k) for k in sums])


def targets(sized: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``source, source_size, n_rows, target`` for rows of ``source, size``."""
    src = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_rows"))
    src = running(src, [F.col("source").asc_nulls_last()], {"rank": F.lit(1)})
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    src = src.withColumn("w", weight.cast("long")).withColumn("cap", F.col("source_size") * max_epochs)
    src = src.withColumn("reach", F.col("cap") / F.col("w"))
    src = running(src, [F.col("reach"), F.col("rank")], {"cum_cap": F.col("cap"), "cum_w": F.col("w")})
    src = store(src, "sources")
    t, all_w = (F.lit(x or 0).cast("long") for x in src.agg(F.sum("source_size"), F.sum("w")).first())
    c0, w0 = F.col("cum_cap") - F.col("cap"), all_w - F.col("cum_w") + F.col("w")
    # its share among those that reach their cap no earlier lies above its cap
    src = src.withColumn("stops", (t - c0) * F.col("w") > F.col("cap") * w0)
    used, used_w = (F.lit(x or 0).cast("long") for x in src.where("stops").agg(F.sum("cap"), F.sum("w")).first())
    share = (t - used).cast("double") * F.col("w") / (all_w - used_w)
    return src.select("source", "source_size", "n_rows",
                      F.round(F.when(F.col("stops"), F.col("cap").cast("double")).otherwise(share), 6).alias("target"))


def random_key(id_col: Column, seed: str) -> Column:
    """A uniform key of KEY_BITS bits from the id, the same in every run."""
    text = F.concat(F.coalesce(id_col.cast("string"), F.lit("null")), F.lit(seed))
    return F.conv(F.substring(F.md5(text), 1, KEY_BITS // 4), 16, 10).cast("long")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS,
        max_epochs: int = MAX_EPOCHS, seed: str = ":mix", carry: bool = False) -> DataFrame:
    """One row per input row: ``doc_id, size, source_size, target, taken``
    (words the mix takes of the row, repeats counted) and, with ``carry``, the
    input row as the struct ``row``.  ``taken`` is whole epochs of ``size``
    words and, for one row of a source at most, a part of it."""
    sized = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
                        random_key(F.col(id_col), seed).alias("key"), F.xxhash64(text_col).alias("tie"),
                        *([F.struct(*docs.columns).alias("row")] if carry else []))
    sized = store(sized, "sized")
    src = store(targets(sized, weights, max_epochs), "targets")

    # ranges of the key: as many for a source as its rows ask for, all of one width
    bits = F.greatest(F.lit(0), F.ceil(F.log2(F.col("n_rows") / RANGE_ROWS))).cast("int")
    share = src.select(F.col("source").alias("s"), "source_size", "target", bits.alias("bits"))
    same = F.col("source").eqNullSafe(F.col("s"))
    if src.count() <= BROADCAST_SOURCES:
        share = F.broadcast(share)
    else:  # too many to broadcast: a hot source's rows meet SALTS copies of its row
        share = share.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        sized = sized.withColumn("salt", F.pmod(F.col("key"), F.lit(SALTS)).cast("int"))
        same = same & (sized["salt"] == share["salt"])
    ranged = (sized.join(share, same).drop("s", "salt")
              .withColumn("range", F.floor(F.col("key") / F.pow(F.lit(2.0), F.lit(KEY_BITS) - F.col("bits"))).cast("long")))
    sums = ranged.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("source").alias("s"), F.col("range").alias("r"),
                       F.coalesce(F.sum("range_size").over(before), F.lit(0)).alias("offset"))
    ranged = ranged.join(sums, F.col("source").eqNullSafe(F.col("s")) & (F.col("range") == F.col("r"))).drop("s", "r")
    inside = Window.partitionBy("source", "range").orderBy("key", "doc_id", "tie").rowsBetween(Window.unboundedPreceding, 0)
    ranged = ranged.repartitionByRange("source", "range")
    start = F.sum("size").over(inside) + F.col("offset") - F.col("size")
    budget = F.floor(F.col("target") + 0.5).cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    left = budget - epochs * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), left - start))
    return ranged.withColumn("taken", epochs * F.col("size") + part).select(
        "doc_id", "size", "source_size", "target", "taken", *(["row"] if carry else []))


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix itself, in the columns of ``docs``: a row for each epoch of a
    document, and its first words where the budget cuts within it.  A document
    without words takes no part of a budget and stays once.

    With ids that are all different and not null only they and the sizes are
    sorted, and one join brings the texts back; otherwise the rows travel along."""
    ids = docs.select(F.col(id_col).alias("id"))
    odd = ids.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 OR id IS NULL").limit(1).count()
    m = mix(docs, id_col, text_col, source_col, carry=bool(odd), **options)
    whole = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).otherwise(1).cast("int")
    rest = F.when(F.col("size") > 0, F.col("taken") % F.col("size")).otherwise(0)
    # one entry per copy: 0 for the whole text, else the words to cut it to
    copies = F.concat(F.array_repeat(F.lit(0).cast("long"), whole), F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<bigint>")))
    if odd:
        m = m.select("row", copies.alias("cuts"))
    else:
        m = (m.where("taken > 0 OR size = 0").select(F.col("doc_id").alias("_id"), copies.alias("cuts"))
             .join(docs.select(F.col(id_col).alias("_own"), F.struct(*docs.columns).alias("row")), F.col("_id") == F.col("_own")))
    m = m.select("row", F.explode("cuts").alias("cut"))
    text = F.col(f"row.{text_col}")
    pieces = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    cut = F.when(F.col("cut") == 0, text).otherwise(F.array_join(F.slice(pieces, F.lit(1), F.col("cut").cast("int")), " "))
    out = {c: F.col(f"row.{c}") for c in docs.columns}
    out[text_col] = cut
    if "n_chars" in out:
        out["n_chars"] = F.when(F.col("cut") == 0, out["n_chars"]).otherwise(F.length(cut).cast("long"))
    return m.select(*[c.alias(k) for k, c in out.items()])


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(doc_id::VARCHAR || ':mix'), 1, 15))::BIGINT AS key FROM documents),
src AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM sized GROUP BY source),
wt AS (SELECT *, [5, 2, 1][((rank - 1) % 3 + 1)::INT]::BIGINT AS w, 3 * source_size AS cap FROM src),
run AS (
  SELECT *, sum(cap) OVER o - cap AS c0, sum(w) OVER () - sum(w) OVER o + w AS w0,
         sum(source_size) OVER () AS t, sum(w) OVER () AS all_w
  FROM wt WINDOW o AS (ORDER BY cap / w, rank ROWS UNBOUNDED PRECEDING)),
st AS (SELECT *, (t - c0) * w > cap * w0 AS stops FROM run),
tg AS (
  SELECT source, source_size, round(CASE WHEN stops THEN cap::DOUBLE ELSE
    (t - coalesce(sum(cap) FILTER (stops) OVER (), 0))::DOUBLE * w::DOUBLE / (all_w - coalesce(sum(w) FILTER (stops) OVER (), 0))::DOUBLE END, 6) AS target FROM st),
cum AS (
  SELECT doc_id, size, source_size, target, floor(target + 0.5)::BIGINT AS budget,
         (sum(size) OVER (PARTITION BY z.source ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS start
  FROM sized z JOIN tg ON z.source IS NOT DISTINCT FROM tg.source),
ep AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM cum)
SELECT doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(size, budget - epochs * source_size - start)))::BIGINT AS taken FROM ep
"""
