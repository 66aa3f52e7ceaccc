"""Per-document text statistics and their distribution summaries (TS1-TS8).

Per-document numbers are column expressions (regex + higher-order functions);
distribution summaries are aggregates over a long ``(stat, value)`` table, so
they are computed for every statistic in one job.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexicrate.functions.text import WORD_OR_PUNCT, raw_word_tokens, sentences
from lexicrate.session import materialize

STAT_COLUMNS = ["num_tokens_per_doc", "num_sentences_per_doc", "avg_sentence_length_per_doc",
                "avg_doc_length", "num_chars_per_doc", "sentence_length_variance"]
# The four statistics the reference draws as histograms and box plots.
PLOTTED_STATS = STAT_COLUMNS[:4]
# A kernel is added to grid points up to this many bandwidths away.
REACH = 8


def text_statistics(df: DataFrame, text_col: str, *, keep: list[str] | None = None) -> DataFrame:
    """Token, sentence, length and sentence-length-variance numbers per row (TS1)."""
    toks = F.size(raw_word_tokens(text_col)).cast("long")
    sent_lens = F.transform(sentences(text_col),
                            lambda s: F.size(F.regexp_extract_all(s, F.lit(WORD_OR_PUNCT), 0)).cast("long"))
    # One pass over the sentence lengths: count, sum and sum of squares as
    # exact integers.  No lambda refers to an outer column, so the optimizer
    # can never inline the (regex) sentence split into a per-element loop.
    moments = F.aggregate(sent_lens, F.struct(F.lit(0).cast("long").alias("n"),
                                              F.lit(0).cast("long").alias("s"),
                                              F.lit(0).cast("long").alias("q")),
                          lambda acc, x: F.struct((acc["n"] + 1).alias("n"), (acc["s"] + x).alias("s"),
                                                  (acc["q"] + x * x).alias("q")))
    base = df.select(*(keep or []), toks.alias("num_tokens_per_doc"), moments.alias("_m"),
                     F.length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("num_chars_per_doc"))
    n_sent = F.col("_m.n")
    # population variance = (n*q - s^2) / n^2, exact in integers before the division
    var = ((n_sent * F.col("_m.q") - F.col("_m.s") * F.col("_m.s")).cast("double")
           / (n_sent * n_sent).cast("double"))
    return base.select(
        *(keep or []),
        "num_tokens_per_doc",
        n_sent.alias("num_sentences_per_doc"),
        F.when(n_sent > 0, F.col("num_tokens_per_doc") / n_sent).otherwise(F.lit(0.0))
         .alias("avg_sentence_length_per_doc"),
        F.col("num_tokens_per_doc").alias("avg_doc_length"),
        "num_chars_per_doc",
        F.when(n_sent > 0, var).otherwise(F.lit(0.0)).alias("sentence_length_variance"))


def to_long(stats: DataFrame, stat_cols: list[str], keep: list[str] | None = None) -> DataFrame:
    """(stat, value) rows, one per statistic and document."""
    arr = F.array(*[F.struct(F.lit(c).alias("stat"), F.col(c).cast("double").alias("value"))
                    for c in stat_cols])
    return stats.select(*(keep or []), F.explode(arr).alias("e")).select(*(keep or []), "e.*")


def stopword_frequency(df: DataFrame, text_col: str, stopwords: DataFrame) -> DataFrame:
    """Occurrences of each stop word in the lower-cased whitespace tokens (TS2).

    ``stopwords`` is a fixed one-column table (``word``) and is broadcast."""
    from lexicrate.functions.text import explode_tokens, whitespace_tokens
    words = explode_tokens(df, whitespace_tokens(text_col), keep=[], alias="word")
    return (words.join(F.broadcast(stopwords), "word", "left_semi")
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")))


def histogram(long: DataFrame, *, bins: int = 30) -> DataFrame:
    """Equal-width histogram per statistic, empty bins included (TS3).

    min/max per statistic is a tiny aggregate joined back; the bin grid is
    generated from it, so no cross join with the data is needed."""
    rng = long.groupBy("stat").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    width = F.col("hi") - F.col("lo")
    binned = (long.join(rng, "stat")
              .select("stat", F.when(width == 0, F.lit(0)).otherwise(
                  F.least(F.floor((F.col("value") - F.col("lo")) / width * bins), F.lit(bins - 1)))
                  .cast("long").alias("bin"))
              .groupBy("stat", "bin").agg(F.count(F.lit(1)).alias("n")))
    grid = rng.select("stat", "lo", "hi",
                      F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    edge = lambda i: F.col("lo") + (F.col("hi") - F.col("lo")) * i / bins
    return (grid.withColumn("bin", F.col("bin").cast("long"))
            .join(binned, ["stat", "bin"], "left")
            .select("stat", "bin", edge(F.col("bin")).alias("bin_lo"),
                    edge(F.col("bin") + 1).alias("bin_hi"),
                    F.coalesce("n", F.lit(0)).cast("long").alias("n")))


def density(long: DataFrame, *, points: int = 200, bins: int | None = None) -> DataFrame:
    """Gaussian kernel density on a ``points`` grid per statistic (TS4).

    Equal values are counted first; each distinct value then adds its kernel to the
    grid points within ``REACH`` bandwidths (beyond, a kernel is below 1.3e-14 of its
    peak), and the sums are combined before the shuffle.  Bandwidths shrink as rows grow,
    so a value touches ever fewer points.  The grids (one row per statistic) are a scalar
    sub-query.  A grid point that no value reaches has density 0.  ``bins`` replaces the values by that many bin
    centres per statistic, an approximation for statistics with very many distinct
    values.  Bandwidth: Scott's rule."""
    summ = long.where(F.col("value").isNotNull()).groupBy("stat").agg(
        F.min("value").alias("lo"), F.max("value").alias("hi"), F.count(F.lit(1)).alias("n_obs"),
        F.stddev_samp("value").alias("sd"))
    h = F.greatest(F.coalesce("sd", F.lit(0.0)) * F.pow(F.col("n_obs"), -0.2), F.lit(1e-9))
    grids = summ.select(F.map_from_entries(F.collect_list(F.struct("stat", F.struct("lo", "hi", "n_obs", h.alias("h")))))).scalar()
    weighted = (long.where(F.col("value").isNotNull()).groupBy("stat", "value").agg(F.count(F.lit(1)).alias("weight"))
                .withColumn("g", grids[F.col("stat")]))
    span = F.col("g.hi") - F.col("g.lo")
    if bins is not None:
        b = F.least(F.floor((F.col("value") - F.col("g.lo")) / F.greatest(span, F.lit(1e-12)) * bins), F.lit(bins - 1))
        weighted = weighted.withColumn("value", F.col("g.lo") + (b + 0.5) * F.greatest(span, F.lit(1e-12)) / bins)
    # grid places of value - reach and value + reach; all points lie at one place when the span is 0
    place = lambda v: F.when(span > 0, (v - F.col("g.lo")) / span * (points - 1))
    first = F.greatest(F.ceil(F.coalesce(place(F.col("value") - REACH * F.col("g.h")), F.lit(0.0))), F.lit(0)).cast("int")
    last = F.least(F.floor(F.coalesce(place(F.col("value") + REACH * F.col("g.h")), F.lit(points - 1.0))), F.lit(points - 1)).cast("int")
    at = weighted.select("stat", "value", "weight", "g", F.explode(F.when(first <= last, F.sequence(first, last))).alias("i"))
    x = F.col("g.lo") + span * F.col("i") / (points - 1)
    z = (x - F.col("value")) / F.col("g.h")
    sums = at.groupBy("stat", "i").agg(F.sum(F.col("weight") * F.exp(-0.5 * z * z)).alias("s"))
    grid = summ.select("stat", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i"))
    return (grid.join(sums, ["stat", "i"], "left").withColumn("g", grids[F.col("stat")])
            .select("stat", x.alias("x"),
                    (F.coalesce("s", F.lit(0.0)) / (F.col("g.n_obs") * F.col("g.h") * math.sqrt(2 * math.pi))).alias("density")))


def box_summary(long: DataFrame, *, by: list[str] | None = None) -> DataFrame:
    """Quartiles, 1.5-IQR whiskers and outlier count per statistic (TS5), exact.

    No group meets in one task: equal values are counted, the distinct values are
    range-sorted and written, running counts inside each range and a sum over the ranges
    before it give every value its ranks, and the values at the quartile ranks are
    picked by an aggregate.  Quartiles interpolate between neighbouring ranks."""
    keys = ["stat"] + (by or [])
    counts = long.where(F.col("value").isNotNull()).groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("c"))
    ranged = materialize(counts.repartitionByRange(*keys, "value").withColumn("part", F.spark_partition_id()))
    before = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranged.groupBy(*keys, "part").agg(F.sum("c").alias("cp"))
               .withColumn("off", F.coalesce(F.sum("cp").over(before), F.lit(0)))
               .withColumn("n", F.sum("cp").over(Window.partitionBy(*keys))))
    inside = Window.partitionBy(*keys, "part").orderBy("value")
    ranks = (ranged.withColumn("upto", F.sum("c").over(inside)).join(offsets, [*keys, "part"])
             .withColumn("upto", F.col("off") + F.col("upto")))

    def at(q: float):
        place = F.lit(q) * (F.col("n") - 1)
        low = F.min(F.when(F.col("upto") > F.floor(place), F.col("value")))
        high = F.min(F.when(F.col("upto") > F.ceil(place), F.col("value")))
        share = F.lit(q) * (F.max("n") - 1)
        return low + (high - low) * (share - F.floor(share))
    quart = ranks.groupBy(*keys).agg(F.max("n").alias("n"), at(0.25).alias("q1"), at(0.5).alias("median"), at(0.75).alias("q3"))
    iqr = F.col("q3") - F.col("q1")
    lo_f, hi_f = F.col("q1") - 1.5 * iqr, F.col("q3") + 1.5 * iqr
    return ranged.join(quart, keys).groupBy(*keys, "n", "q1", "median", "q3").agg(
        F.min(F.when(F.col("value") >= lo_f, F.col("value"))).alias("whisker_lo"),
        F.max(F.when(F.col("value") <= hi_f, F.col("value"))).alias("whisker_hi"),
        F.coalesce(F.sum(F.when((F.col("value") < lo_f) | (F.col("value") > hi_f), F.col("c"))), F.lit(0)).alias("n_outliers"))


def correlation(stats: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, one aggregation pass (TS6)."""
    pairs = [(a, b) for a in cols for b in cols]
    one = stats.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    arr = F.array(*[F.struct(F.lit(a).alias("stat_a"), F.lit(b).alias("stat_b"),
                             F.col(f"c{i}").alias("corr")) for i, (a, b) in enumerate(pairs)])
    return one.select(F.explode(arr).alias("e")).select("e.*")
