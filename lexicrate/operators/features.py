"""Feature engineering (FE1-FE10): TF-IDF, vocabularies, n-grams, categorical
encodings, label codes, stratified split and label attachment.

Two forms are offered where it matters: the MLlib pipeline form (sparse
vectors for learners) and a relational long form ``(row_id, term, weight)``
that can be joined, filtered and checked like any other table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import (IDF, CountVectorizer, ElementwiseProduct, Normalizer,
                                OneHotEncoder, StringIndexer)
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexicrate.functions.text import char_ngrams, explode_tokens, jaccard
from lexicrate.operators.joins import key_bits, maybe_among, rows_among
from lexicrate.session import materialize

#: Terms whose document frequencies are broadcast.
BROADCAST_TERMS = 1 << 16


# ---------------------------------------------------------------- TF-IDF ----
def frequent_part(counts: DataFrame, size_col: str, most: int) -> Column:
    """Condition on ``size_col`` that holds for no more than ``most`` rows of a written table, the largest first.

    Only the number of rows of each size reaches the driver (sizes that differ are few next to the rows)."""
    left, low = most, None
    for size, n in counts.groupBy(size_col).agg(F.count(F.lit(1))).orderBy(F.col(size_col).desc()).toLocalIterator():
        left -= n
        if left < 0:
            break
        low = size
    return F.lit(False) if low is None else F.col(size_col) >= low


def _count_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct tokens of each row with their counts; rows without a token go."""
    for batch in batches:
        lists = batch.column("_tokens")
        tokens, row = lists.flatten(), pc.list_parent_indices(lists).to_numpy()
        if tokens.null_count:
            row, tokens = row[tokens.is_valid().to_numpy(zero_copy_only=False)], tokens.drop_null()
        if not len(tokens):
            continue
        coded = tokens.dictionary_encode()
        width = len(coded.dictionary)
        cells, tf = np.unique(row.astype(np.int64) * width + coded.indices.to_numpy(), return_counts=True)
        rows, sizes = np.unique(cells // width, return_counts=True)
        ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
        terms = pa.StructArray.from_arrays([coded.dictionary.take(pa.array(cells % width)), pa.array(tf)], names=["term", "tf"])
        yield pa.RecordBatch.from_arrays([batch.column("_id").take(pa.array(rows)), pa.ListArray.from_arrays(ends, terms)], names=["_id", "_terms"])


def has_repeats(df: DataFrame, id_col: str) -> bool:
    """Whether an id has several rows."""
    return not df.groupBy(id_col).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").isEmpty()


def counted_rows(df: DataFrame, id_col: str, tokens: Column, repeated: bool) -> DataFrame:
    """One row per id that has a token: _id and _terms, its distinct tokens with counts (term, tf).

    Rows are counted where they are; only if ids are ``repeated`` are their rows brought together first."""
    rows = df.select(F.col(id_col).alias("_id"), tokens.alias("_tokens"))
    if repeated:
        rows = rows.groupBy("_id").agg(F.flatten(F.collect_list("_tokens")).alias("_tokens"))
    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(_count_tokens, f"_id {kind}, _terms array<struct<term: string, tf: bigint>>")


def tfidf_long(df: DataFrame, id_col: str, tokens_col: str, *,
               only_ids: DataFrame | None = None) -> DataFrame:
    """Relational TF-IDF (FE1): raw term count, smoothed idf
    ``ln((1+n)/(1+df)) + 1`` over all rows, L2-normalised per row.

    Columns: id, term, tf, weight.  A row is counted where it is and written as one
    list (``counted_rows``), which goes once by id; weights and norm are made where it then is.  The document
    frequencies of the ``BROADCAST_TERMS`` most frequent terms are broadcast; only the occurrences of
    rarer ones, few by definition, go out by term and come back by id as one list a row.  With
    ``only_ids`` (a written table) the idf still comes from every row, but weights and norms are
    produced only for the listed rows: only these are written, and only their terms counted."""
    n_docs = df.select(F.count(F.lit(1))).scalar()
    repeated = has_repeats(df, id_col)
    if only_ids is None or repeated:
        docs = materialize(counted_rows(df, id_col, F.col(tokens_col), repeated))
        terms = docs.select(F.explode("_terms.term").alias("term"))
    else:
        docs = materialize(counted_rows(rows_among(df, id_col, only_ids), id_col, F.col(tokens_col), False))
        wanted = key_bits(docs.select(F.explode("_terms.term").alias("term")), F.col("term"))
        terms = maybe_among(explode_tokens(df, F.array_distinct(tokens_col), keep=[], alias="term"), F.col("term"), wanted)
    freq = materialize(terms.groupBy("term").agg(F.count(F.lit(1)).alias("df")))
    is_hot = frequent_part(freq, "df", BROADCAST_TERMS)
    hot = F.broadcast(freq.where(is_hot).toDF("_hot", "_hot_df"))
    rare = freq.where(~is_hot).toDF("_rare", "_rare_df")

    docs = docs.where(F.col("_id").isNotNull())
    if only_ids is not None and repeated:
        docs = docs.join(only_ids.select(F.col(id_col).alias("_id")).distinct(), "_id", "left_semi")
    seldom = docs.select("_id", F.explode("_terms").alias("_t")).select("_id", "_t.*").join(hot, F.col("term") == F.col("_hot"), "left_anti")
    seldom = (seldom.join(rare.hint("merge"), F.col("term") == F.col("_rare"))
              .groupBy("_id").agg(F.collect_list(F.struct("term", "tf", F.col("_rare_df").alias("rare"))).alias("_seldom")))
    plain = F.transform("_terms", lambda t: F.struct(t["term"].alias("term"), t["tf"].alias("tf"), F.lit(None).cast("bigint").alias("rare")))
    terms = F.when(F.col("_seldom").isNull(), plain).otherwise(F.concat("_seldom", plain))
    one = docs.join(seldom.hint("merge"), "_id", "left").select("_id", F.explode(terms).alias("_t"))
    one = one.select("_id", "_t.*").join(hot, F.col("term") == F.col("_hot"), "left")
    found = F.coalesce("_hot_df", "rare")  # a rare term is there twice, once with its frequency
    one = one.where(found.isNotNull())
    raw = one.select("_id", "term", "tf", (F.col("tf") * (F.log((n_docs + 1) / (found + 1)) + 1)).alias("raw"))
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy("_id")))  # the rows of an id are in one place already
    return raw.withColumn("norm", norm).select(F.col("_id").alias(id_col), "term", "tf", (F.col("raw") / F.col("norm")).alias("weight"))


def tfidf_vectors(df: DataFrame, tokens_col: str, *, out: str = "features",
                  vocab_size: int = 1 << 18, min_df: float = 1.0):
    """MLlib TF-IDF with the smoothed idf + 1 and L2 norm (FE1, FE2).

    MLlib's IDF is ``ln((n+1)/(df+1))``; the missing ``+1`` is added by
    scaling with ``idf + 1`` (``ElementwiseProduct`` keeps vectors sparse).
    Returns (transformed DataFrame, fitted CountVectorizerModel)."""
    cv = CountVectorizer(inputCol=tokens_col, outputCol="_tf", vocabSize=vocab_size,
                         minDF=min_df).fit(df)
    tf = cv.transform(df)
    idf = IDF(inputCol="_tf", outputCol="_unused").fit(tf)
    scale = Vectors.dense([v + 1.0 for v in idf.idf.toArray()])
    raw = ElementwiseProduct(scalingVec=scale, inputCol="_tf", outputCol="_raw").transform(tf)
    normed = Normalizer(inputCol="_raw", outputCol=out, p=2.0).transform(raw)
    return normed.drop("_tf", "_raw"), cv


def top_vocabulary(df: DataFrame, tokens_col: str, k: int) -> DataFrame:
    """The k terms with the highest corpus count, ties by term (FE2)."""
    return (explode_tokens(df, F.col(tokens_col), keep=[], alias="term")
            .groupBy("term").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.col("n").desc(), F.col("term").asc()).limit(k))


def word_ngrams(tokens, n_min: int = 2, n_max: int = 4):
    """Column: all word n-grams (space-joined) for n in [n_min, n_max] (FE3)."""
    def grams(n):
        # zip n shifted slices; tokens contain no spaces, so joining pairwise
        # equals joining the n-token window
        m = F.greatest(F.size(tokens) - n + 1, F.lit(0))
        acc = F.slice(tokens, 1, m)
        for k in range(2, n + 1):
            acc = F.zip_with(acc, F.slice(tokens, k, m), lambda a, b: F.concat_ws(" ", a, b))
        return acc
    return F.flatten(F.array(*[grams(n) for n in range(n_min, n_max + 1)]))


# ---------------------------------------------------------- categoricals ----
def one_hot(df: DataFrame, col: str, *, out: str = "onehot"):
    """Alphabetical category index + one-hot vector with an extra slot for
    unseen values (FE5).  Returns (DataFrame with ``{col}_idx`` and ``out``, models)."""
    si = StringIndexer(inputCol=col, outputCol=f"{col}_idx", stringOrderType="alphabetAsc",
                       handleInvalid="keep").fit(df)
    idx = f"{col}_idx"
    # codes without the values' names, which may not be empty: an empty text is a value like any other
    coded = {"ml_attr": {"type": "nominal", "name": idx, "num_vals": len(si.labels) + 1}}
    indexed = si.transform(df)
    indexed = indexed.withColumn(idx, F.col(idx).alias(idx, metadata=coded))
    # the indexer already gives unseen values their own index, so the encoder
    # needs no extra slot of its own
    ohe = OneHotEncoder(inputCols=[idx], outputCols=[out], dropLast=False).fit(indexed)
    return ohe.transform(indexed), (si, ohe)


def similarity_encode(values: DataFrame, col: str, categories: DataFrame, cat_col: str,
                      *, n_min: int = 2, n_max: int = 4) -> DataFrame:
    """Similarity of each distinct value to each training category: Jaccard of
    character 2-4-gram sets (FE6).  Long form: value, category, similarity.

    The category list (a small, known dimension) is attached to every distinct
    value as one array computed once; no join of data against data."""
    cats = (categories.select(F.col(cat_col).alias("category")).where(F.col("category").isNotNull())
            .distinct()
            .select(F.array_sort(F.collect_list(F.struct(
                "category", char_ngrams("category", n_min, n_max).alias("grams")))).alias("cats")))
    cats_arr = cats.scalar()
    vals = (values.select(F.col(col).alias("value")).distinct()
            .select("value", char_ngrams("value", n_min, n_max).alias("grams"), cats_arr.alias("cats")))
    ex = vals.select("value", "grams", F.explode("cats").alias("c"))
    return ex.select("value", F.col("c.category").alias("category"),
                     jaccard(F.col("grams"), F.col("c.grams")).alias("similarity"))


def similarity_pairs(values: DataFrame, col: str, categories: DataFrame, cat_col: str,
                     *, n_min: int = 2, n_max: int = 4) -> DataFrame:
    """The similarities of ``similarity_encode`` that are not zero: value, category, similarity.

    An inverted index: distinct values and categories meet on their n-grams, shared grams
    are counted, and the sizes give the Jaccard.  A pair without a shared gram has
    similarity 0 and no row; no list of categories is gathered, so they may be many."""
    def side(df: DataFrame, name: str, alias: str) -> DataFrame:
        grams = df.select(F.col(name).alias(alias)).distinct().select(alias, char_ngrams(alias, n_min, n_max).alias("g"))
        return grams.select(alias, F.size("g").alias(f"n_{alias}"), F.explode("g").alias("gram"))
    met = side(values, col, "value").join(side(categories.where(F.col(cat_col).isNotNull()), cat_col, "category"), "gram")
    shared = met.groupBy("value", "n_value", "category", "n_category").agg(F.count(F.lit(1)).alias("both"))
    return shared.select("value", "category", (F.col("both") / (F.col("n_value") + F.col("n_category") - F.col("both"))).alias("similarity"))


def feature_union(blocks: dict[str, DataFrame], id_col: str) -> DataFrame:
    """Feature blocks as one sparse long table (FE7): id, block, name, value.

    Each block has the columns (id, name, value); zeros are left out, no vector is
    made dense and no vocabulary is cut."""
    parts = [df.select(id_col, F.lit(block).alias("block"), F.col("name").cast("string").alias("name"),
                       F.col("value").cast("double").alias("value")) for block, df in blocks.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.where(F.col("value") != 0)


def label_encode(df: DataFrame, col: str, *, out: str = "label_idx"):
    """Alphabetical label code (FE8).  Returns (DataFrame, StringIndexerModel);
    ``IndexToString(labels=model.labels)`` decodes."""
    model = StringIndexer(inputCol=col, outputCol=out, stringOrderType="alphabetAsc").fit(df)
    return model.transform(df).withColumn(out, F.col(out).cast("long")), model


def _label_key(col: str) -> Column:
    """A map key for a label of any type; NULL is a label of its own."""
    return F.coalesce(F.concat(F.lit("="), F.col(col).cast("string")), F.lit("null"))


def _entry_map(df: DataFrame, key: str, *values: str) -> Column:
    """A small table (one row per label) as one map column: key -> struct(values)."""
    return df.select(F.map_from_entries(F.collect_list(F.struct(key, F.struct(*values))))).scalar()


def stratified_split(df: DataFrame, id_col: str, label_col: str, *, test_fraction: float = 0.1,
                     seed: str = "42") -> DataFrame:
    """Exact, repeatable stratified split (FE9).

    Within each label, rows are ordered by ``md5(id || seed)``, then id; the first
    ``round(test_fraction * n_label)`` rows are the test set.  No window runs over a
    whole label (a label can hold a third of the rows): rows are counted per (label,
    hash bucket) with partial aggregation, a running sum over the bounded bucket grid
    finds the bucket where the cut falls, and only that bucket's rows are ranked, which
    gives the last test row (hash, id) of each label.  Rows are then flagged in place
    against that cut, one row per label, so no other column of ``df`` is ever moved.
    Adds column ``split``."""
    h = F.md5(F.concat(F.col(id_col).cast("string"), F.lit(seed)))
    # bucket = first 16 bits of the hash; bucket order agrees with hash order
    keyed = (df.select(F.col(id_col).alias("_id"), _label_key(label_col).alias("_l"), h.alias("_h"))
             .withColumn("_b", F.conv(F.substring("_h", 1, 4), 16, 10).cast("long")))
    per_label = Window.partitionBy("_l")
    running = per_label.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    k = F.round(F.col("_n") * test_fraction).cast("long")
    edges = (keyed.groupBy("_l", "_b").agg(F.count(F.lit(1)).alias("_nb"))
             .select("_l", "_b", "_nb", F.sum("_nb").over(per_label).alias("_n"), F.sum("_nb").over(running).alias("_cum"))
             .withColumn("_need", k - F.col("_cum") + F.col("_nb"))
             .where((F.col("_need") > 0) & (F.col("_need") <= F.col("_nb"))))
    edge = F.try_element_at(_entry_map(edges, "_l", "_b", "_need"), F.col("_l"))
    last = (keyed.withColumn("_e", edge).where(F.col("_b") == F.col("_e._b"))
            .withColumn("_r", F.row_number().over(per_label.orderBy("_h", "_id")))
            .where(F.col("_r") == F.col("_e._need")))
    cut = F.try_element_at(_entry_map(last, "_l", "_h", "_id"), _label_key(label_col))
    in_test = (h < cut["_h"]) | ((h == cut["_h"]) & (F.col(id_col) <= cut["_id"]))
    return df.withColumn("split", F.when(in_test, F.lit("test")).otherwise(F.lit("train")))
