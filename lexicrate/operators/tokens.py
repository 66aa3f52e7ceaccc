"""Token-level operators.

Tokens stay inside the row as arrays wherever the step is row-local (lexicon
look-ups with a small fixed lexicon, stop-word filtering); a shuffle on the
token is used only when the other side is a table that can grow (a large
lexicon, a selected vocabulary), and the document is then rebuilt from
``(row_id, pos, token)`` rows of that one document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from lexicrate.functions.text import explode_tokens, word_tokens
from lexicrate.operators.features import frequent_part
from lexicrate.operators.joins import free_name
from lexicrate.session import materialize

#: Most frequent tokens of which each task knows whether they are selected.
BROADCAST_TOKENS = 1 << 16


def token_table(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row_id, pos, token) for the normalised tokens of every row."""
    return explode_tokens(df, word_tokens(text_col), keep=[F.col(id_col)], with_pos="pos")


def _regroup(exploded: DataFrame, id_col: str, token_col: str, ids: DataFrame,
             order_cols: tuple[str, ...] = ("pos",)) -> DataFrame:
    """Rebuild ordered token arrays per row; rows with no surviving token get [].

    A group here is the tokens of one input row, so its size is bounded by
    the longest document, not by the data."""
    grouped = (exploded.groupBy(id_col)
               .agg(F.array_sort(F.collect_list(F.struct(*order_cols, token_col))).alias("_s"))
               .select(id_col, F.transform("_s", lambda x: x[token_col]).alias("tokens")))
    return (ids.select(id_col).join(grouped, id_col, "left")
            .select(id_col, F.coalesce("tokens", F.array().cast("array<string>")).alias("tokens")))


def lexicon_normalise(df: DataFrame, tokens_col: str, lexicon, *, out: str = "tokens_norm",
                      id_col: str | None = None) -> DataFrame:
    """Replace each token by its lexicon entry (possibly several words).

    ``lexicon`` is a dict (compiled into a map literal) or a DataFrame
    ``(token, replacement)`` joined on the token.  NULL tokens stay NULL in both."""
    if isinstance(lexicon, dict):
        m = F.create_map(*[F.lit(x) for kv in sorted(lexicon.items()) for x in kv])
        # most tokens have no entry and no space: one look into a hash set, no walk through the map and no split
        repl = F.transform(F.col(tokens_col), lambda t: F.when(t.isin(*lexicon), F.split(F.coalesce(F.try_element_at(m, t), t), " "))
                           .when(t.contains(" "), F.split(t, " ")).when(t.isNotNull(), F.array(t)))
        return df.withColumn(out, F.flatten(repl))
    if id_col is None:
        raise ValueError("a lexicon table needs id_col to rebuild rows")
    ex = df.select(id_col, F.posexplode(tokens_col).alias("pos", "token"))
    ex = (ex.join(lexicon, "token", "left")
          .select(id_col, "pos", F.posexplode(F.split(F.coalesce("replacement", "token"), " "))
                  .alias("sub", "word")))
    rebuilt = _regroup(ex, id_col, "word", df, ("pos", "sub")).withColumnRenamed("tokens", out)
    return df.join(rebuilt, id_col, "left").withColumn(out, F.when(F.col(tokens_col).isNotNull(), F.col(out)))


def remove_stopwords(tokens, stopwords: list[str]):
    """Column: tokens without the given stop words (T4).  ``isin`` over constants becomes a
    hash set; an array would be walked for every token."""
    return F.filter(tokens, lambda t: ~t.isin(*stopwords))


def adjacent_pairs(tokens, combine):
    """Column: ``combine(t[i], t[i+1])`` for every adjacent pair, built by
    zipping two shifted slices (the lambda reads only its own arguments)."""
    m = F.greatest(F.size(tokens) - 1, F.lit(0))
    return F.zip_with(F.slice(tokens, 1, m), F.slice(tokens, 2, m), combine)


def mine_phrases(df: DataFrame, tokens_col: str, *, min_count: int = 5,
                 min_npmi: float = 0.5) -> DataFrame:
    """Adjacent word pairs that co-occur more than chance (T5).

    Bigrams are made inside each row (``transform`` over positions), counted
    with partial aggregation, then scored by normalised PMI against unigram
    counts.  The tokens are written once, and of each count only what is scored: words, and
    pairs of at least ``min_count`` with one row for all others.  Columns: phrase, n, npmi."""
    df, toks = materialize(df.select(tokens_col)), F.col(tokens_col)
    bigrams = adjacent_pairs(toks, lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    uni = materialize(explode_tokens(df, toks, keep=[], alias="w").groupBy("w").agg(F.count(F.lit(1)).alias("nw")))
    bi = (explode_tokens(df, bigrams, keep=[], alias="g").select("g.a", "g.b")
          .groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")))
    bi = materialize(bi.groupBy(F.when(F.col("n") >= min_count, F.struct("a", "b")).alias("g")).agg(F.sum("n").alias("n")))
    n_uni = uni.select(F.sum("nw")).scalar()
    n_bi = bi.select(F.sum("n")).scalar()
    scored = (bi.where(F.col("g").isNotNull()).select("g.a", "g.b", "n")
              .join(uni.select(F.col("w").alias("a"), F.col("nw").alias("na")), "a")
              .join(uni.select(F.col("w").alias("b"), F.col("nw").alias("nb")), "b"))
    p_ab = F.col("n") / n_bi
    pmi = F.log(p_ab / ((F.col("na") / n_uni) * (F.col("nb") / n_uni)))
    npmi = F.when(p_ab >= 1.0, F.lit(1.0)).otherwise(pmi / -F.log(p_ab))
    return (scored.select(F.concat_ws(" ", "a", "b").alias("phrase"), "n", npmi.alias("npmi"))
            .where(F.round("npmi", 9) >= min_npmi))


def append_phrases_join(df: DataFrame, id_col: str, tokens_col: str, phrases: DataFrame,
                        *, out: str = "with_phrases") -> DataFrame:
    """Token set plus the joined form of every phrase (column ``phrase``,
    words separated by one space) that occurs as adjacent tokens, in order of the
    joined form (T5).

    Any number of phrases: adjacent pairs are semi-joined with the phrase
    table and the matches are gathered per document (a group is one
    document), so nothing passes through the driver."""
    pairs = explode_tokens(df, adjacent_pairs(F.col(tokens_col), lambda a, b: F.concat_ws(" ", a, b)),
                           keep=[id_col], alias="phrase")
    found = (pairs.join(phrases.select("phrase").distinct(), "phrase", "left_semi")
             .groupBy(id_col).agg(F.array_sort(F.collect_set(F.regexp_replace("phrase", " ", ""))).alias("_found")))
    return (df.join(found, id_col, "left")
            .withColumn(out, F.array_distinct(F.concat(
                F.col(tokens_col), F.coalesce("_found", F.array().cast("array<string>")))))
            .drop("_found"))


def _runs(lists: pa.Array, tokens: pa.Array, kept: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """(runs, open) of token lists: the kept tokens of a row joined by spaces, and the tokens that are neither
    among ``tokens`` (with ``kept`` for each) nor null.  The k-th open token stands between runs k and k + 1; an
    empty run is null, and so is the list of a null row."""
    valid = lists.is_valid().to_numpy(zero_copy_only=False)
    coded, row = lists.flatten().dictionary_encode(), pc.list_parent_indices(lists).to_numpy().astype(np.int64)
    known = pc.index_in(coded.dictionary, value_set=tokens).fill_null(-1).to_numpy()
    state = np.where(known < 0, 2, kept[known] if len(kept) else 0)  # 0 dropped, 1 kept, 2 open
    there = coded.indices.is_valid().to_numpy(zero_copy_only=False)
    codes, row = coded.indices.drop_null().to_numpy(), row[there]
    state = state[codes]
    is_open = state == 2
    n_open = np.bincount(row[is_open], minlength=len(lists))
    n_runs = np.where(valid, n_open + 1, 0)
    first = np.cumsum(n_runs) - n_runs
    run = first[row] + np.cumsum(is_open) - (np.cumsum(n_open) - n_open)[row]
    sizes = np.bincount(run[state == 1], minlength=n_runs.sum())

    def ends(sizes: np.ndarray) -> pa.Array:
        return pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
    joined = pc.binary_join(pa.ListArray.from_arrays(ends(sizes), coded.dictionary.take(pa.array(codes[state == 1]))), " ")
    joined = pc.if_else(pa.array(sizes > 0), joined, pa.scalar(None, joined.type))
    return (pa.ListArray.from_arrays(ends(n_runs), joined, mask=pa.array(~valid)),
            pa.ListArray.from_arrays(ends(n_open), coded.dictionary.take(pa.array(codes[is_open]))))


def select_tokens(df: DataFrame, id_col: str, tokens_col: str, vocabulary: DataFrame,
                  *, out: str = "selected", counts: DataFrame | None = None, keep_tokens: bool = True) -> DataFrame:
    """Keep the tokens that are in ``vocabulary`` (column ``token``), order and
    repeats preserved; rows with no survivor get '' and NULL text stays NULL (T7).

    The vocabulary can be large.  Of the ``BROADCAST_TOKENS`` most frequent tokens (``counts``: token, n; counted here
    if not given) each task knows whether they are in it, and joins the kept ones to runs where the row is.  Only
    the occurrences of rarer tokens, few by definition, go out by token; those found come back by row, and
    the row itself moves once, as its runs.  Rows are told apart by a key of their own, not by ``id_col``.
    Columns: those of ``df`` (without the tokens unless ``keep_tokens``) and ``out``."""
    taken = df.columns
    key, runs, rest = (free_name(n, [*taken, out]) for n in ("_key", "_runs", "_open"))
    rows = df.withColumn(key, F.monotonically_increasing_id())
    if counts is None:
        counts = explode_tokens(df, F.col(tokens_col), keep=[]).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    vocabulary = vocabulary.select("token", F.lit(True).alias("kept")).distinct()
    counts = materialize(counts.select("token", "n").join(vocabulary, "token", "left").select("token", "n", F.coalesce("kept", F.lit(False)).alias("kept")))
    is_hot = frequent_part(counts, "n", BROADCAST_TOKENS)
    hot = counts.where(is_hot).select("token", "kept").toArrow()
    tokens, kept = hot["token"].combine_chunks(), hot["kept"].to_numpy().astype(np.int64)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = dict(zip(batch.schema.names, batch.columns))
            found = _runs(columns[tokens_col], tokens, kept)
            yield pa.RecordBatch.from_arrays([*(columns[c] for c in carried), *found], names=[*carried, runs, rest])
    carried = [c for c in rows.columns if keep_tokens or c != tokens_col]
    schema = StructType([rows.schema[c] for c in carried] + [StructField(c, ArrayType(StringType())) for c in (runs, rest)])
    rows = materialize(rows.mapInArrow(split, schema))
    open_tokens = explode_tokens(rows, F.col(rest), keep=[key], with_pos="pos")
    seldom = (open_tokens.join(counts.where(~is_hot & F.col("kept")).select("token").hint("merge"), "token", "left_semi")
              .groupBy(key).agg(F.collect_list(F.struct((F.col("pos") * 2 + 1).alias("at"), F.col("token").alias("s"))).alias(rest)))
    own = F.transform(F.col(runs), lambda s, k: F.struct((k * 2).alias("at"), s.alias("s")))
    whole = F.array_sort(F.concat(own, F.coalesce(F.col(rest), F.array().cast("array<struct<at:int,s:string>>"))))
    return (rows.drop(rest).join(seldom, key, "left")
            .withColumn(out, F.array_join(F.transform(whole, lambda x: x["s"]), " "))
            .select(*[F.col(f"`{c}`") for c in taken if c in carried and c != out], out))


def map_values(df: DataFrame, col: str, mapping, *, out: str | None = None,
               key: str = "key", value: str = "value") -> DataFrame:
    """Replace values found in ``mapping``; others pass through.

    A dict is compiled into a map literal; a DataFrame ``(key, value)`` is
    left-joined (adaptive execution broadcasts it when small)."""
    out = out or col
    if isinstance(mapping, dict):
        m = F.create_map(*[F.lit(x) for kv in sorted(mapping.items()) for x in kv])
        return df.withColumn(out, F.coalesce(F.try_element_at(m, F.col(col)), F.col(col)))
    mp = mapping.select(F.col(key).alias("_k"), F.col(value).alias("_v"))
    return (df.join(mp, df[col] == mp["_k"], "left")
            .withColumn(out, F.coalesce(F.col("_v"), F.col(col))).drop("_k", "_v"))
