"""Text column expressions.

Everything here returns a ``Column`` built from Spark's own functions so it
stays inside whole-stage code generation; no Python runs per row.

Regular expressions are written so that Java (Spark) and RE2 read them the
same way: no look-around, Unicode classes spelled as ``\\p{..}``.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed patterns (values that must stay as they are for matching results)
# ---------------------------------------------------------------------------
# ASCII punctuation: the 32 characters !"#$%&'()*+,-./:;<=>?@[\]^_`{|}~
ASCII_PUNCT = r"[!-/:-@\[-`{-~]"
# Word run or a single other visible character (punctuation-style token).
WORD_OR_PUNCT = r"[\p{L}\p{N}_]+|[^\s\p{Z}\p{L}\p{N}_]"
# Vectoriser token: a run of two or more word characters.
VECTOR_TOKEN = r"[\p{L}\p{N}_]{2,}"
# Whitespace separator (ASCII whitespace and Unicode separators).
WHITESPACE = r"[\s\p{Z}]+"
# Sentence: a run up to a terminator, with the terminators that follow it.
SENTENCE = r"[^.!?\n]+[.!?]*"
# Word run used for name keys.
WORD_RUN = r"[\p{L}\p{N}_]+"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_ascii_punct(col: Column | str) -> Column:
    """Delete ASCII punctuation characters."""
    return F.regexp_replace(_c(col), ASCII_PUNCT, "")


def word_tokens(col: Column | str) -> Column:
    """Token list of the normalised text: punctuation deleted, lower-cased,
    then split into word runs and single remaining symbols (T1/T2)."""
    return F.regexp_extract_all(F.lower(strip_ascii_punct(col)), F.lit(WORD_OR_PUNCT), 0)


def raw_word_tokens(col: Column | str) -> Column:
    """Word-or-punctuation tokens of the raw text (used by text statistics)."""
    return F.regexp_extract_all(F.coalesce(_c(col), F.lit("")), F.lit(WORD_OR_PUNCT), 0)


def vector_tokens(col: Column | str) -> Column:
    """Vectoriser tokens: lower-cased runs of >= 2 word characters."""
    return F.regexp_extract_all(F.lower(F.coalesce(_c(col), F.lit(""))), F.lit(VECTOR_TOKEN), 0)


def whitespace_tokens(col: Column | str) -> Column:
    """Lower-cased whitespace split with empty pieces removed."""
    return F.filter(F.split(F.lower(F.coalesce(_c(col), F.lit(""))), WHITESPACE),
                    lambda x: x != "")


def token_set(col: Column | str) -> Column:
    """Distinct whitespace tokens (set semantics for Jaccard)."""
    return F.array_distinct(whitespace_tokens(col))


def sentences(col: Column | str) -> Column:
    return F.regexp_extract_all(F.coalesce(_c(col), F.lit("")), F.lit(SENTENCE), 0)


def jaccard(a: Column, b: Column) -> Column:
    """|a ∩ b| / |a ∪ b| of two distinct-valued arrays; 0 when both are empty."""
    inter = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - inter
    return F.when(union == 0, F.lit(0.0)).otherwise(inter / union)


def name_key(col: Column | str) -> Column:
    """Standard key of a person name (D5): lower-case, drop space, hyphen and
    period, keep word segments longer than two characters, concatenate."""
    squeezed = F.translate(F.lower(_c(col)), " -.", "")
    words = F.regexp_extract_all(squeezed, F.lit(WORD_RUN), 0)
    return F.array_join(F.filter(words, lambda w: F.length(w) > 2), "")


def lcs_length(a: Column | str, b: Column | str) -> Column:
    """Length of the longest common subsequence of two strings.

    Row-by-row dynamic programme with higher-order functions: the outer
    ``aggregate`` walks the characters of ``a`` carrying the previous DP row,
    the inner one builds the next row left to right.
    """
    a, b = _c(a), _c(b)
    la, lb = F.length(a), F.length(b)
    first_row = F.array_repeat(F.lit(0), lb + 1)

    def next_row(prev, i):
        ca = F.substring(a, i, 1)

        def step(cur, j):
            val = F.when(ca == F.substring(b, j, 1), prev[j - 1] + 1) \
                   .otherwise(F.greatest(prev[j], F.element_at(cur, -1)))
            return F.concat(cur, F.array(val))

        return F.aggregate(F.sequence(F.lit(1), lb), F.array(F.lit(0)), step)

    final = F.aggregate(F.sequence(F.lit(1), la), first_row, next_row)
    return F.when((la == 0) | (lb == 0), F.lit(0)).otherwise(F.element_at(final, -1))


def fuzzy_ratio(a: Column | str, b: Column | str) -> Column:
    """Normalised indel similarity in [0, 100]: 200 * LCS / (len a + len b);
    100 for two empty strings."""
    a, b = _c(a), _c(b)
    total = F.length(a) + F.length(b)
    return F.when(total == 0, F.lit(100.0)).otherwise(200.0 * lcs_length(a, b) / total)


def _lcs_bits(a: str, b: str) -> int:
    """Length of the longest common subsequence: one big integer holds a whole
    row of the table, so memory is linear in the shorter name."""
    if len(a) > len(b):
        a, b = b, a
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        u = row & at.get(c, 0)
        row = ((row + u) | (row - u)) & full
    return len(a) - row.bit_count()


def _ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else 100.0 if not x and not y
                      else 200.0 * _lcs_bits(x, y) / (len(x) + len(y)) for x, y in zip(a, b)], dtype="float64")


def long_fuzzy_ratio(a: Column | str, b: Column | str) -> Column:
    """``fuzzy_ratio`` for names of any length, in Arrow batches."""
    return F.pandas_udf(_ratio, "double")(_c(a), _c(b))


def ratio_bound(a: Column | str, b: Column | str) -> Column:
    """No less than ``long_fuzzy_ratio``, without Python: a common subsequence holds only
    characters that both names have, so the characters of either that the other lacks do not count."""
    a, b = _c(a), _c(b)
    total = F.length(a) + F.length(b)
    shared = F.least(*[F.length(x) - F.length(F.call_function("translate", x, y, F.lit(""))) for x, y in ((a, b), (b, a))])
    return F.when(total == 0, F.lit(100.0)).otherwise(200.0 * shared / total)


def char_ngrams(col: Column | str, n_min: int = 2, n_max: int = 4) -> Column:
    """Distinct character n-grams (n_min..n_max) of the lower-cased value
    padded with one space each side."""
    s = F.concat(F.lit(" "), F.lower(F.coalesce(_c(col), F.lit(""))), F.lit(" "))
    grams = F.flatten(F.transform(
        F.sequence(F.lit(n_min), F.lit(n_max)),
        lambda n: F.transform(
            F.sequence(F.lit(1), F.greatest(F.length(s) - n + 1, F.lit(1))),
            lambda i: F.substring(s, i, n))))
    return F.array_distinct(F.filter(grams, lambda g: F.length(g) >= n_min))


def first_line(col: Column | str) -> Column:
    return F.split_part(_c(col), F.lit("\n"), F.lit(1))


def explode_tokens(df, tokens, *, keep: list, alias: str = "token", with_pos: str | None = None):
    """Rows of ``keep`` columns with one token each; rows with no tokens vanish.

    ``explode_outer`` plus a filter on the generated column gives the same
    rows as ``explode``, but stops the optimizer from inferring a
    ``size(tokens) > 0`` filter and pushing that (a second tokenisation) below
    an earlier repartition, where it would run before the work is spread."""
    if with_pos:
        out = df.select(*keep, F.posexplode_outer(tokens).alias(with_pos, alias))
    else:
        out = df.select(*keep, F.explode_outer(tokens).alias(alias))
    return out.where(F.col(alias).isNotNull())
