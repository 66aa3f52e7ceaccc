"""Joins that carry long values by digest and split hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key with more than one in ``HOT_KEYS`` of all counted rows is hot, so there are fewer hot keys than this.
HOT_KEYS = 1000
#: Most 64-bit words of ``key_bits``: a bound on its rows, whatever the number of keys.
KEY_WORDS = 1 << 18


def value_digest(col: Column | str) -> Column:
    """SHA-256 of a value; NULL stays NULL.  Equal digests are taken as equal values."""
    return F.sha2((F.col(col) if isinstance(col, str) else col).cast("string"), 256)


def row_digest(cols: list[str]) -> Column:
    """SHA-256 of several columns, equal exactly where all of them are equal or both NULL."""
    parts = []
    for c in cols:
        s = F.col(c).cast("string")
        parts.append(F.coalesce(F.concat(F.length(s).cast("string"), F.lit(":"), s), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def free_name(name: str, taken: list[str]) -> str:
    """``name``, with underscores in front until no column (of any case) has it."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name = "_" + name
    return name


def attach_groups(df: DataFrame, key: Column, groups: DataFrame, *, key_col: str, size_col: str,
                  values: list[str], how: str = "inner") -> DataFrame:
    """The rows of ``df`` with the ``values`` of their group.

    ``groups`` is a written table with one row per key (text or integer) and the number of
    rows that carry it.  Fewer than ``HOT_KEYS`` keys can be hot; they are broadcast, and
    in the shuffle their rows go by a hash of the whole row instead, so no task gathers the
    rows of one key.  A NULL key finds nothing; ``how`` is inner or left.  Columns of ``df``
    named like a value are replaced."""
    if how not in ("inner", "left"):
        raise ValueError("how must be inner or left")
    kept = [c for c in df.columns if c not in values]
    k, s, h, c = (free_name(n, df.columns + groups.columns) for n in ("_key", "_spread", "_hot", "_cold"))
    total = groups.agg(F.sum(size_col)).first()[0] or 0
    found = F.struct(*values)
    hot = groups.where(F.col(key_col).isNotNull() & (F.col(size_col) * HOT_KEYS > total))
    cold_key = F.col(h).isNull() & F.col(k).isNotNull()
    anywhere = F.xxhash64(*[F.col(f"`{n}`") for n in df.columns]).cast("string")
    marked = (df.withColumn(k, key).join(F.broadcast(hot.select(F.col(key_col).alias(k), found.alias(h))), k, "left")
              .withColumn(s, F.when(cold_key, F.col(k).cast("string")).otherwise(anywhere)))
    cold = groups.where(F.col(key_col).isNotNull() & (F.col(size_col) * HOT_KEYS <= total)).select(
        F.col(key_col).cast("string").alias(s), found.alias(c))
    # a row that went by its hash may meet a key of that spelling: its cold match is not read
    joined = marked.join(cold, s, "left").withColumn(h, F.when(cold_key, F.col(c)).otherwise(F.col(h)))
    if how == "inner":
        joined = joined.where(F.col(h).isNotNull())
    return joined.select(*[F.col(f"`{n}`") for n in kept], *[F.col(h)[v].alias(v) for v in values])


def one_bit(hash_: Column) -> Column:
    """A 64-bit word with the bit that the last six bits of a hash name."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), hash_.bitwiseAND(F.lit(63)).cast("int"))


def _key_place(key: Column, at: str, bit: str) -> list[Column]:
    h = F.xxhash64(key)
    return [F.pmod(F.shiftright(h, 6), F.lit(KEY_WORDS)).cast("bigint").alias(at), one_bit(h).alias(bit)]


def key_bits(keys: DataFrame, key: Column) -> DataFrame:
    """(_word, _bits): a bit for each key, by its hash; at most ``KEY_WORDS`` rows, to be broadcast."""
    return (keys.where(key.isNotNull()).select(*_key_place(key, "_word", "_bit"))
            .groupBy("_word").agg(F.bit_or("_bit").alias("_bits")))


def maybe_among(df: DataFrame, key: Column, bits: DataFrame) -> DataFrame:
    """The rows whose key has its bit in ``bits`` (``key_bits``): all rows with one of its keys and, as hashes may meet, some others.

    No row is moved.  The more keys there are, the more others stay, so an exact step must follow."""
    at, bit = _key_place(key, "_at", "_own")
    return df.join(F.broadcast(bits), (at == F.col("_word")) & (F.col("_bits").bitwiseAND(bit) != 0), "left_semi")


def rows_among(df: DataFrame, id_col: str, ids: DataFrame) -> DataFrame:
    """The rows of ``df`` whose id is in the column of that name of ``ids``, a written table; the rows of other ids are dropped where they are, nearly all of them."""
    wanted = ids.select(id_col)
    return maybe_among(df, F.col(id_col), key_bits(wanted, F.col(id_col))).join(wanted.distinct(), id_col, "left_semi")
