"""Name consolidation and frequency encoding of a multi-valued name column.

Flow: explode the comma list of names with provenance (D8) -> similar texts
give candidate name pairs (D2) -> fuzzy ratio on the *distinct* name pairs
only (D6) -> canonical map, last pair wins (D7) -> replace (D9) -> normalised
frequency over distinct (name, text) (D10) -> best value per input row (D11)
-> attach (D12).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexicrate.functions.text import long_fuzzy_ratio, ratio_bound, name_key
from lexicrate.operators.dedup import group_links, text_groups
from lexicrate.operators.joins import attach_groups, free_name, value_digest
from lexicrate.operators.tokens import map_values
from lexicrate.session import materialize

# The reference's fuzzy threshold as used by the encoding step.
FUZZY_THRESHOLD = 77


def name_variants(df: DataFrame, col: str) -> DataFrame:
    """Group spellings by their standard key (D5): key, number of spellings,
    rows, and the most frequent spelling (ties by value)."""
    per_value = (df.where(F.col(col).isNotNull())
                 .groupBy(col).agg(F.count(F.lit(1)).alias("n"))
                 .withColumn("name_key", name_key(col)))
    return (per_value.groupBy("name_key")
            .agg(F.count(F.lit(1)).alias("n_variants"),
                 F.sum("n").alias("n_rows"),
                 F.min_by(F.col(col), F.struct(-F.col("n"), F.col(col))).alias("top_variant")))


def explode_names(df: DataFrame, *, id_col: str, names_col: str, source: str,
                  keep: list[str] | None = None) -> DataFrame:
    """One row per (source, row, name): split on commas, trim, drop empty."""
    return (df.select(F.lit(source).alias("source"), F.col(id_col).alias("row_id"), *(keep or []),
                      F.explode(F.split(F.col(names_col), ",")).alias("name"))
            .withColumn("name", F.trim("name"))
            .where(F.col("name") != ""))


def fuzzy_name_pairs(pairs: DataFrame, names: DataFrame, id_col: str, name_col: str,
                     text_col: str | None = None, *, at_least: float = 0.0) -> DataFrame:
    """Ratio of each ordered pair of different names that similar rows carry.

    ``names`` has one row per row and name.  Names of all copies of a text are
    compared, also with each other; without ``text_col`` each id is a text of its own.
    The earlier (first id, name) is name_i.  Columns: name_i, name_j, ratio, last (the
    place of the latest such pair).  Name sets are reduced to distinct names per text
    first, and the ratio runs once per distinct pair of names.  Pairs below ``at_least`` are
left out; ``ratio_bound`` drops most of these before any reaches Python."""
    if text_col is None:
        groups = (names.select(F.col(id_col).alias("rep"), F.lit(name_col).alias("column"),
                               F.col(name_col).cast("string").alias("value"), F.col(id_col).alias("first_id")).distinct())
    else:
        groups = text_groups(names, id_col, text_col, [name_col])
    groups = materialize(groups.where(F.col("value").isNotNull()))

    def side(tag):
        return groups.select(F.col("rep").alias(f"id_{tag}"), F.struct("first_id", "value").alias(tag))
    links = group_links(pairs.withColumns({c: F.lit(1.0) for c in ("cosine", "jaccard")}), groups).select("id_i", "id_j")
    met = (links.join(side("i"), "id_i").join(side("j"), "id_j")
           .where((F.col("i.value") != F.col("j.value")) & ((F.col("id_i") < F.col("id_j")) | (F.col("i") < F.col("j")))))
    ordered = met.select(F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j"))
    met = (ordered.groupBy(F.col("i.value").alias("name_i"), F.col("j.value").alias("name_j"))
           .agg(F.max(F.struct("i", "j")).alias("last")))
    if at_least > 0:
        met = met.where(ratio_bound("name_i", "name_j") >= at_least)
    scored = met.select("name_i", "name_j", long_fuzzy_ratio("name_i", "name_j").alias("ratio"), "last")
    return scored.where(F.col("ratio") >= at_least) if at_least > 0 else scored


def fuzzy_name_map(pairs: DataFrame, names: DataFrame, id_col: str, name_col: str, text_col: str | None = None, *,
                   threshold: float = FUZZY_THRESHOLD, closure: bool = False) -> DataFrame:
    """name_j -> name_i for pairs with ratio >= threshold.

    The latest pair wins for the same name_j; self maps are dropped.  With ``closure``
    all names that the map connects go to the smallest of them.  Columns: key, value."""
    scored = fuzzy_name_pairs(pairs, names, id_col, name_col, text_col, at_least=threshold)
    found = scored.groupBy(F.col("name_j").alias("key")).agg(F.max_by("name_i", "last").alias("value"))
    return name_closure(found) if closure else found


def name_closure(links: DataFrame, a: str = "key", b: str = "value") -> DataFrame:
    """One spelling for all names that links connect (D7 with closure, off by default):
    key -> smallest name reachable, links read both ways; names that stay are left out.

    Alternating large and small stars: neighbours move to the smallest name next to them,
    round by round, until no link changes.  Each round is written to the shared folder; a
    name with very many neighbours is split over the tasks (``attach_groups``)."""
    edges = materialize(links.where(F.col(a) != F.col(b))
                        .select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct())

    def hook(pairs: DataFrame) -> DataFrame:
        """(u, v, m): each pair with the smallest v of its u."""
        least = materialize(pairs.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")))
        return attach_groups(pairs, F.col("u"), least, key_col="u", size_col="n", values=["m"])

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("hi", "lo"))).first())
    before, now = None, state(edges)
    while now != before:
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(
            edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        large = materialize(hook(both).where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())
        met = hook(large)
        small = met.where("v <> m").select(F.col("v").alias("hi"), F.col("m").alias("lo")).union(
            met.select(F.col("u").alias("hi"), F.col("m").alias("lo")))
        edges = materialize(small.distinct())
        before, now = now, state(edges)
    return edges.select(F.col("hi").alias("key"), F.col("lo").alias("value"))


def frequency_encode(names: DataFrame, name_col: str, text_col: str) -> DataFrame:
    """Normalised frequency of each name over distinct (name, text) rows.

    Columns: name, encoded.  Texts are told apart by digest; the total is a scalar sub-query."""
    distinct = names.select(name_col, value_digest(text_col).alias(free_name("_digest", [name_col]))).distinct()
    total = distinct.select(F.count(F.lit(1))).scalar()
    return (distinct.groupBy(name_col).agg(F.count(F.lit(1)).alias("n"))
            .select(F.col(name_col).alias("name"), (F.col("n") / total).alias("encoded")))


def max_encoding_per_row(encoded_names: DataFrame) -> DataFrame:
    """Largest encoding per (source, row_id)."""
    return encoded_names.groupBy("source", "row_id").agg(F.max("encoded").alias("encoded"))


def encoding_map(names: DataFrame, *, text_col: str, canonical: DataFrame | None = None) -> DataFrame:
    """Fit end to end (D13): optional canonical map -> frequency -> best per row.

    ``names`` comes from ``explode_names`` (source, row_id, name, text)."""
    if canonical is not None:
        names = map_values(names, "name", canonical)
    freq = frequency_encode(names, "name", text_col)
    enc = names.join(freq, "name", "left")
    return max_encoding_per_row(enc)


def encode_rows(df: DataFrame, mapping: DataFrame, *, source: str, id_col: str,
                out: str = "encoded_director") -> DataFrame:
    """Attach the encoding to the rows of one source; missing -> NULL."""
    m = mapping.where(F.col("source") == source).select(F.col("row_id").alias(id_col),
                                                        F.col("encoded").alias(out))
    return df.join(m, id_col, "left")
