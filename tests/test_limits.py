"""No size at which results change or rows drop out."""

import os
import random
from fractions import Fraction

from pyspark.sql import functions as F

from lexicrate.functions.text import fuzzy_ratio, long_fuzzy_ratio
from lexicrate.operators.dedup import _fraction
from lexicrate.operators.entity import fuzzy_name_map
from lexicrate.operators.tokens import lexicon_normalise
from lexicrate.session import store


def test_fuzzy_ratio_matches_the_expression(spark):
    r = random.Random(1)
    rows = [("".join(r.choices("abc é", k=r.randrange(12))), "".join(r.choices("abc é", k=r.randrange(12)))) for _ in range(200)]
    df = spark.createDataFrame(rows + [(None, "a"), ("a", None)], "a string, b string")
    for x in df.select(fuzzy_ratio("a", "b").alias("x"), long_fuzzy_ratio("a", "b").alias("y")).collect():
        assert x.x == x.y or abs(x.x - x.y) < 1e-9


def test_long_names_are_mapped(spark):
    a = "director " * 40
    names = spark.createDataFrame([(1, a), (2, a[:-1] + "x")], "id long, name string")
    pairs = spark.createDataFrame([(1, 2)], "id_i long, id_j long")
    assert [(x.key, x.value) for x in fuzzy_name_map(pairs, names, "id", "name").collect()] == [(a[:-1] + "x", a)]


def test_lexicon_paths_agree(spark):
    lexicon = {f"w{i}": f"v{i} z" for i in range(6000)}
    df = spark.createDataFrame([(1, ["w1", "q"]), (2, None), (3, []), (4, ["w5999"])], "id long, toks array<string>")
    table = spark.createDataFrame(sorted(lexicon.items()), "token string, replacement string")
    a = lexicon_normalise(df, "toks", lexicon).orderBy("id").collect()
    b = lexicon_normalise(df, "toks", table, id_col="id").orderBy("id").collect()
    assert [x.tokens_norm for x in a] == [x.tokens_norm for x in b] == [["v1", "z", "q"], None, [], ["v5999", "z"]]


def test_threshold_is_exact():
    assert _fraction(0.80005) == Fraction(16001, 20000)


def test_store_reads_back_from_the_shared_folder(spark):
    df = spark.range(5).withColumn("x", F.lit("a"))
    back = store(df)
    assert sorted(map(tuple, back.collect())) == [(i, "a") for i in range(5)]
    folder = spark.sparkContext.getCheckpointDir()
    assert all(os.path.dirname(folder).split(":")[-1] in f for f in back.inputFiles())
    assert store(df.limit(0)).columns == ["id", "x"]
