import pytest
from pyspark.sql import functions as F

from lexicrate.functions import text as T


def _one(spark, col, rows, schema="a string, b string"):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(col).collect()]


@pytest.mark.parametrize("a,b,expected", [
    ("Satyajit Ray", "Satyajit Rai", 91.666667),
    ("kitten", "sitting", 61.538462),
    ("same", "same", 100.0),
    ("", "", 100.0),
    ("abc", "", 0.0),
])
def test_fuzzy_ratio(spark, a, b, expected):
    got = _one(spark, F.round(T.fuzzy_ratio("a", "b"), 6), [(a, b)])[0]
    assert got == pytest.approx(expected, abs=1e-6)


def test_fuzzy_ratio_symmetric(spark):
    rows = [("John Ford", "J. Ford"), ("Akira Kurosawa", "Kurosawa Akira")]
    ab = _one(spark, T.fuzzy_ratio("a", "b"), rows)
    ba = _one(spark, T.fuzzy_ratio("b", "a"), rows)
    assert ab == ba
    assert all(0 <= x <= 100 for x in ab)


def test_name_key(spark):
    got = _one(spark, T.name_key("a"), [("Jean-Luc Godard", None), ("J. R. R. Tolkien", None),
                                        ("Ang Lee", None)])
    # spaces, hyphens and periods go first; only segments longer than 2 remain
    assert got == ["jeanlucgodard", "jrrtolkien", "anglee"]


def test_word_tokens_strip_punctuation(spark):
    got = _one(spark, T.word_tokens("a"), [("Don't STOP, believing! «ok»", None)])[0]
    assert got == ["dont", "stop", "believing", "«", "ok", "»"]


def test_token_set_and_jaccard(spark):
    df = spark.createDataFrame([("a b c d e", "a b c d f"), ("", "")], "a string, b string")
    got = [r[0] for r in df.select(T.jaccard(T.token_set("a"), T.token_set("b"))).collect()]
    assert got[0] == pytest.approx(4 / 6)
    assert got[1] == 0.0


def test_ratio_bound_is_never_below_the_ratio(spark):
    import random

    from lexicrate.functions.text import long_fuzzy_ratio, ratio_bound
    r = random.Random(11)
    rows = [("".join(r.choices("abcde é\U0001f600%", k=r.randint(0, 9))), "".join(r.choices("abdxyz é\U0001f600_", k=r.randint(0, 9)))) for _ in range(600)]
    got = spark.createDataFrame(rows, "a string, b string").select(long_fuzzy_ratio("a", "b").alias("ratio"), ratio_bound("a", "b").alias("bound")).collect()
    assert all(x.bound >= x.ratio for x in got) and sum(x.bound < 60 for x in got) > 100
    assert spark.sql("SELECT 'abc' a, 'cba' b").select(ratio_bound("a", "b")).first()[0] == 100.0


def test_stop_words_and_lexicon_are_looked_up_in_a_hash_set(spark):
    from lexicrate.functions.constants import CONTRACTIONS, ENGLISH_STOPWORDS
    from lexicrate.operators import tokens as T
    df = spark.createDataFrame([(["the", "cat", None, "and", "a b"],), (None,), ([],), (["it", "dont"],)], "t array<string>")
    kept = df.select(T.remove_stopwords(F.col("t"), ENGLISH_STOPWORDS).alias("k"))
    assert [r.k for r in kept.collect()] == [["cat", "a b"], None, [], ["dont"]]
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "INSET" in plan.upper() and "array_contains" not in plan
    normal = T.lexicon_normalise(df, "t", CONTRACTIONS, out="n").select("t", "n")
    assert "INSET" in normal._jdf.queryExecution().optimizedPlan().toString().upper()
    want = " ".join([CONTRACTIONS.get(x, x) for x in ["it", "dont"]]).split(" ")
    assert [r.n for r in normal.collect()] == [None, None, [], want]
