import math
import random

import pytest
from pyspark.sql import functions as F

from lexicrate.operators import evaluate as EV
from lexicrate.operators import features as FE
from lexicrate.operators import textstats as TS
from lexicrate.operators import tokens as TK


def test_stratified_split_exact_counts(spark):
    rows = [(i, "a" if i % 3 else "b") for i in range(500)]
    df = spark.createDataFrame(rows, "id long, lab string")
    out = FE.stratified_split(df, "id", "lab", test_fraction=0.1).where(F.col("split") == "test")
    counts = {r.lab: r["count"] for r in out.groupBy("lab").count().collect()}
    n_a = sum(1 for _, lab in rows if lab == "a")
    assert counts == {"a": round(0.1 * n_a), "b": round(0.1 * (500 - n_a))}
    # same rows as ranking the whole label by the hash
    import hashlib
    exp = set()
    for lab in ("a", "b"):
        ids = sorted((hashlib.md5(f"{i}42".encode()).hexdigest(), i) for i, lb in rows if lb == lab)
        exp |= {i for _, i in ids[: round(0.1 * len(ids))]}
    assert {r.id for r in out.collect()} == exp


def test_select_tokens_keeps_order_and_repeats(spark):
    df = spark.createDataFrame([(1, ["b", "a", "b", "c"]), (2, ["z"]), (3, None)],
                               "id long, toks array<string>")
    vocab = spark.createDataFrame([("b",), ("c",)], "token string")
    got = {r.id: r.selected for r in TK.select_tokens(df, "id", "toks", vocab).collect()}
    assert got == {1: "b b c", 2: "", 3: None}


def test_select_tokens_moves_only_rare_tokens(spark, monkeypatch):
    """Frequent tokens are decided where the row is; rare ones, repeated ids, nulls and empty tokens come out as in plain Python."""
    monkeypatch.setattr(TK, "BROADCAST_TOKENS", 6)
    rnd = random.Random(4)
    words = [*"abcdef"] * 30 + [f"r{k}" for k in range(40)] + ["", None, "x y", "\x00"]
    rows = [(rnd.choice([k, 7, None]), [rnd.choice(words) for _ in range(rnd.randrange(20))]) for k in range(60)] + [(90, None), (91, []), (92, [None])]
    df = spark.createDataFrame(rows, "id long, toks array<string>").repartition(3)
    vocab = {"a", "c", "f", "", "x y", "\x00"} | {f"r{k}" for k in range(0, 40, 3)}
    exploded = []
    real = TK.explode_tokens
    monkeypatch.setattr(TK, "explode_tokens", lambda *a, **k: exploded.append(real(*a, **k)) or exploded[-1])
    got = TK.select_tokens(df, "id", "toks", spark.createDataFrame([(w,) for w in vocab], "token string"))
    want = [(i, t, None if t is None else " ".join(w for w in t if w in vocab)) for i, t in rows]
    assert got.columns == ["id", "toks", "selected"]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    n = sum(len(t or []) for _, t in rows)
    assert exploded[-1].count() < n / 2


def test_phrases_are_scored_from_written_counts(spark):
    """Tokens are read and pairs counted once: the scoring reads the counts and splits no row again."""
    df = spark.createDataFrame([(["a", "b", "c"],), (["a", "b"],), (["c", None, "a"],), ([],), (None,), (["d"],)], "toks array<string>")
    got = TK.mine_phrases(df, "toks", min_count=2, min_npmi=-1)
    assert "Generate" not in got._jdf.queryExecution().executedPlan().toString()
    (row,) = got.collect()
    p, pa, pb = 2 / 5, 3 / 8, 2 / 8  # 5 pairs, the null token's included; 8 words
    assert (row.phrase, row.n) == ("a b", 2) and math.isclose(row.npmi, math.log(p / (pa * pb)) / -math.log(p))
    assert TK.mine_phrases(df, "toks", min_count=3, min_npmi=-1).count() == 0


def test_lexicon_join_path_keeps_word_order(spark):
    df = spark.createDataFrame([(1, ["i", "dont", "know"])], "id long, toks array<string>")
    lex = spark.createDataFrame([("dont", "do not")], "token string, replacement string")
    got = TK.lexicon_normalise(df, "toks", lex, id_col="id", out="n").collect()[0].n
    assert got == ["i", "do", "not", "know"]


def test_text_statistics_edges(spark):
    df = spark.createDataFrame([(1, ""), (2, "word"), (3, "One two. Three four five!")],
                               "id long, text string")
    got = {r.id: r for r in TS.text_statistics(df, "text", keep=["id"]).collect()}
    assert got[1].num_tokens_per_doc == 0 and got[1].avg_sentence_length_per_doc == 0.0
    assert got[2].num_sentences_per_doc == 1 and got[2].sentence_length_variance == 0.0
    # sentences of 3 and 4 tokens (punctuation counts as a token): variance 0.25
    assert got[3].sentence_length_variance == 0.25


def test_confusion_matrix_has_zero_cells(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("c", "a")], "label string, prediction string")
    cm = {(r.actual, r.predicted): r.n for r in EV.confusion_matrix(df).collect()}
    assert len(cm) == 9 and cm[("b", "b")] == 0 and cm[("a", "b")] == 1
    rep = {r.cls: r for r in EV.classification_report(df).collect()}
    assert rep["b"].precision == 0.0 and rep["c"].recall == 0.0


def test_centroid_prediction(spark):
    tr = spark.createDataFrame([("a", [0.0, 0.0]), ("a", [0.0, 2.0]), ("b", [10.0, 10.0])],
                               "label string, f array<double>")
    te = spark.createDataFrame([(1, [0.0, 1.5]), (2, [9.0, 9.0])], "id long, f array<double>")
    pred = {r.id: r.prediction for r in EV.predict_centroids(te, "f", EV.fit_centroids(tr, "f", "label")).collect()}
    assert pred == {1: "a", 2: "b"}


def test_append_phrases_join(spark):
    df = spark.createDataFrame([(1, ["new", "york", "city"]), (2, ["york", "new"]), (3, [])],
                               "id long, toks array<string>")
    ph = spark.createDataFrame([("new york",)], "phrase string")
    got = {r.id: sorted(r.with_phrases) for r in TK.append_phrases_join(df, "id", "toks", ph).collect()}
    assert got == {1: ["city", "new", "newyork", "york"], 2: ["new", "york"], 3: []}


def test_one_hot_vector_has_its_one_at_the_code(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("a",), ("",)], "source string")
    out, (_, encoder) = FE.one_hot(df, "source", out="oh")
    for r in out.collect():
        assert r.oh.size == encoder.categorySizes[0] == 4
        assert list(r.oh.indices) == [int(r.source_idx)] and list(r.oh.values) == [1.0]


def test_density_equals_the_whole_sum(spark):
    values = {"spread": [0.0, 1.0, 1.0, 2.5, 1000.0] + [2.0] * 3000, "one": [3.0] * 4, "pair": [1.0, 2.0, None]}
    long = spark.createDataFrame([(k, v) for k, vs in values.items() for v in vs], "stat string, value double")
    got = {}
    for r in TS.density(long, points=50).collect():
        got.setdefault(r.stat, []).append((r.x, r.density))
    for stat, vs in values.items():
        vs = [v for v in vs if v is not None]
        n, mean = len(vs), sum(vs) / len(vs)
        sd = math.sqrt(sum((v - mean) ** 2 for v in vs) / (n - 1))
        h = max(sd * n ** -0.2, 1e-9)
        lo, hi = min(vs), max(vs)
        want = []
        for i in range(50):
            x = lo + (hi - lo) * i / 49
            want.append((x, sum(math.exp(-0.5 * ((x - v) / h) ** 2) for v in vs) / (n * h * math.sqrt(2 * math.pi))))
        have = sorted(got[stat])
        assert len(have) == 50
        assert all(a[0] == pytest.approx(b[0]) and a[1] == pytest.approx(b[1], rel=1e-9, abs=1e-12) for a, b in zip(have, want))
    assert any(d == 0 for _, d in got["spread"])


def test_similarity_pairs_are_the_ones_that_are_not_zero(spark):
    values = spark.createDataFrame([("American",), ("Amer",), ("",), (None,), ("a",), ("American",), ("Hong Kong",)], "v string")
    cats = spark.createDataFrame([("American",), ("american film",), (None,), ("x",), ("",)], "c string")
    dense = FE.similarity_encode(values, "v", cats, "c").where("similarity > 0").collect()
    pairs = FE.similarity_pairs(values, "v", cats, "c").collect()
    assert len(dense) == len(pairs)
    assert {(r.value, r.category): r.similarity for r in dense} == {(r.value, r.category): r.similarity for r in pairs}
    assert FE.similarity_pairs(values.limit(0), "v", cats, "c").count() == 0


def test_tfidf_moves_rows_as_lists_and_finds_rare_terms(spark, monkeypatch):
    monkeypatch.setattr(FE, "BROADCAST_TERMS", 2, raising=False)  # most terms go by the join
    docs = [(1, ["a", "b", "b"]), (2, ["a", None, "c"]), (3, []), (4, None), (5, ["a", "b", "d"]), (5, ["d", "e"]), (None, ["a", "z"])]
    df = spark.createDataFrame(docs, "id int, toks array<string>")
    out = FE.tfidf_long(df, "id", "toks")
    plan = out._jdf.queryExecution().executedPlan().toString()
    got = {(r.id, r.term): (r.tf, r.weight) for r in out.collect()}
    counts = {1: {"a": 1, "b": 2}, 2: {"a": 1, "c": 1}, 5: {"a": 1, "b": 1, "d": 2, "e": 1}}
    seen = {"a": 4, "b": 2, "c": 1, "d": 1, "e": 1}
    raw = {(i, t): n * (math.log((len(docs) + 1) / (seen[t] + 1)) + 1) for i, c in counts.items() for t, n in c.items()}
    norm = {i: math.sqrt(sum(v * v for (j, _), v in raw.items() if j == i)) for i in counts}
    assert set(got) == set(raw)
    assert all(got[k][0] == counts[k[0]][k[1]] and abs(got[k][1] - raw[k] / norm[k[0]]) < 1e-12 for k in raw)
    assert plan.count("Exchange hashpartitioning") <= 4
    assert [r.id for r in FE.tfidf_long(df, "id", "toks", only_ids=df.where("id = 2")).select("id").distinct().collect()] == [2]
