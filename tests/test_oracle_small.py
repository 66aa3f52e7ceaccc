"""Registered queries against their SQL oracles on the smallest fixture."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()
FAST = ["top_keyness", "keyness_selection", "table_profile", "duplicate_rows", "conflicting_duplicates",
        "text_statistics", "stat_histogram", "tfidf_weights", "stratified_split", "near_duplicate_pairs",
        "encode_directors", "hash_encode", "classification_report", "select_tokens", "mine_phrases"]


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, int) and not isinstance(v, bool):
        return float(v)
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None)),
                        key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t + '.parquet')}')")
    return c


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    got = _rows(E.queries()[name](spark, SF).toPandas())
    exp = _rows(con.execute(E.oracle_sql()[name]).df())
    assert got[0] == exp[0]
    assert got[1] == exp[1]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["lang", "token", "rank", "log_ratio", "in_freq", "total_freq"]


SURVEY_KEYS = """read_corpus_tsv embedding_scan write_embeddings write_predictions stream_embed table_profile
value_counts repeated_values topk_directors director_genre_crosstab class_distribution head_rows fill_with_min
text_statistics stopword_frequency stat_histogram stat_density box_summary stat_correlation pca_embeddings
pca_tfidf duplicate_count duplicate_rows drop_duplicates_first conflicting_duplicates near_duplicate_pairs
near_duplicate_minhash pair_differences name_variants fuzzy_name_pairs fuzzy_name_map explode_directors
canonicalise_directors frequency_encode max_encoding_per_row encode_directors director_encoding_map
token_table lexicon_normalise remove_stopwords mine_phrases preprocess_text select_tokens region_map
class_token_counts log_ratio keyness_selection top_keyness scree_counts tfidf_weights topk_vocabulary
ngram_counts svd_features one_hot similarity_encode assemble_features label_encode stratified_split
label_join chunk_text hash_encode weighted_mean_embedding embed_documents train_gbt train_svm random_search
predict_scores accuracy classification_report confusion_matrix confident_errors errors_by_class
length_vs_error centroid_predict overlap_descriptions rule_predictions rule_agreement
score_unlabelled""".split()


def test_every_survey_query_is_registered():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert set(SURVEY_KEYS) <= set(q)


@pytest.mark.parametrize("name", ["top_keyness", "near_duplicate_pairs", "stratified_split"])
def test_partition_invariance(spark, name):
    q = E.queries()[name]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        one = _rows(q(spark, SF).toPandas())
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        eight = _rows(q(spark, SF).toPandas())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert one == eight


PLAN_CHECKED = ["top_keyness", "log_ratio", "scree_counts", "keyness_selection", "select_tokens",
                "near_duplicate_pairs", "pair_differences", "duplicate_rows", "conflicting_duplicates",
                "text_statistics", "stat_histogram", "box_summary", "tfidf_weights", "mine_phrases",
                "ngram_counts", "similarity_encode", "stratified_split", "encode_directors",
                "hash_encode", "weighted_mean_embedding", "centroid_predict", "confusion_matrix",
                "classification_report", "rule_agreement"]


@pytest.mark.parametrize("name", PLAN_CHECKED)
def test_plan_has_no_python_udf_or_cartesian(spark, name):
    df = E.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, (name, bad)
