"""Digest joins, hot keys and the closure of a name map on small tables."""

import random

import pytest
from pyspark.sql import functions as F

from lexicrate.operators import entity as E
from lexicrate.operators import joins as J
from lexicrate.operators import profile as P
from lexicrate.operators import score as SC
from lexicrate.session import materialize


@pytest.fixture
def shuffled(spark):
    """Plain shuffle joins: nothing is broadcast by size or re-planned."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def test_a_text_in_a_third_of_all_rows_spreads(shuffled):
    df = shuffled.range(6000).select("id", F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(
        F.concat(F.lit("t"), (F.col("id") / 2).cast("long"))).alias("text"))
    out = P.duplicate_rows(df, ["text"])
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    rows = {r.id: r.group_size for r in out.collect()}
    assert len(sizes) == 8 and max(sizes) < 1.5 * sum(sizes) / 8
    by_text = {}
    for r in df.collect():
        by_text.setdefault(r.text, []).append(r.id)
    assert rows == {i: len(ids) for ids in by_text.values() if len(ids) > 1 for i in ids}


def test_no_exchange_has_the_text_as_key(shuffled):
    df = shuffled.createDataFrame([(1, "a", "x"), (2, "a", "y"), (3, None, "x")], "id long, text string, target string")
    rules = SC.rule_table(df, "text", "target", "id")
    for out in (P.duplicate_rows(df, ["text"]), P.conflicting_duplicates(df, "text", "target"),
                SC.apply_rules(df, rules, "text"), SC.overlap(df, df, "text"),
                P.duplicate_count(df, ["text"]), P.drop_duplicates_first(df, ["text"], "id"),
                E.frequency_encode(df, "target", "text")):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(" in plan
        assert not any("hashpartitioning(text" in line or ", text#" in line.split("hashpartitioning(")[1].split(")")[0]
                       for line in plan.splitlines() if "hashpartitioning(" in line)


def test_nulls_empty_texts_and_clashing_names(spark):
    rows = [(1, "a", "x", 1), (2, "a", "x", 2), (3, None, "x", 3), (4, None, "x", 4), (5, "", "x", 5), (6, "a", None, 6), (7, "ax", "", 7)]
    df = spark.createDataFrame(rows, "id long, text string, b string, digest long").withColumn("_key", F.lit(9)).withColumn("_hot", F.lit(8))
    got = P.duplicate_rows(df, ["text", "b"])
    assert got.columns == df.columns + ["group_size"]
    assert sorted((r.id, r.group_size) for r in got.collect()) == [(1, 2), (2, 2), (3, 2), (4, 2)]
    assert [r.id for r in P.drop_duplicates_first(df, ["text", "b"], "id").orderBy("id").collect()] == [1, 3, 5, 6, 7]
    assert P.duplicate_count(df, ["text", "b"]).first()[0] == 2
    ruled = SC.apply_rules(df, SC.rule_table(df, "text", "id", "id"), "text")
    assert {r.id: r.rule_label for r in ruled.collect()} == {1: 6, 2: 6, 3: None, 4: None, 5: 5, 6: 6, 7: 7}
    assert sorted(r.text for r in SC.overlap(df, df.where("id > 4"), "text").collect()) == ["", "a", "ax"]


def test_empty_tables(spark):
    df = spark.createDataFrame([], "id long, text string, target string")
    assert P.duplicate_rows(df, ["text"]).count() == P.conflicting_duplicates(df, "text", "target").count() == 0
    some = spark.createDataFrame([(1, "a", "x")], df.schema)
    ruled = SC.apply_rules(some, SC.rule_table(df, "text", "target", "id"), "text").collect()
    assert [(r.id, r.rule_label) for r in ruled] == [(1, None)]
    assert E.name_closure(df.select(F.col("text").alias("key"), F.col("target").alias("value"))).count() == 0


def test_attach_refuses_other_joins(spark):
    groups = materialize(spark.createDataFrame([("a", 1)], "k string, n long"))
    with pytest.raises(ValueError):
        J.attach_groups(groups, F.col("k"), groups, key_col="k", size_col="n", values=["n"], how="right")


def test_closure_equals_walking_the_links(spark):
    r = random.Random(5)
    links = [(f"n{r.randrange(60)}", f"n{r.randrange(60)}") for _ in range(35)]
    links += [(f"c{i:02d}", f"c{i + 1:02d}") for i in range(20)]          # a chain
    links += [("star", f"s{i}") for i in range(40)] + [("self", "self"), (None, "n1")]
    near = {}
    for a, b in links:
        if a is not None and a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    want = {}
    for start in near:
        seen, todo = {start}, [start]
        while todo:
            todo += [n for n in near[todo.pop()] if n not in seen and not seen.add(n)]
        if min(seen) != start:
            want[start] = min(seen)
    got = E.name_closure(spark.createDataFrame(links, "key string, value string")).collect()
    assert len(got) == len(want) and {x.key: x.value for x in got} == want
