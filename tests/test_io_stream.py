import os
import tempfile

from pyspark.sql import functions as F

from lexicrate.sources import corpus as IO
from lexicrate.streaming.embed_stream import run_to_completion


def test_tsv_reader_width_rules(spark):
    d = tempfile.mkdtemp(prefix="lexi-tsv-")
    p = os.path.join(d, "train.txt")
    with open(p, "w", encoding="utf-8") as fh:
        fh.write("t1\tUS\tdrama\tA, B\tplot one\n")
        fh.write("\tUS\tdrama\tA\tempty title\n")
        fh.write("t3\tUS\tdrama\tA\t\n")
        fh.write("t4\tUS\tdrama\tA\n")
        fh.write("t5\tUS\tdrama\tA\tx\textra\n")
    cols = ["title", "from", "genre", "director", "description"]
    rows = IO.read_corpus_tsv(spark, p, cols).orderBy("row_id").collect()
    assert [r._corrupt for r in rows] == [False, False, False, True, True]
    assert rows[1].title == "" and rows[1].description == "empty title"
    assert rows[2].description == ""


def test_stream_restart_adds_only_new_rows(spark):
    base = tempfile.mkdtemp(prefix="lexi-stream-")
    src, out, ck = (os.path.join(base, x) for x in ("in", "out", "ck"))
    schema = "doc_id long, text string"
    spark.createDataFrame([(1, "hello world"), (2, "more text here")], schema).write.parquet(src)
    sch = spark.read.parquet(src).schema
    run_to_completion(spark, src, sch, out, ck, id_col="doc_id", text_col="text")
    first = spark.read.parquet(out).count()
    spark.createDataFrame([(3, "a new document")], schema).write.mode("append").parquet(src)
    run_to_completion(spark, src, sch, out, ck, id_col="doc_id", text_col="text")
    ids = sorted(r.doc_id for r in spark.read.parquet(out).collect())
    assert first == 2 and ids == [1, 2, 3]


def test_tsv_row_ids_are_contiguous_in_file_order(spark):
    d = tempfile.mkdtemp(prefix="lexi-tsv2-")
    p = os.path.join(d, "big.txt")
    with open(p, "w", encoding="utf-8") as fh:
        for i in range(3000):
            fh.write(f"t{i}\tUS\tdrama\tA\tplot {i}\n")
    cols = ["title", "from", "genre", "director", "description"]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")   # several splits
    try:
        rows = IO.read_corpus_tsv(spark, p, cols).select("row_id", "title").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted((r.row_id, r.title) for r in rows) == [(i, f"t{i}") for i in range(3000)]


def test_tsv_keys_over_several_files_and_splits(spark):
    d = tempfile.mkdtemp(prefix="lexi-tsv3-")
    sizes = {"a.txt": 50, "b.txt": 3000, "c.txt": 700}
    want = []
    for name in ("c.txt", "a.txt", "b.txt"):
        with open(os.path.join(d, name), "w", encoding="utf-8") as fh:
            fh.writelines(f"{name}{i}\tUS\tdrama\tA\tplot {i}\n" for i in range(sizes[name]))
    for name in sorted(sizes):
        want += [f"{name}{i}" for i in range(sizes[name])]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = IO.read_corpus_tsv(spark, d, ["title", "from", "genre", "director", "description"]).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [r.title for r in sorted(rows, key=lambda r: r.row_id)] == want
    assert sorted(r.row_id for r in rows) == list(range(len(want))) and len({r.row_key for r in rows}) == len(want)
