"""Whole-number vectors in blocks, and a query set held against all blocks.

Vectors become integers, floor(scale * x), are ordered by the nearest of a
bounded number of pivots (similar vectors get neighbouring numbers) and cut into
blocks of a bounded size: a block is one row that holds the integers of its
vectors and what an operator wants to know of them.  Queries are rows of the
same table; those of neighbouring blocks form bounded groups.

A query group meets a block only if a bound over the block's summary says that
it may matter; summaries are compared in groups, before any vector moves.  What
is left is dealt out as tiles of a query group and a bounded run of blocks, so
no task holds more than one tile, however the ids, labels or vectors are skewed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexicrate.session import store

#: Vectors of a block and its bytes at most; blocks of a tile; queries of a group; summaries compared at once.
BLOCK, BLOCK_BYTES, TILE, QUERIES, SUMMARIES = 512, 1 << 20, 32, 4096, 4096
#: Vectors and bytes that a range of the order aims at.
RANGE, RANGE_BYTES = 8192, 128 << 20
#: Pivots of the order; only speed depends on them.
PIVOTS = 512
#: Integers beyond this saturate, so that scores of 8192 components are exact even as doubles.
LIMIT = 1 << 20
NONE = np.iinfo(np.int64).min

COLUMNS = "bn bigint, bg bigint, qg bigint, sg bigint, dim int, n int, queries int, rows binary, ids binary, labels binary, x binary"


def whole(vectors: DataFrame, id_col: str, vector_col: str, label: Column, scale: float) -> DataFrame:
    """``row, vec_id, label, v`` of the usable rows: ``v`` holds integers, ``row`` is unique."""
    v = vectors.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("vec_id"), label.alias("label"),
                       F.col(vector_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite, F.lit(False))
    bound = float(LIMIT)
    return v.where(usable).withColumn(
        "v", F.transform("v", lambda x: F.floor(F.greatest(F.least(x * F.lit(float(scale)), F.lit(bound)), F.lit(-bound))).cast("int")))


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows; floats where every sum is exact in them."""
    if not q.size or not x.size:
        return np.zeros((len(q), len(x)), np.int64)
    top = int(np.abs(q).max()) * int(np.abs(x).max()) * q.shape[1]
    kind = np.float32 if top < 1 << 24 else np.float64 if top < 1 << 53 else np.int64
    return (q.astype(kind) @ x.astype(kind).T).astype(np.int64)


def longs(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, np.int64)


def matrix(blob: bytes, dim: int, n: int) -> np.ndarray:
    return np.frombuffer(blob, np.int32).reshape(n, dim)


def blocks(rows: DataFrame, is_query: Callable[[np.ndarray], np.ndarray], describe: Callable[[np.ndarray], dict[str, bytes | float]],
           extra: str, by_label: bool = False, size: int = BLOCK) -> DataFrame:
    """The stored block table of ``whole(...)``: ``COLUMNS`` and the columns
    ``extra`` that ``describe`` gives for a block's integers."""
    spark = rows.sparkSession
    drawn = rows.select("row", "v").orderBy(F.xxhash64("row", F.lit("pivot")), "row").limit(PIVOTS).collect()
    pivots: dict[int, list] = {}
    for r in drawn:
        pivots.setdefault(len(r["v"]), []).append(r["v"])
    shared = spark.sparkContext.broadcast({d: np.array(p, np.float32).reshape(len(p), d) for d, p in pivots.items()})

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = b.column("v")
            dims = np.diff(v.offsets.to_numpy())
            flat = v.flatten().to_numpy()
            ends = np.cumsum(dims)
            cell, raw = np.zeros(len(dims), np.int32), [b""] * len(dims)
            for d in np.unique(dims).tolist():
                at = np.flatnonzero(dims == d)
                x = flat[(ends[at] - d)[:, None] + np.arange(d)].astype(np.int32)
                p = shared.value.get(d)
                if p is not None and d:
                    long_ = np.sqrt((p * p).sum(1)) + 1e-9
                    for i in range(0, len(at), 4096):
                        cell[at[i:i + 4096]] = (x[i:i + 4096].astype(np.float32) @ (p / long_[:, None]).T).argmax(1)
                for i, one in zip(at.tolist(), x):
                    raw[i] = one.tobytes()
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("vec_id"), b.column("label"), pa.array(dims.astype(np.int32)), pa.array(cell),
                                              pa.array(raw, pa.binary())], ["row", "vec_id", "label", "dim", "cell", "x"])

    celled = rows.select("row", "vec_id", F.col("label").cast("long"), "v").mapInArrow(cells, "row bigint, vec_id bigint, label bigint, dim int, cell int, x binary")
    total, width = rows.agg(F.count(F.lit(1)), F.sum(F.size("v"))).first()
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, min(-(-total // RANGE), max(least, -(-4 * (width or 0) // RANGE_BYTES))))
    order = ["dim", *(["label"] if by_label else []), "cell", "vec_id", "row"]
    ordered = celled.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    schema = f"{COLUMNS}{', ' if extra else ''}{extra}"
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "binary": pa.binary()}
    fields = [(c.split()[0], kinds[c.split()[1]]) for c in schema.split(", ")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held: list[tuple] = []
        done, asked = 0, 0

        def close() -> pa.RecordBatch:
            nonlocal done, asked
            row, ids, labels = (np.array([h[c] for h in held], np.int64) for c in (0, 1, 2))
            dim = held[0][3]
            x = np.frombuffer(b"".join(h[5] for h in held), np.int32).reshape(len(held), dim)
            wanted = int(is_query(ids).sum())
            first = part << 32
            one = {"bn": first | done, "bg": first | done // TILE, "qg": first | asked // QUERIES, "sg": first | done // SUMMARIES,
                   "dim": dim, "n": len(held), "queries": wanted, "rows": row.tobytes(), "ids": ids.tobytes(), "labels": labels.tobytes(),
                   "x": x.tobytes(), **describe(x)}
            done, asked = done + 1, asked + wanted
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([one[c]], kind) for c, kind in fields], [c for c, _ in fields])

        for b in batches:
            for one in zip(*[b.column(c).to_pylist() for c in ("row", "vec_id", "label", "dim", "cell", "x")]):
                most = max(1, min(size, BLOCK_BYTES // (4 * max(1, one[3]))))
                if held and (held[0][3] != one[3] or len(held) >= most or (len(held) >= most // 4 and held[-1][4] != one[4])):
                    yield close()
                held.append(one)
        if held:
            yield close()

    return store(ordered.mapInArrow(cut, schema), "blocks")


def queries(table: DataFrame, is_query: Callable[[np.ndarray], np.ndarray], seed: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """The stored queries ``qg, dim, row, vec_id, label, x, least``: ``least`` is
    what ``seed(positions, labels, integers)`` finds in the query's own block."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                ids, labels, x = longs(r["ids"]), longs(r["labels"]), matrix(r["x"], r["dim"], r["n"])
                at = np.flatnonzero(is_query(ids))
                if len(at):
                    least = seed(at, labels, x)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), r["qg"])), pa.array(np.full(len(at), r["dim"], np.int32)), pa.array(longs(r["rows"])[at]), pa.array(ids[at]),
                         pa.array(labels[at]), pa.array([x[i].tobytes() for i in at.tolist()], pa.binary()), pa.array(least.astype(np.int64))],
                        ["qg", "dim", "row", "vec_id", "label", "x", "least"])

    some = table.where("queries > 0").select("qg", "dim", "n", "rows", "ids", "labels", "x")
    return store(some.mapInArrow(pick, "qg bigint, dim int, row bigint, vec_id bigint, label bigint, x binary, least bigint"), "queries")


def stacked(q: pd.DataFrame) -> np.ndarray:
    """The integers of query rows of one length."""
    return np.frombuffer(b"".join(q["x"]), np.int32).reshape(len(q), int(q["dim"].iloc[0]))


def _parts(spark, items: int) -> int:
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(items, max(least, items // 32)))


def _together(left: DataFrame, right: DataFrame, keys: list[str], n: int, work: Callable, schema: str) -> DataFrame:
    """Groups of both sides by ``keys`` in ``n`` partitions: the work is CPU, so they aren't merged by their bytes."""
    a, b = (d.toDF(*d.columns).repartition(n, *keys).groupBy(*keys) for d in (left, right))
    return a.cogroup(b).applyInPandas(work, schema)


def needed(asked: DataFrame, table: DataFrame, summary: list[str], may: Callable[[pd.DataFrame, pd.DataFrame], np.ndarray]) -> DataFrame:
    """The stored pairs ``qg, bn, bg`` for which ``may`` (queries, summaries)
    says for some query of the group that the block may matter."""
    spark = asked.sparkSession
    own = asked.select("qg", "dim").distinct()
    groups = table.select("sg", "dim").distinct()
    met = own.join(groups, "dim")  # groups of queries and groups of summaries, never vectors
    left = asked.join(met, ["qg", "dim"])
    right = table.select("bn", "bg", "sg", "dim", "n", *summary).join(met, ["sg", "dim"])
    keys = ["qg", "sg", "dim"]

    def look(key: tuple, q: pd.DataFrame, s: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(s):
            return pd.DataFrame({"qg": [], "bn": [], "bg": []})
        some = may(q, s).any(0)
        return pd.DataFrame({"qg": np.full(int(some.sum()), key[0]), "bn": s["bn"].to_numpy()[some], "bg": s["bg"].to_numpy()[some]})

    n = _parts(spark, met.count())
    return store(_together(left, right, keys, n, look, "qg bigint, bn bigint, bg bigint"), "block-pairs")


def tiles(asked: DataFrame, table: DataFrame, pairs: DataFrame, columns: list[str], work: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """``work`` (queries, blocks) for each query group and run of blocks of ``pairs``."""
    spark = asked.sparkSession
    met = pairs.select("qg", "bg").distinct()
    n = _parts(spark, met.count())
    keys = ["qg", "bg", "dim"]
    left = asked.join(met, "qg")
    right = table.select("bn", "dim", "n", *columns).join(pairs, "bn")
    empty = {c.split()[0]: [] for c in schema.split(", ")}

    def tile(key: tuple, q: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        return work(q, b) if len(q) and len(b) else pd.DataFrame(empty)

    return _together(left, right, keys, n, tile, schema)


def first_of(group: np.ndarray, score: np.ndarray, ids: np.ndarray, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the ``k`` first of each group (score falling, then id, then row) and their ranks from 0."""
    order = np.lexsort((row, ids, -score, group))
    g = group[order]
    start = np.r_[True, g[1:] != g[:-1]] if len(g) else np.zeros(0, bool)
    rank = np.arange(len(g)) - np.maximum.accumulate(np.where(start, np.arange(len(g)), 0)) if len(g) else np.zeros(0, np.int64)
    return order[rank < k], rank[rank < k]
