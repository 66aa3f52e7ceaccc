"""Exact top-k search by inner product with block-at-a-time pruning.

Each dimension is a term.  A block of vectors knows the largest and the least
value of each term; a query's summed term maxima over a block bound the score
of every vector in it.  A query first scores its own block, which gives a first
k-th score.  Blocks that no query of a group can need are left out before any
vector moves; in a task each query takes its blocks by falling bound, scores a
block as a whole through its forward index (the block's rows of integers), and
stops at the first bound below its k-th score.  A bound equal to the k-th score
is still opened, because a tie may have the smaller id.

The bound is exact integer arithmetic, so results are exact for any data; how
much it prunes depends on how alike the vectors of a block are.

Defined results: components become floor(scale * x), beyond +-2^20 they
saturate; rows with a null id, a null vector or null or non-finite components
take no part; vectors of different length do not meet; empty vectors score 0
with each other; each row with a repeated id is a row of its own, and meets the
others with its id; a query with fewer than k others gets all of them; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexicrate.llm import blocks as B

SCALE, K, EVERY = 256, 5, 50


def kth(scores: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest of each row; B.NONE where there are fewer."""
    if scores.shape[1] < k:
        return np.full(len(scores), B.NONE)
    return np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]


def bounds(q: np.ndarray, top: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Summed term maxima of each query over each block."""
    return B.products(np.maximum(q, 0), top) + B.products(np.minimum(q, 0), low)


def search(q: np.ndarray, own: np.ndarray, least: np.ndarray, found: list[tuple[np.ndarray, np.ndarray, np.ndarray]], limit: np.ndarray,
           k: int) -> tuple[np.ndarray, ...]:
    """(query, score, id, row) of the first ``k`` of each query in the blocks
    ``found`` of (rows, ids, integers); ``limit`` are the bounds, ``least`` the
    k-th scores known so far.  Also how many blocks were opened."""
    order = np.argsort(-limit, axis=1, kind="stable")
    bar = least.copy()
    best = [np.zeros(0, np.int64)] * 4
    opened = 0
    for step in range(len(found)):
        at = order[:, step]
        active = limit[np.arange(len(q)), at] >= bar
        if not active.any():
            break
        new = []
        for j in np.unique(at[active]).tolist():
            who = np.flatnonzero(active & (at == j))
            rows, ids, x = found[j]
            opened += len(who)
            s = B.products(q[who], x)
            s[own[who][:, None] == rows[None, :]] = B.NONE
            i, c = np.nonzero((s >= np.maximum(kth(s, k), bar[who])[:, None]) & (s > B.NONE))
            new.append((who[i], s[i, c], ids[c], rows[c]))
        best = [np.concatenate([b, *[n[c] for n in new]]) for c, b in enumerate(best)]
        keep, rank = B.first_of(best[0], best[1], best[2], best[3], k)
        best = [b[keep] for b in best]
        full = rank == k - 1
        bar[best[0][full]] = np.maximum(bar[best[0][full]], best[1][full])
    return (*best, opened)


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = SCALE) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows whose id is divisible by ``every``."""
    def is_query(ids: np.ndarray) -> np.ndarray:
        return ids % every == 0

    def describe(x: np.ndarray) -> dict:
        return {"top": x.max(0).tobytes(), "low": x.min(0).tobytes()}

    def seed(at: np.ndarray, labels: np.ndarray, x: np.ndarray) -> np.ndarray:
        s = B.products(x[at], x)
        s[np.arange(len(at)), at] = B.NONE
        return kth(s, k)

    def terms(b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        dim = int(b["dim"].iloc[0])
        return tuple(np.frombuffer(b"".join(b[c]), np.int32).reshape(len(b), dim) for c in ("top", "low"))

    def may(q: pd.DataFrame, s: pd.DataFrame) -> np.ndarray:
        return bounds(B.stacked(q), *terms(s)) >= q["least"].to_numpy()[:, None]

    def work(q: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        x, dim = B.stacked(q), int(q["dim"].iloc[0])
        found = [(B.longs(r), B.longs(i), B.matrix(m, dim, n)) for r, i, m, n in zip(b["rows"], b["ids"], b["x"], b["n"])]
        who, score, ids, row, _ = search(x, q["row"].to_numpy(), q["least"].to_numpy(), found, bounds(x, *terms(b)), k)
        return pd.DataFrame({"query_row": q["row"].to_numpy()[who], "query_id": q["vec_id"].to_numpy()[who], "vec_id": ids, "row": row, "score": score})

    rows = B.whole(vectors, id_col, vector_col, F.lit(0), scale)
    table = B.blocks(rows, is_query, describe, "top binary, low binary")
    asked = B.queries(table, is_query, seed)
    pairs = B.needed(asked, table, ["top", "low"], may)
    out = B.tiles(asked, table, pairs, ["rows", "ids", "x", "top", "low"], work, "query_row bigint, query_id bigint, vec_id bigint, row bigint, score bigint")
    first = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    return (out.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


ORACLE = f"""
WITH v AS (SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.row AS qrow, q.vec_id AS query_id, c.vec_id, c.row, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % {EVERY} = 0 AND c.row <> q.row AND len(c.v) = len(q.v)),
r AS (SELECT *, row_number() OVER (PARTITION BY qrow ORDER BY score DESC, vec_id, row) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= {K}
"""
