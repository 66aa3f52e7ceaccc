"""Hard-negative mining with rotated one-bit codes and deterministic intervals.

Vectors are integers in blocks (``blocks``), ordered by label and likeness.  Of
a vector x in a block with centre c the block keeps a one-bit code: the signs b
of the rotated, normalised difference x - c, its length, and the alignment a of
code and vector.  A rotation is made of sign flips and Hadamard transforms, so
nothing is drawn or sent.  A query q, rotated once for a tile, is split into bit
planes; popcounts of planes and codes give <q, b> up to a known error e.  With
x - c = |x - c| (a b + r), r orthogonal to b and |r| = sqrt(1 - a^2),

    <q, x> = <q, c> + |x - c| (a <q, b> + <q, r>),
    |<q, r>| <= sqrt(1 - a^2) sqrt(|q|^2 - <q, b>^2)       (Cauchy-Schwarz),

which is an interval that holds the score for certain.  Rows whose interval
cannot enter the result are dropped; the others are scored in integers.

Two passes over tiles of anchors and blocks: first the positives (same label,
bar: the k-th largest lower end seen), then for each positive the negatives
(other label, score within a window of the positive's, bar: the k-th largest
lower end of intervals inside the window).  Pairs that survive are scored where
they are and never leave a task, but for the first k of each list.

Defined results: labels are integers; rows with a null id, label or vector, or
with null or non-finite components take no part; components become
floor(scale * x), beyond +-2^20 they saturate; vectors of different length do not
meet; rows that repeat an id are rows of their own, each an anchor or a positive
for itself; a positive with a negative score has no negatives; an anchor
without positives gives no rows; an empty table gives none; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexicrate.llm import blocks as B

SCALE, K, EVERY, LOW, HIGH = 256, 5, 100, 80, 100
#: Bits of a query's components; rounds of the rotation; pairs scored at once.
PLANES, ROUNDS, PAIRS = 8, 3, 1 << 16
#: Slack for rounding of the intervals, in parts of the lengths.
SLACK = 1e-9


def rotate(x: np.ndarray) -> np.ndarray:
    """Rows padded to a power of two (64 at least) and rotated: ``ROUNDS`` times signs, then a Hadamard transform."""
    size = 64
    while size < x.shape[1]:
        size *= 2
    out = np.zeros((len(x), size))
    out[:, :x.shape[1]] = x
    for k in range(ROUNDS):
        out *= np.random.default_rng([size, k]).integers(0, 2, size) * 2.0 - 1
        h = 1
        while h < size:
            y = out.reshape(len(x), -1, 2, h)
            out = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], 2).reshape(len(x), size)
            h *= 2
        out /= np.sqrt(size)
    return out


def packed(bits: np.ndarray) -> np.ndarray:
    """Rows of booleans as rows of 64-bit words."""
    return np.packbits(bits, axis=1).view(np.uint64)


def encode(x: np.ndarray) -> dict:
    """Centre, codes, alignments and lengths of a block, as its columns."""
    centre = np.rint(x.mean(0)) if x.size else np.zeros(x.shape[1])
    diff = x - centre
    far = np.sqrt((diff * diff).sum(1))
    o = rotate(diff) / np.where(far > 0, far, 1)[:, None]
    align = np.abs(o).sum(1) / np.sqrt(o.shape[1])
    return {"centre": centre.astype(np.int64).tobytes(), "codes": packed(o >= 0).tobytes(), "align": align.tobytes(), "far": far.tobytes(),
            "reach": float(far.max())}


class Asked:
    """Rotated queries in bit planes."""

    def __init__(self, q: np.ndarray):
        self.q, turned = q, rotate(q)
        self.size = turned.shape[1]
        low, high = turned.min(1), turned.max(1)
        self.low, self.step = low, np.where(high > low, (high - low) / ((1 << PLANES) - 1), 1.0)
        u = np.rint((turned - low[:, None]) / self.step[:, None]).astype(np.int64)
        rest = turned - low[:, None] - u * self.step[:, None]
        self.error = np.sqrt((rest * rest).sum(1))
        self.sum = u.sum(1)
        self.planes = [packed((u >> p & 1).astype(bool)) for p in range(PLANES)]
        self.norm = np.sqrt((q.astype(np.float64) ** 2).sum(1))

    def interval(self, block: dict) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper end of the score of every query with every vector of a block."""
        codes = block["codes"]
        ones = np.bitwise_count(codes).sum(1).astype(np.float64)
        dot = np.zeros((len(self.q), len(codes)))
        for p, plane in enumerate(self.planes):
            for w in range(codes.shape[1]):
                dot += np.bitwise_count(plane[:, w, None] & codes[None, :, w]) * float(1 << p)
        along = (self.low[:, None] * (2 * ones - self.size)[None, :] + self.step[:, None] * (2 * dot - self.sum[:, None])) / np.sqrt(self.size)
        align, far = block["align"][None, :], block["far"][None, :]
        left = np.maximum(0, np.abs(along) - self.error[:, None])
        across = np.sqrt(np.maximum(0, self.norm[:, None] ** 2 - left * left)) * np.sqrt(np.maximum(0, 1 - align * align))
        centre = B.products(self.q, block["centre"][None, :])
        middle = centre + far * align * along
        reach = far * (align * self.error[:, None] + across)
        reach += SLACK * (1 + self.norm[:, None] * (far + np.sqrt((block["centre"].astype(np.float64) ** 2).sum())))
        return middle - reach, middle + reach


def scores(q: np.ndarray, x: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Integer inner products of the pairs (i, j)."""
    out = np.empty(len(i), np.int64)
    top = int(np.abs(q).max(initial=0)) * int(np.abs(x).max(initial=0)) * max(1, q.shape[1])
    kind = np.int32 if top < 1 << 31 else np.int64
    q, x = q.astype(kind), x.astype(kind)
    for s in range(0, len(i), PAIRS):
        e = s + PAIRS
        out[s:e] = np.einsum("ij,ij->i", q[i[s:e]], x[j[s:e]])
    return out


def _opened(b: pd.DataFrame) -> list[dict]:
    dim, found = int(b["dim"].iloc[0]), []
    for r in b.to_dict("records"):
        n = r["n"]
        found.append({"rows": B.longs(r["rows"]), "ids": B.longs(r["ids"]), "labels": B.longs(r["labels"]), "x": B.matrix(r["x"], dim, n),
                      "centre": B.longs(r["centre"]), "codes": np.frombuffer(r["codes"], np.uint64).reshape(n, -1),
                      "align": np.frombuffer(r["align"]), "far": np.frombuffer(r["far"])})
    return found


def _bar(lower: np.ndarray, some: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest lower end among the marked ones of each query; -inf where there are fewer."""
    if lower.shape[1] < k:
        return np.full(len(lower), -np.inf)
    return -np.partition(np.where(some, -lower, np.inf), k - 1, axis=1)[:, k - 1]


def positives(q: np.ndarray, rows: np.ndarray, labels: np.ndarray, least: np.ndarray, found: list[dict], k: int) -> tuple[np.ndarray, ...]:
    """(query, score, id, row) of the first ``k`` others of each query's label, and how many pairs were scored."""
    asked, best, scored = Asked(q), [np.zeros(0, np.int64)] * 4, 0
    bar = np.where(least == B.NONE, -np.inf, least.astype(np.float64))
    for b in found:
        some = (labels[:, None] == b["labels"][None, :]) & (rows[:, None] != b["rows"][None, :])
        if not some.any():
            continue
        lower, upper = asked.interval(b)
        bar = np.maximum(bar, _bar(lower, some, k))
        i, j = np.nonzero(some & (upper >= bar[:, None]))
        s = scores(q, b["x"], i, j)
        scored += len(i)
        best = [np.concatenate(c) for c in zip(best, (i, s, b["ids"][j], b["rows"][j]))]
        keep, rank = B.first_of(best[0], best[1], best[2], best[3], k)
        best = [c[keep] for c in best]
        full = rank == k - 1
        bar[best[0][full]] = np.maximum(bar[best[0][full]], best[1][full])
    return (*best, scored)


def negatives(q: np.ndarray, labels: np.ndarray, low: np.ndarray, high: np.ndarray, found: list[dict], k: int) -> tuple[np.ndarray, ...]:
    """(query, window, score, id, row) of the first ``k`` rows of another label
    in each window [low, high] (queries x windows, empty where low > high), and how many pairs were scored."""
    asked, best, scored = Asked(q), [np.zeros(0, np.int64)] * 4, 0
    windows = low.shape[1]
    bar = np.where(low > high, np.inf, low.astype(np.float64))
    for b in found:
        other = labels[:, None] != b["labels"][None, :]
        if not other.any():
            continue
        lower, upper = asked.interval(b)
        wanted = np.zeros(lower.shape, bool)
        for w in range(windows):
            inside = other & (lower >= low[:, w, None]) & (upper <= high[:, w, None])
            bar[:, w] = np.maximum(bar[:, w], _bar(lower, inside, k))
            wanted |= other & (upper >= bar[:, w, None]) & (lower <= high[:, w, None])
        i, j = np.nonzero(wanted)
        s = scores(q, b["x"], i, j)
        scored += len(i)
        new = []
        for w in range(windows):
            at = np.flatnonzero((s >= bar[i, w]) & (s <= high[i, w]))
            new.append((i[at] * windows + w, s[at], b["ids"][j[at]], b["rows"][j[at]]))
        best = [np.concatenate([c, *[n[p] for n in new]]) for p, c in enumerate(best)]
        keep, rank = B.first_of(best[0], best[1], best[2], best[3], k)
        best = [c[keep] for c in best]
        full = best[0][rank == k - 1]
        if len(full):
            i, w = full // windows, full % windows
            bar[i, w] = np.maximum(bar[i, w], best[1][rank == k - 1])
    return best[0] // windows, best[0] % windows, best[1], best[2], best[3], scored


def mine(vectors: DataFrame, k: int = K, every: int = EVERY, low: int = LOW, high: int = HIGH, id_col: str = "vec_id", vector_col: str = "embedding",
         label: Column | str = "label", scale: float = SCALE) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``:
    for each anchor (id divisible by ``every``) and each of its ``k`` first
    positives the ``k`` first negatives with ``low`` % to ``high`` % of its score."""
    def is_query(ids: np.ndarray) -> np.ndarray:
        return ids % every == 0

    def seed(at: np.ndarray, labels: np.ndarray, x: np.ndarray) -> np.ndarray:
        out = np.full(len(at), B.NONE)
        for n, i in enumerate(at.tolist()):
            same = np.flatnonzero(labels == labels[i])
            if len(same) > k:
                s = B.products(x[i:i + 1], x[same[same != i]])[0]
                out[n] = np.partition(s, len(s) - k)[len(s) - k]
        return out

    def ends(q: np.ndarray, s: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        """An interval for each query over a whole block: centre and radius."""
        centre = np.stack([B.longs(c) for c in s["centre"]])
        norm = np.sqrt((q.astype(np.float64) ** 2).sum(1))[:, None]
        middle = B.products(q, centre).astype(np.float64)
        reach = norm * s["reach"].to_numpy()[None, :]
        reach += SLACK * (1 + norm * np.sqrt((centre.astype(np.float64) ** 2).sum(1))[None, :] + reach)
        return middle - reach, middle + reach

    def may_hold_positive(q: pd.DataFrame, s: pd.DataFrame) -> np.ndarray:
        _, upper = ends(B.stacked(q), s)
        label = q["label"].to_numpy()[:, None]
        first, last = (np.array([f(B.longs(x)) for x in s["labels"]])[None, :] for f in (np.min, np.max))
        least = q["least"].to_numpy()
        return (upper >= np.where(least == B.NONE, -np.inf, least.astype(np.float64))[:, None]) & (first <= label) & (label <= last)

    def windows(q: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest score of a negative, one column for each positive: low * s <= 100 * x <= high * s."""
        n = max(1, max(map(len, q["scores"])))
        lo, hi = np.ones((len(q), n), np.int64), np.zeros((len(q), n), np.int64)
        for i, one in enumerate(q["scores"]):
            lo[i, :len(one)] = [-(-low * int(s) // 100) for s in one]
            hi[i, :len(one)] = [high * int(s) // 100 for s in one]
        return lo, hi

    def may_hold_negative(q: pd.DataFrame, s: pd.DataFrame) -> np.ndarray:
        lower, upper = ends(B.stacked(q), s)
        lo, hi = windows(q)
        label = q["label"].to_numpy()[:, None]
        first, last = (np.array([f(B.longs(x)) for x in s["labels"]])[None, :] for f in (np.min, np.max))
        some = np.zeros(lower.shape, bool)
        for w in range(lo.shape[1]):
            some |= (upper >= lo[:, w, None]) & (lower <= hi[:, w, None]) & (lo[:, w] <= hi[:, w])[:, None]
        return some & ((first != label) | (last != label))

    def near(q: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        who, score, ids, row, _ = positives(B.stacked(q), q["row"].to_numpy(), q["label"].to_numpy(), q["least"].to_numpy(), _opened(b), k)
        return pd.DataFrame({"anchor": q["row"].to_numpy()[who], "positive_id": ids, "positive_row": row, "positive_score": score})

    def hard(q: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        lo, hi = windows(q)
        who, w, score, ids, row, _ = negatives(B.stacked(q), q["label"].to_numpy(), lo, hi, _opened(b), k)
        return pd.DataFrame({"anchor": q["row"].to_numpy()[who], "place": w, "negative_id": ids, "negative_row": row, "negative_score": score})

    label = F.col(label) if isinstance(label, str) else label
    rows = B.whole(vectors, id_col, vector_col, label, scale)
    table = B.blocks(rows, is_query, encode, "centre binary, codes binary, align binary, far binary, reach double", by_label=True)
    asked = B.queries(table, is_query, seed)
    columns = ["rows", "ids", "labels", "x", "centre", "codes", "align", "far"]
    pairs = B.needed(asked, table, ["labels", "centre", "reach"], may_hold_positive)
    found = B.tiles(asked, table, pairs, columns, near, "anchor bigint, positive_id bigint, positive_row bigint, positive_score bigint")
    first = Window.partitionBy("anchor").orderBy(F.desc("positive_score"), "positive_id", "positive_row")
    positive = B.store(found.withColumn("place", F.row_number().over(first) - 1).where(F.col("place") < k), "positives")

    # at most k positives of an anchor, in the order of their place
    lists = positive.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("place", "positive_score"))).alias("p"))
    lists = lists.select("anchor", F.col("p.positive_score").alias("scores"))
    again = B.store(asked.join(lists, F.col("row") == F.col("anchor")).drop("anchor"), "anchors")
    pairs = B.needed(again, table, ["labels", "centre", "reach"], may_hold_negative)
    found = B.tiles(again, table, pairs, columns, hard, "anchor bigint, place int, negative_id bigint, negative_row bigint, negative_score bigint")
    first = Window.partitionBy("anchor", "place").orderBy(F.desc("negative_score"), "negative_id", "negative_row")
    out = found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
    anchor = again.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return (out.join(positive, ["anchor", "place"]).join(anchor, "anchor")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


ORACLE = f"""
WITH v AS (SELECT row_number() OVER () AS row, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.row AS anchor, q.vec_id AS anchor_id, q.label = c.label AS same, c.row, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % {EVERY} = 0 AND c.row <> q.row AND len(c.v) = len(q.v)),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, row) <= {K}),
n AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor, p.row ORDER BY s.score DESC, s.vec_id, s.row) AS rank
      FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same AND {LOW} * p.score <= 100 * s.score AND 100 * s.score <= {HIGH} * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= {K}
"""
