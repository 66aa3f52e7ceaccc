"""Embedding near-duplicates by dual traversal of cover trees.

Vectors are compared within a label by cosine in double precision; on unit
vectors a cosine of at least c is a distance of at most t = sqrt(2 - 2c).
Equal vectors are one node with a count.  The upper level of the tree is laid
out by Spark: a bounded number of pivots (nested: the first of a hash order)
is broadcast, every vector goes to the cell of its nearest pivot, and cells
get their covering radius.  A vector meets the parts of another cell only if
it lies within t of the cell's ball.  Parts hold a bounded number of vectors,
so no label, cell or cluster ends in one task.  For each pair of parts a task
builds cover trees with halving radii and walks them together: a node pair
farther apart than t plus both covering radii is dropped, one that lies within
t as a whole is linked as a whole, and leaves are compared exactly.  A pair of
parts yields link counts and a spanning forest, never all pairs.

Where vectors have no clusters, covering radii cannot prune and the number of
compared parts grows with the square of a label's distinct vectors: that is the method.

Defined results: null, zero or empty vectors and vectors with null or
non-finite parts link with nothing, nor does a row with null label or id;
vectors of different length do not link; of rows with one id each is a vector
of its own; extra columns are ignored; every row is returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexicrate.llm.components import components, join_labels
from lexicrate.session import store

COSINE, PART, PIVOTS = 0.98, 1024, 1024
#: Slack of distance bounds for rounding; exact cosines decide.
SLACK = 1e-7


class CoverTree:
    """Nested levels over unit vectors: the children of a node cover its points
    at half its radius, and its own centre is the centre of its first child."""

    def __init__(self, x: np.ndarray, weight: np.ndarray):
        self.x, self.weight = x, weight
        self.centre, self.radius, self.points, self.children = [], [], [], []
        if len(x):
            self.add(0, np.arange(len(x)))

    def add(self, centre: int, points: np.ndarray) -> int:
        """The node over ``points``; its subtree is laid out without recursion."""
        root = self._node(centre, points)
        todo = [root]
        while todo:
            node = todo.pop()
            reach, own = self.radius[node], self.points[node]
            if len(own) == 1 or reach <= 1e-12:
                continue
            rest, first, kids = own, self.centre[node], []
            while len(rest):
                c = first if not kids else int(rest[0])
                near = self.distance(c, rest) <= reach / 2
                if kids or near.any():
                    kids.append(self._node(c, rest[near]))
                    rest = rest[~near]
            self.children[node] = kids
            todo.extend(kids)
        return root

    def _node(self, centre: int, points: np.ndarray) -> int:
        self.centre.append(centre)
        self.radius.append(float(self.distance(centre, points).max()))
        self.points.append(points)
        self.children.append([])
        return len(self.centre) - 1

    def distance(self, centre: int, points: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0, ((self.x[points] - self.x[centre]) ** 2).sum(1)))


def dual_walk(a: CoverTree, b: CoverTree, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Link weights of the points of both trees, and links (u, v) that connect
    what the pairs connect.  With ``a is b`` pairs of a point with itself do not count."""
    t = float(np.sqrt(2 - 2 * cosine))
    na, nb = np.zeros(len(a.x), np.int64), np.zeros(len(b.x), np.int64)
    us, vs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    todo = [([0], [0])] if len(a.x) and len(b.x) else []
    while todo:
        p, q = todo.pop()
        ra, rb = np.array([a.radius[i] for i in p]), np.array([b.radius[j] for j in q])
        ca, cb = a.x[[a.centre[i] for i in p]], b.x[[b.centre[j] for j in q]]
        cos = ca @ cb.T
        d = np.sqrt(np.maximum(0, 2 - 2 * cos))
        near = d <= t + ra[:, None] + rb[None, :] + SLACK
        whole = d + ra[:, None] + rb[None, :] <= t - SLACK
        leaf = (ra[:, None] + rb[None, :] <= 1e-12) & near
        # the nodes that open the same node go on together
        open_ = near & ~leaf & ~whole
        has_a, has_b = (np.array([bool(t.children[i]) for i in x]) for t, x in ((a, p), (b, q)))
        first = open_ & ((has_a[:, None] & (ra[:, None] >= rb[None, :])) | ~has_b[None, :])
        for i in np.flatnonzero(first.any(1)).tolist():
            todo.append((a.children[p[i]], [q[j] for j in np.flatnonzero(first[i]).tolist()]))
        second = open_ & ~first
        for j in np.flatnonzero(second.any(0)).tolist():
            todo.append(([p[i] for i in np.flatnonzero(second[:, j]).tolist()], b.children[q[j]]))
        done = whole | (leaf & (cos >= cosine))
        for i, j in zip(*np.nonzero(done)):
            x, y = a.points[p[i]], b.points[q[j]]
            na[x] += b.weight[y].sum()
            nb[y] += a.weight[x].sum()
            us += [x, np.full(len(y), a.centre[p[i]])]
            vs += [np.full(len(x), b.centre[q[j]]), y]
    u, v = np.concatenate(us), np.concatenate(vs)
    if a is b:  # each pair was met from both sides, and each point with itself
        na = na - a.weight * (na > 0)
    return na, nb, u, v


def compare(left: tuple, right: tuple | None, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rep, count) of the points with links and forest links of two parts
    given as (reps, weights, unit vectors); one part with itself if ``right`` is None."""
    a = CoverTree(left[2], left[1])
    b = a if right is None else CoverTree(right[2], right[1])
    na, nb, u, v = dual_walk(a, b, cosine)
    reps = left[0] if right is None else np.concatenate([left[0], right[0]])
    count = na if right is None else np.concatenate([na, nb])
    label = join_labels(len(reps), u, v if right is None else v + len(left[0]))
    return reps, count, reps[label]


def _unit(raw: np.ndarray) -> np.ndarray:
    raw = raw / np.abs(raw).max(1, keepdims=True)  # squares neither overflow nor vanish
    return raw / np.sqrt((raw * raw).sum(1, keepdims=True))


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                    cosine: float = COSINE, part: int = PART, pivots: int = PIVOTS) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row."""
    spark = vectors.sparkSession
    v = vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite & F.exists("v", lambda x: x != 0), F.lit(False))
    v = store(v.withColumn("v", F.when(usable, F.transform("v", lambda x: x + 0.0))), "vectors")
    # a node is a vector of a label, not an id: rows that repeat an id may hold several
    nodes = v.where(F.col("v").isNotNull()).groupBy("label", "v").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("n"))
    nodes = store(nodes.withColumn("rep", F.monotonically_increasing_id()), "vector-values")
    nodes = store(nodes.withColumn("dim", F.size("v")).withColumn("h", F.pmod(F.xxhash64("rep"), F.lit(1 << 30))), "vector-nodes")

    total = max(1, nodes.count())
    sizes = nodes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("m"))
    # pivots in proportion to a label's share, so that all labels together have no more than the bound
    k = F.least(F.ceil(F.col("m") / part), F.floor(F.col("m") * pivots / total)).cast("int")
    sizes = store(sizes.withColumn("k", F.when(k >= 2, k).otherwise(1)), "label-sizes")
    rich = sizes.where("k > 1")  # at most pivots / 2 labels
    drawn = (nodes.join(F.broadcast(rich), ["label", "dim"]).where(F.col("h") < float(1 << 30) * (4 * F.col("k") + 16) / F.col("m"))
             .withColumn("cell", F.row_number().over(Window.partitionBy("label", "dim").orderBy("h", "rep")) - 1).where("cell < k"))
    centres: dict[tuple, list] = {}
    for r in sorted(drawn.select("label", "dim", "cell", "v").collect(), key=lambda r: (str(r["label"]), r["dim"], r["cell"])):
        centres.setdefault((r["label"], r["dim"]), []).append(r["v"])
    centres = spark.sparkContext.broadcast({key: _unit(np.array(x)) for key, x in centres.items()})
    label_type = nodes.schema["label"].dataType.simpleString()
    id_type = nodes.schema["rep"].dataType.simpleString()

    def to_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            dims = b.column("dim").to_pylist()
            labels = b.column("label").to_pylist()
            flat = b.column("v").flatten().to_numpy()
            ends = np.cumsum(dims)
            cell, far, raw = np.zeros(len(dims), np.int32), np.zeros(len(dims)), [None] * len(dims)
            for key in set(zip(labels, dims)):
                at = np.array([i for i, x in enumerate(zip(labels, dims)) if x == key])
                x = _unit(np.stack([flat[ends[i] - key[1]:ends[i]] for i in at]))
                c = centres.value.get(key)
                if c is not None:
                    cos = x @ c.T
                    cell[at] = cos.argmax(1)
                    far[at] = np.sqrt(np.maximum(0, 2 - 2 * cos.max(1)))
                for i, row in zip(at.tolist(), x):
                    raw[i] = row.tobytes()
            yield pa.RecordBatch.from_arrays(
                [b.column("label"), b.column("dim"), b.column("rep"), b.column("n"), pa.array(cell), pa.array(far), pa.array(raw, pa.binary())],
                ["label", "dim", "rep", "n", "cell", "far", "x"])

    celled = store(nodes.select("label", "dim", "rep", "n", "v").mapInArrow(
        to_cells, f"label {label_type}, dim int, rep {id_type}, n bigint, cell int, far double, x binary"), "cells")
    known = celled.groupBy("label", "dim", "cell").agg(F.count(F.lit(1)).alias("size"), F.max("far").alias("radius"))
    rows = known.join(F.broadcast(rich.select("label", "dim")), ["label", "dim"], "left_semi").collect()  # at most the bound of pivots
    cells: dict[tuple, dict[int, tuple[int, float]]] = {}
    for r in rows:
        cells.setdefault((r["label"], r["dim"]), {})[r["cell"]] = (r["size"], r["radius"])
    cells = spark.sparkContext.broadcast(cells)
    t = float(np.sqrt(2 - 2 * cosine))

    def to_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["label", "dim", "rep", "n", "x"]
        for b in batches:
            cols = {c: b.column(c).to_pylist() for c in ("label", "dim", "cell", "m", "h")}
            for i0 in range(0, b.num_rows, 256):
                at, keys, sides = [], [], []
                for i in range(i0, min(b.num_rows, i0 + 256)):
                    key = (cols["label"][i], cols["dim"][i])
                    own = cols["cell"][i]
                    there = cells.value.get(key) or {0: (cols["m"][i], 0.0)}
                    mine = (own, cols["h"][i] % -(-there[own][0] // part))
                    near = there
                    if key in centres.value:
                        d = np.sqrt(np.maximum(0, 2 - 2 * (centres.value[key] @ np.frombuffer(b.column("x")[i].as_buffer()))))
                        near = [c for c, (_, r) in there.items() if c == own or d[c] <= t + r + SLACK]
                    for c in near:
                        for q in range(-(-there[c][0] // part)):
                            other = (c, q)
                            at.append(i)
                            keys.append((*min(mine, other), *max(mine, other)))
                            sides.append(int(mine > other))
                if at:
                    rows = pa.RecordBatch.from_arrays([b.column(c) for c in names], names).take(pa.array(at))
                    k = np.array(keys, np.int32).T
                    yield pa.RecordBatch.from_arrays([*rows.columns, *[pa.array(c) for c in k], pa.array(np.array(sides, np.int32))],
                                                     [*names, "a", "ap", "b", "bp", "side"])

    placed = celled.join(sizes, ["label", "dim"]).select("label", "dim", "rep", "n", "x", "cell", "m", F.pmod(F.xxhash64("rep", F.lit("part")), F.lit(1 << 30)).alias("h"))
    pairs = placed.mapInArrow(to_pairs, f"label {label_type}, dim int, rep {id_type}, n bigint, x binary, a int, ap int, b int, bp int, side int")

    def links(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        sides = []
        for s in (0, 1):
            d = pdf[pdf["side"] == s].sort_values("rep")
            x = np.frombuffer(b"".join(d["x"]), np.float64).reshape(len(d), int(key[1]))
            sides.append((d["rep"].to_numpy(), d["n"].to_numpy(), x))
        own = key[2:4] == key[4:6]
        reps, count, root = compare(sides[0], None if own else sides[1], cosine)
        some = count > 0
        return pd.DataFrame({"rep": reps[some], "root": root[some], "links": count[some]})

    found = store(pairs.groupBy("label", "dim", "a", "ap", "b", "bp").applyInPandas(links, f"rep {id_type}, root {id_type}, links bigint"), "part-links")
    comp = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    first = comp.join(nodes.select(F.col("rep").alias("node"), "least"), "node").groupBy("component").agg(F.min("least").alias("component_id"))
    comp = comp.join(first, "component").select("node", "component_id")
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    node = (nodes.join(counts, "rep", "left").join(comp, F.col("rep") == F.col("node"), "left")
            .select("label", "v", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component_id", "least").alias("component_id")))
    joined = v.join(node.select(F.col("label").alias("l"), F.col("v").alias("w"), "n_links", "component_id"), (F.col("label") == F.col("l")) & (F.col("v") == F.col("w")), "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                         F.col("vec_id").eqNullSafe(component).alias("kept"))
