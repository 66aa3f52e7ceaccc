"""Toxicity: a bidirectional gated recurrent network with attention pooling.

A word enters as a learned vector of its hash and the mean of learned vectors
of its character grams (beginnings and ends).  Two gated recurrent layers read
a window of words forwards and backwards, attention pools their states, and a
logistic unit scores the window.  A text is cut into overlapping windows, all
are scored, and the text's score is the highest.

The network is trained here, in numpy, on a bounded sample of labelled rows
(``per_class`` rows of each class, ``train_windows`` windows of a row).  Labels
belong to whole texts, so the windows to learn from are chosen in rounds: at first those
with the words most typical of toxic texts, then those that the network itself
scores highest in toxic texts (to learn as toxic) and in others (as not).

Scoring needs no shuffle: the weights (under 1 MB) are broadcast, and each
different word of a task passes the input layer once.

Defined results: a null or empty text is one empty window, scored by the
bias; without labels of both classes all scores are the share of label 1 (0.5 without any label);
columns besides id and text never enter a score; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexicrate.llm import labelled
from lexicrate.llm.words import Words, bucket, portions

WINDOW, STRIDE = 32, 24
WORD_BUCKETS, GRAM_BUCKETS, DIM, HIDDEN = 4096, 4096, 8, 8
PER_CLASS, TRAIN_WINDOWS, BATCH, RATE = 1500, 64, 128, 0.01
#: Share of words whose own vector is left out of a step, and shrinkage of the learned vectors at each step.
DROPPED, DECAY = 0.5, 0.003
#: Steps of each round: a fixed effort, however few labelled rows there are.
ROUNDS = (120, 80, 60, 60)
THRESHOLD, BLOCK = 0.7, 4096
GRAMS = 6
#: ASCII signs count as spaces.
SIGNS = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def split(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().translate(SIGNS).split()


def describe(words: list[bytes]) -> np.ndarray:
    """Per word: its bucket, then the buckets of its grams."""
    rows = [(bucket(w, WORD_BUCKETS), *[bucket(t + g, GRAM_BUCKETS) for t, g in
             ((b"<", w[:3]), (b"<", w[:4]), (b"<", w[:5]), (b"<", w[:6]), (b">", w[-3:]), (b">", w[-4:]))]) for w in words]
    return np.array(rows, np.int32).reshape(-1, 1 + GRAMS)


def windows(ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, words, text) of all windows of texts that begin and end at ``ends``."""
    n = np.diff(ends)
    each = np.maximum(1, -(-(n - WINDOW) // STRIDE) + 1)
    text = np.repeat(np.arange(len(n)), each)
    k = np.arange(len(text)) - np.repeat(np.cumsum(each) - each, each)
    first = ends[:-1][text] + k * STRIDE
    return first, np.minimum(WINDOW, ends[1:][text] - first), text


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


class Network:
    def __init__(self, seed: int = 1):
        g = np.random.default_rng(seed)
        h3 = 3 * HIDDEN
        self.p = {
            "word": g.normal(0, 0.1, (WORD_BUCKETS, DIM)), "gram": g.normal(0, 0.1, (GRAM_BUCKETS, DIM)),
            "W": g.normal(0, 0.3, (2, 2 * DIM, h3)), "U": g.normal(0, 0.3, (2, HIDDEN, h3)), "b": np.zeros((2, h3)),
            "v": g.normal(0, 0.3, 2 * HIDDEN), "w": g.normal(0, 0.3, 2 * HIDDEN), "c": np.zeros(1)}
        self.p = {k: x.astype(np.float32) for k, x in self.p.items()}
        self.m = {k: (np.zeros_like(x), np.zeros_like(x)) for k, x in self.p.items()}
        self.t = 0

    def inputs(self, rows: np.ndarray) -> np.ndarray:
        """The input vectors of words given by ``describe``."""
        return np.concatenate([self.p["word"][rows[:, 0]], self.p["gram"][rows[:, 1:]].mean(1)], 1)

    def gates(self, rows: np.ndarray) -> np.ndarray:
        """What the words add to the gates of both directions."""
        x = self.inputs(rows)
        return np.concatenate([x @ self.p["W"][d] + self.p["b"][d] for d in (0, 1)], 1).astype(np.float32)

    def read(self, gates: np.ndarray, index: np.ndarray, mask: np.ndarray, keep: list | None = None) -> np.ndarray:
        """States (window, word, 2 x HIDDEN); ``gates[index]`` are the words' parts."""
        states = np.zeros((*index.shape, 2 * HIDDEN), np.float32)
        for d in (0, 1):
            h, u = np.zeros((len(index), HIDDEN), np.float32), self.p["U"][d]
            part = np.ascontiguousarray(gates[:, d * 3 * HIDDEN:(d + 1) * 3 * HIDDEN])
            for t in range(index.shape[1]) if d == 0 else reversed(range(index.shape[1])):
                x, hu = part[index[:, t]], h @ u
                zr = sigmoid(x[:, :2 * HIDDEN] + hu[:, :2 * HIDDEN])
                z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
                n = np.tanh(x[:, 2 * HIDDEN:] + r * hu[:, 2 * HIDDEN:])
                new = n + z * (h - n)
                if not mask[:, t].all():
                    new = np.where(mask[:, t, None], new, h)
                if keep is not None:
                    keep.append((d, t, h, z, r, n, hu[:, 2 * HIDDEN:]))
                h = new
                states[:, t, d * HIDDEN:(d + 1) * HIDDEN] = h
        return states

    def pool(self, states: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(probability, pooled state, attention) of windows."""
        s = np.where(mask, states @ self.p["v"], -1e9)
        a = np.exp(s - s.max(1, keepdims=True))
        a /= a.sum(1, keepdims=True)
        c = (a[:, None, :] @ states)[:, 0]
        return sigmoid(c @ self.p["w"] + self.p["c"][0]), c, a

    def score(self, gates: np.ndarray, numbers: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Probabilities of windows; ``gates`` has a row for each word number."""
        out = np.zeros(len(first))
        numbers = np.append(numbers, 0)
        if not len(gates):
            gates = np.zeros((1, 6 * HIDDEN), np.float32)
        for i in range(0, len(first), BLOCK):
            f, s = first[i:i + BLOCK], size[i:i + BLOCK]
            steps = np.arange(max(1, int(s.max())))
            mask = steps < s[:, None]
            index = numbers[np.where(mask, f[:, None] + steps, len(numbers) - 1)]
            out[i:i + BLOCK] = self.pool(self.read(gates, index, mask), mask)[0]
        return out

    def learn(self, rows: np.ndarray, index: np.ndarray, mask: np.ndarray, y: np.ndarray) -> None:
        """One Adam step on windows ``index`` into the words ``rows``."""
        p, keep = self.p, []
        x = self.inputs(rows)
        # half of the words enter by their grams alone, so that unseen forms of a word are learned too
        whole = (np.random.default_rng(self.t).random((len(rows), 1)) >= DROPPED).astype(x.dtype)
        x[:, :DIM] *= whole
        gates = np.concatenate([x @ p["W"][d] + p["b"][d] for d in (0, 1)], 1)
        states = self.read(gates, index, mask, keep)
        prob, c, a = self.pool(states, mask)
        g = {k: np.zeros_like(v) for k, v in p.items()}
        dl = ((prob - y) / len(y)).astype(np.float32)
        g["w"], g["c"][0] = dl @ c, dl.sum()
        dc = dl[:, None] * p["w"]
        da = (states @ dc[:, :, None])[:, :, 0]
        ds = a * (da - (a * da).sum(1, keepdims=True))
        g["v"] = np.einsum("bt,bth->h", ds, states)
        dstates = a[:, :, None] * dc[:, None, :] + ds[:, :, None] * p["v"]
        dgates = np.zeros_like(gates)
        dh, last = None, None
        for d, t, h, z, r, n, hun in reversed(keep):
            if d != last:
                dh, last = np.zeros_like(h), d
            dh = dh + dstates[:, t, d * HIDDEN:(d + 1) * HIDDEN]
            on = np.where(mask[:, t, None], dh, 0)
            dn, dz = on * (1 - z) * (1 - n * n), on * (h - n) * z * (1 - z)
            dr = dn * hun * r * (1 - r)
            dx, dhu = np.concatenate([dz, dr, dn], 1), np.concatenate([dz, dr, dn * r], 1)
            g["U"][d] += h.T @ dhu
            dh = (dh - on) + on * z + dhu @ p["U"][d].T
            np.add.at(dgates[:, d * 3 * HIDDEN:(d + 1) * 3 * HIDDEN], index[:, t][mask[:, t]], dx[mask[:, t]])
        dx = np.zeros_like(x)
        for d in (0, 1):
            own = dgates[:, d * 3 * HIDDEN:(d + 1) * 3 * HIDDEN]
            g["W"][d], g["b"][d] = x.T @ own, own.sum(0)
            dx += own @ p["W"][d].T
        np.add.at(g["word"], rows[:, 0], dx[:, :DIM] * whole)
        np.add.at(g["gram"], rows[:, 1:], dx[:, None, DIM:] / GRAMS)
        self.t += 1
        for k, v in p.items():
            m, s = self.m[k]
            m += 0.1 * (g[k] - m)
            s += 0.001 * (g[k] ** 2 - s)
            v -= RATE * (m / (1 - 0.9 ** self.t)) / (np.sqrt(s / (1 - 0.999 ** self.t)) + 1e-7)
        for k in ("word", "gram"):
            p[k] *= 1 - DECAY


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text",
        per_class: int = PER_CLASS, train_windows: int = TRAIN_WINDOWS, rounds: tuple[int, ...] = ROUNDS) -> dict | float:
    """The trained weights, or the share of label 1 if a class is missing."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = [split(t) for t in b.column(0).to_pylist()]
            out = []
            for ws in lists:
                first, size, _ = windows(np.array([0, len(ws)]))
                at = np.unique(np.linspace(0, len(first) - 1, train_windows).astype(int)) if len(first) > train_windows else range(len(first))
                out.append(b"\n".join(b" ".join(ws[first[i]:first[i] + size[i]]) for i in at))
            yield pa.RecordBatch.from_arrays([b.column(1), b.column(2), pa.array(out, pa.binary())], ["y", "key", "windows"])

    rows = labelled.sample(docs, labels, label, id_col, text_col, per_class).mapInArrow(cut, "y int, key bigint, windows binary").collect()
    rows.sort(key=lambda r: (r["key"], r["windows"]))
    if len({r["y"] for r in rows}) < 2:
        return labelled.prior(labels, label, id_col)
    return train([(r["y"], [w.split() for w in bytes(r["windows"]).split(b"\n")]) for r in rows], rounds).p


def train(texts: list[tuple[int, list[list[bytes]]]], rounds: tuple[int, ...] = ROUNDS, seed: int = 1) -> Network:
    """Train on (label, windows of words) of texts."""
    g, net, vocabulary = np.random.default_rng(seed), Network(seed), Words(describe)
    numbers, ends = vocabulary.numbers([w for _, ws in texts for w in ws])
    rows = vocabulary.rows[:len(vocabulary.known)]
    first, size = ends[:-1], np.diff(ends)
    owner = np.repeat(np.arange(len(texts)), [len(ws) for _, ws in texts])
    y = np.array([t[0] for t in texts], np.float32)

    # how typical of toxic texts a word is, by itself or by the way it begins: log odds over texts
    word_at = np.repeat(np.arange(len(first)), size)
    odds = np.full(len(rows), -9.0)
    for at in (np.arange(len(rows)), rows[:, 2], rows[:, 3]):
        seen = np.unique(at[numbers].astype(np.int64) * len(y) + owner[word_at])
        n = [np.bincount((seen // len(y))[y[seen % len(y)] == k], minlength=at.max() + 1) for k in (0, 1)]
        odds = np.maximum(odds, (np.log((n[1] + 0.5) / (y == 1).sum()) - np.log((n[0] + 0.5) / (y == 0).sum()))[at])
    score = np.full(len(first), -9.0)
    np.maximum.at(score, word_at, odds[numbers])

    for steps in rounds:
        order = np.lexsort((-score, owner))
        rank = np.arange(len(order)) - np.searchsorted(owner[order], owner[order])
        top, other = order[rank == 0], order[rank > 0]
        chance = other[g.random(len(other)) < 2 * len(top) / max(1, len(other))]
        # windows of toxic texts that are not the highest may be toxic or not: left out
        chosen = np.concatenate([top, chance[y[owner[chance]] == 0]])
        second = order[rank == 1]
        chosen = np.concatenate([chosen, second[y[owner[second]] == 0]])
        for _ in range(steps):
            # half of a batch from each class
            w = np.concatenate([g.choice(c, BATCH // 2) for k in (0, 1) if len(c := chosen[y[owner[chosen]] == k])])
            mask = np.arange(WINDOW) < size[w][:, None]
            index = numbers[np.minimum(first[w][:, None] + np.arange(WINDOW), len(numbers) - 1)] if len(numbers) else np.zeros((len(w), WINDOW), int)
            used, small = np.unique(index, return_inverse=True)
            if len(rows):
                net.learn(rows[used], small.reshape(index.shape), mask, y[owner[w]])
        score = net.score(net.gates(rows), numbers, first, size)
    return net


def score(docs: DataFrame, weights: dict | float, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` plus a double column with the score of each whole text; a column of that name is replaced."""
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() != score_col.lower()])
    if isinstance(weights, float):
        return docs.withColumn(score_col, F.lit(weights))
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    at = docs.columns.index(text_col)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + f", `{score_col}` double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network()
        net.p = shared.value
        vocabulary = Words(lambda words: net.gates(describe(words)))
        for b in batches:
            out = np.zeros(b.num_rows)
            for i, lists in portions(b.column(at).to_pylist(), split):
                numbers, ends = vocabulary.numbers(lists)
                first, size, text = windows(ends)
                np.maximum.at(out, i + text, net.score(vocabulary.rows, numbers, first, size))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out)], [*b.schema.names, score_col])

    return docs.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, **fitting) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row."""
    weights = fit(docs, labels, "toxic", id_col, text_col, **fitting)
    s = score(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), weights)
    return s.select("doc_id", labelled.held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
