"""Quality classifier: nearest-neighbour voting among labelled vectors.

Every whole text becomes a vector of hashed terms: its words, the shapes of
its words, pairs of neighbouring shapes and repeated words, as square roots of
relative frequencies times their inverse document frequency.  The singular vectors of a bounded
labelled sample give the latent-semantic space; the sample's vectors are
broadcast (at most 2 x ``per_class`` rows of ``rank`` numbers) and every
document's cosines with all of them are computed exactly, block by block.  The
nearest neighbours vote with weights that rise with similarity; votes are
corrected for the sample's equal classes by the share of each class among all
labelled rows.

Defined results: a null or empty text has the zero vector and gets the prior;
without usable labels all scores are 0.5; columns besides id and text never
enter a score; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexicrate.llm import labelled
from lexicrate.llm.words import Words, bucket, portions, shapes

WORDS, SHAPES, PAIRS = 512, 256, 512
TERMS = WORDS + SHAPES + PAIRS + 1
RANK, NEIGHBOURS, SHARPNESS, THRESHOLD = 64, 25, 8.0, 0.5
BLOCK = 2048


def _describe(words: list[bytes]) -> np.ndarray:
    return np.array([(bucket(w.lower(), WORDS), bucket(s, SHAPES)) for w, s in zip(words, shapes(words))], np.int32).reshape(-1, 2)


def _split(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def term_vectors(texts: list[str | None]) -> np.ndarray:
    return np.concatenate([np.zeros((0, TERMS), np.float32), *_vectors(texts, Words(_describe))])


def _vectors(texts: list[str | None], vocabulary: Words) -> Iterator[np.ndarray]:
    for _, lists in portions(texts, _split):
        numbers, ends = vocabulary.numbers(lists)
        w, s = vocabulary.rows[numbers].T
        pair = np.append((s[:-1] * 31 + s[1:]) % PAIRS, 0)[:len(s)]
        again = np.append(numbers[1:] == numbers[:-1], False)[:len(s)]
        out = np.zeros((len(lists), TERMS), np.float32)
        for v, a, b in zip(out, ends[:-1].tolist(), ends[1:].tolist()):
            if a == b:
                continue
            v[:WORDS] = np.bincount(w[a:b], minlength=WORDS)
            v[WORDS:WORDS + SHAPES] = np.bincount(s[a:b], minlength=SHAPES)
            v[WORDS + SHAPES:-1] = np.bincount(pair[a:b - 1], minlength=PAIRS)
            v[-1] = again[a:b - 1].sum()
            v /= b - a
        yield np.sqrt(out)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text",
        per_class: int = labelled.PER_CLASS, rank: int = RANK) -> dict:
    """The model: idf, singular vectors, unit vectors and vote weights of the sample."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = term_vectors(b.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(1), b.column(2), pa.array([x.tobytes() for x in v.astype(np.float16)], pa.binary())], ["y", "key", "v"])

    rows = labelled.sample(docs, labels, label, id_col, text_col, per_class).mapInArrow(run, "y int, key bigint, v binary").collect()
    rows.sort(key=lambda r: (r["key"], r["v"]))
    x = np.array([np.frombuffer(r["v"], np.float16) for r in rows], np.float32).reshape(len(rows), TERMS)
    y = np.array([r["y"] for r in rows], np.float32)
    share = labelled.prior(labels, label, id_col)
    if not len(x):
        return {"idf": np.ones(TERMS, np.float32), "v": np.zeros((TERMS, 1), np.float32), "z": np.zeros((0, 1), np.float32), "y": y, "w": y, "prior": 0.5}
    idf = np.log((1 + len(x)) / (1 + (x > 0).sum(0))).astype(np.float32) + 1
    _, vectors = np.linalg.eigh((x * idf).T @ (x * idf))  # right singular vectors
    v = np.ascontiguousarray(vectors[:, ::-1][:, :rank]).astype(np.float32)
    z = unit((x * idf) @ v)
    ones = max(y.mean(), 1e-9)
    w = np.where(y > 0, share / ones, (1 - share) / max(1 - ones, 1e-9)).astype(np.float32)
    return {"idf": idf, "v": v, "z": z, "y": y, "w": w, "prior": share}


def unit(x: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(x, axis=1, keepdims=True)
    return (x / np.where(n > 0, n, 1)).astype(np.float32)


def vote(x: np.ndarray, model: dict) -> np.ndarray:
    """Scores of term vectors: similarity-weighted votes of the neighbours."""
    out = np.full(len(x), model["prior"])
    k = min(NEIGHBOURS, len(model["z"]))
    if not k:
        return out
    for i in range(0, len(x), BLOCK):
        q = unit((x[i:i + BLOCK] * model["idf"]) @ model["v"])
        cos = q @ model["z"].T
        near = np.argpartition(cos, -k, axis=1)[:, -k:]
        w = np.maximum(np.take_along_axis(cos, near, 1), 0).astype(np.float64) ** SHARPNESS * model["w"][near]
        total = w.sum(1)
        some = total > 0
        out[i:i + BLOCK][some] = (w * model["y"][near]).sum(1)[some] / total[some]
    return np.clip(out, 0, 1)


def score(docs: DataFrame, model: dict, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` plus a double column with the score of each whole text; a column of that name is replaced."""
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() != score_col.lower()])
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + f", `{score_col}` double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, m = Words(_describe), shared.value
        for b in batches:
            found = [vote(x, m) for x in _vectors(b.column(at).to_pylist(), vocabulary)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.concatenate([np.zeros(0), *found]))], [*b.schema.names, score_col])

    return docs.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, **fitting) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row."""
    model = fit(docs, labels, "quality", id_col, text_col, **fitting)
    s = score(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), model)
    return s.select("doc_id", labelled.held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
