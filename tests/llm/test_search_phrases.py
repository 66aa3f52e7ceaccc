"""Top-k search, hard negatives and phrase mining against plain Python."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from math import floor

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexicrate.llm import blocks as B
from lexicrate.llm import negatives, phrases, topk

VECTORS = "vec_id bigint, embedding array<float>, label int, score int, row string, x int"


def some_vectors(seed: int, n: int, dim: int, clusters: int) -> list[tuple]:
    r = np.random.default_rng(seed)
    centre = r.normal(size=(clusters, dim))
    out = []
    for i in range(n):
        v = centre[r.integers(clusters)] * (0.2 if i % 3 else 1) + 0.1 * r.normal(size=dim)
        out.append((i, (v / np.linalg.norm(v)).astype(np.float32).tolist(), int(r.integers(4)), 1, "a", 2))
    return out


def odd_vectors() -> list[tuple]:
    rest = (1, "a", 2)
    return [(0, [1.0, 0.0], 0, *rest), (0, [1.0, 0.0], 0, *rest), (0, [0.0, 1.0], 1, *rest), (100, [0.5, 0.5], 0, *rest), (200, None, 0, *rest),
            (300, [1.0, None], 0, *rest), (400, [float("nan"), 1.0], 0, *rest), (500, [float("inf"), 1.0], 0, *rest), (None, [1.0, 1.0], 0, *rest),
            (600, [1.0, 1.0], None, *rest), (700, [], 0, *rest), (701, [], 0, *rest), (800, [1.0, 2.0, 3.0], 0, *rest), (5, [-0.001, 0.999], 0, *rest),
            (7, [1.0, 0.0], 9, *rest), (6, [1e30, -1e30], 0, *rest), (8, [0.0, 0.0], 0, *rest), (9, [0.9, 0.1], 2, *rest)]


def usable(rows: list[tuple], labelled: bool) -> list[tuple]:
    out = []
    for i, v, label, *_ in rows:
        if i is None or v is None or (labelled and label is None) or any(x is None or not np.isfinite(x) for x in v):
            continue
        out.append((i, [floor(max(-B.LIMIT, min(B.LIMIT, 256 * float(x)))) for x in v], label))
    return out


def dot(a: list[int], b: list[int]) -> int:
    return sum(x * y for x, y in zip(a, b))


@pytest.mark.parametrize("rows", [some_vectors(1, 700, 8, 6), some_vectors(2, 300, 70, 3), odd_vectors(), []], ids=["clusters", "wide", "odd", "empty"])
def test_top_k(spark, rows, monkeypatch):
    monkeypatch.setattr(B, "RANGE", 128)
    monkeypatch.setattr(B, "BLOCK", 32)
    got = topk.top_k(spark.createDataFrame(rows, VECTORS).repartition(3))
    known = usable(rows, False)
    want = []
    for i, (q, v, _) in enumerate(known):
        if q % topk.EVERY == 0:
            best = sorted((-dot(v, w), c) for j, (c, w, _) in enumerate(known) if j != i and len(w) == len(v))[:topk.K]
            want += [(q, r, c, -s) for r, (s, c) in enumerate(best, 1)]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert got.schema.simpleString() == "struct<query_id:bigint,rank:int,vec_id:bigint,score:bigint>"


def test_search_opens_only_blocks_that_may_matter():
    r = np.random.default_rng(3)
    # block j holds vectors around its own corner
    found = [(np.arange(j * 50, j * 50 + 50), np.arange(j * 50, j * 50 + 50), (1000 * np.eye(8)[j] + r.integers(0, 20, (50, 8))).astype(np.int32)) for j in range(8)]
    q = np.stack([x[2][0] for x in found])
    limit = topk.bounds(q, np.stack([x[2].max(0) for x in found]), np.stack([x[2].min(0) for x in found]))
    who, score, ids, _, opened = topk.search(q, np.arange(8) * 50, np.full(8, B.NONE), found, limit, 5)
    assert opened == 8  # each query its own corner only
    everything = np.concatenate([x[2] for x in found])
    for i in range(8):
        s = q[i].astype(np.int64) @ everything.T
        s[i * 50] = -1 << 40
        best = sorted(range(400), key=lambda j: (-s[j], j))[:5]
        assert [(int(a), int(b)) for a, b in zip(score[who == i], ids[who == i])] == [(int(s[j]), j) for j in best]


def test_bounds_hold():
    r = np.random.default_rng(4)
    x, q = r.integers(-300, 300, (60, 12)).astype(np.int32), r.integers(-300, 300, (9, 12)).astype(np.int32)
    assert (topk.bounds(q, x.max(0)[None], x.min(0)[None]) >= (q.astype(np.int64) @ x.T).max(1)[:, None]).all()


@pytest.mark.parametrize("dim,spread", [(2, 300), (64, 40), (100, 5), (129, 0)])
def test_intervals_hold_the_score(dim, spread):
    r = np.random.default_rng(dim)
    x = (r.integers(-100, 100, dim) + r.integers(-spread, spread + 1, (80, dim))).astype(np.int32)
    q = r.integers(-200, 200, (30, dim)).astype(np.int32)
    c = negatives.encode(x)
    block = {"centre": B.longs(c["centre"]), "codes": np.frombuffer(c["codes"], np.uint64).reshape(80, -1), "align": np.frombuffer(c["align"]), "far": np.frombuffer(c["far"])}
    lower, upper = negatives.Asked(q).interval(block)
    s = q.astype(np.int64) @ x.T
    assert (lower <= s).all() and (s <= upper).all()
    if spread and spread < 50:  # alike vectors: the interval is much shorter than Cauchy-Schwarz alone
        plain = np.linalg.norm(q, axis=1)[:, None] * np.linalg.norm(x, axis=1)[None]
        assert (upper - lower).mean() < plain.mean()
    turned = negatives.rotate(x)
    assert np.allclose((turned ** 2).sum(1), (x.astype(float) ** 2).sum(1))


@pytest.mark.parametrize("rows", [some_vectors(5, 900, 16, 3), odd_vectors(), []], ids=["clusters", "odd", "empty"])
def test_hard_negatives(spark, rows, monkeypatch):
    monkeypatch.setattr(B, "RANGE", 128)
    monkeypatch.setattr(B, "BLOCK", 32)
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = negatives.mine(spark.createDataFrame(rows, VECTORS).repartition(3), label=moved)
    known = [(i, v, (label + 1) % 10 if i % 7 == 0 else label) for i, v, label in usable(rows, True)]
    want = []
    for i, (a, v, label) in enumerate(known):
        if a % 100 == 0:
            others = sorted((-dot(v, w), c, j) for j, (c, w, _) in enumerate(known) if j != i and len(w) == len(v))
            for s, p, _ in [o for o in others if known[o[2]][2] == label][:5]:
                hard = [o for o in others if known[o[2]][2] != label and 80 * -s <= 100 * -o[0] <= 100 * -s][:5]
                want += [(a, p, r, c, -s, -t) for r, (t, c, _) in enumerate(hard, 1)]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    if len(rows) > 100:
        assert want


def mined(rows: list[tuple], least: int, first: int, longest: int = 5) -> list[tuple]:
    """The contract in plain Python."""
    f: dict[str, Counter] = defaultdict(Counter)
    n: Counter = Counter()
    for text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        some = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        inside: dict = {}
        for p, a in some.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i:i + k]] = max(inside.get(p[i:i + k], 0), a)
        found = []
        for p, a in some.items():
            if inside.get(p, 0) < a:
                score, _, left, right = min((1000 * a * n[lang] // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, r, p.decode(), -a, left, right, n[lang], -s) for r, (s, a, p, left, right) in enumerate(sorted(found)[:first], 1)]
    return sorted(out)


def some_texts(seed: int) -> list[tuple]:
    r = np.random.default_rng(seed)
    words = ["the", "The", "of", "RIVER", "bank", "é", "ÉA", "x y", "|", "a-b", " ", "\x1c"] + [f"w{i}" for i in range(40)]
    marks = [" ", " ", "  ", "\t", ", ", ".", "\n", "\r\n", " ; ", "!?", "\x0b", "\x0c"]
    rows = []
    for i in range(120):
        size = int(r.integers(0, 60))
        at = np.minimum(r.zipf(1.4, size), len(words)) - 1
        text = "".join(words[j] + marks[int(k)] for j, k in zip(at, np.minimum(r.zipf(1.5, size), len(marks)) - 1))
        rows.append((text, [None, "und", "en", "en", ""][i % 5], i, 1, "p"))
    rows += [(None, "en", 200, 1, "p"), ("", None, 201, 1, "p"), ("one two three four five six " * 900, "en", 202, 1, "p"), ("same words here. " * 500, "de", 203, 1, "p"), ("...", "fr", 204, 1, "p")]
    return rows + rows[:10]


TEXTS = "text string, lang string, doc_id int, n bigint, phrase string"


@pytest.mark.parametrize("sample,held,entries", [(0.1, 1 << 21, 1 << 21), (0.9, 300, 50), (1e-9, 1000, 1 << 21)], ids=["usual", "small buffers", "no sample"])
def test_phrases(spark, monkeypatch, sample, held, entries):
    monkeypatch.setattr(phrases, "HELD", held)
    monkeypatch.setattr(phrases, "ENTRIES", entries)
    monkeypatch.setattr(phrases, "PHRASES", entries)
    rows = some_texts(1)
    got = phrases.collocations(spark.createDataFrame(rows, TEXTS).repartition(3), least=6, first=30, sample=sample)
    want = mined(rows, 6, 30)
    assert len(want) > 40
    assert sorted(map(tuple, got.collect())) == want


def test_phrases_do_not_depend_on_the_filter(spark, monkeypatch):
    """A filter with every bit set counts everything; results stay."""
    monkeypatch.setattr(phrases, "FILTER_ROW", 64)
    monkeypatch.setattr(phrases, "FILTER_BITS", 64)
    rows = some_texts(2)
    got = phrases.collocations(spark.createDataFrame(rows, TEXTS), least=8, first=10)
    assert sorted(map(tuple, got.collect())) == mined(rows, 8, 10)


def test_phrases_of_nothing(spark):
    assert phrases.collocations(spark.createDataFrame([], TEXTS)).collect() == []
    assert phrases.collocations(spark.createDataFrame([(None, None, 1, 1, "x"), ("  ", "en", 2, 1, "x")], TEXTS)).collect() == []


def test_phrase_scores_beyond_64_bits(spark):
    """1000 * a * n passes 64 bits in the score."""
    rows = [("lang", None, 4_000_000_000_000_000), ("lang", "a", 3_000_000_000_000), ("lang", "b", 2_000_000_000_000), ("lang", "a b", 1_999_999_999_999)]
    known = spark.createDataFrame(rows, "lang string, phrase string, f bigint")
    got = phrases.ranked(known, first=5, share=100).collect()
    a, left, right, n = 1_999_999_999_999, 3_000_000_000_000, 2_000_000_000_000, 4_000_000_000_000_000
    assert [tuple(r) for r in got] == [("lang", 1, "a b", a, left, right, n, 1000 * a * n // (left * right))]
