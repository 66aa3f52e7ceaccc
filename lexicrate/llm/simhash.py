"""SimHash near-duplicates through Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into segments of 23, 23 and 18 bits (the last
padded with zeros).  With at most two differing bits in all, one segment is
equal and any other differs in two bits at most (pigeonhole).  The perfect
Golay code (23, 12, 7) has a codeword within three bits of every word; two
words within two bits of each other have a word midway that lies within one
bit of both, whose codeword lies within four bits of both.  So each segment is
decoded to the indices of all codewords within four bits (one or six of them),
and (equal segment, codeword index of the next) is a key that linked
fingerprints share.  Candidates of a key are verified by their bit distance.

Equal fingerprints are one node, so copies cost nothing.  A
key shared by few fingerprints yields its verified pairs; one shared by more
yields a spanning forest of its verified pairs; one shared by over ``ball_above`` is
resolved by the exact ball join instead: two fingerprints differ in at most two
bits just when some word is within one bit of both, and at most 65
fingerprints are within one bit of a word, so no group is unbounded.

Defined results: a null text is empty; a text without words has fingerprint
zero and links like any other; rows with a null id get no component and carry
no links; columns besides id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexicrate.llm.components import components, join_labels
from lexicrate.session import store

SHINGLE, MAX_BITS, SEED = 3, 2, 42
SEGMENTS = ((0, 23), (23, 23), (46, 18))
SMALL, BALL_ABOVE = 16, 16384
#: Fixed value: generator polynomial of the Golay code, x^11+x^10+x^6+x^5+x^4+x^2+1.
GENERATOR = 0b110001110101


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Majority bits of the hashes of all word shingles of a whole text."""
    words = (text or "").encode().lower().split()  # bytes: A-Z and the six ASCII spaces only
    if not words:
        return 0
    joined, at = b" ".join(words), np.cumsum([0] + [len(w) + 1 for w in words])
    n = max(1, len(words) - shingle + 1)
    starts, ends = at[:n].tolist(), (at[min(shingle, len(words)):] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 16):  # bounded memory for very long texts
        h = np.array([digest(joined[s:e], seed) for s, e in zip(starts[i:i + (1 << 16)], ends[i:i + (1 << 16)])], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int32)
    return int(((2 * ones > n).astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum())


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """``doc_id, fp`` (the fingerprint as a signed 64-bit integer) and
    ``text_hash`` (``xxhash64`` of the text)."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t, shingle, seed) for t in b.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64)), b.column(2)], ["doc_id", "fp", "text_hash"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_hash")).mapInArrow(
        run, f"doc_id {id_type}, fp bigint, text_hash bigint")


def golay_tables() -> tuple[np.ndarray, np.ndarray]:
    """For each of the 2048 syndromes: the error of up to three bits, and for
    errors of three bits the five weight-7 codewords that cover them."""
    bits = [1 << i for i in range(23)]
    errors = [0, *bits, *[a | b for i, a in enumerate(bits) for b in bits[:i]],
              *[a | b | c for i, a in enumerate(bits) for j, b in enumerate(bits[:i]) for c in bits[:j]]]
    errors = np.array(errors, np.int64)
    leader = np.zeros(2048, np.int64)
    leader[syndrome(errors)] = errors
    words = codewords()
    heavy = words[np.bitwise_count(words) == 7]
    cover = np.zeros((2048, 5), np.int64)
    for s in np.flatnonzero(np.bitwise_count(leader) == 3):
        cover[s] = heavy[(heavy & leader[s]) == leader[s]]
    return leader, cover


def syndrome(words: np.ndarray) -> np.ndarray:
    """Remainder of 23-bit words by the generator polynomial."""
    r = words.copy()
    for i in range(22, 10, -1):
        r ^= ((r >> i) & 1) * (GENERATOR << (i - 11))
    return r


def codewords() -> np.ndarray:
    """The 4096 codewords; the upper 12 bits of each are its index."""
    data = np.arange(4096, dtype=np.int64) << 11
    return data ^ syndrome(data)


def near_codewords(words: np.ndarray, tables: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(row, index) of all codewords within four bits of each 23-bit word."""
    leader, cover = tables
    s = syndrome(words)
    nearest = words ^ leader[s]
    far = np.flatnonzero(np.bitwise_count(leader[s]) == 3)
    rows = np.concatenate([np.arange(len(words)), np.repeat(far, 5)])
    found = np.concatenate([nearest, (nearest[far, None] ^ cover[s[far]]).ravel()])
    return rows, found >> 11


def keys(fps: np.ndarray, tables) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) for every key of each fingerprint (uint64)."""
    seg = [((fps >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]
    rows, out = [], []
    for k in range(len(SEGMENTS)):
        r, idx = near_codewords(seg[(k + 1) % len(SEGMENTS)], tables)
        rows.append(r)
        out.append((k << 40) | (seg[k][r] << 12) | idx)
    return np.concatenate(rows), np.concatenate(out)


def forest(fps: np.ndarray, max_bits: int) -> np.ndarray:
    """For each fingerprint the smallest position in its component."""
    label, u, v = None, [], []
    for i in range(0, len(fps), 256):
        a, b = np.nonzero(np.bitwise_count(fps[i:i + 256, None] ^ fps[None, i:]) <= max_bits)
        u.append(a + i)
        v.append(b + i)
        if sum(map(len, u)) > 1 << 20 or i + 256 >= len(fps):
            label, u, v = join_labels(len(fps), np.concatenate(u), np.concatenate(v), label), [], []
    return label


def links(distinct: DataFrame, max_bits: int = MAX_BITS, ball_above: int = BALL_ABOVE) -> DataFrame:
    """Links ``a, b`` between representatives of the rows ``fp, rep`` whose
    components are those of all pairs within ``max_bits`` (2 at most)."""
    if not 0 <= max_bits <= 2:
        raise ValueError("the keys cover up to two differing bits")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = golay_tables()
        for b in batches:
            fp, rep = b.column(0).to_numpy(), b.column(1).to_numpy()
            for i in range(0, len(fp), 8192):
                rows, key = keys(fp[i:i + 8192].view(np.uint64), tables)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp[i:i + 8192][rows]), pa.array(rep[i:i + 8192][rows])], ["key", "fp", "rep"])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(a, b, fp):
            none = np.zeros(len(a), bool)
            return pa.RecordBatch.from_arrays(
                [pa.array(a), pa.array(b, mask=none if fp is None else ~none), pa.array(a if fp is None else fp, mask=~none if fp is None else none)], ["a", "b", "fp"])

        def runs(key, fp, rep):
            """Links of whole runs of equal keys."""
            start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            size = np.diff(np.r_[start, len(key)])
            own = np.repeat(size, size)
            few = own <= SMALL
            for d in range(1, SMALL):
                i = np.flatnonzero(few[:-d] & (key[:-d] == key[d:])) if d < len(key) else np.zeros(0, np.int64)
                if not len(i):
                    break
                i = i[np.bitwise_count((fp[i] ^ fp[i + d]).view(np.uint64)) <= max_bits]
                if len(i):
                    yield batch(rep[i], rep[i + d], None)
            for s, n in zip(start[size > SMALL].tolist(), size[size > SMALL].tolist()):
                if n > ball_above:
                    yield batch(rep[s:s + n], rep[s:s + n], fp[s:s + n])
                    continue
                label = forest(fp[s:s + n].view(np.uint64), max_bits)
                i = np.flatnonzero(label != np.arange(n))
                if len(i):
                    yield batch(rep[s + i], rep[s + label[i]], None)

        held, hot = None, None
        for b in batches:
            now = [b.column(k).to_numpy() for k in range(3)]
            if not len(now[0]):
                continue
            if hot is not None:  # the rest of a run that was already handed on
                n = int(np.searchsorted(now[0], hot, "right"))
                if n:
                    yield batch(now[2][:n], now[2][:n], now[1][:n])
                now = [x[n:] for x in now]
                if not len(now[0]):
                    continue
                hot = None
            if held is not None:
                now = [np.concatenate(x) for x in zip(held, now)]
            last = int(np.searchsorted(now[0], now[0][-1], "left"))
            if last:
                yield from runs(*[x[:last] for x in now])
            held = [x[last:] for x in now]
            if len(held[0]) > ball_above:
                yield batch(held[2], held[2], held[1])
                hot, held = held[0][0], None
        if held is not None:
            yield from runs(*held)

    keyed = distinct.select("fp", "rep").mapInArrow(spread, "key bigint, fp bigint, rep bigint")
    found = keyed.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(joined, "a bigint, b bigint, fp bigint")
    found = store(found, "candidates")
    masks = [0, *[1 << i if i < 63 else -(1 << 63) for i in range(64)]] if max_bits else [0]
    ball = (found.where(F.col("fp").isNotNull()).select("a", "fp").distinct()
            .select("a", "fp", F.explode(F.array(*[F.lit(m).cast("long") for m in masks])).alias("m")))
    ball = ball.select("a", "fp", F.col("fp").bitwiseXOR(F.col("m")).alias("point"))
    if max_bits == 1:  # a shared point proves two bits only; keep links from a fingerprint to its own neighbours
        ball = ball.join(ball.where("m = 0").select(F.col("fp").alias("point"), F.col("a").alias("b")), "point").select("a", "b")
    else:
        from pyspark.sql import Window
        ball = ball.select("a", F.min("a").over(Window.partitionBy("point")).alias("b"))
    return found.where(F.col("fp").isNull()).select("a", "b").union(ball.where("a != b").select("a", "b"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS, seed: int = SEED, ball_above: int = BALL_ABOVE, with_hash: bool = False) -> DataFrame:
    """``doc_id, fingerprint`` (16 hex digits), ``component_id`` and
    ``group_size`` (rows that share the fingerprint) of every row, and with
    ``with_hash`` ``text_hash``, which tells rows of one id apart."""
    fps = store(fingerprints(docs, id_col, text_col, shingle, seed), "fingerprints")
    distinct = store(fps.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n")), "distinct-fingerprints")
    # nodes are fingerprints: rows of one id and different texts may give the same smallest id
    comp = components(links(distinct.where(F.col("rep").isNotNull()).select("fp", F.col("fp").alias("rep")), max_bits, ball_above))
    least = comp.join(distinct, F.col("node") == F.col("fp")).groupBy("component").agg(F.min("rep").alias("least"))
    comp = comp.join(least, "component").select("node", "least")
    nodes = distinct.join(comp, distinct["fp"] == comp["node"], "left").select(
        F.col("fp").alias("f"), F.coalesce("least", "rep").alias("component_id"), F.col("n").alias("group_size"))
    return fps.join(nodes, F.col("fp") == F.col("f")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"), "group_size", *(["text_hash"] if with_hash else []))
