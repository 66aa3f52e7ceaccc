"""Removal of repeated passages by a distributed sort of suffixes.

A byte goes if a string of ``length`` bytes that covers it also starts earlier
(in a smaller document, or earlier in its own).  All strings are judged on the
input; matches never cross documents.

Which suffixes: every string of ``length`` bytes has one anchor, its gram of ``gram``
bytes with the least hash (the leftmost such), so equal strings have equal anchors
at equal places.  The neighbouring starts that share an anchor form a region, and only regions
whose anchor gram occurs more than once can hold a repeated string; the others
drop out after one exchange of compact hash lists.

How they are sorted: each task sorts its regions by the suffix that starts at the anchor
(then by what stands left of it), front-codes the sorted run, and cuts it at
sampled splitters.  A range receives its runs and merges them with a loser
tree that carries common-prefix lengths: of two heads the one that shares more
with the last output is smaller without looking at a byte, and otherwise bytes
are compared only behind the known prefix.  Equal regions come out as neighbours: all but the
earliest go as a whole.  Different regions with one gram are also neighbours;
their strings are compared in full and each earliest one stays.

Hot grams: equal regions of a run travel once, with their earliest place, so a passage costs a range one
item for each run.  The places are rows of their own that join the outcome of their region by a digest of 128 bits;
outcomes of hot regions are broadcast, so no task gathers the places of a passage.  A gram with over ``many`` occurrences sends its strings one by one,
each a region of its own, so that no group of different regions needs to be held.
Grams found often in the sample skip the hash exchange: they are known to repeat.

Defined results: a null text is empty; a null id comes after all others; rows
equal in id and text count as one document and each gets its result; rows with
one id and different texts are ordered by a hash of the text; texts shorter
than ``length`` lose nothing; ids are integers; extra columns are ignored.
"""

from __future__ import annotations

import struct
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexicrate.llm.batches import slices, small_batches
from lexicrate.session import store

LENGTH, GRAM = 100, 32
MANY = 1 << 16
#: Starts of a text and bytes handled at once; bytes of memory of a run; documents of the sample that places splitters and finds hot grams.
SEGMENT, BUFFER, RUN_BYTES, SAMPLE = 1 << 18, 1 << 19, 48 << 20, 2000
#: Bytes of text that a task holds at once.
SLICE = 8 << 20
#: Memory that a region and one more place of it take beside the region's bytes.
ITEM, PLACE = 320, 180
#: Anchors that a bucket of the hash exchange aims at, bytes that a range of the sort aims at.
BUCKET_ANCHORS, RANGE_BYTES = 1 << 19, 16 << 20
HOT_GRAMS = 4096
BASE = 0x9E3779B97F4A7C15


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for b in (BASE, pow(BASE, -1, 1 << 64)):
        p = np.full(n, b, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p, dtype=np.uint64, out=p))
    return out[0], out[1]


class Anchors:
    """Regions of texts: (text, anchor, first start, last start, gram hash)."""

    def __init__(self, length: int = LENGTH, gram: int = GRAM):
        self.length, self.gram, self.powers = length, min(gram, length), None

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, ...]:
        if self.powers is None:
            self.powers = _powers(max(BUFFER, SEGMENT + self.length) + 1)
        out: list[list[np.ndarray]] = [[] for _ in range(5)]
        segs: list[tuple[int, int, bytes]] = []
        size = 0
        for i, t in enumerate(texts):
            for s in range(0, len(t) - self.length + 1, SEGMENT):
                seg = t[s:s + SEGMENT + self.length - 1]
                if size + len(seg) > BUFFER and segs:
                    self._buffer(segs, out)
                    segs, size = [], 0
                segs.append((i, s, seg))
                size += len(seg)
        if segs:
            self._buffer(segs, out)
        kinds = (np.int64, np.int64, np.int64, np.int64, np.uint64)
        return tuple(np.concatenate([np.zeros(0, k), *o]) for k, o in zip(kinds, out))

    def _buffer(self, segs: list, out: list) -> None:
        k, w = self.gram, self.length - self.gram + 1
        buf = b"".join(s for _, _, s in segs)
        n = len(buf)
        x = np.frombuffer(buf, np.uint8).astype(np.uint64)
        x += np.uint64(1)
        x *= self.powers[0][:n]
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(x, out=sums[1:])
        h = sums[k:] - sums[:-k]
        del x, sums
        h *= self.powers[1][:n - k + 1]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
        low = np.uint64((1 << 24) - 1)
        m, size = (h & ~low) | np.arange(len(h), dtype=np.uint64), 1
        while 2 * size <= w:
            m = np.minimum(m[:-size], m[size:])
            size *= 2
        if w > size:
            m = np.minimum(m[:len(m) - (w - size)], m[w - size:])
        lens = np.array([len(s) for _, _, s in segs])
        offs = np.cumsum(lens) - lens
        starts = lens - self.length + 1
        owner = np.repeat(np.arange(len(segs)), starts)
        at = np.arange(len(owner)) - np.repeat(np.cumsum(starts) - starts, starts) + offs[owner]
        pos = (m[at] & low).astype(np.int64)
        new = np.flatnonzero(np.r_[True, (pos[1:] != pos[:-1]) | (owner[1:] != owner[:-1])])
        last = np.r_[new[1:], len(pos)] - 1
        seg = owner[new]
        base = np.array([s for _, s, _ in segs])[seg] - offs[seg]
        for o, v in zip(out, (np.array([i for i, _, _ in segs])[seg], pos[new] + base, at[new] + base, at[last] + base, h[pos[new]])):
            o.append(v)


def pack(*arrays: np.ndarray) -> bytes:
    """Integer arrays of one length in the least bytes a value, after one another."""
    out = [struct.pack("<q", len(arrays[0]))]
    for x in arrays:
        low, high = (int(x.min()), int(x.max())) if len(x) else (0, 0)
        kind = next(c for c, n in (("B", 8), ("H", 16), ("I", 32), ("Q", 64)) if high - low < 1 << n)
        out += [kind.encode(), struct.pack("<q", low), (x.astype(np.int64) - low).astype(f"<u{ {'B': 1, 'H': 2, 'I': 4, 'Q': 8}[kind]}").tobytes()]
    return b"".join(out)


def unpack(blob: bytes) -> list[np.ndarray]:
    n, at, out = struct.unpack_from("<q", blob)[0], 8, []
    while at < len(blob):
        width = {"B": 1, "H": 2, "I": 4, "Q": 8}[chr(blob[at])]
        low = struct.unpack_from("<q", blob, at + 1)[0]
        out.append(np.frombuffer(blob, f"<u{width}", n, at + 9).astype(np.int64) + low)
        at += 9 + n * width
    return out


def common(a: bytes, b: bytes, at: int) -> int:
    """Length of the common prefix of two strings that share ``at`` bytes."""
    n = min(len(a), len(b))
    x, y = a[at:n], b[at:n]
    if x == y:
        return n
    d = int.from_bytes(x) ^ int.from_bytes(y)
    return n - (d.bit_length() + 7) // 8


def merge(runs: list[Iterator[tuple[int, bytes]]]) -> Iterator[tuple[int, bytes, int]]:
    """(common prefix with the last output, string, run) in order, from runs of
    (common prefix with the last of the run, string).  A loser tree: a node
    keeps the loser of its match with what it shares with the match's winner."""
    k = 1
    while k < len(runs):
        k *= 2
    ended = (-1, b"")
    heads: list[tuple[int, bytes]] = [next(r, ended) for r in runs] + [ended] * (k - len(runs))
    shared = [min(h, 0) for h, _ in heads]  # with the last output: nothing yet, or -1 when ended
    strings = [s for _, s in heads]
    loser = [0] * k

    def match(a: int, b: int) -> tuple[int, int]:
        """(winner, loser)"""
        x, y = shared[a], shared[b]
        if x != y:
            return (a, b) if x > y else (b, a)
        if x < 0:
            return a, b
        s, t = strings[a], strings[b]
        n = common(s, t, x)
        if n == len(s) or (n < len(t) and s[n] < t[n]):
            shared[b] = n
            return a, b
        shared[a] = n
        return b, a

    winners = list(range(k))
    node = k
    while node > 1:  # first matches, level by level from the leaves
        node //= 2
        nxt = []
        for i in range(node):
            w, lo = match(winners[2 * i], winners[2 * i + 1])
            loser[node + i] = lo
            nxt.append(w)
        winners = nxt
    w = winners[0]
    while shared[w] >= 0:
        yield shared[w], strings[w], w
        shared[w], strings[w] = next(runs[w], ended)
        node = (w + k) // 2
        while node:
            w, loser[node] = match(loser[node], w)
            node //= 2


def digest(key: bytes) -> tuple[int, int]:
    """128 bits that stand for a region, as two signed numbers."""
    d = xxhash.xxh3_128_intdigest(key)
    return (d >> 64) - (1 << 63), (d & (1 << 64) - 1) - (1 << 63)


class Run:
    """Regions of one task: sorted, front-coded and cut at the splitters.  A run
    sends each region once, with its earliest place and how many there are; the
    places themselves are rows of their own and meet no range."""

    def __init__(self, splitters: list[bytes]):
        self.splitters, self.items, self.size = splitters, {}, 0

    def add(self, text: bytes, doc: int, rank: int, anchor: int, first: int, end: int, alone: bool) -> None:
        right, left = text[anchor:end], text[first:anchor]
        key = b"%b%b%b" % (right, left, struct.pack(">HHB", len(right), len(left), alone))
        places = self.items.get(key)
        if places is None:
            self.items[key] = [(doc, rank, first)]
            self.size += len(key) + ITEM
        else:
            places.append((doc, rank, first))
            self.size += PLACE

    def places(self) -> list[np.ndarray]:
        """Region (two numbers), doc, rank, first, size of every place."""
        keys = [(*digest(k), *p, sum(struct.unpack(">HHB", k[-5:])[:2])) for k, places in self.items.items() for p in places]
        return list(np.array(keys, np.int64).reshape(-1, 6).T)

    def blobs(self) -> Iterator[tuple[int, bytes]]:
        keys = sorted(self.items)
        cuts = [0, *[bisect_left(keys, s) for s in self.splitters], len(keys)]
        for part, (i, j) in enumerate(zip(cuts, cuts[1:])):
            if i == j:
                continue
            own, last = keys[i:j], b""
            share, rest = [], []
            for key in own:
                n = common(last, key, 0) if last else 0
                share.append(n)
                rest.append(key[n:])
                last = key
            flat = np.array([min(self.items[key]) for key in own], np.int64)
            counts = pack(np.array(share), np.array([len(r) for r in rest]), np.array([len(self.items[key]) for key in own]))
            where = pack(np.diff(flat[:, 0], prepend=0) if np.ptp(flat[:, 0]) < 1 << 62 else flat[:, 0], flat[:, 1], flat[:, 2])
            yield part, struct.pack("<?qq", bool(np.ptp(flat[:, 0]) < 1 << 62), len(counts), len(where)) + counts + where + b"".join(rest)

    def clear(self) -> None:
        self.items, self.size = {}, 0


class Coded:
    """Reads a front-coded run."""

    def __init__(self, blob: bytes):
        diffs, n, m = struct.unpack_from("<?qq", blob)
        at = struct.calcsize("<?qq")
        self.share, self.rest, self.count = unpack(blob[at:at + n])
        doc, rank, first = unpack(blob[at + n:at + n + m])
        self.places = (np.cumsum(doc) if diffs else doc, rank, first)
        self.text, self.at = blob[at + n + m:], 0

    def strings(self) -> Iterator[tuple[int, bytes]]:
        last, at = b"", 0
        for n, m in zip(self.share.tolist(), self.rest.tolist()):
            last = last[:n] + self.text[at:at + m]
            at += m
            yield n, last

    def next_place(self) -> tuple[int, tuple[int, int, int]]:
        """Number of places and the earliest one of the strings in turn."""
        i, self.at = self.at, self.at + 1
        return int(self.count[i]), tuple(int(x[i]) for x in self.places)


def repeated(blobs: list[bytes], length: int, gram: int) -> Iterator[tuple]:
    """Of a range's runs: (region, region, doc, rank, first, -1, copies) of each
    region that has several places, with the earliest one, and (0, 0, doc, rank, from, to, 0) of strings of an earliest place that occur earlier in another region."""
    runs = [Coded(b) for b in blobs]
    group: dict[bytes, tuple[int, int, int]] = {}  # different regions with one gram: the earliest place of each
    last, copies, first_place = b"", 0, (0, 0, 0)

    def close_item() -> Iterator[tuple]:
        """All places of a region but the earliest are repeated as a whole."""
        if copies > 1:
            yield (*digest(last), *first_place, -1, copies)
        if copies and not last[-1]:
            group[last] = first_place

    def close_group() -> Iterator[tuple]:
        if len(group) > 1:
            earliest: dict[bytes, tuple[int, int, int]] = {}
            regions = []
            for key, (doc, rank, first) in group.items():
                n, m, _ = struct.unpack(">HHB", key[-5:])
                text = key[n:n + m] + key[:n]
                regions.append((text, doc, rank, first))
                for j in range(len(text) - length + 1):
                    s, place = text[j:j + length], (doc, rank, first + j)
                    if s not in earliest or place < earliest[s]:
                        earliest[s] = place
            for text, doc, rank, first in regions:
                begin = end = -1
                for j in range(len(text) - length + 1):
                    if earliest[text[j:j + length]] != (doc, rank, first + j):
                        if j > end:
                            if begin >= 0:
                                yield 0, 0, doc, rank, first + begin, first + end, 0
                            begin = j
                        end = j + length
                if begin >= 0:
                    yield 0, 0, doc, rank, first + begin, first + end, 0
        group.clear()

    for n, s, r in merge([c.strings() for c in runs]):
        more, place = runs[r].next_place()
        if n == len(s) == len(last) and copies:
            copies, first_place = copies + more, min(first_place, place)
            continue
        yield from close_item()
        if n < gram:
            yield from close_group()
        last, copies, first_place = s, more, place
    yield from close_item()
    yield from close_group()


def repeated_spans(texts: DataFrame, length: int = LENGTH, gram: int = GRAM, many: int = MANY) -> DataFrame:
    """``doc, rank, spans`` (array of struct<s, e>, which may overlap) of the
    texts ``doc, rank, text`` that hold repeated strings."""
    spark = texts.sparkSession
    anchors = Anchors(length, gram)
    gram = anchors.gram
    docs_n = texts.count()

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", SLICE):
            own = b.column("text").to_pylist()
            t, a, _, _, h = anchors(own)
            keep = np.sort(np.random.default_rng(len(t)).permutation(len(t))[:4096]) if len(t) > 4096 else np.arange(len(t))
            yield pa.RecordBatch.from_arrays([pa.array(h[keep].view(np.int64)), pa.array([own[t[i]][a[i]:a[i] + gram] for i in keep.tolist()], pa.binary()),
                                              pa.array(np.full(len(keep), len(t), np.int64))], ["h", "gram", "of"])

    rows = texts.sample(fraction=min(1.0, SAMPLE / max(1, docs_n)), seed=7).mapInArrow(look, "h bigint, gram binary, of bigint").limit(1 << 17).collect()
    hashes = np.array([r["h"] for r in rows], np.int64)
    values, counts = np.unique(hashes, return_counts=True)
    share = docs_n / max(1, min(docs_n, SAMPLE))  # documents that one of the sample stands for
    hot = values[np.argsort(-counts, kind="stable")[:HOT_GRAMS]]
    hot = hot[np.isin(hot, values[counts >= 4])]
    alone = hot[np.isin(hot, values[counts * share > many])]
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    per_anchor = (length - gram + 2) / 2
    buckets = 1 << max(0, int(np.ceil(np.log2(max(1, size / per_anchor / BUCKET_ANCHORS)))))
    shared_hot = spark.sparkContext.broadcast((np.sort(hot).view(np.uint64), np.sort(alone).view(np.uint64)))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.uint64(64 - (buckets.bit_length() - 1)) if buckets > 1 else None
        for b in slices(batches, "text", SLICE):
            doc, rank = b.column("doc").to_numpy(), b.column("rank").to_numpy()
            t, _, first, _, h = anchors(b.column("text").to_pylist())
            cold = ~np.isin(h, shared_hot.value[0])
            t, first, h = t[cold], first[cold], h[cold]
            bucket = (h >> bits).astype(np.int64) if bits is not None else np.zeros(len(h), np.int64)
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            parts, out = [], []
            for k in np.flatnonzero(np.diff(cuts)).tolist():
                i = order[cuts[k]:cuts[k + 1]]
                parts.append(k)
                # 40 bits of the hash are enough: a collision only lets a region into the sort
                out.append(pack((h[i] & np.uint64((1 << 40) - 1)).view(np.int64) & 0xFF, (h[i] >> np.uint64(8)).astype(np.int64) & 0xFFFFFFFF,
                                doc[t[i]], rank[t[i]], first[i]))
            yield pa.RecordBatch.from_arrays([pa.array(np.array(parts, np.int32)), pa.array(out, pa.binary())], ["bucket", "blob"])

    def twice(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        low, high, doc, rank, first = (np.concatenate(x) for x in zip(*[unpack(b) for b in pdf["blob"]]))
        _, back, n = np.unique(high << 8 | low, return_inverse=True, return_counts=True)
        n = n[back]
        some = n > 1
        return pd.DataFrame({"doc": doc[some], "rank": rank[some], "start": np.where(n > many, -1 - first, first)[some]})

    keyed = texts.mapInArrow(hashed, "bucket int, blob binary").groupBy("bucket").applyInPandas(twice, "doc bigint, rank bigint, start bigint")
    found = store(keyed, "repeated-anchors")  # run here, so that the small batches hold
    starts = found.groupBy("doc", "rank").agg(F.collect_list("start").alias("starts"))  # as many as the text has

    # splitters: gram texts of the sample at equal distances; a range gets whole grams
    ranges = max(1, int(np.ceil(found.count() * 4 * per_anchor / RANGE_BYTES)), min(int(spark.conf.get("spark.sql.shuffle.partitions")), 1 + len(values) // 64))
    grams = sorted({bytes(r["gram"]) for r in rows})
    splitters = sorted({grams[len(grams) * i // ranges] for i in range(1, ranges)}) if grams else []

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = Run(splitters)
        hot_now, alone_now = shared_hot.value

        names = ["part", "blob", "d1", "d2", "doc", "rank", "first", "size"]

        def flush() -> Iterator[pa.RecordBatch]:
            """The regions for the ranges, then their places."""
            found = list(run.blobs())
            empty = [pa.nulls(len(found), pa.int64())] * 6
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in found], pa.int32()), pa.array([x for _, x in found], pa.binary()), *empty], names)
            places = run.places()
            run.clear()
            n = len(places[0])
            yield pa.RecordBatch.from_arrays([pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()), *[pa.array(x) for x in places]], names)

        for b in slices(batches, "text", SLICE):
            doc, rank = b.column("doc").to_pylist(), b.column("rank").to_pylist()
            marked, own = b.column("starts").to_pylist(), b.column("text").to_pylist()
            t, a, first, last, h = anchors(own)
            pick, single = np.isin(h, hot_now), np.isin(h, alone_now)
            flat = np.array([(i, s) for i, m in enumerate(marked) if m for s in m], np.int64).reshape(-1, 2)
            place = t << 40 | first
            single |= np.isin(place, flat[:, 0][flat[:, 1] < 0] << 40 | (-1 - flat[:, 1][flat[:, 1] < 0]))
            pick |= single | np.isin(place, flat[:, 0][flat[:, 1] >= 0] << 40 | flat[:, 1][flat[:, 1] >= 0])
            for i, at, f, z, one in zip(*[x[pick].tolist() for x in (t, a, first, last, single)]):
                if one:
                    for s in range(f, z + 1):
                        run.add(own[i], doc[i], rank[i], at, s, s + length, True)
                else:
                    run.add(own[i], doc[i], rank[i], at, f, z + length, False)
                if run.size > RUN_BYTES:
                    yield from flush()
        yield from flush()

    result = "d1 bigint, d2 bigint, doc bigint, rank bigint, s bigint, e bigint, copies bigint"

    def merged(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        rows = np.array(list(repeated(list(pdf["blob"]), length, gram)), np.int64).reshape(-1, 7)
        return pd.DataFrame(rows, columns=[c.split()[0] for c in result.split(", ")])

    marked = texts.join(starts.hint("shuffle_hash"), ["doc", "rank"], "left").select("doc", "rank", "text", "starts")
    sent = store(marked.mapInArrow(runs, "part int, blob binary, d1 bigint, d2 bigint, doc bigint, rank bigint, first bigint, size bigint"), "suffix-runs")
    merging = sent.where(F.col("part").isNotNull()).select("part", "blob").groupBy("part").applyInPandas(merged, result)
    merging = store(merging, "repeated-regions")

    # the places of a region with several, but for its earliest, go as a whole.  Regions with over ``many`` places are at most
    # a ``many``-th of all places and are broadcast, so that the places of a hot one stay where they are
    places = sent.where(F.col("d1").isNotNull()).select("d1", "d2", "doc", "rank", "first", "size")
    regions = merging.where("copies > 0").select(
        "d1", "d2", F.struct(F.col("doc"), F.col("rank"), F.col("s").alias("first")).alias("least"), F.col("copies") > many)
    regions = regions.toDF("d1", "d2", "least", "hot")
    hot, cold = F.broadcast(regions.where("hot")), regions.where("not hot")
    gone = places.join(hot, ["d1", "d2"], "left").withColumnRenamed("least", "hot_least")
    rest = gone.where("hot is null").drop("hot", "hot_least").join(cold.drop("hot"), ["d1", "d2"])
    both = gone.where("hot").select("doc", "rank", "first", "size", F.col("hot_least").alias("least")).union(rest.select("doc", "rank", "first", "size", "least"))
    both = both.where(F.struct("doc", "rank", "first") != F.col("least")).select("doc", "rank", F.col("first").alias("s"), (F.col("first") + F.col("size")).alias("e"))
    spans = both.union(merging.where("copies = 0").select("doc", "rank", "s", "e"))
    return spans.groupBy("doc", "rank").agg(F.collect_list(F.struct("s", "e")).alias("spans"))


def united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of overlapping or touching spans."""
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, many: int = MANY) -> DataFrame:
    """``doc_id, n_bytes, spans`` (removed runs, array of struct<s, e>) and
    ``kept`` (the other bytes) of every row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    ids = docs.select(F.col(id_col).alias("doc"))
    unique = ids.groupBy("doc").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count() == 0
    rank = F.lit(0).cast("long") if unique else F.xxhash64(text)
    texts = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1)).alias("doc"), rank.alias("rank"),
                        text.cast("binary").alias("text"), F.col(id_col).alias("doc_id"))
    with small_batches(docs.sparkSession, SLICE):
        spans = repeated_spans(texts.select("doc", "rank", "text"), length, gram, many)
    id_type = texts.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", SLICE):
            kept, gone = [], []
            for t, ss in zip(b.column("text").to_pylist(), b.column("spans").to_pylist()):
                u = united([(x["s"], x["e"]) for x in ss]) if ss else []
                ends = [0, *[p for se in u for p in se], len(t)]
                kept.append(b"".join(t[ends[i]:ends[i + 1]] for i in range(0, len(ends), 2)) if u else t)
                gone.append([{"s": s, "e": e} for s, e in u])
            kind = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([len(t) for t in b.column("text").to_pylist()], pa.int64()),
                                              pa.array(gone, kind), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "spans", "kept"])

    joined = texts.join(spans.hint("shuffle_hash"), ["doc", "rank"], "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(cut, f"doc_id {id_type}, n_bytes bigint, spans array<struct<s:bigint,e:bigint>>, kept binary")
