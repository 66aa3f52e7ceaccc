"""Best-fit packing by bin completion.

Documents become token ids (plus the end id); only documents longer than a
sequence are cut, into pieces of the full length and a rest.  The pieces are
dealt by hash into groups of bounded size, and each group is packed on its own
by bin completion: around the largest open piece the undominated fillings are
enumerated, branches are pruned by the waste they make necessary, and the
best-fit packing is the first incumbent.  A group loses less than one sequence
to its border, so the loss falls with the size of a group, not with the corpus.

Defined results: a null or empty text is one piece with the end id alone; rows
that share an id are packed one by one; columns besides id and text are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from array import array
from bisect import bisect_right, insort
from collections import defaultdict
from collections.abc import Iterator
from functools import cache
from itertools import chain, count, islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexicrate.llm.words import portions
from lexicrate.session import store

LENGTH, END_ID = 4096, 1
#: Pieces a group aims at; branch-and-bound nodes for a group; fillings kept at a node.
GROUP, NODES, FILLINGS = 8192, 4000, 8
#: Words a task remembers with their ids; only speed depends on it.
REMEMBERED = 1 << 19


#: The usual word: Latin-1 letters, which are their own normal form, then ASCII marks but ' and <, which can begin a token of their own.
USUAL = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-&(-/:;=-@\[-`{-~]*)")


class TokenIds:
    """From texts to one id array and the number of ids of each text.

    The tokenizer drops white space and cuts there first, so a word has the
    same ids wherever it stands and each different word is encoded once.  A
    usual word is cut into its letters and its marks, as the tokenizer cuts it,
    and the letters go to the tokenizer's model; all others go through the whole tokenizer."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.model = self.tok.model
        # the tokenizer writes bytes as visible characters: the printable ones as they are, others from 256 on
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.visible = {b: 256 + i for i, b in enumerate(sorted({*range(256)} - {*own}))}
        self.cores: dict[str, bytes] = {}  # ids as four bytes each, far smaller than lists
        self.clear()

    def clear(self) -> None:
        self.cores.clear()
        self.marks: dict[str, bytes] = {"": b""}
        self.words: defaultdict[bytes, int] = defaultdict(count().__next__)
        self.sizes, self.first, self.flat = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def letters(self, core: str) -> bytes:
        ids = self.cores.get(core)
        if ids is None:
            seen = core if core.isascii() else core.encode().decode("latin-1").translate(self.visible)
            ids = self.cores[core] = array("I", [t.id for t in self.model.tokenize(seen)]).tobytes()
        return ids

    def word(self, word: bytes) -> bytes:
        w = word.decode()
        if m := USUAL.fullmatch(w):
            core, marks = m.groups()
            if marks not in self.marks:
                self.marks[marks] = array("I", self.tok.encode(marks, add_special_tokens=False).ids).tobytes()
            return self.letters(core.lower()) + self.marks[marks]
        return array("I", self.tok.encode(w, add_special_tokens=False).ids).tobytes()

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.words) > REMEMBERED:
            self.clear()
        lists = [(t or "").encode().split() for t in texts]  # the six ASCII white-space bytes
        n_words = np.fromiter(map(len, lists), np.int64, len(lists))
        known = len(self.words)
        at = np.fromiter(map(self.words.__getitem__, chain.from_iterable(lists)), np.int32, int(n_words.sum()))
        if len(self.words) > known:
            ids = [self.word(w) for w in list(islice(reversed(self.words), len(self.words) - known))[::-1]]
            sizes = np.fromiter(map(len, ids), np.int32, len(ids)) // 4
            ends = np.cumsum(sizes, dtype=np.int64)
            self.first = np.concatenate([self.first, len(self.flat) + ends - sizes])
            self.flat = np.concatenate([self.flat, np.frombuffer(b"".join(ids), np.uint32)])
            self.sizes = np.concatenate([self.sizes, sizes])
        n = self.sizes[at]
        ends = np.cumsum(n, dtype=np.int64)
        step = np.repeat(self.first[at] - (ends - n), n)
        step += np.arange(len(step))
        return self.flat[step], np.diff(np.append(0, ends)[np.append(0, np.cumsum(n_words))])


@cache
def token_ids(path: str) -> TokenIds:
    """One for each worker process, so that later tasks know the words of earlier ones."""
    return TokenIds(path)


def pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
           length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every document."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = token_ids(tokenizer_path)
        for batch in batches:
            rows: tuple[list, ...] = ([], [], [], [], [])
            for first, texts in portions(batch.column(1).to_pylist(), lambda t: t):
                flat, counts = encode(texts)
                at = 0
                for i, n in enumerate(counts.tolist(), first):
                    own = np.append(flat[at:at + n], np.uint32(end_id)).astype("<u4")
                    at += n
                    for k, s in enumerate(range(0, n + 1, length)):
                        part = own[s:s + length]
                        for col, v in zip(rows, (i, k, s, len(part), zlib.crc32(part.tobytes()))):
                            col.append(v)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows[0], pa.int64())), pa.array(rows[1], pa.int32()), *[pa.array(c, pa.int64()) for c in rows[2:]]],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    cols = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return cols.mapInArrow(run, f"doc_id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint")


def best_fit(sizes: list[int], length: int) -> list[list[int]]:
    """Best fit decreasing: bins as lists of piece sizes."""
    open_: list[tuple[int, int]] = []  # (room, bin), sorted
    bins: list[list[int]] = []
    for s in sorted(sizes, reverse=True):
        i = bisect_right(open_, (s, -1))
        if i < len(open_):
            room, b = open_.pop(i)
        else:
            room, b = length, len(bins)
            bins.append([])
        bins[b].append(s)
        if room > s:
            insort(open_, (room - s, b))
    return bins


def fillings(room: int, counts: dict[int, int], sizes: list[int], limit: int) -> list[list[int]]:
    """Up to ``limit`` undominated fillings of ``room``, least waste first.

    ``sizes`` descend.  A filling is dominated if one unused piece fits into
    what it wastes, or if it can swap a piece for a larger unused one that still
    fits; only maximal fillings in that sense are kept."""
    found: list[tuple[int, list[int]]] = []
    steps = [0]

    def extend(left: int, at: int, chosen: list[int]) -> bool:
        """Depth first, large pieces first; true when an exact filling is found."""
        steps[0] += 1
        i = at
        while i < len(sizes) and sizes[i] > left:
            i += 1
        used: dict[int, int] = {}
        for c in chosen:
            used[c] = used.get(c, 0) + 1
        while i < len(sizes) and counts[sizes[i]] <= used.get(sizes[i], 0):
            i += 1
        if i == len(sizes):
            free = [s for s in sizes if counts[s] > used.get(s, 0)]
            if any(s <= left for s in free) or any(c < s <= c + left for c in used for s in free):
                return False
            found.append((left, list(chosen)))
            return left == 0
        for j in range(i, len(sizes)):
            s = sizes[j]
            if counts[s] > used.get(s, 0):
                if steps[0] > 40 * limit:
                    return False
                if extend(left - s, j, [*chosen, s]):
                    return True
                if len(found) >= limit:
                    return False
        return False

    extend(room, 0, [])
    return [f for _, f in sorted(found, key=lambda x: x[0])]


def bin_completion(sizes: list[int], length: int, nodes: int = NODES) -> list[list[int]]:
    """Bins as lists of sizes: the best packing found.  Optimal when it meets
    the lower bound or when the search ends within ``nodes`` nodes and no node
    had more fillings than are kept."""
    best = best_fit(sizes, length)
    bound = -(-sum(sizes) // length)
    if len(best) <= bound:
        return best
    counts: dict[int, int] = {}
    for s in sizes:
        counts[s] = counts.get(s, 0) + 1
    budget = [nodes]
    slack = [len(best) - 1]  # bins a better packing may use

    total = sum(sizes)
    path: list[list[int]] = []
    # a stack of levels, each with the fillings still to try for its largest piece
    stack: list[tuple[int, list[list[int]]]] = []

    def options() -> tuple[int, list[list[int]]]:
        order = sorted((s for s, n in counts.items() if n), reverse=True)
        big = order[0]
        counts[big] -= 1
        out = fillings(length - big, counts, order, FILLINGS)
        counts[big] += 1
        return big, out or [[]]

    waste, left = 0, len(sizes)
    stack.append(options())
    while stack and budget[0] > 0:
        big, todo = stack[-1]
        if len(path) == len(stack):  # back from below: undo
            last = path.pop()
            for s in last:
                counts[s] += 1
            left += len(last)
            waste -= length - sum(last)
        if not todo:
            stack.pop()
            continue
        fill = [big, *todo.pop(0)]
        budget[0] -= 1
        path.append(fill)
        for s in fill:
            counts[s] -= 1
        left -= len(fill)
        waste += length - sum(fill)
        if -(-(total + waste) // length) > slack[0]:  # waste bound: cannot beat the incumbent
            continue
        if not left:
            if len(path) <= slack[0]:
                best = [list(b) for b in path]
                slack[0] = len(best) - 1
                if len(best) <= bound:
                    return best
            continue
        stack.append(options())
    return best


def pack(parts: DataFrame, length: int = LENGTH, group: int = GROUP, nodes: int = NODES) -> DataFrame:
    """``parts`` (with ``length``) plus ``sequence_id`` and ``offset``."""
    groups = max(1, -(-parts.count() // group))
    dealt = parts.withColumn("_group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in parts.schema) + ", sequence_id bigint, offset bigint"

    def one(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        sizes = pdf["length"].to_numpy()
        waiting: dict[int, list[int]] = {}
        for i in np.argsort(pdf["ids_crc32"].to_numpy(), kind="stable").tolist():
            waiting.setdefault(int(sizes[i]), []).append(i)
        seq, off = np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64)
        for b, filling in enumerate(bin_completion(sizes.tolist(), length, nodes)):
            at = 0
            for s in filling:
                i = waiting[s].pop()
                seq[i], off[i] = (int(key[0]) << 32) + b, at
                at += s
        return pdf.drop(columns="_group").assign(sequence_id=seq, offset=off)

    return dealt.groupBy("_group").applyInPandas(one, schema)


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece."""
    return pack(store(pieces(docs, tokenizer_path, id_col, text_col), "pieces"), **options)
