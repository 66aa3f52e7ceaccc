"""Words of whole texts as arrays, for operators that work in numpy."""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import chain, count, islice

import numpy as np

#: Different words that a task remembers; only speed depends on it.
REMEMBERED = 1 << 19
#: Words handled at once, so that very long texts stay bounded.
HELD = 1 << 21


class Words:
    """Numbers different words and keeps a row of ``describe(words)`` for each."""

    def __init__(self, describe: Callable[[list[bytes]], np.ndarray]):
        self.describe, self.rows = describe, None
        self.known: defaultdict[bytes, int] = defaultdict(count().__next__)

    def numbers(self, lists: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of all words of the lists in turn, and where each list begins and ends."""
        if len(self.known) > REMEMBERED:
            self.known, self.rows = defaultdict(count().__next__), None
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        at = len(self.known)
        flat = np.fromiter(map(self.known.__getitem__, chain.from_iterable(lists)), np.int32, int(sizes.sum()))
        new = list(islice(reversed(self.known), len(self.known) - at))[::-1]
        if new or self.rows is None:
            rows = self.describe(new)
            if self.rows is None or len(self.rows) < at + len(new):  # grow by doubling
                room = np.empty((max(1024, 2 * (at + len(new))), *rows.shape[1:]), rows.dtype)
                if self.rows is not None:
                    room[:at] = self.rows[:at]
                self.rows = room
            self.rows[at:at + len(new)] = rows
        return flat, np.concatenate([[0], np.cumsum(sizes)])


def portions(texts: list[str | None], split: Callable[[str | None], list[bytes]], held: int = HELD) -> Iterator[tuple[int, list[list[bytes]]]]:
    """(first position, word lists) for runs of texts of about ``held`` characters."""
    first, lists, size = 0, [], 0
    for i, t in enumerate(texts):
        lists.append(split(t))
        size += len(t or "")
        if size > held:
            yield first, lists
            first, lists, size = i + 1, [], 0
    if lists:
        yield first, lists


def bucket(part: bytes, n: int) -> int:
    return zlib.crc32(part) % n


def shapes(words: list[bytes]) -> list[bytes]:
    """Of each word: letters as a or A, digits as 0, others as they are, runs as one."""
    s = "\n".join([w.decode() for w in words])
    for pattern, to in ((r"[A-Z\u00c0-\u00d6\u00d8-\u00de]+", "A"), (r"(?:(?!A)[^\W\d_])+", "a"), (r"\d+", "0"), (r"(.)\1+", r"\1")):
        s = re.sub(pattern, to, s)
    return s.encode().split(b"\n")
