"""Substring dedup over a logarithmic family of suffix arrays (operator 1)."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from strataloom.llm.repeats import HOT, Rule, without_repeats

WINDOW, GRAM, BATCH = 100, 32, 1 << 15
#: Suffixes of a level whose leading bytes are laid out at once; one in FENCE of a level always is.
CHUNK, FENCE = 1 << 15, 32


@dataclass
class Level:
    """A suffix array: places in a text, in the lexicographic order of the suffixes there, all different in `depth` bytes."""

    text: np.ndarray
    place: np.ndarray
    depth: int

    def __post_init__(self) -> None:
        self.fence = self.leading(slice(None, None, FENCE))

    def leading(self, at: np.ndarray) -> np.ndarray:
        """The first `depth` bytes of the suffixes at places of the array."""
        return leading(self.text, self.place[at], self.depth)

    def below(self, some: np.ndarray) -> np.ndarray:
        """How many suffixes of the level come before each of the sorted ones: a merge of the two sorted lists.

        Both are walked where they are of like size; through a much longer level each search gallops from fence to fence.
        """
        n = len(self.place)
        if n > 8 * len(some):
            lo = np.maximum(np.searchsorted(self.fence, some) - 1, 0) * FENCE
            hi = np.minimum(lo + FENCE, n)
            for _ in range(FENCE.bit_length()):
                mid = (lo + hi) // 2
                before = (mid < hi) & (self.leading(np.minimum(mid, n - 1)) < some)
                lo, hi = np.where(before, mid + 1, lo), np.where(before, hi, mid)
            return lo
        out, done = np.full(len(some), n), 0
        for c in range(0, n, CHUNK):
            own = self.leading(slice(c, c + CHUNK))
            upto = int(np.searchsorted(some, own[-1], "right"))
            out[done:upto] = c + np.searchsorted(own, some[done:upto])
            done = upto
        return out


def leading(text: np.ndarray, place: np.ndarray, depth: int) -> np.ndarray:
    """The bytes of the suffixes at `place` up to the depth, as byte strings, which compare lexicographically."""
    return np.lib.stride_tricks.sliding_window_view(text, depth)[place].view(f"S{depth}")[:, 0]


def common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The length of the longest common prefix of each two byte strings."""
    depth = a.dtype.itemsize
    differ = a.view(np.uint8).reshape(-1, depth) != b.view(np.uint8).reshape(-1, depth)
    return np.where(differ.any(axis=1), differ.argmax(axis=1), depth)


class SuffixLevels:
    """Suffix arrays of about BATCH * 2**rank suffixes; two of one rank merge into one of the next.

    A batch of text gets a suffix array, which a merge with each level scans for suffixes that share `depth` bytes or more. What is
    new becomes a level. So a suffix moves log2(n) times in n batches, and is stored once however often it occurs.
    """

    def __init__(self, depth: int) -> None:
        self.depth = depth
        self.levels: list[tuple[int, Level]] = []

    def add(self, text: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Takes in the suffixes at ascending places of a text: which of them match an earlier one for `depth` bytes.

        Bytes are raised by one, as a byte string's last zeros don't count in comparisons (UTF-8 has no byte 255).
        """
        text = text + np.uint8(1)
        keys = leading(text, place, self.depth)
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        again = np.concatenate([[False], common(keys[1:], keys[:-1]) >= self.depth])
        fresh = np.flatnonzero(~again)
        old = np.zeros(len(fresh), bool)
        for _, level in self.levels:
            at = level.below(keys[fresh])
            inside = np.flatnonzero(at < len(level.place))
            old[inside] |= common(level.leading(at[inside]), keys[fresh[inside]]) >= self.depth
        again[fresh] = old
        out = np.empty(len(place), bool)
        out[order] = again
        self._insert(Level(text, place[order[fresh[~old]]], self.depth))
        return out

    def _insert(self, new: Level) -> None:
        rank = 0
        while self.levels and self.levels[-1][0] == rank:
            new, rank = merged(self.levels.pop()[1], new), rank + 1
        self.levels.append((rank, new))


def merged(a: Level, b: Level) -> Level:
    """One level of two without common suffixes."""
    at = np.concatenate([np.zeros(0, np.int64), *[a.below(b.leading(slice(c, c + CHUNK))) for c in range(0, len(b.place), CHUNK)]]) + np.arange(len(b.place))
    place = np.empty(len(a.place) + len(b.place), np.int64)
    rest = np.ones(len(place), bool)
    rest[at] = False
    place[at], place[rest] = b.place + len(a.text), a.place
    return Level(np.concatenate([a.text, b.text]), place, a.depth)


def seen_before(segments: list[bytes], more: np.ndarray, at: np.ndarray, window: int, gram: int, batch: int = BATCH) -> np.ndarray:
    """Which windows of different segments, in document order, an earlier segment has.

    Segments of about `batch` windows at a time enter the levels; those whose anchor's gram no other one has can't repeat.
    """
    grams = [s[a : a + gram] for s, a in zip(segments, at.tolist(), strict=True)]
    n = Counter(grams)
    end = np.cumsum(more + 1)
    out, levels = np.zeros(int(end[-1]) if len(end) else 0, bool), SuffixLevels(window)
    wanted = np.array([k for k, g in enumerate(grams) if n[g] > 1], np.int64)
    size = more[wanted] + 1
    for some in np.split(wanted, np.flatnonzero(np.diff(np.cumsum(size) // batch)) + 1) if len(wanted) else []:
        text = np.frombuffer(b"".join([segments[k] for k in some.tolist()]), np.uint8)
        count = more[some] + 1
        step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        length = count + window - 1
        found = levels.add(text, np.repeat(np.cumsum(length) - length, count) + step)
        out[np.repeat(end[some] - count, count) + step] = found
    return out


def suffix_dedup(docs: DataFrame, *, window: int = WINDOW, texts: bool = False, carried: tuple[str, ...] = (), hot: int = HOT) -> DataFrame:
    """Removes each byte covered by `window` bytes that also start earlier; see repeats.without_repeats()."""
    return without_repeats(docs, Rule(window, min(GRAM, max(1, window // 3)), False, True, seen_before, hot), texts=texts, carried=carried)
