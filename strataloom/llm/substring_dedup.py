"""Seed-and-extend substring dedup on words (operator 7)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from strataloom.llm.repeats import HOT, Rule, without_repeats

WINDOW, GRAM = 35, 12


def numbered(segments: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The words of all segments as numbers, the same for the same word, and where each segment's words start."""
    known: dict[bytes, int] = {}
    ids, n = [], []
    for s in segments:
        own = s.split(b" ")
        ids.append(np.array([known.setdefault(w, len(known)) for w in own], np.int32))
        n.append(len(own))
    return np.concatenate([np.zeros(0, np.int32), *ids]), np.append(0, np.cumsum(n)).astype(np.int64)


def extended(word: np.ndarray, off: np.ndarray, at: np.ndarray, step: int, most: int) -> np.ndarray:
    """Matches of the seeds at `at`, walked word by word: for each number of words up to `most` the class of each segment.

    Two segments are in one class of a number of words just where they agree in as many of them from the seed on (step 1: to the right,
    the seed included; -1: to the left of it). A segment that has fewer words is in class -1.
    """
    now = np.zeros(len(at), np.int64)
    out = np.full((most + 1, len(at)), -1, np.int64)
    out[0] = now
    for n in range(1, most + 1):
        place = off[:-1] + at + (n - 1 if step > 0 else -n)
        inside = np.flatnonzero((now >= 0) & (place >= off[:-1]) & (place < off[1:]))
        _, which = np.unique((now[inside] << 32) | word[place[inside]], return_inverse=True)
        now = np.full(len(at), -1, np.int64)
        now[inside] = which
        out[n] = now
    return out


def shared(segments: list[bytes], more: np.ndarray, at: np.ndarray, window: int, gram: int) -> np.ndarray:
    """Which windows of different segments another one has.

    Segments meet on their seeds, the anchors' grams. Their matches are extended to both sides; where some agree in i words
    to the left and in window - i from the seed on, they share the window that starts i words before it. Windows that
    follow one another join up to the maximal repeats.
    """
    end = np.cumsum(more + 1)
    out = np.zeros(int(end[-1]) if len(end) else 0, bool)
    if len(segments) < 2:
        return out
    word, off = numbered(segments)
    right = extended(word, off, at, 1, window)
    met = np.flatnonzero(np.bincount(right[gram][right[gram] >= 0])[right[gram]] > 1)  # some other segment has the seed
    left = extended(word, off, at, -1, window - gram)
    for i in range(window - gram + 1):
        has = met[(at[met] >= i) & (i >= at[met] - more[met])]
        _, which, n = np.unique((left[i][has] << 32) | right[window - i][has], return_inverse=True, return_counts=True)
        again = has[n[which] > 1]
        out[end[again] - 1 - more[again] + at[again] - i] = True
    return out


def substring_dedup(docs: DataFrame, *, window: int = WINDOW, texts: bool = False, carried: tuple[str, ...] = (), hot: int = HOT) -> DataFrame:
    """Removes each word covered by `window` words that also start anywhere else; see repeats.without_repeats()."""
    return without_repeats(docs, Rule(window, min(GRAM, max(1, window // 3)), True, False, shared, hot), texts=texts, carried=carried)
