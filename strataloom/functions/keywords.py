"""Many words sought in texts at once: one pass over the bytes, whatever the number of words.

The words' automaton (Aho and Corasick's) is a table of states by bytes. Texts are cut into pieces that overlap by a word's length, and all
pieces of a batch step through the table together, so each step is an array operation.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from strataloom.session import importable

#: Bytes of one automaton's table at most (more words go to several), and of all that are broadcast.
TABLE, BROADCAST = 64 << 20, 512 << 20
#: Bytes of a piece of text, and of texts that step together.
PIECE, TOGETHER = 1024, 8 << 20
NONE = np.iinfo(np.int32).max


@dataclass
class Automaton:
    """`step` has the next state by state and class of byte; states are numbered by their row's beginning in it."""

    classes: np.ndarray
    step: np.ndarray
    shift: int
    #: By state: the least word that ends there (NONE if there is none), and all of them.
    least: np.ndarray
    ending: dict[int, np.ndarray]
    longest: int

    def pieces(self, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First and last byte of each piece and its row, the longest first. A piece begins early enough for words that end in it."""
        size = max(PIECE, 4 * self.longest)
        length = np.diff(off)
        n = -(-length // size)
        row = np.repeat(np.arange(len(length)), n)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        end = np.minimum(off[row] + (nth + 1) * size, off[row + 1])
        start = np.maximum(off[row] + nth * size - (self.longest - 1), off[row])
        order = np.argsort(start - end, kind="stable")
        return start[order], end[order], row[order]

    def walk(self, raw: np.ndarray, off: np.ndarray):
        """Row and state of each piece after each step."""
        start, end, row = self.pieces(raw, off)
        of_byte = self.classes[raw]
        state = np.zeros(len(row), np.int32)
        active = len(row)
        for k in range(int((end - start)[0]) if len(row) else 0):
            while active and end[active - 1] - start[active - 1] <= k:
                active -= 1
            state = self.step[state[:active] + of_byte[start[:active] + k]]
            yield row[:active], state

    def first(self, raw: np.ndarray, off: np.ndarray) -> np.ndarray:
        """The least word of each row, NONE where it has none."""
        out = np.full(len(off) - 1, NONE, np.int32)
        for row, state in self.walk(raw, off):
            found = self.least[state >> self.shift]
            hit = np.flatnonzero(found != NONE)
            if len(hit):
                np.minimum.at(out, row[hit], found[hit])
        return out

    def all(self, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row and word of all that occur, each once."""
        met: list[np.ndarray] = []
        size = 0
        for row, state in self.walk(raw, off):
            hit = np.flatnonzero(self.least[state >> self.shift] != NONE)
            if len(hit):
                met.append(np.unique(row[hit].astype(np.int64) << 32 | state[hit]))
                size += len(met[-1])
                if size > 1 << 22:
                    met = [np.unique(np.concatenate(met))]
                    size = len(met[0])
        pairs = np.unique(np.concatenate(met)) if met else np.zeros(0, np.int64)
        words = [self.ending[s] for s in (pairs & 0xFFFFFFFF).tolist()]
        rows = np.repeat(pairs >> 32, [len(w) for w in words])
        both = np.unique(rows << 32 | (np.concatenate(words) if words else np.zeros(0, np.int64)))
        return both >> 32, both & 0xFFFFFFFF


def automaton(words: Sequence[tuple[int, bytes]]) -> Automaton:
    """The automaton of numbered words, none of them empty."""
    classes = np.zeros(256, np.int32)
    used = sorted({b for _, w in words for b in w})
    classes[used] = np.arange(1, len(used) + 1)
    shift = (len(used) + 1 - 1).bit_length()
    nexts: list[dict[int, int]] = [{}]
    own: list[list[int]] = [[]]
    for number, word in words:
        at = 0
        for b in word:
            if b not in nexts[at]:
                nexts[at][b] = len(nexts)
                nexts.append({})
                own.append([])
            at = nexts[at][b]
        own[at].append(number)
    step = np.zeros((len(nexts), 1 << shift), np.int32)
    least = np.full(len(nexts), NONE, np.int32)
    ending: list[list[int]] = [[] for _ in nexts]
    fail = np.zeros(len(nexts), np.int64)
    level = [0]
    while level:  # a state's shorter suffix is above it, so its row is there
        below = []
        for at in level:
            if at:
                step[at] = step[fail[at]]
                ending[at] = sorted({*own[at], *ending[fail[at]]})
                if ending[at]:
                    least[at] = ending[at][0]
            for b, to in nexts[at].items():
                fail[to] = step[at, classes[b]] >> shift if at else 0
                below.append(to)
            for b, to in nexts[at].items():
                step[at, classes[b]] = to << shift
        level = below
    return Automaton(classes, step.reshape(-1), shift, least, {i << shift: np.array(e, np.int64) for i, e in enumerate(ending) if e}, max(len(w) for _, w in words))


def automata(words: Sequence[str]) -> list[Automaton]:
    """Automata of the words, each with a table of TABLE bytes at most; a single word longer than that is refused."""
    coded = [(i, w.encode()) for i, w in enumerate(words) if w]
    out, some, size = [], [], 0
    for number, word in coded:
        more = (len(word) + 1) * 4 * 256
        if more > TABLE:
            raise ValueError(f"a word of {len(word)} bytes is too long")
        if size + more > TABLE:
            out.append(automaton(some))
            some, size = [], 0
        some.append((number, word))
        size += more
    return [*out, automaton(some)] if some else out


def _texts(text: pa.Array):
    """The texts' bytes and offsets, a bounded number of bytes at a time (a longer text by itself); null is empty."""
    text = text.fill_null("").cast(pa.large_string())
    i = 0
    while i < len(text):
        offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + TOGETHER, "right")) - 1)
        data = text.buffers()[2]
        raw = np.frombuffer(data, np.uint8)[offsets[i] : offsets[j]] if data is not None and offsets[j] > offsets[i] else np.zeros(0, np.uint8)
        yield i, raw, offsets[i : j + 1] - offsets[i]
        i = j


class Words:
    """A list of words to seek. The list is the driver's, so it is bounded; its automata are broadcast once."""

    def __init__(self, spark: SparkSession, words: Sequence[str]):
        importable(spark)
        self.words = list(words)
        self.empty = next((i for i, w in enumerate(self.words) if not w), None)
        built = automata(self.words)
        if (size := sum(a.step.nbytes for a in built)) > BROADCAST:
            raise ValueError(f"{len(self.words)} words need {size >> 20} MB, more than is broadcast: seek them list by list")
        self.sent = spark.sparkContext.broadcast(built)

    def first(self, text: Column) -> Column:
        """The least number (from 0) of the words that a text contains, null where there is none. An empty word is in each text but null."""
        sent = self.sent

        def least(text: pa.Array) -> pa.Array:
            out = np.full(len(text), NONE, np.int32)
            for i, raw, off in _texts(text):
                for one in sent.value:
                    out[i : i + len(off) - 1] = np.minimum(out[i : i + len(off) - 1], one.first(raw, off))
            return pa.array(out, pa.int32(), mask=out == NONE)

        found = F.arrow_udf(least, "int")(text)
        return found if self.empty is None else F.when(text.isNotNull(), F.least(found, F.lit(self.empty)))

    def all(self, text: Column) -> Column:
        """The numbers of all words that a text contains, ascending; an empty word isn't among them. Null has none."""
        sent = self.sent

        def every(text: pa.Array) -> pa.Array:
            rows, words = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for i, raw, off in _texts(text):
                for one in sent.value:
                    row, word = one.all(raw, off)
                    rows.append(row + i)
                    words.append(word)
            row, word = np.concatenate(rows), np.concatenate(words)
            order = np.lexsort([word, row])
            offsets = np.searchsorted(row[order], np.arange(len(text) + 1))
            return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(word[order].astype(np.int32)))

        return F.arrow_udf(every, "array<int>")(text)
