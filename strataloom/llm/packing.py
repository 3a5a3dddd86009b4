"""Sum-of-squares online packing of tokenised documents (operator 10)."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataloom.llm.bpe import loaded, standard_path
from strataloom.llm.common import prepare, utf8

CAPACITY, END_ID, MOST_OPEN = 2048, 1, 4096
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def chosen(level: np.ndarray, size: int) -> int:
    """The fill level, 0 for a new window, where a piece lets the sum of the squared counts of partly filled windows grow least.

    level[l] counts the open windows that hold l tokens; its length is the capacity plus one. A piece adds a window at
    l + size and takes one from l, but that new and full windows don't count. Of several levels the fullest is taken.
    """
    growth = 2 * level[size:] + 1
    growth[-1] = 0
    growth[1:] -= 2 * level[1 : len(growth)] - 1
    usable = level[: len(growth)] > 0
    usable[0] = True
    return len(growth) - 1 - int(np.argmin(np.where(usable, growth, np.iinfo(np.int64).max)[::-1]))


class Packer:
    """Places pieces of documents, one after the other, into windows of `capacity` tokens.

    Each piece goes where chosen() says. A full window leaves. No more than `most_open` windows are open: a piece that would open one more
    is cut to fill the fullest one, and what is left of it is a piece of its own. So memory and the tail are bounded. What is
    open in the end, the tail, is laid end to end and cut into full windows; the last tokens become windows of a power of two, which need no
    padding.
    """

    def __init__(self, capacity: int, first_id: int, most_open: int = MOST_OPEN):
        self.capacity, self.next_id, self.most_open = capacity, first_id, most_open
        self.level = np.zeros(capacity + 1, np.int64)
        self.open: dict[int, list[list[tuple]]] = {}
        self.n_open = 0
        self.rows: list[tuple] = []

    def add(self, doc: object, ids: np.ndarray) -> None:
        """A document's tokens, the last of which ends it."""
        whole = len(ids) // self.capacity * self.capacity
        for start in range(0, whole, self.capacity):
            self._close([(doc, start, ids[start : start + self.capacity], len(ids))])
        if whole < len(ids):
            self._place((doc, whole, ids[whole:].copy(), len(ids)))  # so that a long document need not be held

    def _place(self, piece: tuple) -> None:
        while True:
            doc, start, ids, total = piece
            at = chosen(self.level, len(ids))
            if at or self.n_open < self.most_open:
                return self._put(piece, at)
            fullest = int(np.flatnonzero(self.level)[-1])
            room = self.capacity - fullest
            if len(ids) <= room:
                return self._put(piece, fullest)
            self._put((doc, start, ids[:room], total), fullest)
            piece = (doc, start + room, ids[room:], total)

    def _put(self, piece: tuple, at: int) -> None:
        """A piece into a window that holds `at` tokens, or a new one."""
        window = self.open[at].pop() if at else []
        self.level[at] -= bool(at)
        self.n_open -= bool(at)
        window.append(piece)
        fill = at + len(piece[2])
        if fill == self.capacity:
            return self._close(window)
        self.n_open += 1
        self.level[fill] += 1
        self.open.setdefault(fill, []).append(window)

    def _close(self, window: list[tuple]) -> None:
        offset = 0
        for doc, start, ids, total in window:
            self.rows.append((doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, self.next_id, offset))
            offset += len(ids)
        self.next_id += 1

    def flush(self) -> None:
        """Cuts what is open into full windows, the rest into powers of two."""
        left = [piece for fill in sorted(self.open, reverse=True) for window in self.open[fill] for piece in window]
        self.open, self.n_open = {}, 0
        self.level[:] = 0
        rest = sum(len(p[2]) for p in left)
        window, room = [], 0
        for doc, start, ids, total in left:
            while len(ids):
                if not room:
                    room = self.capacity if rest >= self.capacity else 1 << (rest.bit_length() - 1)
                part = ids[:room]
                window.append((doc, start, part, total))
                ids, start, room, rest = ids[room:], start + len(part), room - len(part), rest - len(part)
                if not room:
                    self._close(window)
                    window = []

    def taken(self) -> pa.RecordBatch:
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        columns = zip(*self.rows, strict=True) if self.rows else [[]] * len(names)
        out = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)
        self.rows = []
        return out


def _pack(path: str | None, capacity: int, end_id: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def of_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path or standard_path())
        packer = Packer(capacity, TaskContext.get().partitionId() << 40)
        end = np.array([end_id], np.uint32)
        for batch in batches:
            ids, at = bpe.texts(*utf8(batch["text"]))
            for i, doc in enumerate(batch["doc_id"].to_pylist()):
                packer.add(doc, np.concatenate([ids[at[i] : at[i + 1]], end]))
            yield packer.taken()
        packer.flush()
        yield packer.taken()

    return of_partition


def packed(docs: DataFrame, *, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Each task packs the documents of its partition as they come, without a shuffle; sequence ids hold the partition's number
    and a count. Null and empty texts are a single end token; null and repeated doc_ids are documents of their own. No rows
    give no rows.
    """
    prepare(docs.sparkSession)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return own.mapInArrow(_pack(path, capacity, end_id), SCHEMA)
