"""Exact repeats of a fixed window: the stages that operators 1 and 7 share.

A *window* is L consecutive tokens of one document (bytes, or words). Among the grams of k tokens in a window, the one
of smallest hash (leftmost if several) is its *anchor*, so equal windows have equal anchors at equal offsets. Consecutive
windows with the same anchor form a *segment*: the anchor with all that its windows cover on both sides.

Stages, each bounded by the size of one partition: documents (dealt evenly by id and text) -> hashes of their anchors'
grams -> shards, which answer which of them another bucket has too -> documents, which send the segments of such grams, in
bytes -> shards, where each operator compares them by its own method -> marks -> documents, which drop what is marked.
Hashes only choose what is sent and where; whether windows are equal is decided on their bytes.

Copies inside one partition are settled there (a segment leaves it once, however often it occurs), so a group of copies of
any size costs a shard one row for each partition. A *hot* gram, one with more than HOT different segments, doesn't go to
one shard: its segments are cut by how far the anchor is from the window's start, and each cut goes where the hash of all
that its windows have in common says. So a phrase that very many documents share spreads by what stands around it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataloom.llm.common import BYTE, U64, dealt, even_keys, mixed, partitions, pieces, prepare, span_hashes, utf8, words

NO_ID = -(1 << 63)
HOT, PIECE = 1 << 10, 1 << 18
_BASE = 0xB7E151628AED2A6B
#: Positions have so many low bits of an anchor's rank; the high ones are the gram's hash.
_AT_BITS = U64(40)
MARK, SEGMENT = 0, 1
_GRAMS = "part int, bucket int, grams binary, n binary"
_MOVED = "part int, kind int, bucket int, docs binary, places binary, body binary"


@dataclass(frozen=True)
class Rule:
    """What counts as a repeat. `compare` gets a shard's different segments, in document order, and says of each of their
    windows whether it is to go (first_stays: only if an earlier segment has it; else if any other one has)."""

    window: int
    gram: int
    by_words: bool
    first_stays: bool
    compare: Callable[[list[bytes], np.ndarray, np.ndarray, int, int], np.ndarray]
    hot: int = HOT


# --- tokens, hashes and runs ----------------------------------------------------------------------


def rolled(t: np.ndarray, n: int) -> np.ndarray:
    """The polynomial hash of every n consecutive tokens (not finalized)."""
    m = 1 << 64
    with np.errstate(over="ignore"):
        part, size, power = t, 1, _BASE
        whole, have = None, 0
        while True:
            if n & size:
                if whole is None:
                    whole, have = part, size
                else:
                    long = len(t) - have - size + 1
                    whole = whole[:long] * U64(power) + part[have : have + long]
                    have += size
            if have == n:
                return whole
            part = part[: len(part) - size] * U64(power) + part[size:]
            power = power * power % m
            size *= 2


def smallest(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every `width` consecutive values."""
    size = 1
    while size * 2 <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    rest = width - size
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def runs(t: np.ndarray, off: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """Of each run: its row, first window's start in the row, windows besides the first, the anchor's distance from that
    start, hash of gram, hash of run."""
    count = np.maximum(np.diff(off) - window + 1, 0)
    if not count.sum():
        none = np.zeros(0, np.int64)
        return none, none, none, none, none.astype(U64), none.astype(U64)
    grams = mixed(rolled(t, gram))
    least = smallest((grams >> _AT_BITS << _AT_BITS) | np.arange(len(grams), dtype=U64), window - gram + 1)
    row = np.repeat(np.arange(len(count)), count)
    start = np.arange(len(row)) + np.repeat(off[:-1] - (np.cumsum(count) - count), count)
    anchor = (least[start] & ((U64(1) << _AT_BITS) - U64(1))).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    last = np.concatenate([first[1:], [len(row)]]) - 1
    whole = rolled(t, window)
    a, b, more = start[first], start[last], last - first
    with np.errstate(over="ignore"):
        context = mixed(whole[a] * U64(0xC2B2AE3D27D4EB4F) + whole[b] * U64(0x165667B19E3779F9) + more.astype(U64) * U64(0x27D4EB2F165667C5))
    return row[first], a - off[:-1][row[first]], more, anchor[first] - a, grams[anchor[first]], context


class Tokens:
    """The documents of one bucket, in document order; row numbers in it are the same in every stage."""

    def __init__(self, docs: pa.Table, rule: Rule):
        ids = pc.fill_null(docs["doc_id"], NO_ID)
        keys = [("i", "ascending"), ("h", "ascending")]
        cols = {"i": ids, "h": docs["hash"]}
        if len(pc.unique(ids)) < len(ids):
            cols["t"] = pc.fill_null(docs["text"], "")
            keys.append(("t", "ascending"))
        order = pc.sort_indices(pa.table(cols), sort_keys=keys)
        self.docs = docs.take(order)
        self.ids, self.hashes = pc.take(ids, order).to_numpy(), self.docs["hash"].to_numpy()
        self.rule = rule
        self.raw, self.bytes_off = utf8(self.docs["text"])
        if not rule.by_words:
            self.off = self.bytes_off
            return
        start, end, off = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(1, np.int64)]
        for i, j in pieces(self.bytes_off, PIECE):
            lo, n = self.bytes_off[i], off[-1][-1]
            a, b, first = words(self.raw[lo : self.bytes_off[j]], self.bytes_off[i : j + 1] - lo)
            start.append(a + lo), end.append(b + lo), off.append(first[1:] + n)
        self.start, self.end, self.off = map(np.concatenate, (start, end, off))

    def hashed(self, a: int, b: int) -> np.ndarray:
        """Hashes of tokens a to b."""
        if not self.rule.by_words:
            return BYTE[self.raw[a:b]]
        if a == b:
            return np.zeros(0, U64)
        lo = self.start[a]
        return span_hashes(self.raw[lo : self.end[b - 1]], self.start[a:b] - lo, self.end[a:b] - lo)

    def runs(self) -> list[np.ndarray]:
        """What runs() gives, for all rows. A long row is read in parts: a run that is cut in two is two runs."""
        found: list[list[np.ndarray]] = [[] for _ in range(6)]
        window, gram = self.rule.window, self.rule.gram
        for i, j in pieces(self.off, PIECE):
            a, b = self.off[i], self.off[j]
            for c in range(a, max(a + 1, b - window + 1), PIECE if b - a > 2 * PIECE else b - a + 1):
                d = min(b, c + PIECE + window - 1) if b - a > 2 * PIECE else b
                off = self.off[i : j + 1] - a if d - c == b - a else np.array([0, d - c])
                for to, x in zip(found, runs(self.hashed(c, d), off, window, gram), strict=True):
                    to.append(x)
                found[0][-1], found[1][-1] = found[0][-1] + i, found[1][-1] + (c - a)
        return [np.concatenate(x) if x else np.zeros(0, np.int64) for x in found]

    def written(self, a: int, b: int) -> bytes:
        """Tokens a to b; words are joined by one space."""
        if not self.rule.by_words:
            return self.raw[a:b].tobytes()
        return b" ".join(self.raw[self.start[a] : self.end[b - 1]].tobytes().split()) if b > a else b""


def cuts(reach: int) -> list[int]:
    """Where the distances 0 to `reach` of an anchor are cut: finely at both ends, where windows have least in common."""
    steps = [0, *[1 << k for k in range(reach.bit_length()) if 2 << k <= reach]]
    return sorted({*steps, *[reach + 1 - s for s in steps]})


def _split(by: np.ndarray, *arrays: np.ndarray) -> Iterator[tuple[int, list[np.ndarray]]]:
    """The arrays' rows by value of `by`, in the order they have."""
    order = np.argsort(by, kind="stable")
    cut = np.flatnonzero(np.diff(by[order])) + 1
    for part in np.split(order, cut) if len(order) else []:
        yield int(by[part[0]]), [x[part] for x in arrays]


def _packed(*arrays: np.ndarray, kind: type = np.int32) -> bytes:
    return np.concatenate([np.asarray(x, kind) for x in arrays]).tobytes()


def _columns(body: bytes, n: int, kind: type = np.int32) -> np.ndarray:
    """The n arrays of _packed()."""
    return np.frombuffer(body, kind).reshape(n, -1)


# --- stages -------------------------------------------------------------------------------------------


def _grams(rule: Rule, keys: list[int]) -> Callable[[tuple, pa.Table], pa.Table]:
    """Each bucket's grams, a pack for each shard, with the number of different segments of each (255 at most)."""

    def of_bucket(key: tuple, docs: pa.Table) -> pa.Table:
        *_, gram, context = Tokens(docs, rule).runs()
        _, one = np.unique(context, return_index=True)
        gram, n = np.unique(gram[one].astype(U64), return_counts=True)
        packs = list(_split((gram % U64(len(keys))).astype(np.int64), gram, np.minimum(n, 255).astype(np.uint8)))
        return pa.table({
            "part": pa.array([keys[s] for s, _ in packs], pa.int32()), "bucket": pa.array([key[0].as_py()] * len(packs), pa.int32()),
            "grams": pa.array([g.tobytes() for _, (g, _) in packs], pa.binary()), "n": pa.array([x.tobytes() for _, (_, x) in packs], pa.binary()),
        })

    return of_bucket


def _shared(most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Tells each bucket which of its grams another one has too, and which of these are hot."""

    def of_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, n, bucket = [np.zeros(0, U64)], [np.zeros(0, np.uint8)], [np.zeros(0, np.int32)]
        for batch in batches:
            for b, g, c in zip(*(batch[x].to_pylist() for x in ("bucket", "grams", "n")), strict=True):
                grams.append(np.frombuffer(g, U64)), n.append(np.frombuffer(c, np.uint8)), bucket.append(np.full(len(c), b, np.int32))
        grams, n, bucket = map(np.concatenate, (grams, n, bucket))
        _, which, size = np.unique(grams, return_inverse=True, return_counts=True)
        hot = np.bincount(which, n) > most
        far = size[which] > 1
        for b, (g, h) in _split(bucket[far], grams[far], hot[which[far]]):
            yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([b], pa.int32()), pa.array([g.tobytes()], pa.binary()), pa.array([h.tobytes()], pa.binary())], ["part", "bucket", "grams", "n"])

    return of_partition


def _segments(rule: Rule, keys: list[int]) -> Callable[[tuple, pa.Table, pa.Table], pa.Table]:
    """The different segments of grams that occur again. What occurs again inside the bucket as a whole is marked here."""

    def of_bucket(key: tuple, docs: pa.Table, told: pa.Table) -> pa.Table:
        bucket, tokens, window = key[0].as_py(), Tokens(docs, rule), rule.window
        row, pos, more, at, gram, context = tokens.runs()
        if not len(row):
            return _moved([])
        far = np.concatenate([np.zeros(0, U64), *[np.frombuffer(g, U64) for g in told["grams"].to_pylist()]])
        far_hot = np.concatenate([np.zeros(0, bool), *[np.frombuffer(h, bool) for h in told["n"].to_pylist()]])
        order = np.argsort(far)
        far, far_hot = np.append(far[order], U64(0)), np.append(far_hot[order], False)
        own, which, size = np.unique(gram, return_inverse=True, return_counts=True)
        place = np.searchsorted(far[:-1], own)
        elsewhere = (place < len(far) - 1) & (far[place] == own)
        _, one = np.unique(context, return_index=True)
        kinds = np.bincount(which[one], minlength=len(own))  # different segments here
        hot = np.where(elsewhere, far_hot[place], kinds > rule.hot)
        wanted = np.flatnonzero((elsewhere | (size > 1))[which])
        sent: list[tuple] = []  # shard, row, start, windows besides the first, the anchor's distance, bytes, number of the gram
        first: dict[bytes, int] = {}
        copies, firsts = [], set()
        limits = cuts(window - rule.gram)
        for k, h in zip(wanted.tolist(), hot[which[wanted]].tolist(), strict=True):
            base, reach, last = int(tokens.off[row[k]] + pos[k]), int(at[k]), int(at[k] - more[k])
            # Windows whose anchor is `last` to `reach` away; a hot gram's are cut at the limits.
            for lo, hi in ((max(a, last), min(b - 1, reach)) for a, b in zip(limits, limits[1:], strict=False)) if h else ((last, reach),):
                if lo > hi:
                    continue
                start = base + reach - hi
                body = tokens.written(start, start + hi - lo + window)
                row_of = (int(row[k]), start - int(tokens.off[row[k]]), hi - lo)
                if body in first:
                    copies.append(row_of)
                    firsts.add(first[body])
                    continue
                first[body] = len(sent)
                if h:
                    a, b = max(x for x in limits if x <= lo), min(x for x in limits if x > hi)
                    # What all windows of the whole cut, here and elsewhere, have in common: a tokens before the anchor, so many after.
                    common = tokens.written(base + reach - a, base + reach + window - b + 1)
                    shard = int.from_bytes(hashlib.blake2b(common + a.to_bytes(4, "little"), digest_size=8).digest(), "little") % len(keys)
                else:
                    shard = int(gram[k] % U64(len(keys)))
                sent.append((shard, *row_of, hi, body, int(which[k])))
        bodies = np.bincount([s[6] for s in sent], minlength=len(own))
        gone = copies if rule.first_stays else copies + [sent[i][1:4] for i in sorted(firsts)]
        out = [(keys[bucket % len(keys)], MARK, bucket, b"", _packed(*np.array(gone).T), b"")] if gone else []
        far = [s for s in sent if elsewhere[s[6]] or bodies[s[6]] > 1]
        for s, (some,) in _split(np.array([s[0] for s in far], np.int64), np.arange(len(far))):
            rows, n = np.unique([far[i][1] for i in some], return_counts=True)
            numbers = [[far[i][c] for i in some] for c in (2, 3, 4)]
            out.append((keys[s], SEGMENT, bucket, _packed(tokens.ids[rows], tokens.hashes[rows], rows, n, kind=np.int64), _packed(*numbers, [len(far[i][5]) for i in some]), b"".join([far[i][5] for i in some])))
        return _moved(out)

    return of_bucket


def _moved(rows: list[tuple]) -> pa.Table:
    columns = zip(*rows, strict=True) if rows else [[]] * 6
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
    return pa.table({name.split()[0]: pa.array(c, k) for name, c, k in zip(_MOVED.split(", "), columns, kinds, strict=True)})


def _runs_of(gone: np.ndarray, bucket: np.ndarray, row: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, ...]:
    """Marked windows, joined where they follow one another into the longest repeats: bucket, row, start, windows besides the first."""
    at = np.flatnonzero(gone)
    at = at[np.lexsort((pos[at], row[at], bucket[at]))]
    if not len(at):
        return at, at, at, at
    b, r, p = bucket[at], row[at], pos[at]
    new = np.concatenate([[True], (np.diff(b) != 0) | (np.diff(r) != 0) | (np.diff(p) > 1)])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    return b[first], r[first], p[first], p[last] - p[first]


def _compare(rule: Rule) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Finds a shard's repeated windows. Marks pass through on their way to the documents."""

    def of_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: list[list[np.ndarray]] = [[] for _ in range(7)]
        bodies: list[bytes] = []
        for batch in batches:
            for kind, bucket, docs, places, body in zip(*(batch[c].to_pylist() for c in ("kind", "bucket", "docs", "places", "body")), strict=True):
                if kind == MARK:
                    yield from _moved([(0, MARK, bucket, b"", places, b"")]).to_batches()
                    continue
                ids, hashes, rows, n = _columns(docs, 4, np.int64)
                pos, more, at, size = _columns(places, 4)
                for to, x in zip(got, (np.repeat(ids, n), np.repeat(hashes, n), np.repeat(rows, n), pos, more, at, np.full(len(pos), bucket)), strict=True):
                    to.append(x)
                end = np.cumsum(size).tolist()
                bodies += [body[a:b] for a, b in zip([0, *end], end, strict=False)]
        if not bodies:
            return
        ids, hashes, row, pos, more, at, bucket = map(np.concatenate, got)
        order = np.lexsort((pos, row, hashes, ids))  # document order
        # Equal segments of several buckets are one segment; all but its first holder have earlier copies.
        number: dict[bytes, int] = {}
        which = np.array([number.setdefault(bodies[k], len(number)) for k in order.tolist()])
        _, one, holders = np.unique(which, return_index=True, return_counts=True)
        gone_of = rule.compare(list(number), more[order[one]], at[order[one]], rule.window, rule.gram)
        if not rule.first_stays:
            gone_of = gone_of | np.repeat(holders > 1, more[order[one]] + 1)
        first = np.zeros(len(order), bool)
        first[one] = True
        more, row, pos, bucket = more[order], row[order], pos[order], bucket[order]
        n = more + 1
        begin = (np.cumsum(n[one]) - n[one])[which]
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        gone = gone_of[np.repeat(begin, n) + step]
        if rule.first_stays:
            gone = gone | np.repeat(~first, n)
        b, r, p, m = _runs_of(gone, np.repeat(bucket, n), np.repeat(row, n), np.repeat(pos, n) + step)
        for k, xs in _split(b, r, p, m):
            yield from _moved([(0, MARK, k, b"", _packed(*xs), b"")]).to_batches()

    return of_partition


def _kept(rule: Rule, carried: list[str], texts: bool) -> Callable[[tuple, pa.Table, pa.Table], pa.Table]:
    def of_bucket(key: tuple, docs: pa.Table, marks: pa.Table) -> pa.Table:
        tokens = Tokens(docs, rule)
        got = [_columns(x, 3) for x in marks["places"].to_pylist()]
        row, pos, more = np.concatenate([np.zeros((3, 0), np.int64), *got], axis=1)
        begin = tokens.off[row] + pos
        order = np.argsort(begin, kind="stable")
        row, begin, end = row[order], begin[order], (begin + more + rule.window)[order]
        # Overlapping and touching ranges of one document are one.
        reach = np.maximum.accumulate(end) if len(end) else end
        first = np.flatnonzero(np.concatenate([[True], (begin[1:] > reach[:-1]) | (np.diff(row) != 0)])) if len(end) else np.zeros(0, np.int64)
        row, begin, end = row[first], begin[first], reach[np.append(first[1:], len(reach)) - 1] if len(end) else end
        cut = np.searchsorted(row, np.arange(len(tokens.off)))
        removed, kept, digests = [], [], []
        for k, (lo, hi) in enumerate(zip(tokens.off[:-1].tolist(), tokens.off[1:].tolist(), strict=True)):
            a, b = begin[cut[k] : cut[k + 1]].tolist(), end[cut[k] : cut[k + 1]].tolist()
            removed.append(sum(b) - sum(a))
            some = [tokens.written(x, y) for x, y in zip([lo, *b], [*a, hi], strict=True) if x < y]
            body = (b" " if rule.by_words else b"").join(some)
            digests.append(hashlib.sha256(body).hexdigest())
            if texts:
                kept.append(body.decode("utf-8", "ignore"))
        out = {"doc_id": tokens.docs["doc_id"], f"n_{'words' if rule.by_words else 'bytes'}": pa.array(np.diff(tokens.off), pa.int64()), "n_removed": pa.array(removed, pa.int64()), "n_spans": pa.array(np.diff(cut), pa.int64()), "kept_sha256": pa.array(digests, pa.string())}
        if texts:
            out["kept"] = pa.array(kept, pa.string())
        return pa.table(out | {f"_{c}": tokens.docs[f"_{c}"] for c in carried})

    return of_bucket


def without_repeats(docs: DataFrame, rule: Rule, *, texts: bool = False, carried: tuple[str, ...] = ()) -> DataFrame:
    """What is left of each document: doc_id, n_bytes or n_words, n_removed, n_spans, kept_sha256.

    With texts, `kept` too (a character cut in two is dropped); carried columns come back with a leading underscore.
    Null texts are empty. A null id comes first in document order; rows with one id are in the order of a hash of their
    texts, and each row counts. Other columns don't matter, whatever their names. An empty table gives an empty table.
    """
    spark = docs.sparkSession
    prepare(spark)
    keys = even_keys(partitions(spark))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("hash"), *[F.col(c).alias(f"_{c}") for c in carried])
    kept = ", ".join([f"doc_id long, n_{'words' if rule.by_words else 'bytes'} long, n_removed long, n_spans long, kept_sha256 string", *["kept string"] * texts, *[f"`_{c}` {own.schema[f'_{c}'].dataType.simpleString()}" for c in carried]])
    # The same exchange serves all three reads of the documents.
    own = own.withColumn("bucket", dealt([F.coalesce("doc_id", F.lit(NO_ID)), F.col("hash")], keys)).repartition(len(keys), "bucket")
    by_bucket = own.groupBy("bucket")
    grams = by_bucket.applyInArrow(_grams(rule, keys), _GRAMS).repartition(len(keys), "part")
    shared = grams.mapInArrow(_shared(rule.hot), _GRAMS)
    sent = by_bucket.cogroup(shared.groupBy("bucket")).applyInArrow(_segments(rule, keys), _MOVED).repartition(len(keys), "part")
    marks = sent.mapInArrow(_compare(rule), _MOVED)
    return by_bucket.cogroup(marks.groupBy("bucket")).applyInArrow(_kept(rule, list(carried), texts), kept)
