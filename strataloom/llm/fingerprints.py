"""One-permutation MinHash fingerprints with optimal densification and packed low-order bits (operator 2)."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataloom.functions.ranges import range_of
from strataloom.llm.common import U64, even_keys, mixed, numbers, partitions, pieces, prepare, span_hashes, utf8, word_end, words

WIDTH, BINS, LOW_BITS = 5, 256, 4
#: Characters and rows that are fingerprinted at once, and bytes of a long text.
CHARS, ROWS, BLOCK = 1 << 21, 512, 1 << 19
NO_ID = -(1 << 63)
EMPTY = U64(np.iinfo(np.uint64).max)


def shingle_hashes(raw: np.ndarray, off: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of each text's runs of `width` words, and the number for each text (fewer words: the whole text's run)."""
    start, end, first = words(raw, off)
    return run_hashes(span_hashes(raw, start, end), first, width)


def run_hashes(word: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """As shingle_hashes(), from the hashes of words and the place of each text's first one."""
    has = np.diff(first)
    n = np.where(has >= width, has - width + 1, np.minimum(has, 1))
    begin = np.repeat(first[:-1] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    size = np.minimum(width, np.repeat(has, n))
    out = np.zeros(len(begin), U64)
    with np.errstate(over="ignore"):
        for i in range(width):
            inside = i < size
            out = np.where(inside, out * U64(0xD1342543DE82EF95) + word[np.where(inside, begin + i, 0)], out) if len(begin) else out
    return mixed(out), n


def long_hashes(raw: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """The hashes of one text's runs of words, a block of the text at a time."""
    left, at, told = np.zeros(0, U64), 0, False
    while at < len(raw):
        stop = min(len(raw), at + BLOCK)
        stop = word_end(raw, stop)
        part = raw[at:stop]
        start, end, _ = words(part, np.array([0, len(part)]))
        word = np.concatenate([left, span_hashes(part, start, end)])
        at = stop
        if len(word) >= width or (at == len(raw) and not told and len(word)):
            yield run_hashes(word, np.array([0, len(word)]), width)[0]
            told = True
        left = word[max(0, len(word) - width + 1) :] if width > 1 else word[:0]


@cache
def probes(bins: int) -> np.ndarray:
    """For each bin the bins to borrow from, in order: a hash of bin and attempt, the same for every text."""
    return (numbers(bins * 8 * bins, 11) % U64(bins)).astype(np.int64).reshape(bins, 8 * bins)


def bin_minima(hashes: np.ndarray, n: np.ndarray, bins: int) -> np.ndarray:
    """Each text's least hash in each bin; EMPTY where there is none. One hash for each shingle places and ranks it."""
    out = np.full(len(n) * bins, EMPTY, U64)
    text = np.repeat(np.arange(len(n)), n)
    place = (hashes >> U64(65 - bins.bit_length())).astype(np.int64)  # bins is a power of two
    np.minimum.at(out, text * bins + place, mixed(hashes ^ U64(0xA0761D6478BD642F)))
    return out.reshape(len(n), bins)


def densified(minima: np.ndarray) -> np.ndarray:
    """Fills each empty bin from the first bin on its list of probes that isn't empty (optimal densification)."""
    bins = minima.shape[1]
    lists, out = probes(bins), minima.copy()
    row, col = np.nonzero((minima == EMPTY) & (minima != EMPTY).any(axis=1)[:, None])
    for attempt in range(lists.shape[1]):
        if not len(row):
            return out
        got = minima[row, lists[col, attempt]]
        full = got != EMPTY
        out[row[full], col[full]] = got[full]
        row, col = row[~full], col[~full]
    for r, c in zip(row, col, strict=True):  # all but never: the next full bin
        out[r, c] = next(v for k in range(bins) if (v := minima[r, (c + k) % bins]) != EMPTY)
    return out


def sketched(least: np.ndarray, bits: int) -> np.ndarray:
    """The low-order bits of bins after densification; zeros for a text without words.

    A value borrowed into many bins shows other bits in each, so that chance agreement stays independent.
    """
    shown = mixed(densified(least) ^ numbers(least.shape[1], 23)) & U64((1 << bits) - 1)
    shown[(least == EMPTY).all(axis=1)] = 0
    return shown.astype(np.uint8)


def signatures(raw: np.ndarray, off: np.ndarray, width: int = WIDTH, bins: int = BINS, bits: int = LOW_BITS) -> tuple[np.ndarray, np.ndarray]:
    """The low-order bits of every text's filled bins (zeros for a text without words), and which texts have words."""
    low, some = [np.zeros((0, bins), np.uint8)], [np.zeros(0, bool)]
    for i, j in pieces(off, BLOCK):
        if off[j] - off[i] > 2 * BLOCK:  # one long text
            least = np.full((1, bins), EMPTY, U64)
            for hashes in long_hashes(raw[off[i] : off[j]], width):
                least = np.minimum(least, bin_minima(hashes, np.array([len(hashes)]), bins))
        else:
            least = bin_minima(*shingle_hashes(raw[off[i] : off[j]], off[i : j + 1] - off[i], width), bins)
        low.append(sketched(least, bits))
        some.append((least != EMPTY).any(axis=1))
    return np.concatenate(low), np.concatenate(some)


def packed_hex(low: np.ndarray, bits: int) -> list[str]:
    """Each row's values, `bits` bits each, as hex."""
    flat = np.packbits(np.unpackbits(low[:, :, None], axis=2, bitorder="little")[:, :, :bits].reshape(len(low), -1), axis=1, bitorder="little") if bits < 8 else low
    return [x.tobytes().hex() for x in flat]


def likeness(a: np.ndarray, b: np.ndarray, has_a: np.ndarray, has_b: np.ndarray, bits: int) -> np.ndarray:
    """Estimated resemblance: the share of equal values, less what equal low-order bits give by chance; 0 to 1.

    Two texts without words are alike; one without and one with are not.
    """
    chance = 2.0**-bits
    equal = (a == b).mean(axis=1) if len(a) else np.zeros(0)
    return np.where(has_a & has_b, np.clip((equal - chance) / (1 - chance), 0, 1), (has_a == has_b).astype(float))


def edited(text: str, after: str) -> str:
    """The text with its last half replaced by as much of the beginning of another."""
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


def _rows(width: int, bins: int, bits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows come in document order within each range; the row that follows a range stands at its end, marked."""

    def work(held: list[tuple]) -> pa.RecordBatch:
        texts = [t for _, t, _, _ in held]
        own = [i for i in range(len(held) - 1) if not held[i][2] and held[i][3] == held[i + 1][3]]
        changed = [edited(texts[i], texts[i + 1]) for i in own]
        low, has = signatures(*utf8(pa.array(texts, pa.large_string())), width, bins, bits)
        low_e, has_e = signatures(*utf8(pa.array(changed, pa.large_string())), width, bins, bits)
        at = np.array(own, np.int64)
        columns = [
            pa.array([held[i][0] for i in own], pa.int64()),
            pa.array([len(texts[i]) for i in own], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
            pa.array(packed_hex(low[at], bits), pa.string()),
            pa.array(packed_hex(low_e, bits), pa.string()),
            pa.array(likeness(low[at], low_e, has[at], has_e, bits), pa.float64()),
            pa.array(likeness(low[at], low[at + 1], has[at], has[at + 1], bits), pa.float64()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    def of_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(batch[c].to_pylist() for c in ("doc_id", "text", "tail", "bucket")), strict=True):
                held.append(row)
                size += len(row[1])
                if len(held) > 1 and (size > CHARS or len(held) > ROWS):
                    yield work(held)
                    held, size = held[-1:], len(row[1])
        if held:
            yield work(held)

    return of_partition


def _order() -> list[Column]:
    return [F.col("id"), F.col("text")]


def fingerprints(docs: DataFrame, *, width: int = WIDTH, bins: int = BINS, bits: int = LOW_BITS) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next of each row.

    The next document is the next row by doc_id, then by text; the first follows the last, so a single row follows itself.
    Null doc_ids come first. Null texts are empty. Rows are dealt into ranges of doc_id; the first row of each range goes to
    the end of the range before too, so a task needs no other task's rows. No rows give no rows.
    """
    spark = docs.sparkSession
    prepare(spark)
    own = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.col("doc_id").isNull().alias("none"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    n = partitions(spark)
    # A bound for each partition at most. Bounds are ids that occur, so each range's first row is known to have its bound.
    cuts = own.agg(F.min("id").alias("least"), F.percentile_approx("id", [i / n for i in range(1, n)] or [0.5], 10000).alias("q")).first()
    starts = sorted({cuts["least"], *(cuts["q"] or [])} - {None}) or [NO_ID]
    at = range_of(F.col("id"), starts) - 1
    first = F.element_at(F.array(*[F.lit(s) for s in starts]), (at + 1).cast("int")) == F.col("id")
    # A row with a range's first id goes to the range before too (of several, the least text is read there).
    to = F.when(first, F.array(F.struct(at.alias("bucket"), F.lit(False).alias("tail")), F.struct(F.pmod(at - 1, F.lit(len(starts))).alias("bucket"), F.lit(True).alias("tail"))))
    rows = own.select("*", F.inline(F.coalesce(to, F.array(F.struct(at.alias("bucket"), F.lit(False).alias("tail"))))))
    keys = F.array(*[F.lit(k) for k in even_keys(n)])
    sent = rows.repartition(n, F.element_at(keys, (F.col("bucket") + 1).cast("int"))).sortWithinPartitions("bucket", "tail", *_order()).select(F.when(~F.col("none"), F.col("id")).alias("doc_id"), "text", "tail", F.col("bucket").cast("int").alias("bucket"))
    return sent.mapInArrow(_rows(width, bins, bits), "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
