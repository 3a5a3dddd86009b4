"""SimHash near-dedup by multi-index hashing (operator 8)."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from itertools import combinations
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataloom.llm.common import U64, dropped, even_keys, mixed, partitions, pieces, prepare, span_hashes, stored, utf8, with_room, words
from strataloom.llm.components import forest, stars
from strataloom.llm.fingerprints import bin_minima, long_hashes, run_hashes, shingle_hashes, sketched

WIDTH, RADIUS, SEED = 3, 2, 42
#: Near copies resemble each other so much in shingles of so many words; a sketch has BINS bytes in bands of BAND.
NEAR, NEAR_WIDTH, BINS, BAND = 0.8, 5, 256, 8
#: A text of more bytes is read in blocks.
LONG = 1 << 21
#: Heads of a bucket in the second round. Shingles of so many sets are frequent; how often the others occur makes no difference.
HEADS, OFTEN = 8, 16
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LO, _HI = U64(0xFFFFFFFF), U64(0xFFFFFFFF00000000)


def shingles(raw: np.ndarray, off: np.ndarray, width: int) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased words joined by one space; each shingle's start and end there, and each row's number of shingles."""
    start, end, first = words(raw, off)
    size = end - start
    place = np.cumsum(size + 1) - (size + 1)
    joined = np.full(int((size + 1).sum()), 32, np.uint8)
    joined[np.arange(size.sum()) + np.repeat(np.arange(len(size)), size)] = _LOWER[raw[np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())]]
    has = np.diff(first)
    n = np.where(has >= width, has - width + 1, np.minimum(has, 1))
    begin = np.repeat(first[:-1] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    stop = np.minimum(begin + width, np.repeat(first[1:], n)) - 1
    return joined.tobytes(), place[begin], place[stop] + size[stop], n


def fingerprints(column: pa.Array, width: int) -> np.ndarray:
    """The 64-bit SimHash of each text: zero for one without words."""
    raw, off = utf8(column)
    out = np.zeros(len(column), U64)
    of = xxhash.xxh64_intdigest
    for i, j in pieces(off, 1 << 18):
        text, a, b, n = shingles(raw[off[i] : off[j]], off[i : j + 1] - off[i], width)
        h = np.array([of(text[x:y], SEED) for x, y in zip(a.tolist(), b.tolist(), strict=True)], U64)
        if not len(h):
            continue
        rows = np.flatnonzero(n)
        starts = (np.cumsum(n) - n)[rows]
        ones = np.zeros((len(rows), 64), np.int64)
        for k in range(0, 64, 8):  # a byte of the hashes at a time
            ones[:, k : k + 8] = np.add.reduceat(np.unpackbits(((h >> U64(k)) & U64(255)).astype(np.uint8)[:, None], axis=1, bitorder="little"), starts, axis=0, dtype=np.int64)
        bits = (ones * 2 > n[rows][:, None]).astype(np.uint8)
        out[i:j][rows] = np.packbits(bits, axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def _fingerprint(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def of_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(fingerprints(batch["text"], width).view(np.int64))], ["doc_id", "fp"])

    return of_partition


# --- links -----------------------------------------------------------------------------------------


def _ball(most: int) -> np.ndarray:
    """All masks of up to `most` of 32 bits."""
    return np.array([sum(1 << b for b in c) for n in range(most + 1) for c in combinations(range(32), n)], U64)


def matches(table: np.ndarray, query: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For queries, places in the sorted table with the same upper half whose lower half differs in up to `most` bits.

    A short list of rows with that upper half is compared; a long one is looked up at every point of the ball instead, so
    the work for a query is bounded whatever the number of rows that share its key.
    """
    lo, hi = np.searchsorted(table, query & _HI), np.searchsorted(table, query | _LO, "right")
    size, ball = hi - lo, _ball(most)
    few = np.flatnonzero((size > 0) & (size <= len(ball)))
    step = max(1, (1 << 21) // len(ball))
    for i in range(0, len(few), step):
        q = few[i : i + step]
        n = size[q]
        place = np.arange(n.sum()) + np.repeat(lo[q] - (np.cumsum(n) - n), n)
        who = np.repeat(q, n)
        near = np.bitwise_count(table[place] ^ query[who]) <= most
        yield who[near], place[near]
    many = np.flatnonzero(size > len(ball))
    for i in range(0, len(many), step):
        q = np.repeat(many[i : i + step], len(ball))
        point = query[q] ^ np.tile(ball, len(q) // len(ball))
        place = np.searchsorted(table, point)
        place[place == len(table)] = 0
        hit = table[place] == point
        yield q[hit], place[hit]


def _turned(fp: np.ndarray) -> np.ndarray:
    return (fp << U64(32)) | (fp >> U64(32))


def _send(keys: list[int], radius: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Each fingerprint's rows for the tables of its two halves, and its probes of the neighbouring keys.

    Of two fingerprints within the radius (3 at most), some half differs in one bit or none. Of two keys that differ in one
    bit only the one without it probes. Within a radius of 2, halves that differ in a bit each meet in the first table.
    """

    def rows(fp: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        for half in (0, 1):
            own = _turned(fp) if half else fp
            yield half, 0, own
            if half == 0 or radius > 2:
                for bit in range(32, 64):
                    if len(less := own[(own >> U64(bit)) & U64(1) == 0]):
                        yield half, bit, less | (U64(1) << U64(bit))

    def of_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, body = [], []
            held: dict[tuple[int, int, int], list] = {}
            for half, probe, q in rows(batch["fp"].to_numpy().view(U64)):
                shard = (mixed((q >> U64(32)) + U64(half << 40)) % U64(len(keys))).astype(np.int64)
                order = np.argsort(shard, kind="stable")
                for x in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1) if len(order) else []:
                    held.setdefault((int(shard[x[0]]), half, probe), []).append(q[x])
            for (s, half, probe), q in held.items():
                part.append(keys[s])
                body.append(pickle.dumps((half, probe, np.concatenate(q)), protocol=5))
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(body, pa.binary())], ["part", "body"])

    return of_partition


def _link(radius: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Verifies whole distances. A shard sends on a forest of its links, never all pairs."""

    def of_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list] = {}
        for batch in batches:
            for body in batch["body"].to_pylist():
                half, probe, q = pickle.loads(body)
                held.setdefault((half, probe), []).append(q)
        u, v, n = [], [], 0
        for half in (0, 1):
            if (half, 0) not in held:
                continue
            table = np.sort(np.concatenate(held[half, 0]))
            for probe in (0, *range(32, 64)):  # 0: the keys themselves; else the bit by which keys differ
                if (half, probe) not in held:
                    continue
                query = np.concatenate(held[half, probe]) if probe else table
                for who, place in matches(table, query, radius - bool(probe)):
                    if probe:
                        a, b = query[who] ^ (U64(1) << U64(probe)), table[place]
                    else:
                        a, b = table[who[who < place]], table[place[who < place]]
                    u.append(_turned(a) if half else a), v.append(_turned(b) if half else b)
                    n += len(a)
                    if n > 1 << 21:
                        x, y = forest(np.concatenate(u), np.concatenate(v))
                        u, v, n = [x], [y], 0
        if u:
            x, y = forest(np.concatenate(u), np.concatenate(v))
            yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)), pa.array(y.view(np.int64))], ["u", "v"])

    return of_partition


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """From distinct fingerprints `fp`, pairs (u, v) within the radius that connect all that such pairs connect."""
    if not 0 < radius <= 3:
        raise ValueError("two segments with balls of one bit cover a radius of 1 to 3")
    keys = even_keys(partitions(fps.sparkSession))
    sent = fps.select("fp").mapInArrow(_send(keys, radius), "part int, body binary")
    return sent.repartition(len(keys), "part").mapInArrow(_link(radius), "u long, v long")


def simhash_groups(docs: DataFrame, *, width: int = WIDTH, radius: int = RADIUS) -> DataFrame:
    """doc_id, fp (the fingerprint as a long), fingerprint (16 hex digits) and component_id of each row.

    Rows without words (null, empty or blank texts) have fingerprint zero, shorter texts one shingle. Groups form over the
    distinct fingerprints, so copies cost one row. component_id is the smallest doc_id reachable over links of `radius`
    bits or fewer; null ids count only where there is no other. Repeated rows each return. No rows give no rows.
    """
    prepare(docs.sparkSession)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    fp, _ = stored(own.mapInArrow(_fingerprint(width), "doc_id long, fp long"), "fingerprints")
    first = fp.groupBy("fp").agg(F.min("doc_id").alias("least"))
    of, _ = stars(links(first, radius))
    root = first.join(of, first.fp == of.u, "left").select("fp", "least", F.coalesce("v", "fp").alias("root"))
    least = root.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = root.join(least, "root").select("fp", "component_id")
    return fp.join(by_fp, "fp", "left").select("doc_id", "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


# --- near copies ----------------------------------------------------------------------------------------


def simhash_of_sets(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The 64-bit SimHash of each text's set of words, from the words' hashes: copies with a few words changed differ in few bits."""
    out = np.zeros(len(first) - 1, U64)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    if not len(h):
        return out
    order = np.lexsort((h, text))
    h, text = h[order], text[order]
    new = np.concatenate([[True], (np.diff(h) != 0) | (np.diff(text) != 0)])
    h, text = h[new], text[new]
    rows, starts, n = np.unique(text, return_index=True, return_counts=True)
    ones = np.concatenate([np.add.reduceat(np.unpackbits(((h >> U64(k)) & U64(255)).astype(np.uint8)[:, None], axis=1, bitorder="little"), starts, axis=0, dtype=np.int64) for k in range(0, 64, 8)], axis=1)
    out[rows] = np.packbits((ones * 2 > n[:, None]).astype(np.uint8), axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def whole_set(raw: np.ndarray, width: int) -> np.ndarray:
    """The set of a long text's run hashes, sorted, found a block of the text at a time."""
    out = np.zeros(0, U64)
    for hashes in long_hashes(raw, width):
        out = np.union1d(out, hashes)
    return out


def _described(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Each text's SimHash of its set of words, and its one-permutation MinHash of shingles."""

    def of_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, off = utf8(batch["text"])
            fp, sketch = [], []
            for i, j in pieces(off, 1 << 19):
                part, own = raw[off[i] : off[j]], off[i : j + 1] - off[i]
                if len(part) > LONG:
                    h = whole_set(part, 1)
                    first, least = np.array([0, len(h)]), bin_minima(u := whole_set(part, width), np.array([len(u)]), BINS)
                else:
                    start, end, first = words(part, own)
                    word = span_hashes(part, start, end)
                    h, least = mixed(word), bin_minima(*run_hashes(word, first, width), BINS)
                fp.append(simhash_of_sets(h, first))
                sketch += [r.tobytes() if k else b"" for r, k in zip(sketched(least, 8), np.diff(first).tolist(), strict=True)]
            fps = np.concatenate([np.zeros(0, U64), *fp]).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["node"], pa.array(fps), pa.array(sketch, pa.binary())], ["doc_id", "node", "fp", "sketch"])

    return of_partition


def _shingled(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Each text's whole set of shingles, as sorted hashes."""

    def of_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, off = utf8(batch["text"])
            sets = []
            for i, j in pieces(off, 1 << 19):
                if off[j] - off[i] > LONG:
                    sets.append(whole_set(raw[off[i] : off[j]], width).tobytes())
                    continue
                hashes, n = shingle_hashes(raw[off[i] : off[j]], off[i : j + 1] - off[i], width)
                sets += [np.unique(hashes[e - k : e]).tobytes() for k, e in zip(n.tolist(), np.cumsum(n).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch["node"], pa.array(sets, pa.binary())], ["node", "shingles"])

    return of_partition


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A bucket for each BAND bins of a sketch; one for all texts without words."""
    for batch in batches:
        node, bucket = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for n, s in zip(batch["node"].to_pylist(), batch["sketch"].to_pylist(), strict=True):
            bands = np.frombuffer(s, f"<u{BAND}") if s else np.zeros(1, U64)
            node.append(np.full(len(bands), n, np.int64))
            bucket.append(mixed(mixed(bands) ^ mixed(np.arange(len(bands), dtype=U64))).view(np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(bucket)), pa.array(np.concatenate(node))], ["bucket", "node"])


def resembling(similarity: float, a: bytes, b: bytes) -> bool:
    """Whether two sets of shingles resemble each other so much or more; texts without words are alike."""
    x, y = np.frombuffer(a, U64), np.frombuffer(b, U64)
    if min(len(x), len(y)) < similarity * max(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both >= similarity * (len(x) + len(y) - both)


def _alike(similarity: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The pairs whose sets resemble each other."""

    def of_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = pa.array([resembling(similarity, a, b) for a, b in zip(batch["a"].to_pylist(), batch["b"].to_pylist(), strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch["u"].filter(keep), batch["v"].filter(keep)], ["u", "v"])

    return of_partition


def _spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each shingle of each set."""
    for batch in batches:
        sets = [np.frombuffer(b, np.int64) for b in batch["shingles"].to_pylist()]
        at = pa.array(np.repeat(np.arange(len(sets)), [len(x) for x in sets]))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, np.int64), *sets])), batch["node"].take(at)], ["shingle", "node"])


def prefix(shingles: np.ndarray, often: np.ndarray, n: np.ndarray, similarity: float) -> np.ndarray:
    """The shingles of which two sets share one if they resemble each other so much: the first in the order of rarity that all sets have in
    common, so many that the rest is too few. Both are sorted; `often` are the frequent ones among them, each in n sets, and behind all others."""
    rank = np.zeros(len(shingles), np.int64)
    rank[np.searchsorted(shingles, often)] = n
    return shingles[np.lexsort((shingles, rank))][: len(shingles) - ceil(similarity * len(shingles) - 1e-9) + 1]


def _prefixes(similarity: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def of_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.sort(np.frombuffer(b, np.int64)) for b in batch["shingles"].to_pylist()]  # they are stored in the order of unsigned numbers
            ends = np.cumsum(pc.fill_null(pc.list_value_length(batch["often"]), 0).to_numpy(zero_copy_only=False))
            often, n = (x.to_numpy() for x in pc.list_flatten(batch["often"]).flatten())
            first = [prefix(x, often[i:j], n[i:j], similarity) if len(x) else x for x, i, j in zip(sets, [0, *ends[:-1].tolist()], ends.tolist(), strict=True)]
            at = pa.array(np.repeat(np.arange(len(sets)), [len(x) for x in first]))
            size = pa.array([len(x) for x in sets], pa.int64())
            place = pa.array(np.concatenate([np.zeros(0, np.int64), *[np.arange(len(x)) for x in first]]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, np.int64), *first])), batch["node"].take(at), size.take(at), place], ["shingle", "node", "size", "place"])

    return of_partition


def _by_prefix(members: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """All pairs (u, v) of nodes of different groups that share a bucket and may resemble each other: those whose prefixes meet.

    members has bucket, node and group, sets has node and shingles. Texts that have frequent passages in common, and else differ, have no rare
    shingle in common, and make no pair. Texts all of whose shingles are frequent meet by bucket too, so unlike ones mostly don't. How often a
    shingle occurs is a table by shingle, of any size; it is joined to the sets that have the frequent ones.
    """
    some = sets.join(members.select("node").distinct(), "node").select("node", "shingles")
    each = some.mapInArrow(with_room(_spelled), "shingle long, node long")
    often = each.groupBy("shingle").agg(F.count("*").alias("n")).where(F.col("n") >= OFTEN)
    of_node = each.join(often, "shingle").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("shingle", "n"))).alias("often"))
    ends = some.join(of_node, "node", "left").mapInArrow(with_room(_prefixes(similarity)), "shingle long, node long, size long, place long")
    rows, at = stored(members.join(ends, "node").select(F.xxhash64("bucket", "shingle").alias("key"), "node", "group", "size", "place"), "prefixes")
    a, b = (rows.select("key", *[F.col(c).alias(f"{side}_{c}") for c in ("node", "group", "size", "place")]) for side in "ab")
    # So many shingles must be common; the first common one comes early enough in both.
    common = F.ceil((F.col("a_size") + F.col("b_size")) * F.lit(similarity / (1 + similarity)) - 1e-9)
    early = (F.col("a_place") <= F.col("a_size") - common) & (F.col("b_place") <= F.col("b_size") - common)
    near = (F.col("a_node") > F.col("b_node")) & (F.col("a_group") != F.col("b_group")) & (F.least("a_size", "b_size") >= similarity * F.greatest("a_size", "b_size")) & early
    return a.join(b, (a.key == b.key) & near).select(F.col("a_node").alias("u"), F.col("b_node").alias("v")).distinct()


def _connected(buckets: DataFrame, pairs: DataFrame, between: Callable[[DataFrame], tuple[DataFrame, Callable[[DataFrame], DataFrame]]], similarity: float) -> DataFrame:
    """Stars (u, v) over all links found among the pairs (u, v) of nodes, and among nodes that share a bucket.

    `between` gets the nodes that may be paired and returns their sets of shingles, and what finds the links among pairs of them.

    First the nodes of a bucket are paired with a head, then, those that no link connects yet, with a head of each of HEADS parts of the bucket; a
    bucket whose nodes are all connected is done. So a group of copies costs a pair for each. Heads are those that meet most others in
    all their buckets: an original comes before its copies; they are found by aggregation, so no task holds a whole bucket. The
    nodes of the buckets that are left, which mostly are unlike, are paired in their buckets where the rare ends of their sets meet, which is exact.
    Links are stored before they are joined up, as a task with two Python functions in a row has two workers, which both stay.
    """
    spark = buckets.sparkSession
    sizes = buckets.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    full, at = stored(buckets.join(sizes, "bucket"), "buckets")
    sets, alike = between(full.select("node").union(pairs.select("u")).union(pairs.select("v")).distinct())
    met = full.groupBy("node").agg(F.sum("n").alias("met"))
    left, left_at = stored(full.join(met, "node").select("bucket", "node", "met", F.col("node").alias("group")), "left")
    dropped(spark, at)
    links, link_at = None, None
    for parts in (1, HEADS):
        best = left.groupBy("bucket", F.pmod(F.xxhash64("node"), F.lit(parts)).alias("part")).agg(F.max(F.struct("met", "node", "group")).alias("k"))
        heads, heads_at = stored(best.select("bucket", F.col("k.node").alias("head"), F.col("k.group").alias("of")), "heads")
        tried = left.join(heads, (left.bucket == heads.bucket) & (left.group != heads.of)).select(F.greatest("node", "head").alias("u"), F.least("node", "head").alias("v"))
        found, found_at = stored(alike((tried.union(pairs.select("u", "v")) if links is None else tried).distinct()), "alike")
        more, more_at = stars(found if links is None else found.union(links.select("u", "v")))
        rest = left.drop("group").join(heads.select("bucket", F.col("head").alias("node")), ["bucket", "node"], "left_anti")
        rest = rest.join(more, F.col("node") == more.u, "left").select("bucket", "node", "met", F.coalesce("v", "node").alias("group"))
        split = rest.groupBy("bucket").agg(F.min("group").alias("least"), F.max("group").alias("most")).where("least < most").select("bucket")
        now, now_at = stored(rest.join(split, "bucket"), "left")
        for x in (left_at, heads_at, link_at, found_at):
            if x:
                dropped(spark, x)
        left, left_at, links, link_at = now, now_at, more, more_at
        if left.isEmpty():
            return links
    found, found_at = stored(alike(_by_prefix(left.select("bucket", "node", "group"), sets, similarity)), "alike")
    out, _ = stars(found.union(links.select("u", "v")))
    dropped(spark, found_at)
    return out


def one_of_each(docs: DataFrame, *, width: int = NEAR_WIDTH, similarity: float = NEAR, radius: int = 3, carried: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, text and the carried columns of one row of each group of copies and near copies: that of the least doc_id.

    Texts whose SimHashes, of their sets of words, are within `radius` bits are candidates, and so are those that share a band of
    a MinHash sketch, as few pairs of so low a resemblance have fingerprints so near. Candidates are compared until all are
    connected or each pair of unconnected ones has been: they are a link if their whole sets of `width`-word shingles resemble each
    other by `similarity` or more. Groups are connected by links; equal texts are one. Texts without words are alike; a null text is
    empty. Null doc_ids come last; of several rows with the least id, that of the least text stays. No rows give no rows. The
    documents are read three times, and shuffled twice.
    """
    spark = docs.sparkSession
    prepare(spark)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *[F.col(c).alias(f"_{c}") for c in carried])
    own = own.withColumn("node", F.xxhash64(F.coalesce("text", F.lit(""))))
    rows, rows_at = stored(own.select("doc_id", "node", "text").mapInArrow(with_room(_described(width)), "doc_id long, node long, fp long, sketch binary"), "words")
    nodes, nodes_at = stored(rows.groupBy("node").agg(F.min("fp").alias("fp"), F.min("doc_id").alias("least"), F.max("sketch").alias("sketch")), "nodes")
    dropped(spark, rows_at)
    # Of the texts with one fingerprint the least stands for all towards other fingerprints; they are pairs with it themselves.
    of_fp = nodes.groupBy("fp").agg(F.min("node").alias("node"), F.count("*").alias("n"))
    near = links(of_fp, radius)
    ends = lambda side, to: of_fp.select(F.col("fp").alias(side), F.col("node").alias(to))
    pairs = near.join(ends("u", "a"), "u").join(ends("v", "b"), "v").select(F.col("a").alias("u"), F.col("b").alias("v"))
    same = nodes.select("node", "fp").join(of_fp.where("n > 1").select("fp", F.col("node").alias("v")), "fp").where("node <> v").select(F.col("node").alias("u"), "v")
    pairs, pairs_at = stored(pairs.union(same).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), "pairs")
    # Joined on text and id together: a text that many rows share doesn't go to one task.
    pick = lambda id_: F.xxhash64(F.col("node"), F.coalesce(F.col(id_), F.lit(0)), F.col(id_).isNull())

    def between(some: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
        """By their whole sets of shingles, from the texts read again."""
        wanted = nodes.join(some, "node").select(pick("least").alias("pick"))
        texts = own.select("doc_id", "node", "text").withColumn("pick", pick("doc_id")).join(wanted, "pick").select("node", "text")
        sets, _ = stored(texts.mapInArrow(with_room(_shingled(width)), "node long, shingles binary").groupBy("node").agg(F.max("shingles").alias("shingles")), "shingles")
        of = lambda side, name: sets.select(F.col("node").alias(side), F.col("shingles").alias(name))
        return sets, lambda pairs: pairs.join(of("u", "a"), "u").join(of("v", "b"), "v").select("u", "v", "a", "b").mapInArrow(with_room(_alike(similarity)), "u long, v long")

    grouped = _connected(nodes.select("node", "sketch").mapInArrow(with_room(_bands), "bucket long, node long"), pairs, between, similarity)
    dropped(spark, pairs_at)
    member = nodes.join(grouped, nodes.node == grouped.u, "left").select("node", "least", F.coalesce("v", "node").alias("group"))
    stays = member.groupBy("group").agg(F.min(F.struct(F.col("least").isNull().alias("none"), "least", "node")).alias("k")).select(F.col("k.least").alias("kept_id"), F.col("k.node").alias("node"))
    kept = own.withColumn("pick", pick("doc_id")).join(stays.select(pick("kept_id").alias("pick")), "pick")
    nth = F.row_number().over(Window.partitionBy("pick").orderBy(F.coalesce("text", F.lit(""))))
    return kept.withColumn("nth", nth).where("nth = 1").select("doc_id", "text", *[F.col(f"_{c}").alias(c) for c in carried])
