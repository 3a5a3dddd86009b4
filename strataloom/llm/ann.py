"""Nearest neighbours with a permutation index (operator 6).

Pivots are a bounded sample of the vectors. A vector is represented by its NEAREST pivots, nearest first, and posted in the
inverted file of the first. A query visits the files of its first pivots, where candidates are ranked by the footrule distance
between the two orders, and those that are near enough are reranked by their true distance. The number of pivots grows with the
square root of that of the vectors, and so does the length of a file; a longer file is cut into parts.

How many files a query visits and how near a candidate's order must be is measured, not guessed: a survey finds the true
neighbours of SAMPLE rows among all rows, and both are set so that the wanted part of these would be found. Where vectors
lie in clusters that is a small part of the files; where they lie about evenly in many dimensions, as random ones do, it is most.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import ceil, isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataloom.llm.common import U64, even_keys, mixed, partitions, prepare

#: Pivots: so many times the square root of the number of vectors, within these limits.
PER_ROOT, FEWEST, MOST = 4, 32, 16384
NEAREST, TOP = 32, 10
#: Rows whose neighbours are surveyed, and the part of their neighbours that the index is to find.
SAMPLE, AIM = 96, 0.96
#: A part of a file holds about so many vectors; so many pairs are compared at once.
PART, PAIRS = 4096, 1 << 16


def permutations(x: np.ndarray, pivots: np.ndarray, nearest: int) -> np.ndarray:
    """The nearest pivots of each vector, nearest first, ties to the smaller pivot."""
    out = np.zeros((len(x), min(nearest, len(pivots))), np.int32)
    for i in range(0, len(x), 1024):
        far = (pivots**2).sum(1)[None] - 2 * x[i : i + 1024] @ pivots.T
        k = out.shape[1]
        some = np.sort(np.argpartition(far, k - 1, axis=1)[:, :k], axis=1) if k < len(pivots) else np.tile(np.arange(k), (len(far), 1))
        out[i : i + 1024] = np.take_along_axis(some, np.argsort(np.take_along_axis(far, some, 1), axis=1, kind="stable"), 1)
    return out


def footrule(orders: np.ndarray, queries: np.ndarray, n_pivots: int) -> np.ndarray:
    """How near each query's order (row) is to each vector's (column): the larger, the smaller their footrule distance.

    A pivot that an order lacks stands at its end, place k. The distance of two orders is then the same for all less twice the sum
    of k - max(place, place) over the pivots that they share.
    """
    k = orders.shape[1]
    gain = np.zeros((len(queries), n_pivots), np.int16)  # k - place of each pivot
    np.put_along_axis(gain, queries, np.arange(k, 0, -1, dtype=np.int16)[None], axis=1)
    own = np.arange(k, 0, -1, dtype=np.int16)
    out = np.zeros((len(queries), len(orders)), np.int32)
    for place in range(k):
        out += np.minimum(gain[:, orders[:, place]], own[place])
    return out


def searched(x: np.ndarray, orders: np.ndarray, q: np.ndarray, q_orders: np.ndarray, n_pivots: int, top: int, gain: int) -> tuple[np.ndarray, ...]:
    """For the queries of one file, whose vectors are in the order of their ids: numbers of query and vector, and their distance.

    Of each query's candidates those whose orders gain so much, and the `top` that gain most (ties to the smaller id), are reranked; the
    nearest `top` of these stay.
    """
    n, out = len(x), []
    for i in range(0, len(q), max(1, PAIRS // n)):
        some = slice(i, i + max(1, PAIRS // n))
        near = footrule(orders, q_orders[some], n_pivots)
        wanted = near >= gain
        if n > top:
            best = near.astype(np.int64) * n + np.arange(n - 1, -1, -1)
            np.put_along_axis(wanted, np.argpartition(-best, top - 1, axis=1)[:, :top], True, axis=1)
        else:
            wanted[:] = True
        who, which = np.nonzero(wanted)
        far = np.sqrt(((x[which] - q[some][who]) ** 2).sum(axis=1))
        order = np.lexsort((which, far, who))
        who, which, far = who[order], which[order], far[order]
        nth = np.arange(len(who)) - np.searchsorted(who, who)
        keep = nth < top
        out.append((who[keep] + i, which[keep], far[keep]))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _vectors(t: pa.Table | pa.RecordBatch, name: str, dim: int) -> np.ndarray:
    column = t[name].combine_chunks() if isinstance(t[name], pa.ChunkedArray) else t[name]
    return (column.flatten().to_numpy(zero_copy_only=False) if len(column) else np.zeros(0)).astype(np.float64).reshape(-1, dim)


def files_of(order: np.ndarray, size: np.ndarray, probed: int, least: int) -> list[np.ndarray]:
    """The files that each query visits: those of its first `probed` pivots, and more until they hold `least` vectors."""
    held = np.cumsum(size[order], axis=1)
    n = np.maximum(probed, 1 + (held < least).sum(axis=1))
    return [o[:k] for o, k in zip(order, n.tolist(), strict=True)]


def chosen(ranks: list[int], gains: list[int], aim: float) -> tuple[int, int]:
    """How many files to visit and how much an order must gain, so that each alone misses half of what may be missed of the surveyed neighbours."""
    missed = (1 - aim) / 2
    return 1 + int(np.quantile(ranks, 1 - missed, method="higher")), int(np.quantile(gains, missed, method="lower"))


def _survey(shared, nearest: int, top: int, dim: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A partition's number of vectors in each file, and the nearest rows to each surveyed one: their distance, the place of their file in
    the surveyed row's order, and what their orders gain."""

    def of_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots, ids, q = shared.value
        size, whole = np.zeros(len(pivots), np.int64), permutations(q, pivots, len(pivots))
        place = np.argsort(whole, axis=1)
        far, rank, gain = np.full((len(q), top), np.inf), np.zeros((len(q), top), np.int64), np.zeros((len(q), top), np.int64)
        for batch in batches:
            x, own = _vectors(batch, "x", dim), batch["vec_id"].to_numpy()
            order = permutations(x, pivots, nearest)
            size += np.bincount(order[:, 0], minlength=len(pivots))
            now = np.maximum(0, (q**2).sum(1)[:, None] - 2 * q @ x.T + (x**2).sum(1)[None])
            now[(own[None] == ids[:, None]) & (now < 1e-9)] = np.inf
            both = np.concatenate([far, now], axis=1)
            best = np.argpartition(both, top - 1, axis=1)[:, :top]
            # Only rows that come among the nearest are looked at more closely.
            new = np.unique(best[best >= top]) - top
            near = np.zeros((len(q), len(x)), np.int64)
            near[:, new] = footrule(order[new], whole[:, :nearest], len(pivots))
            gain = np.take_along_axis(np.concatenate([gain, near], axis=1), best, 1)
            rank = np.take_along_axis(np.concatenate([rank, place[:, order[:, 0]]], axis=1), best, 1)
            far = np.take_along_axis(both, best, 1)
        some, files = np.nonzero(np.isfinite(far).reshape(-1))[0], np.flatnonzero(size)
        columns = {
            "key": np.concatenate([some // top, files]), "far": np.concatenate([far.reshape(-1)[some], np.full(len(files), -1.0)]),
            "rank": np.concatenate([rank.reshape(-1)[some], np.zeros(len(files), np.int64)]), "gain": np.concatenate([gain.reshape(-1)[some], size[files]]),
        }
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], list(columns))

    return of_partition


def _posted(shared, visits, nearest: int, dim: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Each vector with its first pivot, the part of that file that it is in, the part's shard, and its order."""

    def of_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = visits.value[-1]
        parts = np.array([len(s) for s in shards])
        for batch in batches:
            x = _vectors(batch, "x", dim)
            order = permutations(x, shared.value[0], nearest)
            with np.errstate(over="ignore"):
                part = (mixed(x.view(U64).sum(axis=1) ^ mixed(batch["vec_id"].to_numpy().astype(U64))) % parts[order[:, 0]].astype(U64)).astype(np.int32)
            shard = [shards[f][k] for f, k in zip(order[:, 0].tolist(), part.tolist(), strict=True)]
            whole = pa.array([o.astype(np.uint16).tobytes() for o in order], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), pa.array(order[:, 0]), pa.array(part), batch["vec_id"], batch["x"], whole], ["shard", "pivot", "part", "vec_id", "x", "order"])

    return of_partition


def _asked(shared, visits, dim: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A row of each query for each shard that has a part of a file that it visits."""

    def of_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, probed, least, shards = visits.value
        for batch in batches:
            order = permutations(_vectors(batch, "x", dim), shared.value[0], len(size))
            to = [sorted({s for f in files.tolist() for s in shards[f]}) for files in files_of(order, size, probed, least)]
            at = pa.array(np.repeat(np.arange(len(to)), [len(t) for t in to]))
            yield pa.RecordBatch.from_arrays([pa.array([s for t in to for s in t], pa.int32()), batch["vec_id"].take(at), batch["x"].take(at)], ["shard", "vec_id", "x"])

    return of_partition


def _search(shared, visits, nearest: int, top: int, gain: int, dim: int) -> Callable[[tuple, pa.Table, pa.Table], pa.Table]:
    def of_shard(key: tuple, vectors: pa.Table, queries: pa.Table) -> pa.Table:
        rows = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        if len(vectors) and len(queries):
            (pivots, *_), (size, probed, least, _) = shared.value, visits.value
            pivot, part, ids = (vectors[c].to_numpy() for c in ("pivot", "part", "vec_id"))
            order = np.lexsort((ids, part, pivot))
            pivot, part, ids, x = pivot[order], part[order], ids[order], _vectors(vectors, "x", dim)[order]
            orders = np.frombuffer(b"".join(vectors["order"].to_pylist()), np.uint16).reshape(len(order), -1)[order].astype(np.int32)
            q, q_ids = _vectors(queries, "x", dim), queries["vec_id"].to_numpy()
            whole = permutations(q, pivots, len(pivots))
            visitors: dict[int, list[int]] = {}
            for k, files in enumerate(files_of(whole, size, probed, least)):
                for f in files.tolist():
                    visitors.setdefault(f, []).append(k)
            first = np.flatnonzero(np.concatenate([[True], (np.diff(pivot) != 0) | (np.diff(part) != 0)]))
            for a, b in zip(first.tolist(), [*first[1:].tolist(), len(order)], strict=True):
                if (who := visitors.get(int(pivot[a]))) is not None:
                    # One more than are wanted, as the query's own row may be among them.
                    which, found, far = searched(x[a:b], orders[a:b], q[who], whole[who, :nearest], len(pivots), top + 1, gain)
                    rows.append((q_ids[who][which], ids[a:b][found], far))
        a, b, c = (np.concatenate(r) for r in zip(*rows, strict=True))
        if len(a):  # of each query the nearest of all of the shard's files
            order = np.lexsort((b, c, a))
            a, b, c = a[order], b[order], c[order]
            keep = np.arange(len(a)) - np.searchsorted(a, a) <= top
            a, b, c = a[keep], b[keep], c[keep]
        return pa.table({"query_id": pa.array(a, pa.int64()), "vec_id": pa.array(b, pa.int64()), "score": pa.array(c, pa.float64())})

    return of_shard


def neighbours(vectors: DataFrame, *, every: int = 100, top: int = TOP, per_root: int = PER_ROOT, nearest: int = NEAREST, sample: int = SAMPLE, aim: float = AIM, part: int = PART) -> DataFrame:
    """query_id, rank, vec_id and score: the nearest vectors found to each row whose vec_id is divisible by `every`.

    Rows without a vec_id, and vectors that are null, zero, of another length than most (ties: the shorter), or that hold
    null, NaN or infinite components, take no part. Of several rows with a query's vec_id that of the least vector is the query, the
    others are candidates; a candidate that stands several times is found as often. Equal distances go by vec_id. Without candidates
    a query has no rows; no rows, no result. A vector is sent to one shard, a query once to each shard that has a file that it visits,
    and a shard sends on `top` rows and one for it. The driver gets the pivots, the files' sizes and the survey's rows.
    """
    spark = vectors.sparkSession
    prepare(spark)
    component = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    kind = vectors.schema["embedding"].dataType.simpleString()
    own = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind if kind == "array<float>" else "array<double>").alias("x")).where("vec_id IS NOT NULL AND x IS NOT NULL")
    own = own.where(F.forall("x", component) & F.exists("x", lambda c: c != 0))
    sizes = own.groupBy(F.size("x").alias("n")).count().orderBy(F.desc("count"), "n").first()
    dim, total = (sizes["n"], sizes["count"]) if sizes else (1, 0)
    own = own.where(F.size("x") == dim)
    n_pivots = min(MOST, max(FEWEST, per_root * isqrt(total)))
    # A hash thins the rows to several times what is taken, so that the tasks don't all send as many.
    thinned = lambda n: own.where(F.pmod(F.xxhash64("x"), F.lit(max(1, total // (4 * n)))) == 0).groupBy("x").agg(F.min("vec_id").alias("vec_id"))
    pivots = _vectors(thinned(n_pivots).orderBy(F.xxhash64("x"), "x").limit(n_pivots).toArrow(), "x", dim)
    surveyed = thinned(max(n_pivots, sample)).orderBy(F.desc(F.xxhash64("x")), "x").limit(sample).toArrow()
    shared = spark.sparkContext.broadcast((pivots, surveyed["vec_id"].to_numpy(), _vectors(surveyed, "x", dim)))  # MOST and SAMPLE vectors at most
    told = own.mapInArrow(_survey(shared, nearest, top, dim), "key long, far double, rank long, gain long") if total else spark.createDataFrame([], "key long, far double, rank long, gain long")
    files = told.where("far < 0").groupBy("key").agg(F.lit(-1.0).alias("far"), F.lit(0).cast("long").alias("rank"), F.sum("gain").alias("gain"))
    nearest_rows = told.where("far >= 0").withColumn("nth", F.row_number().over(Window.partitionBy("key").orderBy("far"))).where(F.col("nth") <= top).drop("nth")
    size, ranks, gains = np.zeros(len(pivots), np.int64), [0], [0]
    for r in files.unionByName(nearest_rows).collect():
        if r["far"] < 0:
            size[r["key"]] = r["gain"]
        else:
            ranks.append(r["rank"]), gains.append(r["gain"])
    probed, gain = chosen(ranks[1:] or ranks, gains[1:] or gains, aim)
    keys = even_keys(partitions(spark))
    parts = np.maximum(1, -(-size // part))
    # A file's parts go to shards one after the other; files go round, the longest first, so that shards are about alike.
    shards, turn = [[] for _ in size], 0
    for f in np.argsort(-size, kind="stable").tolist():
        shards[f] = [keys[(turn + k) % len(keys)] for k in range(int(parts[f]))]
        turn += int(parts[f])
    visits = spark.sparkContext.broadcast((size, probed, 4 * (top + 1), shards))
    vector = f"x {own.schema['x'].dataType.simpleString()}"
    left = own.mapInArrow(_posted(shared, visits, nearest, dim), f"shard int, pivot int, part int, vec_id long, {vector}, order binary")
    asked = own.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("x").alias("x"))
    right = asked.mapInArrow(_asked(shared, visits, dim), f"shard int, vec_id long, {vector}")
    found = left.groupBy("shard").cogroup(right.groupBy("shard")).applyInArrow(_search(shared, visits, nearest, top, gain, dim), "query_id long, vec_id long, score double")
    # The query's own row goes: of the rows with its id and no distance, one.
    mine = (F.col("vec_id") == F.col("query_id")) & (F.col("score") == 0)
    of_query = Window.partitionBy("query_id")
    ranked = found.withColumn("mine", mine).withColumn("nth", F.row_number().over(of_query.orderBy(F.desc("mine"), "score", "vec_id"))).where(F.col("nth") <= top + 1)
    others = ranked.where(~(F.col("mine") & (F.col("nth") == 1)))
    return others.withColumn("rank", F.row_number().over(of_query.orderBy("score", "vec_id"))).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")
