"""What the operators of this package share: scratch tables, partition keys and text arrays."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator
from contextlib import suppress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataloom.session import importable

U64 = np.uint64
#: Rows and bytes of one Arrow batch, where the session says nothing else. Long texts make rows large.
BATCH_ROWS, BATCH_BYTES = "1024", "4m"


def prepare(spark: SparkSession) -> None:
    """Lets Python workers import this package, and bounds their Arrow batches where the session leaves them at Spark's own limits."""
    importable(spark)
    for key, usual, value in (("maxRecordsPerBatch", 10000, BATCH_ROWS), ("maxBytesPerBatch", 64 << 20, BATCH_BYTES)):
        name = f"spark.sql.execution.arrow.{key}"
        if _bytes(spark.conf.get(name, str(usual))) == usual:
            spark.conf.set(name, value)


def _bytes(size: str) -> int:
    """A number of bytes as Spark's settings have it."""
    number = size.strip().lower().rstrip("b")
    return int(number.rstrip("kmg")) << {"k": 10, "m": 20, "g": 30}.get(number[-1:], 0)


def partitions(spark: SparkSession) -> int:
    """The number of shuffle partitions, which a cluster sets to suit its input."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def scratch(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. Without it there is none, and a guess would lose data."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return at.rstrip("/")


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Writes a table to the shared folder and reads it again, which cuts its lineage."""
    at = f"{scratch(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at), at


def dropped(spark: SparkSession, at: str) -> None:
    """Deletes a table that stored() wrote."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(at)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: What empties the caches that operators keep from task to task in a Python worker.
caches: list[Callable[[], None]] = []


def cleared() -> None:
    """Gives the system back what tasks of this process have cached or freed."""
    for clear in caches:
        clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    with suppress(AttributeError, OSError):  # the C library may not be glibc
        ctypes.CDLL(None).malloc_trim(0)


def with_room(f: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A partition's function, begun without what other operators' tasks have left: Spark's workers go on from stage to stage and keep what they took."""

    def of_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cleared()
        yield from f(batches)

    return of_partition


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- partition keys -----------------------------------------------------------------------------


def _murmur3(x: int) -> int:
    """Spark's hash() of an int, as a signed 32-bit number."""
    m, rot = 0xFFFFFFFF, lambda v, n: ((v << n) | (v >> (32 - n))) & 0xFFFFFFFF
    h = 42 ^ (rot(x * 0xCC9E2D51 & m, 15) * 0x1B873593 & m)
    h = (rot(h, 13) * 5 + 0xE6546B64) & m ^ 4
    h = (h ^ (h >> 16)) * 0x85EBCA6B & m
    h = (h ^ (h >> 13)) * 0xC2B2AE35 & m
    h ^= h >> 16
    return h - (1 << 32) if h >> 31 else h


def even_keys(n: int) -> list[int]:
    """n ints of which Spark's hash partitioning sends each to a partition of its own."""
    keys: dict[int, int] = {}
    x = 0
    while len(keys) < n:
        keys.setdefault(_murmur3(x) % n, x)
        x += 1
    return [keys[i] for i in range(n)]


def dealt(of: Column | list[Column], keys: list[int]) -> Column:
    """One of the keys, chosen by a hash of columns."""
    hashed = F.xxhash64(*(of if isinstance(of, list) else [of]))
    return F.element_at(F.array(*[F.lit(k) for k in keys]), (F.pmod(hashed, F.lit(len(keys))) + 1).cast("int")).cast("int")


# --- text arrays ---------------------------------------------------------------------------------


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column end to end, and where each row starts; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
    return raw, off - off[0]


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def words(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word `[^\\x20\\x09-\\x0D]+`, and at which word each row starts."""
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    solid = ~_SPACE[raw]
    first = np.empty(len(raw), bool)
    first[0] = True
    np.logical_not(solid[:-1], out=first[1:])
    cuts = off[:-1][off[:-1] < len(raw)]
    first[cuts] = True
    last = np.empty(len(raw), bool)
    last[-1] = True
    np.logical_not(solid[1:], out=last[:-1])
    last[cuts[cuts > 0] - 1] = True
    start, end = np.flatnonzero(solid & first), np.flatnonzero(solid & last) + 1
    return start, end, np.searchsorted(start, off)


def word_end(raw: np.ndarray, at: int) -> int:
    """The first place from `at` on that no word goes on at."""
    for i in range(at, len(raw), 1 << 16):
        if len(found := np.flatnonzero(_SPACE[raw[i : i + (1 << 16)]])):
            return i + int(found[0])
    return len(raw)


def mixed(x: np.ndarray) -> np.ndarray:
    """A finalizer that spreads every bit of uint64 values (splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


def numbers(n: int, seed: int) -> np.ndarray:
    """n fixed pseudo-random uint64 values, the same on every machine."""
    with np.errstate(over="ignore"):
        return mixed((np.arange(1, n + 1, dtype=U64) + U64(seed) * U64(0x632BE59BD9B4E019)) * U64(0x9E3779B97F4A7C15))


BYTE = numbers(256, 7)
BASE = 0x9E6C63D0876A9A35
#: Longer spans are hashed one by one: a polynomial modulo 2**64 has known collisions from about a thousand bytes on.
SHORT_SPAN, SPAN_BLOCK = 64, 1 << 20


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(max(n, 1), U64)
    done, step = 1, base
    with np.errstate(over="ignore"):
        while done < n:
            more = min(done, n - done)
            np.multiply(out[:more], U64(step), out=out[done : done + more])
            done, step = done + more, step * step % (1 << 64)
    return out


_tables: list[np.ndarray] = []


def _short_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    if not _tables:
        n = SPAN_BLOCK + SHORT_SPAN + 1
        _tables[:] = [_powers(BASE, n), _powers(pow(BASE, -1, 1 << 64), n)]
    up, down = _tables
    with np.errstate(over="ignore"):
        total = np.zeros(len(raw) + 1, U64)
        np.cumsum(BYTE[raw] * up[: len(raw)], out=total[1:])
        return mixed((total[end] - total[start]) * down[start] + (end - start).astype(U64) * U64(0xD6E8FEB86659FD93))


def span_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes, spans in ascending order; equal bytes, equal hash. A block of the bytes at a time."""
    out = np.zeros(len(start), U64)
    for lo in range(0, len(raw), SPAN_BLOCK):
        i, j = np.searchsorted(start, [lo, lo + SPAN_BLOCK])
        a, b = start[i:j] - lo, end[i:j] - lo
        out[i:j] = _short_hashes(raw[lo : lo + SPAN_BLOCK + SHORT_SPAN], a, np.minimum(b, a + SHORT_SPAN))
    for k in np.flatnonzero(end - start > SHORT_SPAN).tolist():
        out[k] = xxhash.xxh3_64_intdigest(raw[start[k] : end[k]].data)
    return out


def pieces(off: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Ranges of rows of about `most` bytes each; a longer row is a range of its own."""
    out, i, n = [], 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + most, "right")) - 1)
        out.append((i, j))
        i = j
    return out
