"""Character n-gram classifier scaled by naive Bayes log-count ratios (operator 5)."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataloom.llm.common import dropped, prepare, stored

#: Twice as many features, or all buckets, tell no more of a sample of this size (README).
ORDERS, BITS, FEATURES = (3, 4, 5), 18, 2048
#: The classifier is fitted on so many labelled rows at most, those of the least hash; all texts are scored.
MOST_ROWS = 6000
CHUNK, TRAIN_TASKS = 1 << 12, 8
THRESHOLD, HELD_OUT = 0.3, 2
SHARE = 1000.0  # a feature's value is the square root of its occurrences in so many n-grams


def characters(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the lower-cased texts, each between blanks, and where each starts; null is empty."""
    low = [f" {(t or '').lower()} " for t in texts]
    return np.frombuffer("".join(low).encode("utf-32-le"), np.uint32), np.append(0, np.cumsum([len(t) for t in low]))


def grams(code: np.ndarray, order: int) -> np.ndarray:
    """A bucket for each run of `order` code points."""
    n = max(0, len(code) - order + 1)
    with np.errstate(over="ignore"):
        h = np.full(n, order * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
        for i in range(order):
            h *= np.uint32(0x01000193)
            h ^= code[i : i + n]
            h *= np.uint32(0x85EBCA6B)
        return (h ^ (h >> np.uint32(15))) * np.uint32(0xC2B2AE35) >> np.uint32(32 - BITS)


@dataclass
class Classifier:
    """place of each bucket among the features (-1: none), the features' weights, log-count ratio included, and the bias."""

    place: np.ndarray
    weight: np.ndarray
    bias: float

    def score(self, texts: list[str | None]) -> np.ndarray:
        out = np.zeros(len(texts))
        size = np.cumsum([len(t or "") for t in texts])
        i = 0
        while i < len(texts):  # about a quarter of a million characters at a time
            j = max(i + 1, int(np.searchsorted(size, (size[i - 1] if i else 0) + (1 << 18), "right")))
            out[i:j] = self._sums(texts[i:j])
            i = j
        return 1 / (1 + np.exp(-np.clip(out + self.bias, -500, 500)))

    def _sums(self, texts: list[str | None]) -> np.ndarray:
        code, off = characters(texts)
        found, n, features = [], np.zeros(len(texts)), max(1, len(self.weight))
        for order in ORDERS:
            place = self.place[grams(code, order)]
            at = np.flatnonzero(place >= 0)
            text = np.searchsorted(off, at, "right") - 1
            inside = at + order <= off[text + 1]
            found.append(text[inside] * features + place[at[inside]])
            n += np.maximum(np.diff(off) - order + 1, 0)
        key, count = np.unique(np.concatenate(found), return_counts=True)
        text, feature = np.divmod(key, features)
        return np.bincount(text, self.weight[feature] * np.sqrt(SHARE * count / n[text]), len(texts)) if len(key) else np.zeros(len(texts))


def _buckets(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """A text's buckets and the number of n-grams in each."""
    code, _ = characters([text])
    return np.unique(np.concatenate([grams(code, order) for order in ORDERS]), return_counts=True)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many clean and toxic texts of a partition have each bucket: a row for each CHUNK buckets."""
    has = np.zeros((2, 1 << BITS), np.int64)
    for batch in batches:
        for text, label in zip(batch["text"].to_pylist(), batch["label"].to_pylist(), strict=True):
            has[label][_buckets(text)[0]] += 1
    starts = range(0, 1 << BITS, CHUNK)
    yield pa.RecordBatch.from_arrays([pa.array(starts, pa.int32()), pa.array([has[:, i : i + CHUNK].tobytes() for i in starts], pa.binary())], ["chunk", "has"])


def _summed(rows: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x, np.int64) for x in rows["has"].to_pylist())
    return pa.table({"chunk": pa.array([rows["chunk"][0].as_py()], pa.int32()), "has": pa.array([total.tobytes()], pa.binary())})


def _shares(chosen: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A labelled text's features, those it has, and their values."""
    place = np.full(1 << BITS, -1)
    place[chosen] = np.arange(len(chosen))

    def of_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            features, values = [], []
            for text in batch["text"].to_pylist():
                bucket, n = _buckets(text)
                at = place[bucket]
                features.append(at[at >= 0].astype(np.uint16).tobytes())
                values.append(np.sqrt(SHARE * n[at >= 0] / n.sum()).astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays([batch["label"], pa.array(features, pa.binary()), pa.array(values, pa.binary())], ["label", "at", "x"])

    return of_partition


def told(has: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The FEATURES buckets that tell most, and each one's log-count ratio, from how many texts of each label have it."""
    n = texts + 2
    ratio = np.log((has[1] + 1) / n[1]) - np.log((has[0] + 1) / n[0])
    expected = has.sum(axis=0) * n[1] / n.sum()
    tells = np.where(has.sum(axis=0) > 4, np.abs(has[1] - expected) / np.sqrt(expected + 1), 0)
    chosen = np.sort(np.argsort(-tells, kind="stable")[:FEATURES])
    return chosen, ratio[chosen]


def fit(y: np.ndarray, x: np.ndarray, chosen: np.ndarray, ratio: np.ndarray, *, steps: int = 200, penalty: float = 0.002) -> Classifier:
    """A logistic regression on the chosen features, scaled by their log-count ratios (Adam on the whole sample)."""
    x = x * ratio.astype(np.float32)
    w, b = np.zeros(len(chosen), np.float32), np.float32(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    m, v, m_b, v_b = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for step in range(1, steps + 1):
        off = 1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30))) - y
        g, g_b = (x.T @ off.astype(np.float32)) / len(y) + penalty * w, float(off.mean())
        m, v, m_b, v_b = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g, 0.9 * m_b + 0.1 * g_b, 0.99 * v_b + 0.01 * g_b * g_b
        fix_m, fix_v = 1 - 0.9**step, 1 - 0.99**step
        w = w - 0.03 * (m / fix_m) / (np.sqrt(v / fix_v) + 1e-8)
        b = b - 0.03 * (m_b / fix_m) / (np.sqrt(v_b / fix_v) + 1e-8)
    place = np.full(1 << BITS, -1)
    place[chosen] = np.arange(len(chosen))
    return Classifier(place, w * ratio, float(b))


def held_out(doc_id: Column) -> Column:
    """Rows that training never sees."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == HELD_OUT, F.lit(False))


def trained(docs: DataFrame, labels: DataFrame, *, most_rows: int = MOST_ROWS) -> Classifier:
    """Fits a classifier on labelled rows that aren't held out, `most_rows` at most.

    Copies of a text are one text, of the label that most of them have (ties: 1). Without both labels there is nothing to
    learn: every score is then the share of toxic texts, smoothed. The driver gets fixed-size counts, and of each
    row the features that it has, FEATURES at most.
    """
    spark = docs.sparkSession
    prepare(spark)
    id_ = F.col("doc_id").cast("long")
    known = labels.select(id_.alias("doc_id"), F.col("toxic").cast("int").alias("label")).where("doc_id IS NOT NULL AND label IS NOT NULL").where(~held_out(F.col("doc_id")))
    some = known.groupBy("doc_id").agg((F.max("label") > 0).cast("int").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_rows)
    texts = docs.select(id_.alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(F.broadcast(some), "doc_id")
    texts = texts.groupBy(F.md5("text").alias("digest")).agg(F.first("text").alias("text"), (F.avg("label") >= 0.5).cast("int").alias("label"))
    rows, at = stored(texts.select("digest", "text", "label"), "labelled")
    n = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if min(n.get(0, 0), n.get(1, 0)) == 0:
        return Classifier(np.full(1 << BITS, -1), np.zeros(0), float(np.log((n.get(1, 0) + 1) / (n.get(0, 0) + 1))))
    rows = rows.repartition(TRAIN_TASKS)
    sums = rows.select("text", "label").mapInArrow(_frequencies, "chunk int, has binary").groupBy("chunk").applyInArrow(_summed, "chunk int, has binary").collect()
    has = np.concatenate([np.frombuffer(r["has"], np.int64).reshape(2, CHUNK) for r in sorted(sums, key=lambda r: r["chunk"])], axis=1)
    chosen, ratio = told(has, np.array([n[0], n[1]]))
    got = sorted(rows.select("label", "text").mapInArrow(_shares(chosen), "label int, at binary, x binary").collect())
    dropped(spark, at)
    y = np.array([r["label"] for r in got], np.float64)
    x = np.zeros((len(got), len(chosen)), np.float32)
    for row, r in zip(x, got, strict=True):
        row[np.frombuffer(r["at"], np.uint16)] = np.frombuffer(r["x"], np.float32)
    return fit(y, x, chosen, ratio)


def _score(shared) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def of_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = pa.array(shared.value.score(batch["text"].to_pylist()))
            yield pa.RecordBatch.from_arrays([*batch.columns, score], [*batch.schema.names, "score"])

    return of_partition


def scored(docs: DataFrame, labels: DataFrame, *, carried: tuple[str, ...] = (), most_rows: int = MOST_ROWS) -> DataFrame:
    """doc_id, text, the carried columns with a leading underscore, and score, by a classifier trained on the labels."""
    model = docs.sparkSession.sparkContext.broadcast(trained(docs, labels, most_rows=most_rows))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *[F.col(c).alias(f"_{c}") for c in carried])
    return own.mapInArrow(_score(model), ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema], "score double"]))


def toxicity(docs: DataFrame, labels: DataFrame, *, threshold: float = THRESHOLD, most_rows: int = MOST_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted of each row.

    Null texts are empty; an empty text has the score of the bias alone. A null doc_id isn't held out. Of a doc_id's
    several labels the largest counts, null labels don't. Repeated rows each return. No rows give no rows.
    """
    return scored(docs, labels, most_rows=most_rows).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, *, threshold: float = THRESHOLD, carried: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, text and the carried columns of the rows that score below the threshold; see toxicity()."""
    kept = scored(docs, labels, carried=carried).where(F.col("score") < threshold)
    return kept.select("doc_id", "text", *[F.col(f"_{c}").alias(c) for c in carried])
