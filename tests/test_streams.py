"""Streams in any order of arrival against the batch plans over the same rows."""

from __future__ import annotations

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from strataloom.operators import breaker, records
from strataloom.streaming.breaker import stream_breaker
from strataloom.streaming.spool import stream_answered

START = datetime(2026, 1, 1, tzinfo=timezone.utc)


def after(seconds: float) -> datetime:
    return START + timedelta(seconds=seconds)


def landed(spark, rows, schema, folder, batches):
    """Writes rows as files, one for each micro-batch, and reads them as a stream in the order of writing."""
    for n, some in enumerate(batches):
        spark.createDataFrame([rows[i] for i in some], schema).coalesce(1).write.parquet(str(folder / f"{n:03d}"))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(folder))


def taken(spark, stream, name, folder):
    stream.writeStream.format("memory").queryName(name).option("checkpointLocation", str(folder)).trigger(availableNow=True).start().awaitTermination()
    return spark.table(name).collect()


@pytest.mark.parametrize("seed", range(3))
def test_stream_breaker_in_any_order(spark, tmp_path, seed):
    """Calls come shuffled within the delay, over several micro-batches; the last one's time lets all others pass."""
    rng = random.Random(seed)
    calls = [(k, i, after(i * 10 + rng.randrange(5)), rng.random() < 0.6) for k in ("a", "b") for i in range(24)]
    come = sorted(range(len(calls)), key=lambda i: calls[i][2] + timedelta(seconds=rng.randrange(50)))
    batches = [come[i : i + 7] for i in range(0, len(come), 7)]
    rows = [*calls, ("end", 0, after(10_000), False), ("end", 1, after(20_000), False)]
    schema = "key string, seq long, at timestamp, failed boolean"
    stream = landed(spark, rows, schema, tmp_path / "in", [*batches, [len(calls)], [len(calls) + 1]])
    got = taken(spark, stream_breaker(stream, cooldown=35, delay="60 seconds"), f"sent{seed}", tmp_path / "c")
    batch = breaker.with_cooldown(spark.createDataFrame(calls, schema), "key", "at", "failed", "seq", cooldown=35)
    assert sorted((r["key"], r["seq"], r["sent"], r["open"]) for r in got if r["key"] != "end") == sorted(map(tuple, batch.collect()))


def test_stream_breaker_wakes_a_silent_key(spark, tmp_path):
    """A key's last calls are decided when time passes, though none of its own come any more."""
    rows = [("a", 0, after(0), True), ("a", 1, after(5), True), ("a", 2, after(9), True), ("b", 0, after(500), False), ("b", 1, after(900), False)]
    stream = landed(spark, rows, "key string, seq long, at timestamp, failed boolean", tmp_path / "in", [[2], [0, 1], [3], [4]])
    got = taken(spark, stream_breaker(stream, cooldown=60, delay="30 seconds"), "woken", tmp_path / "c")
    assert sorted((r["key"], r["seq"], r["sent"]) for r in got if r["key"] == "a") == [("a", 0, True), ("a", 1, True), ("a", 2, False)]


def test_spool(spark, tmp_path):
    """Early, late, repeated and missing answers; a replay gives each request once, as the batch plan does."""
    asked = [(f"r{i}", after(60 * i)) for i in range(8)] + [("end", after(9_000)), ("end2", after(20_000))]
    answers = [("r0", after(30), "own 0"), ("r3", after(200), "own 3"), ("r3", after(230), "own 3"), ("r5", after(2_000), "too late"), ("x", after(60), "nobody's"), ("end", after(9_001), "e"), ("end2", after(20_001), "e")]
    requests = landed(spark, asked, "id string, asked timestamp", tmp_path / "asked", [[1, 0, 2], [5, 4, 3], [6, 7], [8], [9]])
    responses = landed(spark, answers, "id string, answered timestamp, content string", tmp_path / "answered", [[0, 4], [1], [2], [3], [5], [6]])
    daily = spark.createDataFrame([("2026-01-01", "of the day"), ("2026-01-02", "another")], "date string, content string")
    got = taken(spark, stream_answered(requests, responses, daily, "none", wait="10 minutes", delay="60 seconds"), "spool", tmp_path / "c")
    mine = sorted((r["id"], r["content"]) for r in got if not r["id"].startswith("end"))
    in_time = spark.createDataFrame([a for a in answers if a[2] != "too late"], "id string, answered timestamp, content string")
    batch = records.answered(spark.createDataFrame(asked[:8], "id string, asked timestamp"), in_time, daily, F.lit("2026-01-01"), "none")
    assert mine == sorted((r["id"], r["content"]) for r in batch.collect())
    assert dict(mine)["r0"] == "own 0" and dict(mine)["r5"] == "of the day"
