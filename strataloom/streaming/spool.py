"""The request spool as a stream: requests meet their answers as these come, and get a stand-in when time is up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stream_answered(requests: DataFrame, responses: DataFrame, daily: DataFrame, default: str, *, wait: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """id, asked and content of each request: its own response, else the one of its day, else the default.

    requests (id, asked timestamp) and responses (id, answered timestamp, content) are streams, either of which may be `delay` late; daily
    (date, content) is a table. A response counts that comes within `wait` of its request. A request is given out once, when its
    response is there or when the watermarks say that none can come any more, so state holds what is younger than both. Of
    several responses with an id the first to come counts.
    """
    asked = requests.withWatermark("asked", delay)
    first = responses.withWatermark("answered", delay).dropDuplicatesWithinWatermark(["id"]).select(F.col("id").alias("_id"), "answered", F.col("content").alias("own"))
    in_time: Column = F.expr(f"id = _id AND answered >= asked AND answered <= asked + INTERVAL {wait}")
    met = asked.join(first, in_time, "leftOuter")
    by_day = daily.groupBy(F.col("date").cast("date").alias("_day")).agg(F.min("content").alias("day"))
    whole = met.join(by_day, F.to_date("asked") == F.col("_day"), "left")
    return whole.select("id", "asked", F.coalesce("own", "day", F.lit(default)).alias("content"))
