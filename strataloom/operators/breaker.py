"""The circuit breaker: streaks of failures, and the state machine with a cooldown."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataloom.functions.ranges import range_of

LIMIT = 2


def time_ranges(calls: DataFrame, at: str, n: int | None = None) -> Column:
    """Which of n ranges of `at`, with about as many calls each, a call is in; null times are in the first."""
    n = n or int(calls.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = calls.schema[at].dataType.simpleString()
    value = F.col(at) if kind in ("tinyint", "smallint", "int", "bigint", "float", "double") else F.unix_micros(F.col(at).cast("timestamp"))
    cuts = calls.agg(F.percentile_approx(value, [i / n for i in range(1, n)] or [0.5], 10000)).first()[0]
    return F.coalesce(range_of(value, sorted(set(cuts or []))), F.lit(0))


def failure_streaks(calls: DataFrame, key: str, failed: Column, *order: str, ranges: int | None = None) -> DataFrame:
    """Adds `streak`, how many calls of the key in a row have failed up to this one; a success makes it 0.

    A key's calls are dealt into ranges of the first order column, a number or a time, so that one of very many calls isn't one task's.
    Of each range only its number of calls, whether all failed, and the streak at its end matter to the next one: these few rows are
    scanned by key, and what reaches a range is added to the streaks before its first success.
    """
    w = Window.partitionBy(key, "_range").orderBy(*order)
    ranged = calls.withColumn("_failed", F.coalesce(failed, F.lit(False)).cast("long")).withColumn("_range", time_ranges(calls, order[0], ranges))
    rows = ranged.withColumn("_wins", F.sum(F.lit(1) - F.col("_failed")).over(w))
    own = rows.withColumn("streak", F.sum("_failed").over(Window.partitionBy(key, "_range", "_wins").orderBy(*order)))

    # A range that is all failures adds its calls to the streak that reaches it; any other begins anew.
    last = F.max_by(F.struct(F.col("_wins").alias("wins"), "streak"), F.struct("_wins", "streak"))
    ends = own.groupBy(key, "_range").agg(last.alias("end")).select(key, "_range", F.col("end.wins").alias("wins"), F.col("end.streak").alias("suffix"))
    along = Window.partitionBy(key).orderBy("_range")
    islands = ends.withColumn("_island", F.count_if(F.col("wins") > 0).over(along))
    through = islands.withColumn("_through", F.sum("suffix").over(Window.partitionBy(key, "_island").orderBy("_range")))
    carried = through.select(F.col(key).alias("_key"), F.col("_range").alias("_in"), F.lag("_through", 1, 0).over(along).alias("_carried"))
    met = own.join(carried, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_range") == F.col("_in")), "left")
    reached = F.when(F.col("_wins") == 0, F.coalesce("_carried", F.lit(0))).otherwise(0)
    return met.withColumn("streak", (F.col("streak") + reached).cast("long")).drop("_failed", "_range", "_wins", "_key", "_in", "_carried")


def without_cooldown(calls: DataFrame, key: str, failed: Column, *order: str, limit: int = LIMIT, ranges: int | None = None) -> DataFrame:
    """Adds `sent`: a call goes out until `limit` calls in a row have failed, and none after. Of each key only the call that trips is looked up."""
    streaks = failure_streaks(calls, key, failed, *order, ranges=ranges)
    tripped = streaks.where(F.col("streak") >= limit).groupBy(F.col(key).alias("_key")).agg(F.min(F.struct(*order)).alias("_trip"))
    met = streaks.join(tripped, F.col(key).eqNullSafe(F.col("_key")), "left")
    return met.withColumn("sent", F.coalesce(F.struct(*order) <= F.col("_trip"), F.lit(True))).drop("_key", "_trip")


@dataclass
class Breaker:
    """Closed until `limit` failures in a row; then open. After `cooldown` seconds one probe passes, and decides."""

    limit: int = LIMIT
    cooldown: float = 60.0
    streak: int = 0
    opened: float | None = None

    def call(self, at: float, failed: bool) -> tuple[bool, bool]:
        """Whether the call at a time is sent, and whether the breaker is open after it."""
        if self.opened is not None and at - self.opened < self.cooldown:
            return False, True
        self.streak = self.streak + 1 if failed else 0
        self.opened = at if failed and (self.opened is not None or self.streak >= self.limit) else None
        return True, self.opened is not None


def fold(rows: Iterator[tuple[float, bool]], breaker: Breaker) -> Iterator[tuple[bool, bool]]:
    for at, failed in rows:
        yield breaker.call(at, failed)


def with_cooldown(calls: DataFrame, key: str, at: str, failed: str, tie: str, *, limit: int = LIMIT, cooldown: float = 60.0) -> DataFrame:
    """key, tie, sent and open of each call: a stream over each task's sorted rows that holds one breaker at a time."""
    fields = {key: calls.schema[key].dataType.simpleString(), tie: calls.schema[tie].dataType.simpleString()}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, breaker = None, Breaker(limit, cooldown)
        for batch in batches:
            out = []
            for k, t, a, f in zip(batch[key], batch[tie], batch["_at"], batch["_failed"], strict=True):
                if k != now:
                    now, breaker = k, Breaker(limit, cooldown)
                out.append((k, t, *breaker.call(a, f)))
            yield pd.DataFrame(out, columns=[key, tie, "sent", "open"])

    seconds = F.unix_micros(F.col(at).cast("timestamp")) / 1e6
    rows = calls.select(key, tie, seconds.alias("_at"), F.col(failed).alias("_failed")).repartition(key).sortWithinPartitions(key, "_at", tie)
    return rows.mapInPandas(run, f"{key} {fields[key]}, {tie} {fields[tie]}, sent boolean, open boolean")
