"""The breaker over a stream of calls: its state lives in Spark's state store, by key."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from strataloom.operators.breaker import LIMIT, Breaker
from strataloom.session import importable

STATE = "streak int, opened double, at array<double>, seq array<long>, failed array<boolean>"
OUT = "key string, seq long, sent boolean, open boolean"


def stream_breaker(calls: DataFrame, *, limit: int = LIMIT, cooldown: float = 60.0, delay: str = "10 minutes") -> DataFrame:
    """key, seq, sent and open for a stream of (key string, seq long, at timestamp, failed boolean), in order of (at, seq).

    A call waits in its key's state until the watermark, `delay` behind the latest call, has passed it; then calls that came before and after it
    are known, and it is decided in its place. So calls may come in any order within the delay, and the rows are those of with_cooldown()
    over the same calls; Spark drops calls that come later. A key whose calls all wait is woken by its event-time timer. The state holds
    what came within the delay, and is given up by batch, never a key's whole history.
    """
    importable(calls.sparkSession)

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        streak, opened, at, seq, failed = state.get if state.exists else (0, None, [], [], [])
        waiting = [*zip(at, seq, failed, strict=True)]
        for batch in batches:
            waiting += zip(batch["at"].map(lambda t: t.timestamp()), batch["seq"], batch["failed"].astype(bool), strict=True)
        waiting.sort()
        passed = state.getCurrentWatermarkMs() / 1000
        due = next((i for i, (t, _, _) in enumerate(waiting) if t >= passed), len(waiting))
        breaker = Breaker(limit, cooldown, streak, opened)
        out = [(key[0], s, *breaker.call(t, f)) for t, s, f in waiting[:due]]
        left = waiting[due:]
        state.update((breaker.streak, breaker.opened, [float(t) for t, _, _ in left], [int(s) for _, s, _ in left], [bool(f) for _, _, f in left]))
        if left:
            state.setTimeoutTimestamp(max(int(left[0][0] * 1000), int(passed * 1000)) + 1)
        yield pd.DataFrame(out, columns=["key", "seq", "sent", "open"])

    timed = calls.withWatermark("at", delay)
    return timed.groupBy("key").applyInPandasWithState(run, OUT, STATE, "append", GroupStateTimeout.EventTimeTimeout)
