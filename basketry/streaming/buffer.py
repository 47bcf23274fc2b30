"""Events sent on in groups: by number, or once the oldest has waited long enough.

Each lane has a buffer in the state store that lives across micro-batches and restarts.  A full
buffer leaves at once; what is left leaves when the oldest event has waited ``seconds``.  A buffer
never holds ``size`` events or more, so the state is bounded by lanes x size; a task holds that and
one Arrow batch, however many events of a lane a micro-batch brings.
"""

from __future__ import annotations

import time
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

SIZE, SECONDS, LANES = 100, 30.0, 64
FLUSHED = "lane bigint, flush bigint, n bigint, full boolean, payloads array<string>"
_HELD = "held array<string>, since bigint, flushes bigint"


def _collect(size: int, seconds: float):
    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held, since, flushes = state.get if state.exists else ([], 0, 0)
        held, now = list(held), int(time.time() * 1000)

        def sent(groups: list[list[str]]) -> pd.DataFrame:
            nonlocal flushes
            rows = [(key[0], flushes + k, len(g), len(g) >= size, g) for k, g in enumerate(groups)]
            flushes += len(groups)
            return pd.DataFrame(rows, columns=["lane", "flush", "n", "full", "payloads"])

        if not held:
            since = now
        # Full groups leave with the part that fills them, so a lane is never held whole.
        for part in parts:
            held += part["payload"].tolist()
            full = len(held) // size * size
            if full:
                yield sent([held[k:k + size] for k in range(0, full, size)])
                held, since = held[full:], now
        if held and now - since >= 1000 * seconds:
            yield sent([held])
            held = []
        state.update((held, since, flushes))
        if held:
            state.setTimeoutDuration(max(1, since + int(1000 * seconds) - now))
    return step


def in_groups(events: DataFrame, lane: Column | None = None, size: int = SIZE,
              seconds: float = SECONDS) -> DataFrame:
    """One row per group of events: ``lane``, its number in the lane, and the payloads.

    ``events`` has ``payload``.  Lanes (default: a hash of the payload) are worked on side by
    side; a lane's events keep the order in which its micro-batch delivers them.
    """
    lane = F.pmod(F.xxhash64("payload"), F.lit(LANES)) if lane is None else lane
    return (events.select(lane.cast("bigint").alias("lane"), F.col("payload").cast("string").alias("payload"))
            .groupBy("lane").applyInPandasWithState(
                _collect(size, seconds), FLUSHED, _HELD, "append",
                GroupStateTimeout.ProcessingTimeTimeout))


def append_groups(groups: DataFrame, path: str, checkpoint: str, every: str = "1 second") -> StreamingQuery:
    """Append the groups to a Parquet table; runs until it is stopped, since buffers wait for time."""
    return (groups.writeStream.format("parquet").outputMode("append").option("path", path)
            .option("checkpointLocation", checkpoint).trigger(processingTime=every).start())


def _await(query: StreamingQuery, reached, patience: float) -> None:
    limit = time.time() + patience
    while query.isActive and time.time() < limit:
        if query.lastProgress and reached(query.lastProgress):
            return
        time.sleep(0.1)
    if query.exception():
        raise query.exception()


def taken_in(query: StreamingQuery, patience: float = float("inf")) -> int:
    """Wait until a micro-batch found nothing new; gives its number.

    Buffers that wait for time keep such a query running batches for ever, so it is never idle.
    A large first batch may take long; only a given ``patience`` ends the wait before it is done.
    """
    _await(query, lambda p: p["numInputRows"] == 0, patience)
    return query.lastProgress["batchId"] if query.lastProgress else -1


def drain(query: StreamingQuery, seconds: float, patience: float = float("inf")) -> None:
    """Let a query take in all there is, wait out the buffers' time, and stop it."""
    taken_in(query, patience)
    time.sleep(seconds)
    done = query.lastProgress["batchId"] if query.lastProgress else -1
    # The batch after the one that may have been under way when the time was up.
    _await(query, lambda p: p["batchId"] >= done + 2, patience)
    query.stop()
