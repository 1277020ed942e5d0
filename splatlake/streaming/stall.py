"""Stalled-job detection over progress events, as a batch query and as a stream."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..functions.order_stats import lagged


def stall_detect(events: DataFrame, progress_timeout: float, load_timeout: float = 0.0, starts: DataFrame | None = None, as_of=None,
                 key: str = "job_id", ts: str = "ts", tie: str = "event_id") -> DataFrame:
    """Waits longer than a timeout in seconds; a timeout of zero or less is off.

    `load`: from a job's start (`starts`: key, start_ts) to its first event. `progress`:
    between events, and with `as_of` from the last event to that time (then `until` is
    NULL). Every event counts as one more finished item.
    """
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    seconds = lambda a, b: (micros(b) - micros(a)) / 1e6
    found = []
    if progress_timeout > 0:
        gaps = lagged(events.select(key, ts, tie), [key], [ts, tie], {"since": ts})
        found.append(gaps.filter(seconds(F.col("since"), F.col(ts)) > progress_timeout).select(key, F.lit("progress").alias("kind"), "since", F.col(ts).alias("until")))
        if as_of is not None:
            last = events.groupBy(key).agg(F.max(ts).alias("since"))
            open_end = seconds(F.col("since"), F.lit(as_of)) > progress_timeout
            found.append(last.filter(open_end).select(key, F.lit("progress").alias("kind"), "since", F.lit(None).cast(dict(events.dtypes)[ts]).alias("until")))
    if load_timeout > 0 and starts is not None:
        first = starts.join(events.groupBy(key).agg(F.min(ts).alias("until")), key, "left")
        by = F.coalesce("until", F.lit(as_of).cast(dict(events.dtypes)[ts]))
        found.append(first.filter(seconds(F.col("start_ts"), by) > load_timeout).select(key, F.lit("load").alias("kind"), F.col("start_ts").alias("since"), "until"))
    if not found:
        return events.select(key, F.lit("").alias("kind"), F.col(ts).alias("since"), F.col(ts).alias("until")).limit(0)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.withColumn("seconds", seconds(F.col("since"), F.col("until")))


class _StallProcessor(StatefulProcessor):
    """Keeps the last event time per job; a timer at that time plus the timeout reports a silent job."""

    def __init__(self, timeout: float):
        self.wait_us = int(timeout * 1e6)

    def init(self, handle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "us bigint, reported boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        times = sorted(int(t) for pdf in rows for t in pdf["us"])
        us, reported = self.last.get() if self.last.exists() else (None, False)
        out = []
        for t in times:
            if us is not None and t > us:
                if t - us > self.wait_us and not reported:
                    out.append((key[0], us))
                reported = False
            us = t if us is None else max(us, t)
        for timer in self.handle.listTimers():
            self.handle.deleteTimer(timer)
        self.last.update((us, reported))
        self.handle.registerTimer((us + self.wait_us) // 1000 + 1)
        yield pd.DataFrame({"job_id": [k for k, _ in out], "since_us": [u for _, u in out]}, columns=["job_id", "since_us"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        us, reported = self.last.get()
        self.last.update((us, True))
        quiet = [] if reported else [us]
        yield pd.DataFrame({"job_id": [key[0]] * len(quiet), "since_us": quiet}, columns=["job_id", "since_us"])

    def close(self) -> None:
        pass


def stream_stalls(events: DataFrame, progress_timeout: float, delay: str = "0 seconds", key: str = "job_id", ts: str = "ts") -> DataFrame:
    """Streaming form: (job_id, since) once for every silence longer than the timeout.

    Reported when the next event arrives or when the watermark passes the timeout,
    whichever comes first. Needs the RocksDB state store.
    """
    rows = events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay).select(F.col(key).alias("job_id"), ts, F.unix_micros(ts).alias("us"))
    found = rows.groupBy("job_id").transformWithStateInPandas(
        _StallProcessor(progress_timeout), f"job_id {dict(events.dtypes)[key]}, since_us bigint", "Append", "EventTime")
    return found.select("job_id", F.timestamp_micros("since_us").alias("since"))
