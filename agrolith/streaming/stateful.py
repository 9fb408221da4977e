"""Streams with state of their own by key: alerts with a cool-down that runs from the last one sent, and losses of contact.

State lies in Spark's RocksDB store (``prepared`` names it) and is dropped by timers of event time, so a key that falls silent keeps
none. Rows behind the watermark are dropped by Spark. A key's times of one batch meet in one task; how many there are is the trigger's to bound.

Defined results: rows with a null time are left out; null keys are a key like any other; repeated rows count; an empty stream gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StructField, StructType

from agrolith.session import ship

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_MINUTE = 60_000_000
_longs = lambda *names: StructType([StructField(n, LongType()) for n in names])


def prepared(spark: SparkSession) -> SparkSession:
    """The session with the state store that these streams need."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    ship(spark)
    return spark


def _times(rows: Iterator[pd.DataFrame], column: str) -> np.ndarray:
    """The microseconds of a key's rows, in order."""
    parts = [r[column].to_numpy(np.int64) for r in rows]
    return np.sort(np.concatenate(parts)) if parts else np.zeros(0, np.int64)


class Cooling(StatefulProcessor):
    """Of a key's alerts those that begin ``hours`` or more after the last one sent.

    Each batch is taken in order of time. An alert that comes late, before one that was sent, is within its cool-down as long as it
    is remembered.
    """

    def __init__(self, keys: list[str], hours: float):
        self.keys, self.span = keys, int(hours * 60 * _MINUTE)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.sent = handle, handle.getValueState("sent", _longs("at"))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        known = self.sent.get() if self.sent.exists() else None
        last, out = None if known is None else known[0], []
        times, at = _times(rows, "us"), 0
        while at < len(times):
            if last is not None and times[at] - last < self.span:
                at = max(at + 1, int(np.searchsorted(times, last + self.span)))  # on to the end of the cool-down
                continue
            last = int(times[at])
            out.append(last)
            at += 1
        if out:
            self.sent.update((last,))
            self.handle.registerTimer((last + self.span) // 1000 + 1)
        yield _rows(self.keys, key, {"us": out})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.sent.exists() and (self.sent.get()[0] + self.span) // 1000 + 1 <= expiredTimerInfo.getExpiryTimeInMs():
            self.sent.clear()  # the timers of earlier alerts leave a later one's state alone
        yield _rows(self.keys, key, {"us": []})

    def close(self) -> None:
        pass


class Contact(StatefulProcessor):
    """Runs of a key's readings with less than ``minutes`` between; each is told when the watermark is ``minutes`` past its end.

    Runs that may still grow are the state: those within the lateness, and the current one. Rows out of order put runs together.
    """

    def __init__(self, keys: list[str], minutes: float):
        self.keys, self.span = keys, int(minutes * _MINUTE)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.runs = handle, handle.getListState("runs", _longs("first", "last", "n"))

    def _merged(self, runs: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        out: list[tuple[int, int, int]] = []
        for first, last, n in sorted(runs):
            if out and first - out[-1][1] < self.span:
                out[-1] = (out[-1][0], max(out[-1][1], last), out[-1][2] + n)
            else:
                out.append((first, last, n))
        return out

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        times = _times(rows, "us")
        if len(times):
            cuts = np.flatnonzero(np.diff(times) >= self.span) + 1
            new = [(int(t[0]), int(t[-1]), len(t)) for t in np.split(times, cuts)]
            runs = self._merged([tuple(map(int, r)) for r in self.runs.get()] + new)
            self.runs.put(runs)
            for _, last, _ in runs:
                self.handle.registerTimer(self._over(last))
        yield self._told(key, [])

    def _over(self, last: int) -> int:
        return -(-(last + self.span) // 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        runs = [tuple(map(int, r)) for r in self.runs.get()]
        over, open_ = [r for r in runs if self._over(r[1]) <= now], [r for r in runs if self._over(r[1]) > now]
        if over and open_:
            self.runs.put(open_)
        elif over:
            self.runs.clear()
        yield self._told(key, over)

    def _told(self, key, runs) -> pd.DataFrame:
        return _rows(self.keys, key, {"first": [r[0] for r in runs], "last": [r[1] for r in runs], "n": [r[2] for r in runs]})

    def close(self) -> None:
        pass


def _rows(keys: list[str], key, values: dict[str, list[int]]) -> pd.DataFrame:
    n = len(next(iter(values.values())))
    return pd.DataFrame({**{k: pd.Series([v] * n, dtype=object) for k, v in zip(keys, key, strict=True)}, **{c: pd.Series(v, dtype="int64") for c, v in values.items()}})


def _run(rows: DataFrame, keys: list[str], time: str, lateness: str, processor: StatefulProcessor, told: str) -> DataFrame:
    prepared(rows.sparkSession)
    at = F.col(time).cast("timestamp")
    timed = rows.select(*[F.col(k).cast("string").alias(k) for k in keys], at.alias("_at"), F.unix_micros(at).alias("us")).where("_at is not null").withWatermark("_at", lateness)
    schema = ", ".join([*[f"`{k}` string" for k in keys], told])
    return timed.groupBy(*keys).transformWithStateInPandas(processor, schema, "Append", "EventTime")


_moment = lambda c: F.timestamp_micros(F.col(c)).cast("timestamp_ntz")


def cooled(alerts: DataFrame, keys: list[str], time: str = "detected_at", hours: float = 12, lateness: str = "0 seconds") -> DataFrame:
    """``keys`` (as text) and the time of each alert to be sent: the first of a key, then each ``hours`` or more after the last one sent."""
    return _run(alerts, keys, time, lateness, Cooling(keys, hours), "us long").select(*keys, _moment("us").alias(time))


def contact_lost(readings: DataFrame, keys: list[str], minutes: float = 120, lateness: str = "0 seconds") -> DataFrame:
    """``keys`` (as text), ``first_seen, last_seen, records, lost_at`` of each run of readings that ended in silence of ``minutes`` or more."""
    out = _run(readings, keys, "ts", lateness, Contact(keys, minutes), "first long, last long, n long")
    lost = F.timestamp_micros(F.col("last") + F.lit(int(minutes * _MINUTE))).cast("timestamp_ntz")
    return out.select(*keys, _moment("first").alias("first_seen"), _moment("last").alias("last_seen"), F.col("n").alias("records"), lost.alias("lost_at"))
