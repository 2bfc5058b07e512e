"""Anomalies found inside the stream: the last windows of every key are kept as state.

``events.window_anomalies`` looks back over a stored table of windows. Here each
finished window is judged when its micro-batch brings it, against the windows
of its key that the state store remembers, so nothing is read twice and a
restart goes on where the checkpoint ends.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class LastWindows(StatefulProcessor):
    """Judges a key's windows by the ``previous`` ones before. State: their values, oldest first, and when they expire."""

    def __init__(self, key: str, value: str, previous: int, bound: float, idle: timedelta | None):
        self.key, self.value, self.previous, self.bound, self.idle = key, value, previous, bound, idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.known = handle.getValueState("known", "last array<double>, expires bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        windows = pd.concat(list(rows)).sort_values("start", kind="stable")  # the windows of one key that end in one batch
        last, expires = self.known.get() if self.known.exists() else ([], None)
        values = np.array([*(np.nan if v is None else v for v in last), *windows[self.value].astype(float)])
        z = np.full(len(windows), np.nan)
        before = len(values) - len(windows)
        for i in range(len(windows)):
            past = values[max(before + i - self.previous, 0) : before + i]
            if len(past) == self.previous and past.std() > 0:  # false with a missing value among them
                z[i] = (values[before + i] - past.mean()) / past.std()
        if self.idle is not None:
            if expires is not None:
                self.handle.deleteTimer(expires)
            expires = int((windows["end"].max() + self.idle).timestamp() * 1000)
            self.handle.registerTimer(expires)
        kept = values[max(len(values) - self.previous, 0) :]
        self.known.update(([None if np.isnan(v) else float(v) for v in kept], expires))
        with np.errstate(invalid="ignore"):
            found = np.abs(z) > self.bound
        if found.any():
            yield windows.assign(z=z)[found][["start", "end", self.key, "n", "mean", "z"]]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """No window for ``idle``: the key is forgotten and needs ``previous`` windows anew."""
        self.known.clear()
        return iter([])

    def close(self) -> None:
        pass


def anomaly_stream(stream: DataFrame, time_col: str, key: str, value: str, width: str, delay: str, judged: str = "n",
                   previous: int = 7, bound: float = 3.0, idle: timedelta | None = None) -> DataFrame:
    """Windows of a stream whose ``judged`` (``n`` rows or ``mean`` of ``value``) lies more than ``bound`` population
    deviations from the ``previous`` windows of the key: start, end, key, n, mean, z.

    Rows are counted per window before they meet the state, so a busy key sends one row per window. A row that comes
    later than ``delay`` is dropped and changes nothing; a window is judged once, when the watermark passes its end.
    Windows without rows do not exist. A window is not judged if fewer than ``previous`` windows came before, if one of
    them has no value, or if they do not differ. Rows without a key form a key of their own. With ``idle`` a key that has
    no window for that long is forgotten, which bounds the state by the keys alive; without it keys stay.
    """
    windows = (
        stream.withWatermark(time_col, delay).groupBy(F.window(time_col, width).alias("w"), key)
        .agg(F.count("*").alias("n"), F.avg(value).alias("mean"))
        .select(F.window_time("w").alias("at"), F.col("w.start").alias("start"), F.col("w.end").alias("end"), key, "n", "mean")
    )
    kind = windows.schema[key].dataType.simpleString()
    return windows.groupBy(key).transformWithStateInPandas(
        LastWindows(key, judged, previous, bound, idle), f"start timestamp, end timestamp, `{key}` {kind}, n bigint, mean double, z double",
        "Append", "EventTime")


def append_anomalies(found: DataFrame, path: str, checkpoint: str) -> None:
    """Work off what has arrived and append its anomalies to a parquet folder, exactly once."""
    conf = found.sparkSession.conf
    before = conf.get(STORE, None)
    conf.set(STORE, ROCKS)  # keyed state with timers needs this store; a query keeps the settings it was started with
    try:
        query = found.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        conf.unset(STORE) if before is None else conf.set(STORE, before)
    query.awaitTermination()
