"""Pending ids as state: each is held open from its first entry until it is resolved, and reported once if that takes too long.

The log of entries and the log of resolutions are one stream of events by id. State is an entry an id, in the state store of the
cluster; event-time timers end it, so it does not grow with the age of the stream.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CHANGES = "id string, status string, kind string, at timestamp, waited_s long"
_STATE = "status string, kind string, at timestamp, first_at timestamp"


class OpenIds(StatefulProcessor):
    """One id: opened by its first entry, closed by its first resolution, overdue ``patience`` after it was opened, forgotten ``keep`` after the last of these."""

    def __init__(self, patience: timedelta, keep: timedelta) -> None:
        self.patience, self.keep = patience, keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.state = handle, handle.getValueState("id", _STATE)

    def _set(self, status: str, kind: str | None, at: pd.Timestamp, first_at: pd.Timestamp, wait: timedelta) -> None:
        self.state.update((status, kind, at.to_pydatetime(), first_at.to_pydatetime()))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(int((at + wait).timestamp() * 1000))

    def _change(self, key, status: str, kind: str | None, at: pd.Timestamp, first_at: pd.Timestamp) -> pd.DataFrame:
        return pd.DataFrame({"id": [key[0]], "status": [status], "kind": [kind], "at": [at], "waited_s": [int((at - first_at).total_seconds())]})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        events = pd.concat(list(rows)).sort_values(["at", "resolved", "kind"], kind="stable")
        for e in events.itertuples():
            now = self.state.get() if self.state.exists() else None
            if e.resolved and (now is None or now[0] != "resolved"):
                first_at, kind = (pd.Timestamp(now[3]), now[1]) if now else (e.at, None)
                self._set("resolved", kind, e.at, first_at, self.keep)
                if now:
                    yield self._change(key, "resolved", kind, e.at, first_at)
            elif not e.resolved and now is None:
                self._set("open", e.kind, e.at, e.at, self.patience)
                yield self._change(key, "open", e.kind, e.at, e.at)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        now = self.state.get() if self.state.exists() else None
        if now and now[0] == "open":
            at, first_at = pd.Timestamp(expiredTimerInfo.getExpiryTimeInMs(), unit="ms"), pd.Timestamp(now[3])
            self._set("overdue", now[1], at, first_at, self.keep)
            yield self._change(key, "overdue", now[1], at, first_at)
        else:
            self.state.clear()

    def close(self) -> None:
        pass


def changes(entries: DataFrame, resolved: DataFrame, patience: timedelta = timedelta(days=7), keep: timedelta = timedelta(days=30), late: str = "1 day") -> DataFrame:
    """(id, status, kind, at, waited_s): a row whenever an id is opened, resolved or overdue. Both inputs are streams.

    ``entries``: id, ts, kind; ``resolved``: id, ts. Replays change nothing; an id that was resolved before its entry comes is never opened while it is remembered; an overdue one is still resolved.
    Null ids and times are left out. Events more than ``late`` behind the latest one may be lost, as with every watermark. Sets the RocksDB state store, which holds such state.
    """
    spark = entries.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    opened = entries.select("id", F.to_timestamp("ts").alias("at"), F.col("kind").cast("string").alias("kind"), F.lit(False).alias("resolved"))
    closed = resolved.select("id", F.to_timestamp("ts").alias("at"), F.lit(None).cast("string").alias("kind"), F.lit(True).alias("resolved"))
    events = opened.union(closed).where("id is not null and at is not null").withWatermark("at", late)
    return events.groupBy("id").transformWithStateInPandas(OpenIds(patience, keep), outputStructType=CHANGES, outputMode="Update", timeMode="EventTime")
