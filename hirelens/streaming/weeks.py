"""Weekly counts on a stream, with the weeks in which nothing came.

Closed weeks come out of a windowed aggregate, one row a week. A second stateful step keeps the
first week that has not been told yet and sets event-time timers: when the watermark passes a week of
which no row came, its timer tells it with 0. All weeks share one key, of one row a week.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

WEEK = timedelta(days=7)
_OUT = "week date, jobs long"


def _millis(moment: datetime) -> int:
    return int(moment.replace(tzinfo=timezone.utc).timestamp() * 1000)


def _moment(millis: int) -> datetime:
    return datetime.fromtimestamp(millis / 1000, timezone.utc).replace(tzinfo=None)


class FilledWeeks(StatefulProcessor):
    """State: the end of the next week to tell, and closed weeks that came ahead of their turn."""

    def init(self, handle) -> None:
        self.handle = handle
        self.next_end = handle.getValueState("next_end", "millis long")
        self.ahead = handle.getMapState("ahead", "millis long", "jobs long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for frame in rows:
            for end, jobs in zip(frame["end"], frame["jobs"]):
                self.ahead.updateValue((_millis(end.to_pydatetime()),), (int(jobs),))
        if not self.next_end.exists():
            self._await(min(k[0] for k in self.ahead.keys()))
        yield from self._told(timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._told(timerValues.getCurrentWatermarkInMs())

    def _await(self, end: int) -> None:
        self.next_end.update((end,))
        self.handle.registerTimer(end)

    def _told(self, watermark: int) -> Iterator[pd.DataFrame]:
        """All weeks up to the watermark that have not been told."""
        told, end = [], self.next_end.get()[0]
        while end <= watermark:
            jobs = 0
            if self.ahead.containsKey((end,)):
                jobs = self.ahead.getValue((end,))[0]
                self.ahead.removeKey((end,))
            told.append(((_moment(end) - timedelta(days=1)).date(), jobs))
            end += int(WEEK.total_seconds() * 1000)
        if told:
            self._await(end)
            yield pd.DataFrame(told, columns=["week", "jobs"])

    def close(self) -> None:
        pass


def filled_weeks(stream: DataFrame, time: str = "ts", delay: str = "1 day") -> DataFrame:
    """(week, jobs) of every week, named by its Sunday, from the first with rows to the watermark; 0 where none came.

    Needs the RocksDB state store (``use_rocksdb``).
    """
    counted = stream.withWatermark(time, delay).groupBy(F.window(time, "7 days", "7 days", "4 days").alias("w")).agg(
        F.count(F.lit(1)).alias("jobs"))
    ended = counted.select(F.lit(0).alias("one"), F.col("w.end").alias("end"), F.window_time("w").alias("at"), "jobs")
    return ended.groupBy("one").transformWithStateInPandas(
        statefulProcessor=FilledWeeks(), outputStructType=_OUT, outputMode="Append", timeMode="EventTime").select("week", "jobs")


def use_rocksdb(spark) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
