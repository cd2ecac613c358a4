"""Alarms on a running stream: a country that stays silent, and its return.

A day counts once it is closed, that is, further behind the newest day than late rows may be. Closed days of each country come out of a
windowed aggregate (combined on the map side, so a hot country is a row per task and day) in ascending batches. A keyed state holds the
last of them, and a timer goes off when too many days have passed after it. What is raised depends on the closed days alone, not on
how they came in batches; state and alarms are committed together, so that a restart neither repeats nor loses one.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import UTC, date, datetime, timedelta

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tallyward.session import settings

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
EPOCH = date(1970, 1, 1)
ALARMS = "country_code string, kind string, last_day date, day date"


def _millis(day: date) -> int:
    return int(datetime(day.year, day.month, day.day, tzinfo=UTC).timestamp() * 1000)


class Silence(StatefulProcessor):
    """For one country: the last closed day with rows, and whether its silence since has been raised."""

    def __init__(self, silent_days: int):
        self.silent_days = silent_days

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "day date, raised boolean")

    def _due(self, last: date) -> date:
        return last + timedelta(days=self.silent_days + 1)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        days = sorted({EPOCH + timedelta(days=row["day"]) for row in rows})
        last, raised = tuple(self.last.get()) if self.last.exists() else (None, False)
        if last is not None and not raised:
            self.handle.deleteTimer(_millis(self._due(last)))
        for day in days:
            if last is not None and day >= self._due(last):
                if not raised:
                    yield Row(country_code=key[0], kind="silent", last_day=last, day=self._due(last))
                yield Row(country_code=key[0], kind="back", last_day=last, day=day)
            if last is None or day > last:
                last, raised = day, False
        self.last.update((last, raised))
        if not raised:
            self.handle.registerTimer(_millis(self._due(last)))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        last, _ = self.last.get()
        self.last.update((last, True))
        yield Row(country_code=key[0], kind="silent", last_day=last, day=self._due(last))


def closed_country_days(staged: DataFrame, lateness_days: int) -> DataFrame:
    """(reported_at, country_code, day) of each country-day, once it is closed; the day also as a number, which no time zone moves."""
    reported = staged.select(F.col("date").cast("timestamp").alias("reported_at"), "country_code")
    watched = reported.withWatermark("reported_at", f"{lateness_days} days")
    closed = watched.groupBy("reported_at", "country_code").agg(F.count(F.lit(1)).alias("row_count"))
    return closed.select("reported_at", "country_code", F.unix_date(F.to_date("reported_at")).alias("day"))


def outages(staged: DataFrame, silent_days: int = 5, lateness_days: int = 7) -> DataFrame:
    """(country_code, kind, last_day, day) of a stream of staged rows, in session time UTC.

    ``silent``: no rows for ``silent_days`` days after ``last_day``, raised for the ``day`` after these. ``back``: the first ``day`` with rows
    again. A country is known from its first closed day on; rows that come later than ``lateness_days`` are not looked at.
    """
    if silent_days < 1:
        raise ValueError("a silence lasts a day at least")
    closed = closed_country_days(staged, lateness_days)
    return closed.groupBy("country_code").transformWithState(Silence(silent_days), ALARMS, "Append", "EventTime")


def watch_outages(staged: DataFrame, path: str, checkpoint: str, silent_days: int = 5, lateness_days: int = 7) -> StreamingQuery:
    """Append the alarms of what has arrived to the files under ``path``, then stop; the same ``checkpoint`` carries on.

    Timers need the state store that is set here for this query only.
    """
    spark = staged.sparkSession
    with settings(spark, spark__sql__streaming__stateStore__providerClass=STATE_STORE):
        return (
            outages(staged, silent_days, lateness_days)
            .writeStream.format("parquet")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start(path)
        )
