"""Alarms of a stream: the same however the days come in batches, each once, across restarts."""

from __future__ import annotations

import random
from datetime import timedelta

import pytest

from tallyward.sources import versions
from tallyward.streaming import outages
from tests.frames import MARCH

SCHEMA = "date date, country_code string"


def plain(days, silent, lateness):
    """From the closed days of each country: its gaps, and the silence that goes on."""
    closed = max(day for _, day in days) - timedelta(days=lateness)
    found = set()
    for country in {c for c, _ in days}:
        mine = sorted({day for c, day in days if c == country and day <= closed})
        for day, following in zip(mine, [*mine[1:], None], strict=True):
            due = day + timedelta(days=silent + 1)
            if (following or closed) >= due:
                found.add((country, "silent", day, due))
                if following:
                    found.add((country, "back", day, following))
    return sorted(found, key=str)


class Feed:
    """Files that arrive one after the other, and the alarms that have been written."""

    def __init__(self, spark, folder, silent=3, lateness=2, per_batch=None):
        self.spark, self.folder, self.silent, self.lateness, self.per_batch = spark, str(folder), silent, lateness, per_batch

    def arrive(self, days):
        rows = [(day, country) for country, day in days]
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.folder}/arrivals")

    def run(self):
        reader = self.spark.readStream.schema(SCHEMA)
        if self.per_batch:
            reader = reader.option("maxFilesPerTrigger", self.per_batch)
        stream = reader.parquet(f"{self.folder}/arrivals")
        query = outages.watch_outages(stream, f"{self.folder}/alarms", f"{self.folder}/checkpoint", self.silent, self.lateness)
        query.awaitTermination()
        return self.alarms()

    def alarms(self):
        return sorted((tuple(row) for row in self.spark.read.schema(outages.ALARMS).parquet(f"{self.folder}/alarms").collect()), key=str)


def day(n):
    return MARCH + timedelta(days=n)


@pytest.mark.parametrize("seed", [1, 2])
def test_any_batches_give_the_same_alarms(spark, tmp_path, seed):
    """Files in order, with rows up to the lateness behind, as one batch, a file per batch, or a run per file."""
    rnd = random.Random(seed)
    days = [(c, day(n)) for c in ("AA", "BB", "CC") for n in range(40) if rnd.random() < (0.35 if c != "CC" else 0.9)]
    days += [(None, day(3)), (None, day(20))]
    days.sort(key=lambda x: (x[1] + timedelta(days=rnd.choice([0, 0, 1]))))
    cuts = [0, 20, 31, 45, len(days)]
    parts = [days[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
    expected = plain(days, 3, 2)
    whole, single, restarted = (Feed(spark, tmp_path / name, per_batch=n) for name, n in (("w", None), ("s", 1), ("r", None)))
    for part in parts:
        whole.arrive(part), single.arrive(part), restarted.arrive(part)
        restarted.run()
    assert restarted.alarms() == expected
    assert whole.run() == expected
    assert single.run() == expected


def test_a_silence_is_raised_when_it_is_long_enough_and_once(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.arrive([("AA", day(0)), ("BB", day(0)), ("BB", day(5))])
    assert feed.run() == []  # closed up to day 3; the alarm for AA is due on day 4
    feed.arrive([("BB", day(6))])
    assert feed.run() == [("AA", "silent", day(0), day(4)), ("BB", "silent", day(0), day(4))]
    feed.arrive([("BB", day(n)) for n in range(7, 12)])
    assert feed.run() == [("AA", "silent", day(0), day(4)), ("BB", "back", day(0), day(5)), ("BB", "silent", day(0), day(4))]
    assert feed.run() == feed.alarms() and len(feed.alarms()) == 3  # a run without arrivals repeats nothing
    feed.arrive([("AA", day(12)), ("BB", day(14))])
    assert ("AA", "back", day(0), day(12)) in feed.run()


def test_a_batch_that_failed_after_its_alarms_is_not_raised_again(spark, tmp_path):
    """The commit of the last batch is lost, as when the driver dies: the batch runs again, and its alarms stay single."""
    feed = Feed(spark, tmp_path)
    feed.arrive([("AA", day(0)), ("BB", day(0))])
    feed.run()
    feed.arrive([("BB", day(n)) for n in range(1, 12)])
    before = feed.run()
    assert ("AA", "silent", day(0), day(4)) in before
    system, place = versions.folder(spark, f"{feed.folder}/checkpoint/commits")
    commits = [entry.getPath() for entry in system.listStatus(place)]
    last = max((path for path in commits if path.getName().isdigit()), key=lambda path: int(path.getName()))
    system.delete(last, False)
    assert feed.run() == before


def test_a_silence_has_a_day(spark):
    stream = spark.readStream.schema(SCHEMA).parquet("/root/testdata/sf0.001/nation.parquet")
    with pytest.raises(ValueError):
        outages.outages(stream, silent_days=0)
