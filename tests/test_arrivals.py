"""Runs and misses as feeds arrive."""

from __future__ import annotations

import json
import os
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from shelfline.schemas import FEEDS
from shelfline.streaming.arrivals import Watch, due, landed_events

DAY = date(2023, 1, 9)


class Site:
    """A landing folder and a watch over it, with times of our own."""

    def __init__(self, spark, root):
        self.spark, self.landing = spark, root / "landing"
        self.landing.mkdir()
        self.watch = Watch(spark, f"{root}/watch", "landing/")

    def land(self, table, stamp, at):
        file = self.landing / f"{table}_{stamp}.csv"
        file.write_text("K\n1\n")
        os.utime(file, (at.timestamp(), at.timestamp()))

    def told(self, now, days=()):
        frame = self.spark.createDataFrame([(d,) for d in days], "feed_date date")
        self.watch.expect(frame, now)
        self.watch.follow(landed_events(self.spark, str(self.landing)))
        return sorted(tuple(r) for r in self.watch.outcomes().select("run_date", "outcome", F.coalesce("table_name", F.lit(""))).collect())


@pytest.fixture
def site(spark, tmp_path):
    return Site(spark, tmp_path)


def at(hours):
    return datetime(DAY.year, DAY.month, DAY.day, tzinfo=timezone.utc) + timedelta(hours=hours)


RUN = DAY + timedelta(days=1)


def test_the_last_feed_makes_a_run(site):
    for n, table in enumerate(FEEDS[:4]):
        site.land(table, "2023-01-9", at(10 + n))  # a single digit
    assert site.told(at(15), [DAY]) == []
    site.land(FEEDS[4], "2023-01-09", at(16))
    assert site.told(at(17)) == [(RUN, "ready", "")]
    (row,) = site.watch.outcomes().collect()
    manifest = json.loads(row["detail"])
    assert list(manifest) == sorted(FEEDS) and manifest["calendar"] == "calendar_2023-01-9.csv"
    site.land("sales", "2023-01-09", at(18))  # again, by another name
    assert site.told(at(60)) == [(RUN, "ready", "")]


def test_what_is_missing_when_the_deadline_passes_and_a_late_run(site):
    for table in ("sales", "store", "product"):
        site.land(table, f"{DAY}", at(10))
    assert site.told(at(20), [DAY]) == []
    late = (due(DAY) - at(0)).total_seconds() / 3600 + 3
    missed = [(RUN, "missing", "calendar"), (RUN, "missing", "inventory")]
    assert site.told(at(late)) == missed
    details = {r["table_name"]: r["detail"] for r in site.watch.outcomes().collect()}
    assert details["calendar"] == "landing/calendar_2023-01-09.csv"
    for table in ("calendar", "inventory"):
        site.land(table, f"{DAY}", at(late + 1))
    assert site.told(at(late + 2)) == sorted([*missed, (RUN, "ready", "")])
    assert site.told(at(late + 50)) == sorted([*missed, (RUN, "ready", "")])


def test_a_day_without_arrivals_is_missed_and_others_are_not_expected(site):
    site.land("sales", f"{DAY + timedelta(days=3)}", at(90))
    site.land("note", f"{DAY}", at(90))
    got = site.told(at(200), [DAY])
    assert got == sorted((RUN, "missing", t) for t in FEEDS)
