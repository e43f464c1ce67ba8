"""Date expressions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

FEED_STAMP = "yyyy-MM-dd"


def as_day(value: Column | str) -> Column:
    """Text, timestamp or date to DATE; NULL where the text is no date."""
    value = F.col(value) if isinstance(value, str) else value
    return value.try_cast("date")


def stamp_of(day: Column) -> Column:
    """The day as it stands in a feed's file name, month and day zero-padded."""
    return F.date_format(day, FEED_STAMP)


def feed_day(run_date: Column) -> Column:
    """A run handles the feeds stamped with the day before it."""
    return F.date_sub(run_date, 1)


def day_lit(day: date | None) -> Column:
    return F.lit(day).cast("date")
