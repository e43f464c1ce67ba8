"""The calendar: checking it, joining facts to it, finding the current week."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.functions.dates import day_lit

# Largest calendar to broadcast: one row per day, so this is more than 500 years. Its
# date and two numbers take a few megabytes; with all columns, texts may be of any
# length and the bytes are measured.
MAX_BROADCAST_DAYS = 200_000
MAX_BROADCAST_BYTES = 32 * 1024**2

DAY_COLUMNS = ["CAL_DT", "DAY_OF_WK_NUM", "YR_WK_NUM"]


@dataclass(frozen=True)
class Days:
    """Calendar days to join facts to, their first and last one, and whether to broadcast them."""

    frame: DataFrame
    first: date | None
    last: date | None
    small: bool = True

    def select(self, *columns: str) -> Days:
        return replace(self, frame=self.frame.select(*columns))

    def within(self, facts: DataFrame, date_column: str) -> DataFrame:
        """The facts between the first and last day.

        An inner join to the days keeps no others; as plain bounds on the date
        they reach the scan, which can then skip partitions and row groups.
        """
        return facts.where(F.col(date_column).between(day_lit(self.first), day_lit(self.last)))


@dataclass(frozen=True)
class CheckedCalendar:
    """A calendar that is unique on its date, with its measured size."""

    frame: DataFrame
    day_count: int
    first_day: date | None
    last_day: date | None
    current_week: int | None
    last_current_day: date | None = None
    small: bool = True

    @property
    def full(self) -> DataFrame:
        """All calendar columns, ready to join."""
        return self._hinted(self.frame, self.small)

    @property
    def days(self) -> Days:
        """The three columns the weekly job needs, ready to join."""
        hinted = self._hinted(self.frame.select(DAY_COLUMNS), True)
        return Days(hinted, self.first_day, self.last_day, self.day_count <= MAX_BROADCAST_DAYS)

    @property
    def days_to_now(self) -> Days:
        """The days of the weeks up to the one of ``as_of``."""
        days = self.days
        now = days.frame.where(F.col("YR_WK_NUM") <= self.current_week)
        return replace(days, frame=now, last=self.last_current_day)

    def _hinted(self, frame: DataFrame, narrow: bool) -> DataFrame:
        # Beyond the bounds Spark chooses the join, and AQE splits a hot date.
        small = narrow and self.day_count <= MAX_BROADCAST_DAYS
        return F.broadcast(frame) if small else frame


def check_calendar(
    calendar: DataFrame, as_of: date | None = None, calendar_type: str | None = None
) -> CheckedCalendar:
    """Measure the calendar in one small job and refuse one that would multiply rows.

    Raises ``ValueError`` if a date occurs twice, or if ``as_of`` is given and
    is not in the calendar. ``calendar_type`` picks the rows with that
    ``CAL_TYPE_DESC`` from a feed that holds several calendars.
    """
    known = calendar.where(F.col("CAL_DT").isNotNull())
    if calendar_type is not None:
        known = known.where(F.col("CAL_TYPE_DESC") == calendar_type)
    line = F.octet_length(F.to_csv(F.struct(*[F.col(c) for c in known.columns])))
    is_today = F.lit(False) if as_of is None else F.col("CAL_DT") == day_lit(as_of)
    per_day = known.groupBy("CAL_DT").agg(
        F.count(F.lit(1)).alias("n"), F.max("YR_WK_NUM").alias("week"), F.sum(line + 1).alias("bytes")
    )
    # A row per calendar week.
    weeks = (
        per_day.groupBy("week")
        .agg(
            F.sum("bytes").alias("bytes"),
            F.count(F.lit(1)).alias("days"),
            F.min("CAL_DT").alias("first"),
            F.max("CAL_DT").alias("last"),
            F.max("n").alias("most"),
            F.max(is_today).alias("has_today"),
            F.min(F.when(F.col("n") > 1, F.col("CAL_DT"))).alias("first_double"),
        )
        .collect()
    )
    most = max((w["most"] for w in weeks), default=1)
    if most > 1:
        double = min(w["first_double"] for w in weeks if w["first_double"] is not None)
        raise ValueError(
            f"calendar has {most} rows for one date, e.g. {double}; "
            "every join on the date would multiply the facts"
        )
    week = next((w["week"] for w in weeks if w["has_today"]), None)
    if as_of is not None and week is None:
        raise ValueError(f"as_of date {as_of} has no week in the calendar")
    until_now = [w["last"] for w in weeks if week is not None and w["week"] is not None and w["week"] <= week]
    return CheckedCalendar(
        known,
        sum(w["days"] for w in weeks),
        min((w["first"] for w in weeks), default=None),
        max((w["last"] for w in weeks), default=None),
        week,
        max(until_now, default=None),
        sum(w["bytes"] for w in weeks) <= MAX_BROADCAST_BYTES,
    )


def current_week(calendar: DataFrame, as_of: date) -> DataFrame:
    """The calendar row of ``as_of``: its date and its week."""
    return calendar.where(F.col("CAL_DT") == day_lit(as_of)).select("CAL_DT", "YR_WK_NUM")


def with_calendar(
    facts: DataFrame, date_column: str, days: Days | DataFrame, how: str
) -> DataFrame:
    """Join facts to the calendar on their date; the calendar's date is ``Date``.

    An inner join scans only the facts between the first and last of the days.
    """
    if isinstance(days, Days):
        facts = days.within(facts, date_column) if how == "inner" else facts
        days = days.frame
    days = days.withColumnRenamed("CAL_DT", "Date")
    return facts.join(days, facts[date_column] == days["Date"], how)
