"""Feed file names: building them and taking them apart."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfline.functions.dates import as_day, stamp_of


def feed_path(table: Column, day: Column, prefix: str = "") -> Column:
    """``<prefix><table>_<yyyy-MM-dd>.csv``."""
    return F.concat(F.lit(prefix), table, F.lit("_"), stamp_of(day), F.lit(".csv"))


def feed_table_name(path: Column) -> Column:
    """Table name of a feed path: the file name up to its first underscore."""
    file_name = F.element_at(F.split(path, "/"), -1)
    return F.element_at(F.split(file_name, "_"), 1)


def stamp_day(stamp: Column) -> Column:
    """The day of a stamp, with one or two digits for month and day; NULL if it is none."""
    return as_day(F.when(stamp.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), stamp))
