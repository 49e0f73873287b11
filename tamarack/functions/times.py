"""Dates and ages."""

from __future__ import annotations

import re
from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_age(text: str) -> timedelta:
    """An age out of "30d", "12h" or "45m"."""
    m = re.fullmatch(r"\s*(\d+)\s*([dhm])\s*", text)
    if not m:
        raise ValueError("an age is a number with d, h or m")
    return timedelta(**{{"d": "days", "h": "hours", "m": "minutes"}[m[2]]: int(m[1])})


def fiscal_year(day: Column, first_month: int = 10) -> Column:
    """The fiscal year that a day is in, named by the year it ends in."""
    return F.year(day) + (F.month(day) >= first_month).cast("int")


def fiscal_window(day: Column, first_month: int = 10) -> Column:
    """(first, last) day of the fiscal year that a day is in."""
    first = F.make_date(fiscal_year(day, first_month) - 1, F.lit(first_month), F.lit(1))
    return F.struct(first.alias("first"), F.date_sub(F.add_months(first, 12), 1).alias("last"))


def first_sunday(day: Column) -> Column:
    """The first Sunday of a day's month."""
    return F.next_day(F.date_sub(F.trunc(day, "month"), 1), "Sun")


def latest_month(day: Column) -> Column:
    """The first Sunday, of this month or the one before, that is before the day: when the latest monthly extract came out."""
    here = first_sunday(day)
    return F.when(here < day, here).otherwise(first_sunday(F.add_months(day, -1)))


def fresh(fetched: Column, now: Column, most: timedelta | None) -> Column:
    """Whether something fetched is young enough to be used again; without a limit all is."""
    if most is None:
        return fetched.isNotNull()
    return F.coalesce(fetched >= now - F.make_dt_interval(secs=F.lit(most.total_seconds())), F.lit(False))
