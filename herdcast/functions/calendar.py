"""Week calendar: weeks start on Monday, days before the first Monday are week 0."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def week_w(date: Column) -> Column:
    """Week number of the year, Monday-based, 0 before the first Monday."""
    return F.floor((F.dayofyear(date) + F.lit(6) - F.weekday(date)) / 7).cast("int")


def first_monday(year: Column) -> Column:
    jan1 = F.make_date(year, F.lit(1), F.lit(1))
    return F.date_add(jan1, F.pmod(-F.weekday(jan1), F.lit(7)))


def monday_of_week(year: Column, week: Column) -> Column:
    """The Monday that starts week ``week`` of ``year`` (weeks may be 0 or negative)."""
    return F.date_add(first_monday(year), ((week - 1) * 7).cast("int"))


def monday_of(date: Column) -> Column:
    return F.date_sub(date, F.weekday(date))


def day_number(date: Column) -> Column:
    return F.unix_date(date)


def week_backnumber(date: Column, year: Column) -> Column:
    """Week of ``date`` counted from ``year``'s first Monday; earlier weeks are 0, -1, ..."""
    return (F.datediff(monday_of(date), first_monday(year)) / 7 + 1).cast("int")
