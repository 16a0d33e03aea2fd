"""Dates: windows, ranges and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def minus_days(date: Column, days: int) -> Column:
    """M9."""
    return F.date_sub(date, days)


def date_array(start: Column, end: Column) -> Column:
    """All dates from start to end, both included; empty when end < start.

    ``sequence`` counts down when its end comes first, so that case is cut off here.
    """
    return F.when(end >= start, F.sequence(start, end)).otherwise(
        F.array().cast("array<date>")
    )


def iso_week(date: Column) -> Column:
    """M11."""
    return F.weekofyear(date)


def week_year(date: Column, year_mode: str = "calendar") -> Column:
    """Year that goes with a week: the calendar year, or the ISO year of that week."""
    if year_mode == "calendar":
        return F.year(date)
    if year_mode == "iso":
        return F.extract(F.lit("YEAROFWEEK"), date)
    raise ValueError(f"year_mode must be 'calendar' or 'iso', not {year_mode!r}")


def date_text(date: Column) -> Column:
    """A date as yyyy-mm-dd text."""
    return F.date_format(date, "yyyy-MM-dd")
