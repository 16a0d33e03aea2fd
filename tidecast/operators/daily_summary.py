"""Daily summaries that are kept and brought up to date where something changed.

A summary is a table with one folder per day, or per month where days are small (see
``sources.parted_output``). New days, restated days and late cancellations name the days they
touch; only their parts are built again, from facts of those days, and only their folders are
replaced. All other parts stay as they are and are never read. What a summary holds afterwards
equals one built from scratch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import date, timedelta
from itertools import groupby

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidecast.sources import parted_output as po

DAY, PART = "yyyy_mm_dd", "part_day"
GRAINS = ("day", "month")


def day_ranges(days: Iterable[date]) -> list[tuple[date, date]]:
    """The days as ranges of neighbours, each read by one date-bounded scan."""
    numbered = enumerate(sorted(set(days)))
    out = []
    for _, run in groupby(numbered, lambda x: x[1] - timedelta(days=x[0])):
        found = [day for _, day in run]
        out.append((found[0], found[-1]))
    return out


def touched_days(changed: DataFrame, *dates: Column) -> list[date]:
    """The distinct days that changed rows touch, by any of the given dates.

    A reservation touches the day it was made and the day it was cancelled, for instance. What
    reaches the driver is bounded by the calendar.
    """
    every = F.array_compact(F.array(*[F.to_date(d) for d in dates]))
    days = changed.select(F.explode(every).alias("day")).distinct()
    return sorted(r["day"] for r in days.collect())


def part_of(day: date, grain: str) -> date:
    """A part is named by its first day."""
    return day.replace(day=1) if grain == "month" else day


def part_end(part: date, grain: str) -> date:
    if grain == "day":
        return part
    return (part.replace(day=28) + timedelta(days=4)).replace(day=1) - timedelta(days=1)


def parts_between(start: date, end: date, grain: str) -> list[date]:
    days = (start + timedelta(days=k) for k in range((end - start).days + 1))
    return sorted({part_of(day, grain) for day in days})


class DailySummary:
    """A kept summary: ``build(start, end)`` makes its rows for a range of days, both included.

    ``schema`` has the columns beside the day, ``sums`` names those that the manifest adds up.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        build: Callable[[date, date], DataFrame],
        schema: str,
        sums: list[str],
        grain: str = "day",
    ):
        if grain not in GRAINS:
            raise ValueError(f"grain must be one of {GRAINS}, not {grain!r}")
        self.spark, self.folder, self.build = spark, folder, build
        self.schema, self.sums, self.grain = schema, sums, grain

    def rows_for(self, parts: Iterable[date]) -> DataFrame:
        """The rows of these parts, made anew from facts of their days only."""
        ends = [(part, part_end(part, self.grain)) for part in parts]
        days = (first + timedelta(days=k) for first, last in ends for k in range((last - first).days + 1))
        built = [self.build(*ends) for ends in day_ranges(days)]
        out = built[0]
        for more in built[1:]:
            out = out.unionByName(more)
        first = F.trunc(DAY, "month") if self.grain == "month" else F.col(DAY)
        return out.withColumn(PART, first)

    def refresh(self, days: Iterable[date]) -> DataFrame | None:
        """Build the parts of these days again; returns their manifest rows.

        Without days nothing happens.
        """
        parts = sorted({part_of(day, self.grain) for day in days})
        if not parts:
            return None
        return po.write_parts(self.rows_for(parts), self.folder, PART, parts, self.sums)

    def missing(self, start: date, end: date) -> list[date]:
        """The first days of the parts of a range that were never built."""
        wanted = parts_between(start, end, self.grain)
        try:
            rows = po.read_manifest(self.spark, self.folder, PART).select(PART).distinct().collect()
        except AnalysisException as error:
            # Nothing was ever written there.
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return wanted
        return sorted(set(wanted).difference(r[PART] for r in rows))

    def read(self, start: date, end: date, check: bool = False) -> DataFrame:
        """The rows of a range of days; with ``check``, held against the manifest first.

        All parts of the range must have been built: a missing one raises an error.
        """
        wanted = parts_between(start, end, self.grain)
        within = F.col(PART).between(F.lit(wanted[0]), F.lit(wanted[-1]))
        manifest = po.read_manifest(self.spark, self.folder, PART).where(within)
        n = manifest.select(PART).distinct().count()
        if n != len(wanted):
            raise po.IncompleteOutput(f"{self.folder}: {n} of {len(wanted)} parts from {start} to {end}")
        schema = f"{DAY} date, {self.schema}"
        rows = po.read_parts(self.spark, self.folder, PART, schema, within, check)
        return rows.where(F.col(DAY).between(F.lit(start), F.lit(end))).drop(PART)
