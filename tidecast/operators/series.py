"""Daily series: many series in one table, one row per (series_id, ds).

After the daily sum a series has at most one row per calendar day, so windows over one
series stay small no matter how many facts a day holds. All windows below partition by
``series_id`` and share one shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from tidecast.functions import dates as dt
from tidecast.functions import numbers as nm

# --- Fixed values ---------------------------------------------------------------------
HISTORY_START = "2015-01-01"
CAP_FACTOR = 1.1
FLOOR_FACTOR = 0.9
HOLDOUT_DAYS = 14
RANK_WINDOW_DAYS = 365
# --------------------------------------------------------------------------------------


def whole_series() -> WindowSpec:
    return Window.partitionBy("series_id")


def by_date() -> WindowSpec:
    return whole_series().orderBy("ds")


def daily_series(metric: DataFrame, value: str, series_id: Column | None = None) -> DataFrame:
    """G12 + R1: daily sums as ``(series_id, ds, y)``; one 'All' series unless told otherwise."""
    series = F.lit("All") if series_id is None else series_id
    return (
        metric.select(
            series.alias("series_id"), F.col("yyyy_mm_dd").alias("ds"), F.col(value).alias("y")
        )
        .groupBy("series_id", "ds")
        .agg(F.sum("y").cast("double").alias("y"))
    )


def transform(series: DataFrame, kind: str | None = None, lam: float | None = None) -> DataFrame:
    """R1 with M6 / M7: optional log or Box-Cox transform of y.

    A day whose y has no transform (negative, or 0 under log or a lambda of 0 or less) raises
    an error, so that no day falls out of a fit unnoticed; NULL stays NULL.
    """

    def checked(done: Column, bad: Column) -> Column:
        where = F.concat_ws(" ", F.col("series_id").cast("string"), F.col("ds").cast("string"))
        error = F.concat(F.lit(f"no {kind} transform of a zero or negative y: "), where)
        return F.when(bad, F.raise_error(error).cast("double")).otherwise(done)

    if kind is None:
        return series
    y = F.col("y")
    if kind == "log":
        return series.withColumn("y", checked(nm.log_transform(y), y <= 0))
    if kind == "box_cox":
        if lam is None:
            raise ValueError("box_cox needs a lambda")
        return series.withColumn("y", checked(nm.box_cox(y, lam), (y <= 0) if lam <= 0 else (y < 0)))
    raise ValueError(f"unknown transform {kind!r}")


def transform_back(
    forecast: DataFrame, columns: list[str], kind: str | None = None, lam: float | None = None
) -> DataFrame:
    """R1 backwards: the columns on the scale of y before ``transform``."""
    if kind is None:
        return forecast
    if kind == "log":
        return forecast.withColumns({c: nm.inverse_log(F.col(c)) for c in columns})
    if kind == "box_cox" and lam is not None:
        return forecast.withColumns({c: nm.inverse_box_cox(F.col(c), lam) for c in columns})
    raise ValueError(f"no inverse for {kind!r} with lambda {lam}")


def bounds(series: DataFrame) -> DataFrame:
    """One row per series with its cap and floor."""
    return series.groupBy("series_id").agg(
        (F.max("y") * CAP_FACTOR).alias("cap"), (F.min("y") * FLOOR_FACTOR).alias("floor")
    )


def with_bounds(series: DataFrame) -> DataFrame:
    """G18 on every row."""
    return series.withColumns(
        {
            "cap": F.max("y").over(whole_series()) * CAP_FACTOR,
            "floor": F.min("y").over(whole_series()) * FLOOR_FACTOR,
        }
    )


def indexed(series: DataFrame) -> DataFrame:
    """``rn`` counts rows from 0 in date order; ``n`` is the length of the series."""
    return series.withColumns(
        {
            "rn": F.row_number().over(by_date()) - 1,
            "n": F.count(F.lit(1)).over(whole_series()).cast("int"),
        }
    )


def tail_split(series: DataFrame, holdout: int = HOLDOUT_DAYS) -> DataFrame:
    """Mark the last rows of each series as holdout (``is_train`` false)."""
    return indexed(series).withColumn("is_train", F.col("rn") < F.col("n") - holdout)


def tail(series: DataFrame, rows: int) -> DataFrame:
    """The last rows of each series."""
    latest_first = Window.partitionBy("series_id").orderBy(F.desc("ds"))
    return (
        series.withColumn("from_end", F.row_number().over(latest_first))
        .where(F.col("from_end") <= rows)
        .drop("from_end")
    )


def future_dates(series: DataFrame, periods: int, carry: tuple[str, ...] = ()) -> DataFrame:
    """R4 + R5: the days after the last date of each series, with values carried along."""
    last = series.groupBy("series_id").agg(
        F.max("ds").alias("last_ds"), *[F.max(c).alias(c) for c in carry]
    )
    days = dt.date_array(F.date_add("last_ds", 1), F.date_add("last_ds", periods))
    return last.select("series_id", F.explode(days).alias("ds"), *carry)


def with_future(series: DataFrame, periods: int) -> DataFrame:
    """R4 + R5: history followed by ``periods`` days without y."""
    carry = tuple(c for c in ("cap", "floor") if c in series.columns)
    return series.unionByName(
        future_dates(series, periods, carry), allowMissingColumns=True
    )


def with_gaps_filled(series: DataFrame, periods: int = 0) -> DataFrame:
    """Every calendar day from the first date on, ``periods`` days past the last one.

    Days without a row get a NULL y; folds count rows, forecasts count days.
    """
    carry = [c for c in ("cap", "floor") if c in series.columns]
    span = series.groupBy("series_id").agg(
        F.min("ds").alias("first_ds"),
        F.max("ds").alias("last_ds"),
        *[F.max(c).alias(c) for c in carry],
    )
    days = dt.date_array(F.col("first_ds"), F.date_add("last_ds", periods))
    spine = span.select("series_id", F.explode(days).alias("ds"), *carry)
    return spine.join(series.drop(*carry), ["series_id", "ds"], "left")


def gap_report(series: DataFrame) -> DataFrame:
    """Days a series lacks between its first and last date."""
    return series.groupBy("series_id").agg(
        F.count(F.lit(1)).alias("days_present"),
        (F.datediff(F.max("ds"), F.min("ds")) + 1 - F.count(F.lit(1))).alias("days_missing"),
    )


def level_shift(series: DataFrame) -> DataFrame:
    """R2 + W5: number of the year in the series; the next one already from 28 December."""
    year_number = F.dense_rank().over(
        Window.partitionBy("series_id").orderBy(F.year("ds"))
    ) - 1
    late = (F.month("ds") >= 12) & (F.day("ds") >= 28)
    return series.withColumn("level_shift", year_number + F.when(late, 1).otherwise(0))


def attach_regressor(series: DataFrame, regressor: DataFrame, how: str = "inner") -> DataFrame:
    """R3 + J11: keep days the regressor knows, with its one extra column as ``regressor``.

    With ``how="left"`` all days stay, and ``regressor`` is NULL where it is not known.
    """
    keys = [c for c in ("series_id", "ds") if c in regressor.columns]
    (value,) = [c for c in regressor.columns if c not in keys]
    side = regressor.select(*keys, F.col(value).cast("double").alias("regressor"))
    return series.join(side, keys, how)


def trailing_pos_totals(
    metric: DataFrame, value: str, end_date: str, by: list[str] | None = None
) -> DataFrame:
    """Total per point of sale over the last 365 days before the end date.

    ``by`` keeps several series in one table apart, for instance ``["series_id"]``.
    """
    since = F.date_sub(F.to_date(F.lit(end_date)), RANK_WINDOW_DAYS)
    return (
        metric.where(F.col("yyyy_mm_dd") >= since)
        .groupBy(*(by or []), "pos")
        .agg(F.sum(value).alias("total"))
    )


def average_rank(
    totals: DataFrame, value: str = "total", by: list[str] | None = None
) -> DataFrame:
    """Descending rank in which ties share the mean of their places.

    The input has one row per point of sale (and series), a short list by nature.
    """
    keys = by or []
    place = F.rank().over(Window.partitionBy(*keys).orderBy(F.desc(value)))
    ties = F.count(F.lit(1)).over(Window.partitionBy(*keys, value))
    return totals.withColumn("pos_rank", place + (ties - 1) / F.lit(2.0))
