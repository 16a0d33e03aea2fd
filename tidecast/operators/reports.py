"""Reports: rounded daily forecast, full weeks, year over year, residuals."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidecast.functions import dates as dt
from tidecast.functions import numbers as nm

# --- Fixed values ---------------------------------------------------------------------
FULL_WEEK = 7
WINSOR_SHARE = 0.05
# --------------------------------------------------------------------------------------


def daily_prediction(forecast: DataFrame) -> DataFrame:
    """M8: date and forecast rounded half-even to whole numbers."""
    return forecast.select(
        "series_id", "ds", nm.round_half_even(F.col("yhat")).alias("yhat")
    )


def weekly_totals(prediction: DataFrame, year_mode: str = "calendar") -> DataFrame:
    """Forecast per week, for weeks with all seven days predicted.

    ``calendar`` pairs the ISO week with the calendar year; around New Year the parts of
    one week then fall into different years. ``iso`` uses the ISO year instead.
    """
    return (
        prediction.groupBy(
            "series_id",
            dt.week_year(F.col("ds"), year_mode).alias("year"),
            dt.iso_week(F.col("ds")).alias("week"),
        )
        .agg(F.count("yhat").alias("days"), F.sum("yhat").alias("yhat"))
        .where(F.col("days") == FULL_WEEK)
        .drop("days")
    )


def year_over_year(
    prediction: DataFrame, actual: DataFrame, year_mode: str = "calendar"
) -> DataFrame:
    """Predicted week next to the same week one year before."""
    last_year = actual.groupBy(
        "series_id",
        (dt.week_year(F.col("ds"), year_mode) + 1).alias("year"),
        dt.iso_week(F.col("ds")).alias("week"),
    ).agg(F.sum("y").alias("y_last_year"))
    return (
        weekly_totals(prediction, year_mode)
        .join(last_year, ["series_id", "year", "week"])
        .withColumn("yoy", F.try_divide("yhat", "y_last_year") - 1)
    )


def residuals(forecast: DataFrame, actual: DataFrame) -> DataFrame:
    """J14 + M13: forecast minus actual on days that have both."""
    predicted = forecast.select("series_id", "ds", "yhat")
    joined = predicted.join(actual.select("series_id", "ds", "y"), ["series_id", "ds"])
    return joined.withColumn("residual", F.col("yhat") - F.col("y"))


def winsorize(
    rows: DataFrame, column: str, result: str, share: float = WINSOR_SHARE
) -> DataFrame:
    """Replace the lowest and highest ``share`` of each series by the nearest kept value.

    int(share * n) values change on each side, so a short series keeps all of its values.
    """
    whole = Window.partitionBy("series_id")
    order = whole.orderBy(column)
    ranked = rows.withColumns(
        {
            "_place": F.row_number().over(order),
            "_count": F.count(F.lit(1)).over(whole),
        }
    ).withColumn("_cut", F.floor(F.col("_count") * share))
    kept = F.when(
        (F.col("_place") > F.col("_cut")) & (F.col("_place") <= F.col("_count") - F.col("_cut")),
        F.col(column),
    )
    clipped = F.least(
        F.greatest(F.col(column), F.min(kept).over(whole)), F.max(kept).over(whole)
    )
    return ranked.withColumn(result, clipped).drop("_place", "_count", "_cut")
