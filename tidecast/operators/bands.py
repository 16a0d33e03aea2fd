"""Forecast bands by lead day, from the errors that folds made at the same lead.

A fold predicts each day of the horizon from a known distance, its lead. The sizes of the errors
of all series and folds at one lead, each relative to the mean of its own training rows, are
pooled, and the band at that lead is as wide as the wanted share of them. So bands grow with the
lead where forecasts get worse, which a pair of quantiles of the fit's own residuals cannot show.

The order statistic comes from mergeable summaries of bounded size: its rank is off by at most
one in ``ACCURACY`` of the errors pooled, so up to that many it is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidecast.operators import folds as fd
from tidecast.operators import forecast_closed as fc
from tidecast.operators import scoring as sc
from tidecast.operators import series as ts

WIDTH = 0.95
ACCURACY = 1_000_000


def closed_scores(
    series: DataFrame,
    horizon: int,
    train_length: int = fd.TRAIN_LENGTH,
    cv_type: str = "rolling_window",
    origin: str = ts.HISTORY_START,
) -> DataFrame:
    """(series_id, fold_id, lead, score) of the closed form: one aggregation over C7's folds."""
    folds = fc.fold_fits(series, horizon, train_length, cv_type, origin)
    carry = (*fc.FIT_COLUMNS, "train_end_ds")
    days = fc.on_days(fd.fold_test_dates(folds, carry))
    scaled = days.withColumn("scale", F.abs(F.try_divide(F.col("sy"), F.col("n"))))
    return lead_scores(fc.weighted(sc.align(scaled, series), origin))


def lead_scores(rows: DataFrame) -> DataFrame:
    """Lead and relative size of the error of rows with ``train_end_ds``, ``y``, ``yhat`` and
    ``scale``. Days without a value and series whose scale is 0 have none."""
    known = rows.where(F.col("y").isNotNull() & (F.col("scale") > 0))
    return known.select(
        "series_id",
        "fold_id",
        F.datediff("ds", "train_end_ds").alias("lead"),
        (F.abs(F.col("y") - F.col("yhat")) / F.col("scale")).alias("score"),
    )


def half_widths(scores: DataFrame, by: tuple[str, ...] = (), width: float = WIDTH) -> DataFrame:
    """(lead, n_scores, half_width): relative half width of the band at each lead."""
    if not 0 < width < 1:
        raise ValueError(f"width must lie between 0 and 1, not {width}")
    return scores.groupBy(*by, "lead").agg(
        F.count(F.lit(1)).alias("n_scores"),
        F.percentile_approx("score", width, ACCURACY).alias("half_width"),
    )


def with_bands(
    forecast: DataFrame, widths: DataFrame, lead: Column, scale: Column, by: tuple[str, ...] = ()
) -> DataFrame:
    """``yhat_lower`` and ``yhat_upper`` for rows with yhat; NULL at a lead without errors.

    ``widths`` has a row per day of the horizon.
    """
    rows = forecast.withColumns({"lead": lead, "band_scale": scale})
    half = F.col("half_width") * F.col("band_scale")
    return (
        rows.join(widths.drop("n_scores"), [*by, "lead"], "left")
        .withColumns({"yhat_lower": F.col("yhat") - half, "yhat_upper": F.col("yhat") + half})
        .drop("band_scale", "half_width")
    )


def coverage(scores: DataFrame, widths: DataFrame) -> DataFrame:
    """(lead, n_scores, covered): the share of other folds' errors that lie within the band."""
    within = F.avg((F.col("score") <= F.col("half_width")).cast("double"))
    return (
        scores.join(widths.select("lead", "half_width"), "lead")
        .groupBy("lead")
        .agg(F.count(F.lit(1)).alias("n_scores"), within.alias("covered"))
    )


def closed_forecast_bands(
    series: DataFrame,
    periods: int,
    train_length: int = fd.TRAIN_LENGTH,
    width: float = WIDTH,
    origin: str = ts.HISTORY_START,
) -> DataFrame:
    """K6: the days to come of the closed form, each with the band of its lead."""
    fitted = fc.fit(series, ["series_id"], origin)
    last = series.groupBy("series_id").agg(F.max("ds").alias("last_ds"))
    to_come = ts.future_dates(series, periods).join(fitted, "series_id").join(last, "series_id")
    scaled = fc.on_days(to_come).withColumn("scale", F.abs(F.try_divide(F.col("sy"), F.col("n"))))
    rows = fc.weighted(scaled, origin)
    widths = half_widths(closed_scores(series, periods, train_length, origin=origin), (), width)
    lead = F.datediff("ds", "last_ds")
    return with_bands(rows, widths, lead, F.col("scale")).drop("last_ds", "scale")
