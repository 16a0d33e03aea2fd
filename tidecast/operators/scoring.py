"""Forecast errors.

The error is a quarter of the usual symmetric percentage error (0 .. 50); pass
``scale='standard'`` for 0 .. 200. Days without an actual value and 0/0 do not count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidecast.functions import numbers as nm

LEVELS = ("daily", "weekly", "period")
SCALES = {"quarter": 1.0, "standard": 4.0}


def align(forecast: DataFrame, actual: DataFrame, on: list[str] | None = None) -> DataFrame:
    """Forecast with the actual value of the same day, NULL where there is none."""
    keys = on or ["series_id", "ds"]
    return forecast.join(actual.select(*keys, "y"), keys, "left")


def _relative_gap(y: Column, yhat: Column) -> Column:
    return F.try_divide(F.abs(y - yhat), F.abs(y) + F.abs(yhat)) / 2


def smape(
    rows: DataFrame,
    by: list[str],
    level: str = "daily",
    round_first: bool = False,
    scale: str = "quarter",
) -> DataFrame:
    """Error per group ``by`` of rows with ``ds``, ``y`` and ``yhat``.

    ``round_first`` rounds the forecast half-even before comparing, as for a holdout.
    """
    if level not in LEVELS:
        raise ValueError(f"level must be one of {LEVELS}, not {level!r}")
    y, yhat = F.col("y"), F.col("yhat")
    if round_first:
        rows = rows.withColumn("yhat", nm.round_half_even(yhat))
    factor = 100 * SCALES[scale]
    if level == "daily":
        return rows.groupBy(*by).agg((F.avg(_relative_gap(y, yhat)) * factor).alias("smape"))
    sums = [F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in ("y", "yhat")]
    if level == "weekly":
        weeks = rows.groupBy(*by, F.weekofyear("ds").alias("week")).agg(*sums)
        return weeks.groupBy(*by).agg((F.avg(_relative_gap(y, yhat)) * factor).alias("smape"))
    totals = rows.groupBy(*by).agg(*sums)
    gap = _relative_gap(F.abs(y), F.abs(yhat))
    return totals.select(*by, (gap * factor).alias("smape"))
