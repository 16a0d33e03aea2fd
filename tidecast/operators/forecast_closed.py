"""Closed-form forecaster: linear trend, weekday effects, holiday effects, all as sums.

A fit needs only counts and sums per weekday, so one map-side combined aggregation fits any
number of series (or series x folds) at once and no group is ever collected. The two
weights allow tuning: ``trend_weight`` scales the slope, ``weekday_weight`` the weekday
effects.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidecast.operators import folds as fd
from tidecast.operators import holidays as hol
from tidecast.operators import series as ts

WEEKDAYS = range(7)
TREND_WEIGHTS = (0.0, 0.5, 1.0)
WEEKDAY_WEIGHTS = (0.0, 0.5, 1.0)
BASELINE = (1.0, 1.0)


def closed_params(spark: SparkSession) -> DataFrame:
    """The weight pairs a search tries, numbered from 0."""
    per_row = len(WEEKDAY_WEIGHTS)
    number = F.col("id").cast("int")
    trend = F.array(*[F.lit(w) for w in TREND_WEIGHTS])
    weekday = F.array(*[F.lit(w) for w in WEEKDAY_WEIGHTS])
    return spark.range(len(TREND_WEIGHTS) * per_row).select(
        number.alias("param_id"),
        F.get(trend, F.floor(number / per_row).cast("int")).alias("trend_weight"),
        F.get(weekday, number % per_row).alias("weekday_weight"),
    )


N_CLOSED_PARAMS = len(TREND_WEIGHTS) * len(WEEKDAY_WEIGHTS)


def day_number(ds: Column, origin: str) -> Column:
    """Days since a fixed origin; keep it near the data so that sums stay exact."""
    return F.datediff(ds, F.to_date(F.lit(origin)))


def _day_values(origin: str) -> dict[str, Column]:
    """What a row adds to each sum of a fit; a row without y adds nothing."""
    seen = F.col("y").isNotNull()
    x, y = day_number(F.col("ds"), origin).cast("double"), F.col("y")
    values = {"n": F.lit(1.0), "sx": x, "sy": y, "sxx": x * x, "sxy": x * y}
    for d in WEEKDAYS:
        on_day = F.weekday("ds") == d
        for name, value in (("n", F.lit(1.0)), ("sx", x), ("sy", y)):
            values[f"wd_{name}_{d}"] = F.when(on_day, value).otherwise(0.0)
    return {name: F.when(seen, value).otherwise(0.0) for name, value in values.items()}


def _fit_columns(sums: DataFrame, keep: list[str]) -> DataFrame:
    """The slope from the sums, and the sums per weekday as arrays."""
    slope = F.try_divide(
        F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy"),
        F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx"),
    )
    weekdays = [
        F.array(*[F.col(f"wd_{name}_{d}") for d in WEEKDAYS]).alias(f"wd_{name}")
        for name in ("n", "sx", "sy")
    ]
    return sums.select(
        *keep, "n", "sx", "sy", *weekdays, F.coalesce(slope, F.lit(0.0)).alias("slope")
    )


FIT_COLUMNS = ["n", "sx", "sy", "wd_n", "wd_sx", "wd_sy", "slope"]


def fit(rows: DataFrame, keys: list[str], origin: str = ts.HISTORY_START) -> DataFrame:
    """K7: sums per key over rows with ``ds`` and ``y``; one output row per key."""
    values = _day_values(origin)
    known = rows.where(F.col("y").isNotNull())
    sums = known.groupBy(*keys).agg(*[F.sum(v).alias(name) for name, v in values.items()])
    return _fit_columns(sums, keys)


def fold_fits(
    series: DataFrame,
    pred_size: int,
    train_length: int = fd.TRAIN_LENGTH,
    cv_type: str = "rolling_window",
    origin: str = ts.HISTORY_START,
) -> DataFrame:
    """K7 for every fold of ``fold_table``, with its columns and those of ``fit``.

    Each row carries the running sums of its series. The fit of a fold is the difference of
    two running rows, its last training row and the row before its first one, so the cost is
    one pass over the days, however many folds a day lies in.
    """
    values = _day_values(origin)
    so_far = ts.by_date().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = F.struct(*[F.sum(v).over(so_far).alias(name) for name, v in values.items()])
    rows = series.select("series_id", "ds", running.alias("sums"))
    rolling = cv_type == "rolling_window"
    if rolling:
        rows = rows.withColumn("before", F.lag("sums", train_length).over(ts.by_date()))
    folds = fd.fold_table(rows, pred_size, train_length, cv_type)

    def of_fold(name: str) -> Column:
        upto = F.col(f"sums.{name}")
        return upto - F.coalesce(F.col(f"before.{name}"), F.lit(0.0)) if rolling else upto

    own = [c for c in folds.columns if c not in ("sums", "before")]
    sums = folds.select(*own, *[of_fold(name).alias(name) for name in values])
    return _fit_columns(sums.where(F.col("n") > 0), own)


def on_days(frame: DataFrame) -> DataFrame:
    """Of a fit's sums per weekday, those of the weekday of ``ds``."""
    day = F.weekday("ds")
    names = ("wd_n", "wd_sx", "wd_sy")
    return frame.withColumns({f"day_{n}": F.get(n, day) for n in names}).drop(*names)


def weighted(frame: DataFrame, origin: str = ts.HISTORY_START) -> DataFrame:
    """``yhat`` with its parts for rows that carry a fit (see ``on_days``).

    ``frame`` may carry ``trend_weight`` and ``weekday_weight``; without them both are 1.
    """
    trend_w = F.col("trend_weight") if "trend_weight" in frame.columns else F.lit(BASELINE[0])
    week_w = F.col("weekday_weight") if "weekday_weight" in frame.columns else F.lit(BASELINE[1])
    slope = F.col("slope") * trend_w
    intercept = (F.col("sy") - slope * F.col("sx")) / F.col("n")
    seen = F.col("day_wd_n")
    weekday_gap = (F.col("day_wd_sy") - intercept * seen - slope * F.col("day_wd_sx")) / F.when(
        seen > 0, seen
    )
    trend = intercept + slope * day_number(F.col("ds"), origin)
    return (
        frame.withColumns({"trend": trend, "weekly": F.coalesce(weekday_gap, F.lit(0.0)) * week_w})
        .withColumn("yhat", F.col("trend") + F.col("weekly"))
        .drop("n", "sx", "sy", "slope", "day_wd_n", "day_wd_sx", "day_wd_sy")
    )


def predict(frame: DataFrame, fitted: DataFrame, keys: list[str], origin: str = ts.HISTORY_START):
    """K7: ``yhat`` with its ``trend`` and ``weekly`` parts for every row of ``frame``.

    ``frame`` may carry ``trend_weight`` and ``weekday_weight``; without them both are 1.
    """
    return weighted(on_days(frame.join(fitted, keys)), origin)


def day_sets(holidays: DataFrame) -> DataFrame:
    """``holiday_set`` per day: all holiday effects that fall on it."""
    return hol.features_by_day(holidays).withColumnRenamed("effects", "holiday_set")


def holiday_effects(rows: DataFrame, holidays: DataFrame, keys: list[str]) -> DataFrame:
    """K7: mean of y - yhat over the days with the same set of holidays, per key.

    A day counts once, for its whole set, so holidays that overlap share their effect.
    """
    return (
        rows.where(F.col("y").isNotNull())
        .join(day_sets(holidays), [*hol.series_key(holidays), "ds"])
        .groupBy(*keys, "holiday_set")
        .agg(F.avg(F.col("y") - F.col("yhat")).alias("effect"))
    )


def add_holiday_effects(
    forecast: DataFrame, effects: DataFrame, holidays: DataFrame, keys: list[str]
) -> DataFrame:
    """K7: add the effect of each day's holidays; a set never seen before adds nothing."""
    added = F.coalesce("effect", F.lit(0.0))
    return (
        forecast.join(day_sets(holidays), [*hol.series_key(holidays), "ds"], "left")
        .join(effects, [*keys, "holiday_set"], "left")
        .withColumns({"holidays": added, "yhat": F.col("yhat") + added})
        .drop("holiday_set", "effect")
    )


def forecast(
    series: DataFrame,
    periods: int,
    holidays: DataFrame | None = None,
    origin: str = ts.HISTORY_START,
) -> DataFrame:
    """K7 end to end: history and ``periods`` future days with their fitted values."""
    keys = ["series_id"]
    rows = predict(ts.with_future(series, periods), fit(series, keys, origin), keys, origin)
    if holidays is None:
        return rows.withColumn("holidays", F.lit(0.0))
    effects = holiday_effects(rows, holidays, keys)
    return add_holiday_effects(rows, effects, holidays, keys)
