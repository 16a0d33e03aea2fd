"""Properties of both forecasters on series with known parts."""

from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidecast.operators import additive_fit as af
from tidecast.operators import forecast_additive as fa
from tidecast.operators import forecast_closed as fc
from tidecast.operators import holidays as hol
from tidecast.operators import params as pm

N, TEST = 800, 60
DAYS = np.arange(18000.0, 18000.0 + N)
TRAIN = np.arange(N) < N - TEST
WEEK = np.array([4.0, 2.0, 0.0, -1.0, -2.0, -3.0, 0.0])[np.arange(N) % 7]
LINE = 100.0 + 0.05 * np.arange(N)
NONE = np.zeros((N, 0))


def fit(y, effects=NONE, cap=None, floor=None, regressor=None, **settings):
    return af.fit_predict(DAYS, y, TRAIN, effects, af.Settings(**settings), cap, floor, regressor)


def test_line_and_week_are_recovered():
    out = fit(LINE + WEEK)
    assert np.abs(out["yhat"] - LINE - WEEK).max() < 0.5


def test_multiplicative_week_is_recovered():
    y = LINE * (1 + WEEK / 50)
    out = fit(y, seasonality_mode="multiplicative")
    assert np.abs(out["yhat"] / y - 1).max() < 0.01


def test_forecast_scales_with_the_series():
    y = LINE + WEEK
    one, ten = fit(y)["yhat"], fit(10 * y)["yhat"]
    assert np.abs(ten - 10 * one).max() < 1e-3 * np.abs(ten).max()


@pytest.mark.parametrize("mode", ["additive", "multiplicative"])
def test_logistic_trend_stays_between_floor_and_cap(mode):
    y = 50 + 100 / (1 + np.exp(-(np.arange(N) - 300) / 80)) + WEEK
    cap, floor = y.max() * 1.1, y.min() * 0.9
    out = fit(y, growth="logistic", seasonality_mode=mode, cap=cap, floor=floor)
    assert out["trend"].max() < cap and out["trend"].min() > floor
    assert np.abs(out["yhat"] - y)[TRAIN].mean() < 2.0


def test_smaller_prior_scale_means_smaller_slope_changes():
    y = np.where(np.arange(N) < 300, LINE, LINE + 0.3 * (np.arange(N) - 300))
    noise = np.random.default_rng(1).normal(0, 3, N)

    def bend(tau):
        trend = fit(y + noise, changepoint_prior_scale=tau)["trend"]
        return np.abs(np.diff(trend, 2)).sum()

    assert bend(0.0005) < bend(0.05) <= bend(0.5) * 1.05


def test_holiday_effect_is_recovered():
    hits = np.zeros(N)
    hits[50::97] = 1.0
    out = fit(LINE + 30 * hits, effects=hits[:, None])
    assert np.abs(out["holidays"][hits == 1] - 30).max() < 2.0


def test_regressor_effect_is_recovered():
    x = np.random.default_rng(2).normal(0, 1, N)
    out = fit(LINE + 5 * x, regressor=x)
    assert np.corrcoef(out["regressor"], x)[0, 1] > 0.999
    assert np.abs(out["yhat"] - LINE - 5 * x)[TRAIN].mean() < 0.5


def test_parts_add_up():
    out = fit(LINE + WEEK)
    total = sum(out[p] for p in ("trend", "weekly", "yearly", "holidays", "regressor"))
    assert np.allclose(total, out["yhat"])
    assert (out["yhat_lower"] <= out["yhat_upper"]).all()


def spark_series(spark, names=("A", "B")):
    first = date(2019, 1, 1)
    rows = [
        (s, first + timedelta(days=i), (k + 1) * float(LINE[i] + WEEK[i]))
        for k, s in enumerate(names)
        for i in range(N)
    ]
    return spark.createDataFrame(rows, "series_id string, ds date, y double")


def test_grouped_fit_equals_the_helper(spark):
    frame = fa.with_holiday_effects(
        spark_series(spark).select(
            "*",
            F.lit(None).cast("double").alias("cap"),
            F.lit(None).cast("double").alias("floor"),
            (F.col("ds") < date(2019, 1, 1) + timedelta(days=N - TEST)).alias("is_train"),
        ),
        None,
    )
    work = fa.default_params(frame.select("series_id").distinct())
    rows = fa.fit_predict(frame, work, ["series_id"]).orderBy("series_id", "ds").collect()
    assert len(rows) == 2 * TEST
    origin = (date(2019, 1, 1) - date(1970, 1, 1)).days
    direct = af.fit_predict(
        np.arange(origin, origin + N, dtype=float), LINE + WEEK, TRAIN, NONE, af.Settings()
    )["yhat"][~TRAIN]
    assert np.allclose([r["yhat"] for r in rows[:TEST]], direct)


def test_closed_form_recovers_line_week_and_holiday(spark):
    series = spark_series(spark, ("A",))
    holiday = date(2019, 6, 5)
    bumped = series.withColumn(
        "y", F.col("y") + F.when(F.col("ds") == holiday, 50.0).otherwise(0.0)
    )
    holidays = hol.with_windows(
        spark.createDataFrame([(holiday, "Day")], "ds date, holiday string")
    )
    rows = fc.forecast(bumped, 30, holidays, origin="2019-01-01").collect()
    assert len(rows) == N + 30
    day = [r for r in rows if r["ds"] == holiday][0]
    assert abs(day["holidays"] - 50) < 1.0
    # The bump leaks into its weekday's mean (one of N / 7 values) and into the line, whose
    # ends feel a single value with a weight of at most 4 / N.
    leak = 50 * 7 / N + 50 * 4 / N
    errors = [abs(r["yhat"] - r["y"]) for r in rows if r["y"] is not None]
    assert max(errors) < leak


def test_closed_form_of_one_day_and_missing_weekdays(spark):
    series = spark.createDataFrame(
        [("A", date(2020, 1, 1), 5.0)], "series_id string, ds date, y double"
    )
    rows = fc.forecast(series, 8, origin="2020-01-01").collect()
    assert {r["yhat"] for r in rows} == {5.0}


def one_holiday_day(spark, per_series: bool):
    rows = spark.sql(
        "SELECT 'a' AS series_id, explode(sequence(date'2001-01-01', date'2001-03-31')) AS ds"
    )
    day = "ds = date'2001-02-14'"
    rows = rows.withColumn("y", F.expr(f"CASE WHEN {day} THEN 110.0 ELSE 10.0 END"))
    holidays = spark.sql(
        "SELECT date'2001-02-14' AS ds, explode(array('one', 'two')) AS holiday,"
        " 0 AS lower_window, 0 AS upper_window"
    )
    if per_series:
        holidays = holidays.withColumn("series_id", F.lit("a"))
    return fc.forecast(rows, 7, holidays, "2001-01-01").where(day).first()


def test_overlapping_holidays_count_once(spark):
    row = one_holiday_day(spark, per_series=False)
    assert row["yhat"] == pytest.approx(110.0)


def test_closed_form_takes_holidays_per_series(spark):
    assert one_holiday_day(spark, per_series=True)["yhat"] == pytest.approx(110.0)


def test_all_sampled_sets_are_tried(spark):
    folds = spark.createDataFrame([("a", 0), ("a", 1)], "series_id string, fold_id int")
    params = pm.sample_params(pm.param_space(spark), 40)
    work = pm.work_list(folds, params)
    assert work.count() == 80
    assert work.select("set_bucket").distinct().count() == pm.SET_BUCKETS


def test_seasons_can_be_forced_and_left_out():
    days = np.arange(10.0)
    y = 5 + np.sin(days)
    out = {}
    for weekly in ("auto", "on", "off"):
        out[weekly] = af.fit_predict(
            days, y, np.ones(10, bool), np.zeros((10, 0)), af.Settings(),
            seasons=af.Seasons(weekly=weekly),
        )["weekly"]
    assert not out["auto"].any() and not out["off"].any() and out["on"].any()
    with pytest.raises(ValueError):
        af.Seasons(yearly="maybe")
