"""The additive model from sums against the numpy fit of the days themselves."""

from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidecast.operators import additive_fit as af
from tidecast.operators import folds as fd
from tidecast.operators import linear_fit as lf
from tidecast.operators import scoring as sc

FIRST = date(2018, 3, 4)


def made(days, seed, gaps=True):
    """Line, week, year, one holiday, noise; some days missing, some without a value."""
    rng = np.random.default_rng(seed)
    rows = []
    for k in range(days):
        day = FIRST + timedelta(days=k)
        y = 900 + 0.4 * k + 70 * (day.weekday() == 5) + 120 * np.sin(2 * np.pi * k / 365.25)
        y += 300 * ((day.month, day.day) == (12, 24)) + rng.normal(0, 20)
        if not (gaps and k % 17 == 5):
            rows.append((f"s{seed}", day, None if gaps and k % 23 == 7 else float(y)))
    return rows


@pytest.fixture(scope="module")
def series(spark):
    rows = made(1000, 1) + made(900, 2, gaps=False) + made(40, 3) + [("one", FIRST, 7.0), ("none", FIRST, None)]
    return spark.createDataFrame(rows, "series_id string, ds date, y double").repartition(5).cache()


@pytest.fixture(scope="module")
def holidays(spark):
    rows = [(date(y, 12, 24), "ChristmasEve", -1, 0) for y in range(2017, 2023)]
    return spark.createDataFrame(rows, "ds date, holiday string, lower_window int, upper_window int").cache()


def day_number(day):
    return float((day - date(1970, 1, 1)).days)


def numpy_fit(rows, seasons, known):
    """yhat of the numpy model without changepoints for all rows."""
    days = np.array([day_number(r.ds) for r in rows])
    y = np.array([np.nan if r.y is None else r.y for r in rows])
    names = sorted({e for r, k in zip(rows, known, strict=True) if k for e in r.effects or ()})
    effects = np.array([[float(n in (r.effects or ())) for n in names] for r in rows]).reshape(len(rows), len(names))
    settings = af.Settings(n_changepoints=0)
    return af.fit_predict(days, y, np.array(known), effects, settings, seasons=seasons)


@pytest.mark.parametrize("yearly", [True, False])
def test_sums_give_the_fit_of_the_days(series, holidays, yearly):
    got = lf.forecast(series, 30, holidays, yearly=yearly, origin="2018-01-01")
    rows = got.orderBy("series_id", "ds").collect()
    assert {r.series_id for r in rows} == {"s1", "s2", "s3", "one"}
    seasons = af.Seasons("on" if yearly else "off", "on")
    for name in ("s1", "s2", "s3"):
        own = [r for r in rows if r.series_id == name]
        want = numpy_fit(own, seasons, [r.y is not None for r in own])
        scale = np.abs(want["yhat"]).max()
        if name == "s3" and yearly:
            # 40 days do not determine a year; the days themselves are fitted alike.
            known = [i for i, r in enumerate(own) if r.y is not None]
            assert np.allclose([own[i].yhat for i in known], want["yhat"][known], rtol=1e-4)
            continue
        for part in ("yhat", "trend", "weekly", "yearly", "holidays"):
            assert np.allclose([r[part] for r in own], want[part], rtol=0, atol=1e-5 * scale), (name, part)
    assert all(np.isfinite(r.yhat) for r in rows)


@pytest.mark.parametrize("cv_type", fd.CV_TYPES)
def test_folds_add_up_their_segments(series, holidays, cv_type):
    design = lf.Design(lf.effect_names(holidays))
    rows = lf.with_effects(series, holidays)
    origin, keys = "2018-01-01", ["series_id", "fold_id"]
    folds = fd.fold_table(series, 31, 365, cv_type)
    want = lf.day_sums(fd.fold_train_rows(rows, folds), design, keys, origin).orderBy(*keys).collect()
    got = lf.fold_sums(rows, design, 31, 365, cv_type, origin).orderBy(*keys).collect()
    assert len(got) == len(want) == folds.count() > 20
    for one, other in zip(got, want, strict=True):
        assert [one[k] for k in keys] == [other[k] for k in keys]
        assert np.allclose(one.cells, other.cells, rtol=1e-9, atol=1e-6)
        assert (one.low_day, one.high_day, one.top) == (other.low_day, other.high_day, other.top)


def test_known_parts_are_found(spark):
    """Without noise the line, the weekday and the holiday come back."""
    rows = []
    for k in range(1500):
        day = FIRST + timedelta(days=k)
        rows.append(("s", day, 500 + 0.5 * k + 40.0 * np.cos(2 * np.pi * day_number(day) / 7) + 90.0 * ((day.month, day.day) == (5, 1))))
    days = [(date(y, 5, 1), "MayDay", 0, 0) for y in range(2018, 2025)]
    holidays = spark.createDataFrame(days, "ds date, holiday string, lower_window int, upper_window int")
    series = spark.createDataFrame([(a, b, float(c)) for a, b, c in rows], "series_id string, ds date, y double")
    got = lf.forecast(series, 400, holidays, yearly=False, origin="2018-01-01")
    for r in got.where("y is null").collect():
        k = (r.ds - FIRST).days
        assert r.trend == pytest.approx(500 + 0.5 * k, rel=2e-3)
        assert r.weekly == pytest.approx(40.0 * np.cos(2 * np.pi * day_number(r.ds) / 7), abs=1)
        assert r.holidays == pytest.approx(90.0 if (r.ds.month, r.ds.day) == (5, 1) else 0.0, abs=3)


def test_fold_errors_equal_the_numpy_path(series, holidays):
    """The search's error of a fold is that of fitting its days in numpy."""
    design = lf.Design(lf.effect_names(holidays))
    got = {
        (r.series_id, r.fold_id): r.smape
        for r in lf.cv_scores_linear(series, 31, design, holidays, 740, origin="2018-01-01").collect()
    }
    folds = fd.fold_table(series, 31, 740)
    train = lf.with_effects(fd.fold_train_rows(series, folds).select("series_id", "fold_id", "ds", "y"), holidays)
    test = lf.with_effects(sc.align(fd.fold_test_dates(folds), series), holidays)
    assert len(got) == folds.count() > 5
    both = train.withColumn("known", F.col("y").isNotNull()).unionByName(test.withColumn("known", F.lit(False)))
    rows = both.orderBy("ds").collect()
    for key, smape in got.items():
        own = [r for r in rows if (r.series_id, r.fold_id) == key]
        yhat = numpy_fit(own, af.Seasons("on", "on"), [r.known for r in own])["yhat"]
        last = max(r.ds for r in own if r.known)
        gaps = [abs(r.y - h) / (abs(r.y) + abs(h)) / 2 for r, h in zip(own, yhat, strict=True) if r.ds > last and r.y is not None]
        assert smape == pytest.approx(100 * np.mean(gaps), rel=1e-4)


def test_no_day_reaches_python(series, holidays):
    plan = lf.forecast(series, 30, holidays)._jdf.queryExecution().executedPlan().toString()
    python = [line for line in plan.splitlines() if "Python" in line or "Arrow" in line]
    assert python and not any("ds#" in line or " y#" in line for line in python)
