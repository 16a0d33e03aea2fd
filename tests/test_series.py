"""Series, holidays, folds, scores and reports on hand-made rows."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tidecast.operators import folds as fd
from tidecast.operators import forecast_closed as fc
from tidecast.operators import holidays as hol
from tidecast.operators import params as pm
from tidecast.operators import reports as rp
from tidecast.operators import scoring as sc
from tidecast.operators import series as ts
from tidecast.operators import tuning as tn

FIRST = date(2020, 1, 1)


def make_series(spark, n, series_id="A", first=FIRST, y=lambda i: float(i + 1)):
    rows = [(series_id, first + timedelta(days=i), y(i)) for i in range(n)]
    return spark.createDataFrame(rows, "series_id string, ds date, y double")


def test_average_rank_shares_ties(spark):
    totals = spark.createDataFrame([("a", 10), ("b", 10), ("c", 5)], "pos string, total int")
    ranks = {r["pos"]: r["pos_rank"] for r in ts.average_rank(totals).collect()}
    assert ranks == {"a": 1.5, "b": 1.5, "c": 3.0}


def test_forecast_rounds_half_to_even(spark):
    rows = [("A", FIRST, v) for v in (0.5, 1.5, 2.5)]
    df = spark.createDataFrame(rows, "series_id string, ds date, yhat double")
    assert sorted(r["yhat"] for r in rp.daily_prediction(df).collect()) == [0.0, 2.0, 2.0]


@pytest.mark.parametrize("cv_type", fd.CV_TYPES)
def test_fold_boundary(spark, cv_type):
    folds = fd.fold_table(make_series(spark, 12), 3, 4, cv_type).orderBy("fold_id").collect()
    assert [(f["fold_id"], f["cutoff"]) for f in folds] == [(0, 6), (1, 9)]
    starts = [2, 5] if cv_type == "rolling_window" else [0, 0]
    assert [f["train_start"] for f in folds] == starts
    for f, start in zip(folds, starts):
        assert f["train_start_ds"] == FIRST + timedelta(days=start)
        assert f["train_end_ds"] == FIRST + timedelta(days=f["cutoff"] - 1)


@pytest.mark.parametrize("n, train, size", [(10, 4, 3), (30, 10, 5), (31, 10, 5), (8, 8, 2)])
def test_folds_equal_the_counting_rule(spark, n, train, size):
    expected = sorted(range(n, train, -size)[1:])
    got = fd.fold_table(make_series(spark, n), size, train).orderBy("fold_id").collect()
    assert [f["cutoff"] for f in got] == expected
    assert [f["fold_id"] for f in got] == list(range(len(expected)))


def test_train_and_test_are_disjoint_with_gaps(spark):
    series = make_series(spark, 40).where(F.dayofmonth("ds") % 7 != 3)
    folds = fd.fold_table(series, 4, 10)
    frame = fd.fold_frame(ts.with_gaps_filled(series), folds)
    sizes = frame.groupBy("fold_id").agg(
        F.count_if("is_train").alias("train"),
        F.count_if(~F.col("is_train")).alias("test"),
        F.max(F.when(F.col("is_train"), F.col("ds"))).alias("last"),
        F.min(F.when(~F.col("is_train"), F.col("ds"))).alias("first"),
    ).collect()
    assert sizes and all(r["train"] == 10 and r["test"] == 4 for r in sizes)
    assert all(r["first"] > r["last"] for r in sizes)
    train_rows = fd.fold_train_rows(series, folds).groupBy("fold_id").count().collect()
    assert {r["count"] for r in train_rows} == {10}


def test_fold_sample_is_seeded(spark):
    folds = fd.fold_table(make_series(spark, 60), 3, 10)
    one = {r["cutoff"] for r in fd.sample_folds(folds, 5).collect()}
    two = {r["cutoff"] for r in fd.sample_folds(folds, 5).collect()}
    assert one == two and len(one) == 5
    assert fd.sample_folds(folds, None).count() == folds.count()


def test_short_series_has_no_fold(spark):
    assert fd.fold_table(make_series(spark, 5), 3, 10).count() == 0


def test_param_space_and_sample(spark):
    space = pm.param_space(spark)
    sizes = space.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_distinct(c).alias(c) for c in pm.PARAM_FIELDS],
    ).first()
    assert sizes["n"] == 400_000
    assert [sizes[c] for c in pm.PARAM_FIELDS] == [2, 200, 25, 2, 20]
    sample = pm.sample_params(space).collect()
    assert len({r["space_id"] for r in sample}) == pm.N_ITER
    assert sorted(r["param_id"] for r in sample) == list(range(pm.N_ITER))


def test_scores(spark):
    rows = [("A", FIRST, y, yhat) for y, yhat in ((0.0, 0.0), (0.0, 1.0), (None, 1.0))]
    df = spark.createDataFrame(rows, "series_id string, ds date, y double, yhat double")
    assert sc.smape(df, ["series_id"]).first()["smape"] == 50.0
    assert sc.smape(df, ["series_id"], scale="standard").first()["smape"] == 200.0
    assert sc.smape(df, ["series_id"], "period").first()["smape"] == 50.0
    with pytest.raises(ValueError):
        sc.smape(df, ["series_id"], "quarterly")


def test_weekly_score_sums_weeks_first(spark):
    rows = [("A", FIRST + timedelta(days=i), 1.0, 2.0 if i % 2 else 0.0) for i in range(28)]
    df = spark.createDataFrame(rows, "series_id string, ds date, y double, yhat double")
    daily = sc.smape(df, ["series_id"]).first()["smape"]
    weekly = sc.smape(df, ["series_id"], "weekly").first()["smape"]
    assert daily > weekly > 0.0


def test_only_full_weeks_are_reported(spark):
    monday = date(2019, 12, 16)
    rows = [("A", monday + timedelta(days=i), 1.0) for i in range(25)]
    df = spark.createDataFrame(rows, "series_id string, ds date, yhat double")
    weeks = {(r["year"], r["week"]): r["yhat"] for r in rp.weekly_totals(df).collect()}
    assert weeks == {(2019, 51): 7.0, (2019, 52): 7.0}
    iso = {(r["year"], r["week"]) for r in rp.weekly_totals(df, "iso").collect()}
    assert iso == {(2019, 51), (2019, 52), (2020, 1)}


def test_holiday_selection_counts_rows(spark):
    rows = [(FIRST, "Top", "p1", 1.0), (FIRST, "Top", "p9", 9.0)]
    rows += [(FIRST, "Nine", f"q{i}", 6.0 + i) for i in range(9)]
    rows += [(FIRST, "Ten", f"q{i}", 6.0 + i) for i in range(10)]
    ranked = spark.createDataFrame(rows, "ds date, holiday string, pos string, pos_rank double")
    assert {r["holiday"] for r in hol.select_holidays(ranked).collect()} == {"Top", "Ten"}


def test_holiday_windows_and_days(spark):
    names = ["ChristmasEve", "NewYearsDay", "Other"]
    df = spark.createDataFrame([(FIRST, n) for n in names], "ds date, holiday string")
    days = hol.expand_windows(hol.with_windows(df)).collect()
    offsets = {n: sorted(r["offset"] for r in days if r["holiday"] == n) for n in names}
    assert offsets == {"ChristmasEve": [-1, 0], "NewYearsDay": [-1, 0, 1], "Other": [0]}


def test_winsorize_touches_the_right_count(spark):
    long = make_series(spark, 40).withColumnRenamed("y", "residual")
    out = rp.winsorize(long, "residual", "clipped").agg(
        F.min("clipped").alias("low"), F.max("clipped").alias("high")
    ).first()
    assert (out["low"], out["high"]) == (3.0, 38.0)
    short = make_series(spark, 14).withColumnRenamed("y", "residual")
    same = rp.winsorize(short, "residual", "clipped").where("clipped <> residual")
    assert same.count() == 0


def test_future_and_bounds(spark):
    frame = ts.with_future(ts.with_bounds(make_series(spark, 10)), 3)
    future = frame.where("y is null").orderBy("ds").collect()
    assert [r["ds"] for r in future] == [FIRST + timedelta(days=10 + i) for i in range(3)]
    assert all(abs(r["cap"] - 11.0) < 1e-9 and abs(r["floor"] - 0.9) < 1e-9 for r in future)


def test_level_shift_starts_on_28_december(spark):
    series = make_series(spark, 12, first=date(2019, 12, 25))
    shifts = [r["level_shift"] for r in ts.level_shift(series).orderBy("ds").collect()]
    assert shifts == [0] * 3 + [1] * 9


def test_ties_keep_the_baseline_and_the_first_set(spark):
    base = spark.createDataFrame([("A", 1.0), ("B", 2.0), ("C", 1.0)], "series_id string, smape double")
    tuned = spark.createDataFrame(
        [("A", 3, 1.0), ("B", 4, 1.5)], "series_id string, param_id int, smape double"
    )
    got = {r["series_id"]: r["model"] for r in tn.select_model(base, tuned).collect()}
    assert got == {"A": "baseline", "B": "tuned", "C": "baseline"}
    scores = spark.createDataFrame(
        [("A", 2, 1.0), ("A", 1, 1.0), ("A", 0, 9.0)], "series_id string, param_id int, smape double"
    )
    assert tn.best_params(scores).first()["param_id"] == 1


@pytest.mark.parametrize("kind, lam", [("log", None), ("box_cox", 0.0)])
def test_a_day_without_a_transform_is_an_error(spark, kind, lam):
    days = spark.sql("select 's' series_id, date'2020-01-01' ds, cast(y as double) y from values (0), (2), (null) t(y)")
    with pytest.raises(Exception, match="zero or negative y: s 2020-01-01"):
        ts.transform(days, kind, lam).collect()
    assert ts.transform(days.where("y is null or y > 0"), kind, lam).where("y is null").count() == 1
    assert ts.transform(days, "box_cox", 0.5).where("y is null").count() == 1


@pytest.mark.parametrize("cv_type", fd.CV_TYPES)
def test_running_sums_give_the_fits_of_the_training_rows(spark, cv_type):
    """Two series of different length, with gaps and days without a value, and a short one."""
    rows = [
        ("a", FIRST + timedelta(days=k + k // 9), None if k % 11 == 3 else (k * 37 % 101) + 0.25 * k)
        for k in range(90)
    ]
    rows += [("b", date(2021, 3, 5) + timedelta(days=k), float(k % 7)) for k in range(40)]
    rows += [("c", date(2021, 3, 5), 1.0), ("d", date(2021, 3, 5), None)]
    series = spark.createDataFrame(rows, "series_id string, ds date, y double").repartition(4)
    folds = fd.fold_table(series, 7, 30, cv_type)
    keys = ["series_id", "fold_id"]
    want = fc.fit(fd.fold_train_rows(series, folds), keys, "2020-01-01").orderBy(*keys).collect()
    got = fc.fold_fits(series, 7, 30, cv_type, "2020-01-01").orderBy(*keys).collect()
    assert len(got) == len(want) == folds.count() > 8
    for one, other in zip(got, want, strict=True):
        assert [one[k] for k in keys] == [other[k] for k in keys]
        for name in fc.FIT_COLUMNS:
            assert one[name] == pytest.approx(other[name], rel=1e-9, abs=1e-9), name
