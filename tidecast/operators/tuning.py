"""Search over parameter sets and the choice between the tuned and the baseline model."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidecast.operators import additive_fit as af
from tidecast.operators import folds as fd
from tidecast.operators import forecast_additive as fa
from tidecast.operators import forecast_closed as fc
from tidecast.operators import params as pm
from tidecast.operators import scoring as sc
from tidecast.operators import series as ts

FIT_KEYS = ["series_id", "fold_id", "param_id"]


def cv_scores_closed(
    series: DataFrame,
    horizon: int,
    train_length: int = fd.TRAIN_LENGTH,
    cv_type: str = "rolling_window",
    level: str = "daily",
    origin: str = ts.HISTORY_START,
) -> DataFrame:
    """C7 for the closed form: error per series, fold and weight pair.

    All folds are fitted from running sums, and each carries its fit to the days it has to
    predict; the weights only change the prediction.
    """
    folds = fc.fold_fits(series, horizon, train_length, cv_type, origin)
    days = fc.on_days(fd.fold_test_dates(folds, tuple(fc.FIT_COLUMNS)))
    aligned = sc.align(days, series)
    params = fc.closed_params(series.sparkSession)
    work = pm.work_list(aligned, params).drop("set_bucket")
    return sc.smape(fc.weighted(work, origin), FIT_KEYS, level)


def cv_scores_additive(
    frame: DataFrame,
    folds: DataFrame,
    params: DataFrame,
    level: str = "daily",
    partitions: int | None = None,
    seasons: af.Seasons = af.Seasons(),
) -> DataFrame:
    """Error per series, fold and parameter set of the additive model.

    ``frame`` has every calendar day of each series with cap, floor and holiday effects. The
    sets of a fold are spread over ``SET_BUCKETS`` tasks, each of which gets the fold's days.
    """
    keys = ["series_id", "fold_id", "set_bucket"]
    work = fa.tuned_params(pm.work_list(folds.select("series_id", "fold_id"), params), keys)
    days = fd.fold_frame(frame, folds).withColumn("set_bucket", F.explode(pm.set_buckets()))
    predicted = fa.fit_predict(days, work, keys, partitions=partitions, seasons=seasons)
    return sc.smape(predicted, FIT_KEYS, level)


def median_scores(scores: DataFrame) -> DataFrame:
    """Median error of each parameter set over the folds."""
    return scores.groupBy("series_id", "param_id").agg(F.median("smape").alias("smape"))


def best_params(scores: DataFrame) -> DataFrame:
    """G17 + T4: the set with the lowest median per series, the first one on a tie."""
    ranked = median_scores(scores).where(F.col("smape").isNotNull())
    best = F.min(F.struct("smape", "param_id"))
    return ranked.groupBy("series_id").agg(best.alias("best")).select(
        "series_id", F.col("best.param_id").alias("param_id"), F.col("best.smape").alias("cv_smape")
    )


def select_model(baseline: DataFrame, tuned: DataFrame) -> DataFrame:
    """Per series the model with the lower holdout error; a tie goes to the baseline.

    A series that could not be tuned (too short for a fold) keeps its baseline.
    """
    scores = baseline.select("series_id", F.col("smape").alias("baseline_smape")).join(
        tuned.select("series_id", "param_id", F.col("smape").alias("tuned_smape")),
        "series_id",
        "left",
    )
    keeps_baseline = F.col("tuned_smape").isNull() | (
        F.col("baseline_smape") <= F.col("tuned_smape")
    )
    return scores.withColumn("model", F.when(keeps_baseline, "baseline").otherwise("tuned"))


def select_closed_model(
    series: DataFrame,
    horizon: int,
    train_length: int = fd.TRAIN_LENGTH,
    cv_type: str = "rolling_window",
    level: str = "daily",
    origin: str = ts.HISTORY_START,
) -> DataFrame:
    """C8 with the closed form, from series to chosen weights.

    The holdout score looks at its last ``horizon`` rows when the horizon is shorter.
    """
    split = ts.tail_split(series)
    train = split.where("is_train").select("series_id", "ds", "y")
    scored = ~F.col("is_train") & (F.col("rn") >= F.col("n") - horizon)
    holdout = split.where(scored).select("series_id", "ds", "y")
    scores = cv_scores_closed(train, horizon, train_length, cv_type, level, origin)
    params = F.broadcast(fc.closed_params(series.sparkSession))
    best = best_params(scores).join(params, "param_id")
    fitted = fc.fit(train, ["series_id"], origin)
    base = fc.predict(holdout, fitted, ["series_id"], origin)
    tuned = fc.predict(
        holdout.join(best.drop("cv_smape"), "series_id"), fitted, ["series_id"], origin
    )
    return select_model(
        sc.smape(base, ["series_id"], level, round_first=True),
        sc.smape(tuned, ["series_id", "param_id"], level, round_first=True),
    )
