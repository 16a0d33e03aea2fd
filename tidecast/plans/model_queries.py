"""Registered queries for the additive model and the whole forecast job.

The fits have no SQL twin; ``tests`` checks the model on series with known parts, and the
same search and choice run with SQL twins on the closed form (``series_queries``).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidecast.operators import folds as fd
from tidecast.operators import forecast_additive as fa
from tidecast.operators import params as pm
from tidecast.operators import series as ts
from tidecast.operators import tuning as tn
from tidecast.plans import forecast_job as fj
from tidecast.plans import series_queries as sq
from tidecast.plans.catalog import query
from tidecast.plans.metric_queries import scope
from tidecast.sources.standin import START, Tables

KEYS = ["series_id"]
RUN_DATE = "2001-12-01"


def holdout_frame(t: Tables, series):
    """Bounded series with holiday effects; the last 14 rows are to be predicted."""
    split = ts.tail_split(ts.with_bounds(series))
    return fa.with_holiday_effects(split, sq.job_holidays(t))


def sampled_params(t: Tables):
    return pm.sample_params(pm.param_space(t.spark))


@query("k1_additive_default")
def k1_additive_default(t: Tables):
    frame = holdout_frame(t, sq.series_all(t))
    work = fa.default_params(frame.select("series_id").distinct())
    return fa.fit_predict(frame, work, KEYS)


@query("k2_additive_tuned")
def k2_additive_tuned(t: Tables):
    """K2 - K6: every sampled set on the account-level series."""
    frame = holdout_frame(t, sq.series_all(t))
    work = pm.work_list(frame.select("series_id").distinct(), sampled_params(t))
    spread = [*KEYS, "set_bucket"]
    frame = frame.withColumn("set_bucket", F.explode(pm.set_buckets()))
    return fa.fit_predict(frame, fa.tuned_params(work, spread), spread).drop("set_bucket")


@query("k2_additive_regressor")
def k2_additive_regressor(t: Tables):
    """K2 with the level shift as an extra regressor, for every point of sale."""
    series = sq.series_pos(t)
    shift = ts.level_shift(series).select("series_id", "ds", "level_shift")
    frame = holdout_frame(t, ts.attach_regressor(series, shift))
    work = fa.default_params(frame.select("series_id").distinct())
    return fa.fit_predict(frame, work, KEYS)


@query("c7_cv_scores_additive")
def c7_cv_scores_additive(t: Tables):
    """C7 + K9: all sampled sets on all rolling folds of the account-level series."""
    series = sq.series_all(t)
    train = ts.tail_split(series).where("is_train").select("series_id", "ds", "y")
    folds = fd.fold_table(train, sq.HORIZON)
    frame = ts.with_gaps_filled(ts.with_bounds(series))
    frame = fa.with_holiday_effects(frame, sq.job_holidays(t))
    return tn.cv_scores_additive(frame, folds, sampled_params(t))


@query("e7_components")
def e7_components(t: Tables):
    """Trend, weekly, yearly and holiday parts, history and future, per point of sale."""
    frame = ts.with_future(ts.with_bounds(sq.series_pos(t)), sq.HORIZON)
    frame = frame.withColumn("is_train", F.col("y").isNotNull())
    frame = fa.with_holiday_effects(frame, sq.job_holidays(t))
    work = fa.default_params(frame.select("series_id").distinct())
    return fa.fit_predict(frame, work, KEYS, all_days=True)


def whole_frame(t: Tables):
    """History and future per point of sale, to fit with and to predict."""
    frame = ts.with_future(ts.with_bounds(sq.series_pos(t)), sq.HORIZON)
    frame = frame.withColumn("is_train", F.col("y").isNotNull())
    return fa.with_holiday_effects(frame, sq.job_holidays(t))


def kept_promises(fitted):
    """Whether the parts add up to yhat, and whether the band holds yhat."""
    total = sum((F.col(p) for p in fa.PARTS), F.lit(0.0))
    scale = F.greatest(F.abs("yhat"), *[F.abs(p) for p in fa.PARTS], F.lit(1.0))
    # A band of residual quantiles may lie beside yhat, but never upside down.
    return fitted.withColumns(
        {
            "adds_up": F.abs(total - F.col("yhat")) <= 1e-9 * scale,
            "band_in_order": F.col("yhat_lower") <= F.col("yhat_upper"),
        }
    )


@query("k1_promises", "SELECT series_id, CAST(ds AS VARCHAR) AS ds, true AS adds_up, "
       "true AS band_in_order FROM closed_frame")  # fmt: skip
def k1_promises(t: Tables):
    """Every day of history and future of every series, by its real fit."""
    frame = whole_frame(t)
    work = fa.default_params(frame.select("series_id").distinct())
    fitted = fa.fit_predict(frame, work, KEYS, all_days=True)
    return kept_promises(fitted).select("series_id", "ds", "adds_up", "band_in_order")


@query(
    "k2_promises",
    f"""SELECT 'All' AS series_id, param_id, {ts.HOLDOUT_DAYS} AS n_days, true AS adds_up,
               true AS band_in_order, true AS within_bounds FROM param_sample""",
)
def k2_promises(t: Tables):
    """K2 - K6: every sampled set; a logistic trend stays between floor and cap."""
    frame = holdout_frame(t, sq.series_all(t))
    params = sampled_params(t)
    work = pm.work_list(frame.select("series_id").distinct(), params)
    spread = [*KEYS, "set_bucket"]
    days = frame.withColumn("set_bucket", F.explode(pm.set_buckets()))
    fitted = fa.fit_predict(days, fa.tuned_params(work, spread), spread)
    limits = ts.bounds(sq.series_all(t))
    within = (F.col("growth") == "linear") | F.col("trend").between(F.col("floor"), F.col("cap"))
    return (
        kept_promises(fitted)
        .join(F.broadcast(params.select("param_id", "growth")), "param_id")
        .join(limits, "series_id")
        .groupBy("series_id", "param_id")
        .agg(
            F.count(F.lit(1)).alias("n_days"),
            F.bool_and("adds_up").alias("adds_up"),
            F.bool_and("band_in_order").alias("band_in_order"),
            F.bool_and(within).alias("within_bounds"),
        )
    )


@query(
    "forecast_coverage",
    f"""WITH s AS (
            SELECT series_id, max(ds) AS last_ds FROM series_pos GROUP BY ALL
            UNION ALL SELECT 'OneDay', max(ds) FROM series_pos)
        SELECT series_id, {sq.HORIZON} AS n_days, CAST(last_ds + 1 AS VARCHAR) AS first_ds,
               CAST(last_ds + {sq.HORIZON} AS VARCHAR) AS last_ds, {sq.HORIZON} AS n_known
        FROM s""",
)
def forecast_coverage(t: Tables):
    """Every series, also one of a single day, gets each day of the horizon, even if the
    regressor ends before it."""
    series = sq.series_pos(t)
    last = series.agg(F.max("ds").alias("ds"))
    one_day = last.select(F.lit("OneDay").alias("series_id"), "ds", F.lit(5.0).alias("y"))
    days = series.select("ds").distinct().unionByName(
        last.select(F.explode(F.sequence(F.date_add("ds", 1), F.date_add("ds", 3))).alias("ds"))
    )
    options = fj.ForecastOptions(
        run_date=RUN_DATE, horizon=sq.HORIZON, start_date=START, optimizer="default"
    )
    result = fj.forecast_series(
        series.unionByName(one_day), sq.job_holidays(t), options,
        days.withColumn("load", F.dayofmonth("ds")),
    )
    return result.prediction.groupBy("series_id").agg(
        F.count(F.lit(1)).alias("n_days"),
        F.min("ds").alias("first_ds"),
        F.max("ds").alias("last_ds"),
        F.count("yhat").alias("n_known"),
    )


def job(t: Tables, **changes):
    options = fj.ForecastOptions(
        run_date=RUN_DATE, horizon=sq.HORIZON, start_date=START, **changes
    )
    metrics = ["GrossCommission", "Cancellations"]
    return fj.forecast_account(t, "account_4", metrics, options, scope("account_4"))


@query("forecast_job_search")
def forecast_job_search(t: Tables):
    """The whole job with random search: rounded daily prediction of two metrics."""
    return job(t).prediction


@query("forecast_job_default")
def forecast_job_default(t: Tables):
    """The whole job without a search, per point of sale, as weekly totals."""
    return job(t, optimizer="default", per_pos=True).weekly
