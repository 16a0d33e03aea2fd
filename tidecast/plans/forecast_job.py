"""The daily forecast job: from input tables to daily, weekly and component tables.

All metrics asked for run in one job as separate series. The driver holds plans only. Three
results are materialised with a reliable checkpoint, because each is read several times
and costly to redo: the daily metric table (the only step that reads the big inputs), the
chosen parameter sets, and the final fits.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date, timedelta

from pyspark.sql import DataFrame, functions as F

from tidecast.operators import additive_fit as af
from tidecast.operators import folds as fd
from tidecast.operators import forecast_additive as fa
from tidecast.operators import holidays as hol
from tidecast.operators import params as pm
from tidecast.operators import reports as rp
from tidecast.operators import scoring as sc
from tidecast.operators import series as ts
from tidecast.operators import tuning as tn
from tidecast.operators.daily_summary import DailySummary
from tidecast.plans import registry as rg
from tidecast.session import cut_lineage
from tidecast.sources import scans
from tidecast.sources.csv_files import write_csv, write_run

# --- Fixed values ---------------------------------------------------------------------
DEFAULT_HORIZON = 90
# --------------------------------------------------------------------------------------

OPTIMIZERS = ("random_search", "default")


@dataclass
class ForecastOptions:
    """What to forecast, and how hard to search."""

    run_date: str
    horizon: int = DEFAULT_HORIZON
    optimizer: str = "random_search"
    level: str = "daily"
    cv_type: str = "rolling_window"
    start_date: str = ts.HISTORY_START
    holdout: int = ts.HOLDOUT_DAYS
    train_length: int = fd.TRAIN_LENGTH
    n_iter: int = pm.N_ITER
    seed: int = pm.SEARCH_SEED
    cv_size: int | None = None
    level_shift: bool = False
    per_pos: bool = False
    partitions: int | None = None
    yearly: str = "auto"
    weekly: str = "auto"
    baseline: af.Settings | None = None
    transform: str | None = None
    box_cox_lambda: float | None = None

    @property
    def seasons(self) -> af.Seasons:
        return af.Seasons(self.yearly, self.weekly)

    def __post_init__(self):
        if self.optimizer not in OPTIMIZERS:
            raise ValueError(f"optimizer must be one of {OPTIMIZERS}, not {self.optimizer!r}")
        if self.level not in sc.LEVELS or not self.seasons:
            raise ValueError(f"level must be one of {sc.LEVELS}, not {self.level!r}")


@dataclass
class ForecastResult:
    """Lazy tables over the materialised final fits."""

    prediction: DataFrame
    weekly: DataFrame
    components: DataFrame
    selection: DataFrame
    history: DataFrame

    def year_over_year(self) -> DataFrame:
        """E6 on demand."""
        return rp.year_over_year(self.prediction, self.history)

    def write_run(self, folder: str, run_date: str) -> None:
        """S10 for a daily job: each file holds one part per run date, and writing a run again
        replaces its part (see ``csv_files.write_run``)."""
        write_run(self.prediction, f"{folder}/daily_prediction", run_date, ["yhat"])
        write_run(self.weekly, f"{folder}/weekly_aggregates", run_date, ["yhat"])
        write_run(self.components, f"{folder}/components", run_date, ["yhat"])

    def write_csv(self, folder: str, mode: str = "errorifexists") -> None:
        """Daily, weekly and component files."""
        write_csv(self.prediction, f"{folder}/daily_prediction", mode)
        write_csv(self.weekly, f"{folder}/weekly_aggregates", mode)
        write_csv(self.components, f"{folder}/components", mode)


def job_holidays(
    daily_pos: DataFrame, calendar: DataFrame, pos_map: DataFrame, end_date: str
) -> DataFrame:
    """R6 + R7 for every series of the job, ranked by its own metric."""
    by = ["series_id"]
    totals = ts.trailing_pos_totals(daily_pos, "value", end_date, by)
    ranks = ts.average_rank(totals, by=by)
    return hol.with_windows(hol.select_holidays(hol.ranked_holidays(calendar, pos_map, ranks)))


def _frame(
    series: DataFrame,
    options: ForecastOptions,
    holidays: DataFrame,
    regressor: DataFrame | None,
) -> DataFrame:
    """Every calendar day, ``horizon`` days past the end, with its bounds, holiday effects
    and optional regressor (R3).

    History days that an external regressor does not know are not trained on. Days to come
    stay whether it knows them or not; ``regressor_known`` tells them apart, and the fit
    carries the last known value on.
    """
    frame = ts.with_gaps_filled(ts.with_bounds(series), options.horizon)
    if regressor is not None:
        frame = ts.attach_regressor(frame, regressor, how="left")
        known = F.col("regressor").isNotNull()
        frame = frame.withColumns({"regressor_known": known, "y": F.when(known, F.col("y"))})
    elif options.level_shift:
        frame = ts.level_shift(frame).withColumnRenamed("level_shift", "regressor")
        frame = frame.withColumn("regressor", F.col("regressor").cast("double"))
    return fa.with_holiday_effects(frame, holidays)


def _holdout_score(frame, work, options: ForecastOptions) -> DataFrame:
    predicted = fa.fit_predict(
        frame, work, ["series_id"], partitions=options.partitions, seasons=options.seasons
    )
    return sc.smape(predicted, ["series_id", "param_id"], options.level, round_first=True)


def forecast_series(
    series: DataFrame,
    holidays: DataFrame,
    options: ForecastOptions,
    regressor: DataFrame | None = None,
) -> ForecastResult:
    """Baseline, search, choice and final forecast for all series of a table.

    ``series``: (series_id, ds, y). Bounds come from the whole series, as the final model
    needs them for days to come. The holdout score looks at its last ``horizon`` days when
    the horizon is shorter than the holdout. With a transform, fits, scores and components
    are on the transformed scale, and the prediction is back on that of ``y``.
    """
    keys = ["series_id"]
    scale = (options.transform, options.box_cox_lambda)
    given, series = series, ts.transform(series, *scale)
    frame = cut_lineage(_frame(series, options, holidays, regressor))
    split = ts.tail_split(series, options.holdout)
    scored = split.where(F.col("is_train") | (F.col("rn") >= F.col("n") - options.horizon))
    holdout_frame = frame.join(
        scored.select("series_id", "ds", "is_train"), ["series_id", "ds"]
    ).where(F.col("y").isNotNull())
    groups = frame.select("series_id").distinct()
    base_work = fa.default_params(groups, options.baseline)
    selection = _holdout_score(holdout_frame, base_work, options).select(
        "series_id", F.col("smape").alias("baseline_smape"), F.lit("baseline").alias("model")
    )
    final_work = base_work
    if options.optimizer == "random_search":
        train = split.where("is_train").select("series_id", "ds", "y")
        folds = fd.fold_table(train, options.horizon, options.train_length, options.cv_type)
        folds = fd.sample_folds(folds, options.cv_size, options.seed)
        space = pm.param_space(frame.sparkSession)
        params = cut_lineage(pm.sample_params(space, options.n_iter, options.seed))
        scores = tn.cv_scores_additive(
            frame, folds, params, options.level, options.partitions, options.seasons
        )
        best = cut_lineage(tn.best_params(scores).join(F.broadcast(params), "param_id"))
        tuned_work = fa.tuned_params(best, keys)
        selection = cut_lineage(
            tn.select_model(
                _holdout_score(holdout_frame, base_work, options),
                _holdout_score(holdout_frame, tuned_work, options),
            )
        )
        # The values of each series' best set, whether it was chosen or not.
        selection = selection.join(best.select("series_id", *pm.PARAM_FIELDS), "series_id", "left")
        chosen = selection.where(F.col("model") == "tuned").select("series_id")
        final_work = tuned_work.join(chosen, "series_id", "left_semi").unionByName(
            base_work.join(chosen, "series_id", "left_anti")
        )
    last = cut_lineage(series.groupBy("series_id").agg(F.max("ds").alias("last_ds")))
    final_frame = frame.join(last, "series_id").withColumn(
        "is_train", F.col("ds") <= F.col("last_ds")
    )
    fitted = cut_lineage(
        fa.fit_predict(
            final_frame.where(~F.col("is_train") | F.col("y").isNotNull()).drop("last_ds"),
            final_work,
            keys,
            all_days=True,
            partitions=options.partitions,
            seasons=options.seasons,
        )
    )
    to_come = fitted.join(last, "series_id").where(F.col("ds") > F.col("last_ds"))
    prediction = rp.daily_prediction(ts.transform_back(to_come, ["yhat"], *scale))
    components = fitted.select("series_id", "ds", *fa.VALUES, "status")
    if "regressor_known" in frame.columns:
        known = frame.select("series_id", "ds", "regressor_known")
        components = components.join(known, ["series_id", "ds"])
    return ForecastResult(
        prediction=prediction,
        weekly=rp.weekly_totals(prediction),
        components=components,
        selection=selection,
        history=given,
    )


def forecast_account(
    tables: rg.Tables,
    account_name: str,
    metrics: list[str],
    options: ForecastOptions,
    scope: rg.Scope | None = None,
    regressor: DataFrame | None = None,
    pos: str | list[str] = "All",
    kept: DailySummary | None = None,
) -> ForecastResult:
    """The whole job for one account and any of its metrics.

    With a ``kept`` summary of these metrics (see ``registry.kept_metrics``) the history is read
    from it, and the facts behind it are not read at all.

    Without a ``scope`` it covers the history up to the day before the run date, for the
    chosen ``pos``; a given scope is cut there too.

    ``tables`` also holds ``holidays``, the calendar. Series are account-level sums, or one
    per metric and point of sale with ``per_pos``.
    """
    end_date = str(date.fromisoformat(options.run_date) - timedelta(days=1))
    scope = scope or rg.Scope(options.start_date, end_date, pos=pos)
    scope = replace(scope, end=min(scope.end, end_date))
    if kept is None:
        daily_pos = cut_lineage(rg.metrics_long(tables, account_name, metrics, scope))
    else:
        daily_pos = kept.read(date.fromisoformat(scope.start), date.fromisoformat(scope.end))
    series_id = (
        F.concat_ws("/", "series_id", "pos") if options.per_pos else F.col("series_id")
    )
    series = ts.daily_series(daily_pos, "value", series_id)
    calendar = scans.holiday_calendar(tables["holidays"], options.start_date)
    pos_map = rg.account(account_name).pos_map(tables, scope)
    holidays = job_holidays(daily_pos, calendar, pos_map, end_date)
    if options.per_pos:
        # every series of a metric shares the ranking of that metric's points of sale
        names = daily_pos.select("series_id", "pos").distinct()
        holidays = holidays.join(names, "series_id").select(
            series_id.alias("series_id"), "ds", "holiday", "lower_window", "upper_window"
        )
    return forecast_series(series, holidays, options, regressor)
