"""Additive forecaster for many series: Spark groups the days, a small helper fits them.

A group holds the days of one series (or of one fold of it), so its size is bounded by the
calendar. The parameter sets to try come as a second, cogrouped table: a fold's days are
shuffled once, not once per parameter set.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tidecast.operators import additive_fit as af
from tidecast.operators import holidays as hol
from tidecast.operators import params as pm
from tidecast.session import ship_package, task_slots

# --- Fixed values: interval width of a tuned model -----------------------------------
TUNED_INTERVAL = 0.95
# -------------------------------------------------------------------------------------

PARTS = ["trend", "weekly", "yearly", "holidays", "regressor"]
VALUES = ["yhat", "yhat_lower", "yhat_upper", *PARTS]
# How a row came about: fitted; constant (the one value that a series with a single training
# row has); or no_history, with NULL values.
FITTED, CONSTANT, NO_HISTORY = "fitted", "constant", "no_history"


def default_params(groups: DataFrame, base: af.Settings | None = None) -> DataFrame:
    """K1: the default parameter set, or ``base``, as number -1, for each row of ``groups``."""
    base = base or af.Settings()
    return groups.select(
        "*",
        F.lit(-1).alias("param_id"),
        F.lit(base.interval_width).alias("interval_width"),
        *[F.lit(getattr(base, name)).alias(name) for name in pm.PARAM_FIELDS],
    )


def tuned_params(work: DataFrame, keys: list[str]) -> DataFrame:
    """K2: sampled parameter sets, with the interval width of tuned models."""
    return work.select(
        *keys, "param_id", F.lit(TUNED_INTERVAL).alias("interval_width"), *pm.PARAM_FIELDS
    )


def with_holiday_effects(frame: DataFrame, holidays: DataFrame | None) -> DataFrame:
    """Add ``effects``, the holiday effects of each day (NULL for most days)."""
    if holidays is None:
        return frame.withColumn("effects", F.lit(None).cast("array<string>"))
    return frame.join(
        hol.features_by_day(holidays), [*hol.series_key(holidays), "ds"], "left"
    )


def _effect_matrix(effects: pd.Series, is_train: np.ndarray) -> np.ndarray:
    """One 0/1 column per effect seen in training; other effects have nothing to learn."""
    sets = [() if e is None else tuple(e) for e in effects]
    names = sorted({name for s, used in zip(sets, is_train) if used for name in s})
    matrix = np.zeros((len(sets), len(names)))
    column = {name: i for i, name in enumerate(names)}
    for row, present in enumerate(sets):
        for name in present:
            if name in column:
                matrix[row, column[name]] = 1.0
    return matrix


def _optional(values: pd.Series) -> float | None:
    known = values.dropna()
    return float(known.iloc[0]) if len(known) else None


def _without_fit(known: np.ndarray, rows: int) -> tuple[dict[str, np.ndarray], str]:
    """Values of a series with one training row or none: that value as trend, or nothing."""
    level = float(known[0]) if len(known) else np.nan
    out = {name: np.full(rows, 0.0 if len(known) else np.nan) for name in VALUES}
    for name in ("yhat", "yhat_lower", "yhat_upper", "trend"):
        out[name] = np.full(rows, level)
    return out, CONSTANT if len(known) else NO_HISTORY


def _fit_group(keys: list[str], all_days: bool, seasons: af.Seasons):
    def fit(key: tuple, frame: pd.DataFrame, work: pd.DataFrame) -> pd.DataFrame:
        columns = [*keys, "param_id", "ds", "y", *VALUES, "status"]
        if frame.empty or work.empty:
            return pd.DataFrame(columns=columns)
        frame = frame.sort_values("ds")
        days = pd.to_datetime(frame["ds"]).to_numpy().astype("datetime64[D]").astype(float)
        y = frame["y"].to_numpy(dtype=float)
        is_train = frame["is_train"].to_numpy(dtype=bool)
        effects = _effect_matrix(frame["effects"], is_train)
        regressor = None
        if "regressor" in frame.columns:
            regressor = frame["regressor"].astype(float).ffill().fillna(0.0).to_numpy()
        keep = np.ones(len(frame), dtype=bool) if all_days else ~is_train
        results = []
        for row in work.itertuples(index=False):
            settings = af.Settings(
                interval_width=row.interval_width,
                **{name: getattr(row, name) for name in pm.PARAM_FIELDS},
            )
            if is_train.sum() < 2:
                out, status = _without_fit(y[is_train], len(frame))
            else:
                status = FITTED
                out = af.fit_predict(
                    days, y, is_train, effects, settings,
                    _optional(frame["cap"]), _optional(frame["floor"]), regressor, seasons,
                )
            result = pd.DataFrame({name: out[name][keep] for name in VALUES})
            result.insert(0, "y", y[keep])
            result.insert(0, "ds", frame["ds"].to_numpy()[keep])
            result.insert(0, "param_id", row.param_id)
            result["status"] = status
            for name, value in zip(reversed(keys), reversed(key)):
                result.insert(0, name, value)
            results.append(result)
        return pd.concat(results, ignore_index=True)[columns]

    return fit


def fit_predict(
    frame: DataFrame,
    work: DataFrame,
    keys: list[str],
    all_days: bool = False,
    partitions: int | None = None,
    seasons: af.Seasons = af.Seasons(),
) -> DataFrame:
    """Fit every parameter set of ``work`` on the days of its group.

    ``frame``: keys, ds, y, cap, floor, is_train, effects and optionally regressor.
    ``work``: keys, param_id, interval_width and the parameter fields.
    Returns the days to predict (or all days) with ``yhat``, its band, its parts and a
    ``status``. Every group with days and sets comes out, however short its history.

    The partition count is explicit: AQE would pack these few but costly rows into one task.
    """
    ship_package(frame.sparkSession)
    slots = partitions or task_slots(frame.sparkSession)
    types = {f.name: f.dataType.simpleString() for f in frame.schema.fields}
    schema = ", ".join(
        [f"{k} {types[k]}" for k in keys]
        + ["param_id int", "ds date", "y double"]
        + [f"{name} double" for name in VALUES]
        + ["status string"]
    )
    used = [*keys, "ds", "y", "cap", "floor", "is_train", "effects"]
    if "regressor" in frame.columns:
        used.append("regressor")
    days = frame.select(*used).repartition(slots, *keys).groupBy(*keys)
    # own names, because both sides may stem from the same columns
    set_keys = [f"set_{k}" for k in keys]
    sets = (
        work.withColumnsRenamed(dict(zip(keys, set_keys)))
        .repartition(slots, *set_keys)
        .groupBy(*set_keys)
    )
    fitted = days.cogroup(sets).applyInPandas(_fit_group(keys, all_days, seasons), schema)
    return fitted.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in ["y", *VALUES]})
