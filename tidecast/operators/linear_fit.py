"""The additive model with a straight trend, fitted from sums alone.

With linear growth, additive seasons and no changepoints the posterior mode depends on the days
only through X'X, X'y, y'y and the number of days, X being the columns of the model: intercept,
day, Fourier terms of the week and the year, and one column per holiday effect. Those sums are
one map-side combined aggregation over the days; no day is shipped to Python. What Python gets is
one small matrix per series (or fold), whose size is the number of columns.

Folds are ranges of rows that start and end on few places, so the days are summed once, by the
segments between these places, and a fold adds up its segments.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F

from tidecast.operators import additive_fit as af
from tidecast.operators import folds as fd
from tidecast.operators import holidays as hol
from tidecast.operators import scoring as sc
from tidecast.operators import series as ts
from tidecast.session import ship_package, task_slots

# Solutions for a noise scale and noise scales for a solution take turns; the prior is weak, so
# few turns settle it.
TURNS = 6
EPOCH = "1970-01-01"


class Design:
    """The columns of the model, as one array per day.

    ``effects`` names the holiday effects that get a column; days carry theirs in a column
    ``effects`` (see ``with_holiday_effects``).
    """

    def __init__(self, effects: list[str] = (), yearly: bool = True, weekly: bool = True):
        self.effects = list(effects)
        sizes = {
            "weekly": 2 * af.WEEK_ORDER * weekly,
            "yearly": 2 * af.YEAR_ORDER * yearly,
            "holidays": len(self.effects),
        }
        self.blocks, at = {}, 2
        for name, size in sizes.items():
            self.blocks[name] = (at, size)
            at += size
        self.size = at

    def day(self) -> Column:
        return F.datediff("ds", F.to_date(F.lit(EPOCH))).cast("double")

    def terms(self) -> Column:
        """All columns but intercept and day."""
        day, columns = self.day(), []
        for name, period, order in (
            ("weekly", af.WEEK_DAYS, af.WEEK_ORDER), ("yearly", af.YEAR_DAYS, af.YEAR_ORDER),
        ):
            if self.blocks[name][1]:
                angles = [F.lit(2.0 * np.pi * k / period) * day for k in range(1, order + 1)]
                columns += [F.cos(a) for a in angles] + [F.sin(a) for a in angles]
        for name in self.effects:
            there = F.coalesce(F.array_contains("effects", name), F.lit(False))
            columns.append(there.cast("double"))
        return F.array(*columns) if columns else F.array().cast("array<double>")

    def row(self, origin: Column) -> Column:
        """(1, day - origin, terms, y)."""
        return F.concat(F.array(F.lit(1.0), self.day() - origin), self.terms(), F.array("y"))

    def prior(self) -> np.ndarray:
        """Precision of each coefficient."""
        out = np.full(self.size, 1.0 / af.EFFECT_SCALE**2)
        out[:2] = 1.0 / af.BASE_SCALE**2
        return out


def products(row: str) -> Column:
    """The upper triangle of the outer product of an array with itself, line by line."""
    column = F.col(row)
    return F.flatten(
        F.transform(column, lambda a, i: F.transform(F.slice(column, i + 1, F.size(column) - i), lambda b: a * b))
    )


def effect_names(holidays: DataFrame | None) -> list[str]:
    """The holiday effects of a table of holidays with windows: as many as the calendar names."""
    if holidays is None:
        return []
    names = hol.features_by_day(holidays).select(F.explode("effects").alias("name")).distinct()
    return sorted(r["name"] for r in names.collect())


SUM_COLUMNS = ["cells", "low_day", "high_day", "top"]


def day_sums(rows: DataFrame, design: Design, keys: list[str], origin: str) -> DataFrame:
    """Per key: ``cells``, first and last day number, and the largest size of y.

    ``origin`` is a day near the data; sums of squares of day numbers stay small with it.
    """
    # A day is small but makes a product per pair of columns, so days are dealt out evenly; AQE
    # would pack them into one task by their bytes. A hot series is dealt out too.
    slots = task_slots(rows.sparkSession)
    known = rows.where(F.col("y").isNotNull()).select(*keys, "ds", "y", "effects")
    known = known.repartition(slots, *keys, "ds")
    start = F.datediff(F.to_date(F.lit(origin)), F.to_date(F.lit(EPOCH))).cast("double")
    # A column of its own, so that it is made once per day and not once per product.
    made = known.select(*keys, design.row(start).alias("row"), design.day().alias("day"), "y")
    squared = made.withColumn("cells", array_to_vector(products("row")))
    return squared.groupBy(*keys).agg(
        vector_to_array(Summarizer.sum(F.col("cells"))).alias("cells"),
        F.min("day").alias("low_day"),
        F.max("day").alias("high_day"),
        F.max(F.abs("y")).alias("top"),
    )


def segment_sums(
    series: DataFrame, design: Design, pred_size: int, train_length: int, origin: str
) -> DataFrame:
    """Sums per series and segment: the rows between two neighbouring ends or starts of folds.

    Counted from the end, the row before the m-th cutoff has ``after_end`` m, and the row before
    the start of a window of ``train_length`` that ends there has ``after_start`` m.
    """
    rows = ts.indexed(series)
    left = F.col("n") - 1 - F.col("rn")
    marked = rows.withColumns(
        {
            "after_end": F.floor(left / pred_size).cast("int"),
            "after_start": F.floor((left - train_length) / pred_size).cast("int"),
        }
    )
    return day_sums(marked, design, ["series_id", "after_end", "after_start"], origin)


def fold_sums(
    series: DataFrame,
    design: Design,
    pred_size: int,
    train_length: int = fd.TRAIN_LENGTH,
    cv_type: str = "rolling_window",
    origin: str = ts.HISTORY_START,
) -> DataFrame:
    """The folds of ``fold_table`` with the sums of their training rows.

    A fold meets the segments of its series, about two for each fold, never its days.
    """
    folds = fd.fold_table(series.select("series_id", "ds"), pred_size, train_length, cv_type)
    ends = ts.indexed(series.select("series_id", "ds")).groupBy("series_id").agg(F.max("n").alias("n"))
    numbered = folds.join(ends, "series_id").withColumn(
        "turn", ((F.col("n") - F.col("cutoff")) / pred_size).cast("int")
    )
    segments = segment_sums(series, design, pred_size, train_length, origin)
    within = F.col("after_end") >= F.col("turn")
    if cv_type == "rolling_window":
        within = within & (F.col("after_start") < F.col("turn"))
    keep = [c for c in numbered.columns if c not in ("n", "turn")]
    met = numbered.join(segments, "series_id").where(within)
    return met.groupBy(*keep).agg(
        vector_to_array(Summarizer.sum(array_to_vector("cells"))).alias("cells"),
        F.min("low_day").alias("low_day"),
        F.max("high_day").alias("high_day"),
        F.max("top").alias("top"),
    )


def solve(cells: np.ndarray, start: float, span: float, scale: float, prior: np.ndarray) -> np.ndarray:
    """Coefficients for columns (1, time from 0 to 1 over the training span, terms) and y / scale.

    The posterior mode: with a noise variance v the solution of (X'X + v * prior) theta = X'y,
    and v the mode under its half-normal prior, given the residuals.
    """
    n = len(prior) + 1
    full = np.zeros((n, n))
    full[np.triu_indices(n)] = cells
    full = full + np.triu(full, 1).T
    change = np.eye(n)
    change[0, 1], change[1, 1], change[-1, -1] = -start / span, 1.0 / span, 1.0 / scale
    full = change.T @ full @ change
    gram, pull, total, rows = full[:-1, :-1], full[:-1, -1], full[-1, -1], full[0, 0]
    s, rss = af.NOISE_SCALE**2, total
    theta = np.zeros(len(prior))
    for _ in range(TURNS):
        noise = max(s * (-rows + np.sqrt(rows * rows + 4.0 * rss / s)) / 2.0, 1e-10)
        theta = np.linalg.solve(gram + noise * np.diag(prior), pull)
        rss = max(total - 2.0 * theta @ pull + theta @ gram @ theta, 0.0)
    return theta


def fit(sums: DataFrame, design: Design, origin: str = ts.HISTORY_START) -> DataFrame:
    """``theta``, and the day number, span and size that its columns are scaled with.

    ``sums`` has a row per series (or fold) with the columns of ``day_sums``.
    """
    ship_package(sums.sparkSession)
    prior = design.prior()
    base = (pd.Timestamp(origin) - pd.Timestamp(EPOCH)).days

    @F.pandas_udf("array<double>")
    def solved(cells: pd.Series, low: pd.Series, high: pd.Series, top: pd.Series) -> pd.Series:
        rows = zip(cells, low, high, top, strict=True)
        return pd.Series(
            [
                solve(np.asarray(c, float), a - base, max(b - a, 1.0), t or 1.0, prior).tolist()
                for c, a, b, t in rows
            ],
            dtype=object,
        )

    scaled = sums.withColumn("theta", solved("cells", "low_day", "high_day", "top"))
    return scaled.withColumns(
        {
            "span": F.greatest(F.col("high_day") - F.col("low_day"), F.lit(1.0)),
            "scale": F.when(F.col("top") > 0, F.col("top")).otherwise(1.0),
        }
    ).drop("cells", "high_day", "top")


FIT_COLUMNS = ["theta", "low_day", "span", "scale"]


def values(frame: DataFrame, design: Design) -> DataFrame:
    """``yhat`` and its parts for rows with ``ds``, ``effects`` and the columns of a fit."""
    theta, scale = F.col("theta"), F.col("scale")
    t = (design.day() - F.col("low_day")) / F.col("span")
    rows = frame.withColumn("terms", design.terms())

    def part(at: int, size: int) -> Column:
        products = F.zip_with(
            F.slice(theta, at + 1, size), F.slice("terms", at - 1, size), lambda a, b: a * b
        )
        return F.aggregate(products, F.lit(0.0), lambda total, x: total + x) * scale

    parts = {"trend": (F.get(theta, F.lit(0)) + F.get(theta, F.lit(1)) * t) * scale}
    for name, (at, size) in design.blocks.items():
        parts[name] = part(at, size) if size else F.lit(0.0)
    out = rows.withColumns(parts)
    return out.withColumn("yhat", sum((F.col(p) for p in parts), F.lit(0.0))).drop("terms", *FIT_COLUMNS)


def cv_scores_linear(
    series: DataFrame,
    horizon: int,
    design: Design,
    holidays: DataFrame | None = None,
    train_length: int = fd.TRAIN_LENGTH,
    cv_type: str = "rolling_window",
    level: str = "daily",
    origin: str = ts.HISTORY_START,
) -> DataFrame:
    """C7 for the additive model with a straight trend: error per series and fold."""
    rows = with_effects(series, holidays)
    sums = fold_sums(rows, design, horizon, train_length, cv_type, origin)
    fitted = fit(sums, design, origin)
    days = fd.fold_test_dates(fitted, tuple(FIT_COLUMNS))
    predicted = values(with_effects(sc.align(days, series), holidays), design)
    return sc.smape(predicted, ["series_id", "fold_id"], level)


def with_effects(rows: DataFrame, holidays: DataFrame | None) -> DataFrame:
    """Adds ``effects``, the holiday effects of each day; a calendar that Spark sizes itself."""
    if holidays is None:
        return rows.withColumn("effects", F.lit(None).cast("array<string>"))
    return rows.join(hol.features_by_day(holidays), [*hol.series_key(holidays), "ds"], "left")


def forecast(
    series: DataFrame,
    periods: int,
    holidays: DataFrame | None = None,
    yearly: bool = True,
    weekly: bool = True,
    origin: str = ts.HISTORY_START,
) -> DataFrame:
    """History and ``periods`` future days with fitted values and their parts."""
    design = Design(effect_names(holidays), yearly, weekly)
    frame = with_effects(ts.with_future(series, periods), holidays)
    fitted = fit(day_sums(frame, design, ["series_id"], origin), design, origin)
    return values(frame.join(fitted, "series_id"), design)
