"""Time-series folds as date ranges.

A fold is named by its cutoff: the number of rows before its test part. Cutoffs lie
``pred_size`` rows apart, counted back from the end of the series, and exceed
``train_length``. No index lists are built: a fold is one row, found by looking at the last
training row of each, and joins back to its series by date range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidecast.operators import series as ts

# --- Fixed values ---------------------------------------------------------------------
TRAIN_LENGTH = 730
CV_SIZE = 10
CV_SEED = 42
# --------------------------------------------------------------------------------------

CV_TYPES = ("rolling_window", "backtesting")


def fold_table(
    series: DataFrame,
    pred_size: int,
    train_length: int = TRAIN_LENGTH,
    cv_type: str = "rolling_window",
) -> DataFrame:
    """``(series_id, fold_id, train_start, cutoff, horizon, train_start_ds,
    train_end_ds)``, fold 0 being the earliest. Rolling windows train on the last
    ``train_length`` rows before the cutoff, backtesting on all of them. Further columns of
    ``series`` come along, with their values in the last training row."""
    if cv_type not in CV_TYPES:
        raise ValueError(f"cv_type must be one of {CV_TYPES}, not {cv_type!r}")
    rolling = cv_type == "rolling_window"
    first_ds = (
        F.lag("ds", train_length - 1).over(ts.by_date())
        if rolling
        else F.min("ds").over(ts.whole_series())
    )
    more = [c for c in series.columns if c not in ("series_id", "ds", "y")]
    rows = ts.indexed(series.select("series_id", "ds", *more)).withColumn("train_start_ds", first_ds)
    cutoff = F.col("rn") + 1
    after = F.col("n") - cutoff
    folds_in_series = F.floor((F.col("n") - train_length - 1) / pred_size)
    return rows.where(
        (cutoff > train_length) & (after >= pred_size) & (after % pred_size == 0)
    ).select(
        "series_id",
        (folds_in_series - after / pred_size).cast("int").alias("fold_id"),
        (cutoff - train_length if rolling else F.lit(0)).cast("int").alias("train_start"),
        cutoff.cast("int").alias("cutoff"),
        F.lit(pred_size).alias("horizon"),
        "train_start_ds",
        F.col("ds").alias("train_end_ds"),
        *more,
    )


def sample_folds(folds: DataFrame, cv_size: int | None = CV_SIZE, seed: int = CV_SEED) -> DataFrame:
    """``cv_size`` folds per series without replacement, by a seeded hash of the cutoff."""
    if cv_size is None:
        return folds
    draw = F.md5(F.concat(F.lit(f"{seed}:"), F.col("cutoff").cast("string")))
    order = Window.partitionBy("series_id").orderBy(draw)
    return (
        folds.withColumn("draw", F.row_number().over(order))
        .where(F.col("draw") <= cv_size)
        .drop("draw")
    )


def fold_train_rows(series: DataFrame, folds: DataFrame) -> DataFrame:
    """Training rows of each fold."""
    in_train = F.col("ds").between(F.col("train_start_ds"), F.col("train_end_ds"))
    return (
        series.join(folds, "series_id").where(in_train).select("fold_id", *series.columns)
    )


def fold_test_dates(folds: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """The calendar days each fold has to predict: ``horizon`` days after its last row."""
    days = F.sequence(
        F.date_add("train_end_ds", 1), F.date_add("train_end_ds", F.col("horizon"))
    )
    return folds.select("series_id", "fold_id", F.explode(days).alias("ds"), *carry)


def fold_frame(frame: DataFrame, folds: DataFrame) -> DataFrame:
    """Training and test days of each fold in one table, told apart by ``is_train``.

    ``frame`` holds every calendar day (see ``with_gaps_filled``); training days without a
    value are left out.
    """
    ends = F.date_add("train_end_ds", F.col("horizon"))
    rows = (
        frame.join(folds, "series_id")
        .where(F.col("ds").between(F.col("train_start_ds"), ends))
        .withColumn("is_train", F.col("ds") <= F.col("train_end_ds"))
        .where(~F.col("is_train") | F.col("y").isNotNull())
    )
    return rows.select("fold_id", "is_train", *frame.columns)
