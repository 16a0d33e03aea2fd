"""Holidays: which ones matter, how many days around them count.

A holiday table may hold one selection for everything, or one per ``series_id``; the
functions below keep that column wherever it is present.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# --- Fixed values ---------------------------------------------------------------------
TOP_POS = 5
MIN_ROWS_ELSEWHERE = 10
# holiday: (days before, days after) that belong to its effect
WINDOWS = {
    "ChristmasEve": (-1, 0),
    "ThanksgivingDay": (-1, 1),
    "NewYearsDay": (-1, 1),
}
# --------------------------------------------------------------------------------------


def series_key(df: DataFrame) -> list[str]:
    """``["series_id"]`` when holidays are selected per series."""
    return ["series_id"] if "series_id" in df.columns else []


def ranked_holidays(calendar: DataFrame, pos_map: DataFrame, ranks: DataFrame) -> DataFrame:
    """Calendar rows of mapped points of sale, with their rank.

    A point of sale mapped several times repeats its rows, and these repeats count below.
    All three sides are short lists, so the joins carry no hint.
    """
    ranks = ranks.select(*series_key(ranks), "pos", "pos_rank")
    return calendar.join(pos_map.select("pos"), "pos").join(ranks, "pos")


def select_holidays(
    ranked: DataFrame, top: int = TOP_POS, min_rows: int = MIN_ROWS_ELSEWHERE
) -> DataFrame:
    """R6 (T3, G15, U2): all holidays of the top points of sale, and those with at least
    ``min_rows`` rows elsewhere. One grouping stands for both sets and their union."""
    in_top = F.col("pos_rank") <= top
    keys = [*series_key(ranked), "ds", "holiday"]
    return (
        ranked.groupBy(*keys)
        .agg(
            F.max(in_top).alias("in_top"),
            F.count_if(F.col("pos_rank") > top).alias("rows_elsewhere"),
        )
        .where(F.col("in_top") | (F.col("rows_elsewhere") >= min_rows))
        .select(*keys)
    )


def with_windows(holidays: DataFrame) -> DataFrame:
    """R7 + U3: days before and after each holiday; (0, 0) for most."""
    lower, upper = F.lit(0), F.lit(0)
    for name, (before, after) in WINDOWS.items():
        named = F.col("holiday") == name
        lower = F.when(named, before).otherwise(lower)
        upper = F.when(named, after).otherwise(upper)
    return holidays.withColumns({"lower_window": lower, "upper_window": upper})


def expand_windows(holidays: DataFrame) -> DataFrame:
    """One row per day of each window."""
    keys = series_key(holidays)
    return holidays.select(
        *keys,
        "holiday",
        F.col("ds").alias("holiday_ds"),
        F.explode(F.sequence("lower_window", "upper_window")).alias("offset"),
    ).select(*keys, "holiday", "offset", F.date_add("holiday_ds", F.col("offset")).alias("ds"))


def features_by_day(holidays: DataFrame) -> DataFrame:
    """One row per day with the set of holiday effects that apply to it.

    An effect is a holiday and an offset, so the day before a holiday has its own size.
    The sets are short: a day carries a handful of public holidays.
    """
    effect = F.concat_ws("_", "holiday", F.col("offset").cast("string"))
    return (
        expand_windows(holidays)
        .groupBy(*series_key(holidays), "ds")
        .agg(F.array_sort(F.collect_set(effect)).alias("effects"))
    )
