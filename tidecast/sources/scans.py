"""Scans. Each returns only the columns and rows a job needs, in a form parquet can prune.

Date bounds are inclusive at both ends. Every filter is a plain comparison on a column (or
on ``to_date`` of it, which Catalyst turns into a half-open range), so it reaches the files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# --- Fixed values: reservations in these states are never counted ---------------------
BAD_STATUSES = ["fraudulent", "test", "unknown"]
# --------------------------------------------------------------------------------------


def date_scan(df: DataFrame, column: str, start: str, end: str) -> DataFrame:
    """Rows whose date lies in [start, end]."""
    return df.where(
        F.col(column).between(F.to_date(F.lit(start)), F.to_date(F.lit(end)))
    )


def timestamp_date_scan(df: DataFrame, column: str, start: str, end: str) -> DataFrame:
    """Rows whose timestamp falls on a day in [start, end]."""
    day = F.to_date(column)
    return df.where(day.between(F.to_date(F.lit(start)), F.to_date(F.lit(end))))


def good_status(df: DataFrame, column: str = "status") -> DataFrame:
    """Drop bad states; a NULL state is dropped as well."""
    return df.where(~F.col(column).isin(BAD_STATUSES))


def value_cap(df: DataFrame, column: str, cap: float, inclusive: bool = True) -> DataFrame:
    """Drop outliers above the cap (and at it, when not inclusive); NULL is dropped."""
    value = F.col(column)
    return df.where(value <= cap) if inclusive else df.where(value < cap)


def not_null(df: DataFrame, column: str) -> DataFrame:
    """P3."""
    return df.where(F.col(column).isNotNull())


def not_empty(df: DataFrame, column: str) -> DataFrame:
    """P5: drop empty text; NULL is dropped as well."""
    return df.where(F.col(column) != "")


def matching_silo(df: DataFrame, column: str, pattern: str, keep_unmatched: bool = False):
    """Rows whose silo name holds one of the placements.

    ``keep_unmatched=True`` drops only NULL names, which is what testing the extracted text
    for NULL amounts to (no match gives '', not NULL).
    """
    name = F.col(column)
    return df.where(name.isNotNull()) if keep_unmatched else df.where(name.rlike(pattern))


def keep_pos(df: DataFrame, pos: str | list[str], column: str = "pos") -> DataFrame:
    """Rows of the chosen points of sale; 'All' keeps every row."""
    chosen = [pos] if isinstance(pos, str) else list(pos)
    return df if chosen == ["All"] else df.where(F.col(column).isin(chosen))


def affiliates(df: DataFrame, partner_id: int, name_pattern: str | None = None) -> DataFrame:
    """Affiliates of one partner, optionally only names that match a pattern."""
    chosen = df.where(F.col("partner_id") == partner_id)
    if name_pattern:
        chosen = chosen.where(F.col("name").rlike(name_pattern))
    return chosen.select(F.col("id").alias("affiliate_id"), F.col("name").alias("affiliate_name"))


def preferred_scores(df: DataFrame, start: str, end: str) -> DataFrame:
    """Preferred scores by creation date; the id becomes text like all other ids."""
    return date_scan(df, "created_date", start, end).select(
        F.col("hotelreservation_id").cast("string").alias("hotelreservation_id"),
        F.col("prediction").alias("preferred"),
    )


def fallback_scores(
    df: DataFrame, start: str, end: str, created_at: str = "row_created_at"
) -> DataFrame:
    """Scores taken after booking, by the day their row was created."""
    return timestamp_date_scan(df, created_at, start, end).select(
        "hotelreservation_id", F.col("nits_score").alias("fallback")
    )


def performance(df: DataFrame, start: str, end: str, max_rpb: float) -> DataFrame:
    """Pre-aggregated performance rows with clicks and without outliers."""
    scan = date_scan(df, "yyyy_mm_dd", start, end).where(F.col("clicks") > 0)
    return value_cap(scan, "commission_expected_euro", max_rpb)


def holiday_calendar(df: DataFrame, start: str, end: str | None = None) -> DataFrame:
    """Public holidays (level 1) from start on, optionally up to end."""
    day = F.col("yyyy_mm_dd")
    chosen = df.where((day >= F.to_date(F.lit(start))) & (F.col("level") == 1))
    if end is not None:
        chosen = chosen.where(day <= F.to_date(F.lit(end)))
    return chosen.select(
        day.alias("ds"), F.col("name").alias("holiday"), F.upper("cc1").alias("pos")
    )


def jdbc_lookup(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """A lookup table that lives in a database. Pass ``partitionColumn``, ``lowerBound``,
    ``upperBound`` and ``numPartitions`` when the table is not small."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()
