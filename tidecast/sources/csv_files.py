"""CSV output of daily and weekly forecasts, and reading it back."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tidecast.sources import parted_output as po


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Header, no index. One folder of part files, written by all tasks in parallel."""
    df.write.mode(mode).option("header", True).csv(path)


def read_daily_prediction(
    spark: SparkSession, path: str, schema: str | StructType, date_column: str = "ds"
) -> DataFrame:
    """Read a daily prediction with a given schema and parse its date."""
    df = spark.read.schema(schema).option("header", True).csv(path)
    return df.withColumn(date_column, F.to_date(date_column))


RUN = "run_date"


def write_run(
    df: DataFrame, path: str, run_date: str | date, sums: list[str] = ()
) -> DataFrame:
    """S10 for a job that may run again: the part of one run date, in place of an earlier one.

    Returns the manifest row (see ``parted_output``); other run dates stay.
    """
    day = date.fromisoformat(str(run_date))
    named = df.withColumn(RUN, F.lit(day))
    return po.write_parts(named, path, RUN, [day], list(sums), "csv", header="true")


def read_runs(
    spark: SparkSession, path: str, schema: str, run_date: str | date | None = None
) -> DataFrame:
    """S11 for ``write_run``: all run dates or one, refused if files and manifest differ."""
    where = None if run_date is None else F.col(RUN) == F.lit(date.fromisoformat(str(run_date)))
    return po.read_parts(spark, path, RUN, schema, where, kind="csv", header="true")
