"""Registered queries: each operator over the given tables, with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, DoubleType, IntegralType

from tidecast.plans.standin_sql import VIEWS, with_views
from tidecast.sources.standin import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
SQL_VIEWS = dict(VIEWS)


def query(name: str, sql: str | None = None, bigints: str = ""):
    """Register a query over ``Tables``; ``sql`` may use any view in ``SQL_VIEWS``.

    ``bigints`` names whole-number columns of the SQL result that are narrower than bigint.
    """

    def register(build: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(build(Tables(spark, sf_dir)))

        QUERIES[name] = run
        if sql is not None:
            text = with_views(sql, SQL_VIEWS)
            if bigints:
                casts = ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in bigints.split())
                text = f"SELECT * REPLACE ({casts}) FROM ({text})"
            ORACLES[name] = text
        return build

    return register


# Sums of amounts with two decimals, and of their products with two-decimal scores. Adding
# doubles in another order changes digits far behind these.
AMOUNTS = {
    "y", "total", "value", "cost", "score", "kept", "expected", "commission", "nits_pred",
    "nits_bookings", "nits_commission", "gross_commission", "nits_profit", "gross_profit",
    "cancelled_commission", "asbooked_commission",
}
AMOUNT_DIGITS = 4


def plain(df: DataFrame) -> DataFrame:
    """Dates as text, amounts rounded, whole numbers as bigint: forms both sides share."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(field.dataType, DoubleType) and field.name in AMOUNTS:
            column = F.round(column, AMOUNT_DIGITS)
        elif isinstance(field.dataType, IntegralType):
            column = column.cast("bigint")
        columns.append(column.alias(field.name))
    return df.select(*columns)
