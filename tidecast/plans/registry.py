"""Accounts and metrics by name, and how their facts are put together."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidecast.functions import attribution as at
from tidecast.operators import daily_summary as ds
from tidecast.operators import metrics as mt
from tidecast.sources import scans

# --- Fixed values ---------------------------------------------------------------------
PARTNER_IDS = {
    "account_1": 423463,
    "account_2": 431843,
    "account_3": 404815,
    "account_4": 413084,
}
MAX_RPB = 3000.0
PLACEMENTS = ["DMeta", "Mobile"]
CORE_NAME = "([_][Cc]ore[.])"
CAMPAIGN_OVERRIDE = ("TR", 105)
# metric class: (summary it comes from, column)
METRICS = {
    "GrossBookings": ("stats", "gross_bookings"),
    "RoomNights": ("stats", "roomnights"),
    "CancelledRoomNights": ("cancellations", "cancelled_roomnights"),
    "Cancellations": ("cancellations", "cancellations"),
    "GrossCommission": ("stats", "gross_commission"),
    "CancelledCommission": ("cancellations", "cancelled_commission"),
}
# --------------------------------------------------------------------------------------


@dataclass
class Scope:
    """Which rows an account job looks at."""

    start: str
    end: str
    pos: str | list[str] = "All"
    max_rpb: float = MAX_RPB
    partner_id: int | None = None
    placements: list[str] = field(default_factory=lambda: list(PLACEMENTS))
    campaign_override: tuple[str, int] = CAMPAIGN_OVERRIDE
    devices: list[str] = field(default_factory=lambda: ["web", "mobile"])


# Input tables by role name; a role is only opened by the accounts that need it.
Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Account:
    """The three frames an account can produce from its input tables."""

    name: str
    stat_facts: Callable[[Tables, Scope], DataFrame]
    cancel_facts: Callable[[Tables, Scope], DataFrame]
    pos_map: Callable[[Tables, Scope], DataFrame]

    def stats(self, tables: Tables, scope: Scope, agg_on: list[str]) -> DataFrame:
        return mt.stats_summary(self.stat_facts(tables, scope), agg_on)

    def cancellations(self, tables: Tables, scope: Scope, agg_on: list[str]) -> DataFrame:
        return mt.cancellation_summary(self.cancel_facts(tables, scope), agg_on)

    def combined(
        self, tables: Tables, scope: Scope, agg_on: list[str], fill_first: bool = False
    ) -> DataFrame:
        return mt.combined_stats(
            self.stat_facts(tables, scope), self.cancel_facts(tables, scope), agg_on, fill_first
        )


def _partner(account: str, scope: Scope) -> int:
    return PARTNER_IDS[account] if scope.partner_id is None else scope.partner_id


def _scores(tables: Tables, scope: Scope) -> tuple[DataFrame, DataFrame]:
    return (
        scans.preferred_scores(tables["preferred_scores"], scope.start, scope.end),
        scans.fallback_scores(tables["fallback_scores"], scope.start, scope.end),
    )


def _bookings(tables: Tables, scope: Scope, affiliates: DataFrame, inclusive: bool) -> DataFrame:
    return mt.reservation_scan(
        tables["reservations"], affiliates, scope.start, scope.end, scope.max_rpb, inclusive
    )


def _cancelled(tables: Tables, scope: Scope, affiliates: DataFrame) -> DataFrame:
    return mt.cancelled_scan(tables["reservations"], affiliates, scope.start, scope.end)


# account 1


def _stats_1(tables: Tables, scope: Scope) -> DataFrame:
    report = scans.date_scan(tables["account_1_report"], "yyyy_mm_dd", scope.start, scope.end)
    return mt.account_1_stat_facts(report, mt.campaign_scan(tables["campaigns"], scope.pos))


def _cancels_1(tables: Tables, scope: Scope) -> DataFrame:
    return mt.account_1_cancel_facts(
        tables["reservations"],
        scans.affiliates(tables["affiliates"], _partner("account_1", scope)),
        tables["device_classes"],
        tables["country_campaigns"],
        mt.campaign_scan(tables["campaigns"], scope.pos),
        scope.start,
        scope.end,
    )


def _pos_1(tables: Tables, scope: Scope) -> DataFrame:
    return mt.campaign_pos_map(
        tables["campaigns"], tables["country_campaigns"], scope.campaign_override
    )


# account 2


def _affiliates_2(tables: Tables, scope: Scope) -> DataFrame:
    return scans.affiliates(tables["affiliates"], _partner("account_2", scope), CORE_NAME)


def _stats_2(tables: Tables, scope: Scope) -> DataFrame:
    clicks = mt.two_device_costs(
        tables["web_costs"], tables["mobile_costs"], scope.start, scope.end, scope.devices
    )
    bookings = _bookings(tables, scope, _affiliates_2(tables, scope), True)
    return scans.keep_pos(
        mt.account_2_stat_facts(clicks, bookings, *_scores(tables, scope)), scope.pos
    )


def _cancels_2(tables: Tables, scope: Scope) -> DataFrame:
    rows = mt.account_2_cancel_facts(_cancelled(tables, scope, _affiliates_2(tables, scope)))
    return scans.keep_pos(rows, scope.pos)


def _pos_2(tables: Tables, scope: Scope) -> DataFrame:
    """The locales that occur; this account has no list of its own."""
    clicks = mt.two_device_costs(
        tables["web_costs"], tables["mobile_costs"], scope.start, scope.end, scope.devices
    )
    bookings = mt.by_locale(_bookings(tables, scope, _affiliates_2(tables, scope), True))
    locales = clicks.select("locale").unionByName(bookings.select("locale"))
    return scans.keep_pos(locales.withColumnRenamed("locale", "pos"), scope.pos).distinct()


# account 3


def _affiliates_3(tables: Tables, scope: Scope) -> DataFrame:
    pattern = at.silo_pattern(scope.placements)
    return scans.affiliates(tables["affiliates"], _partner("account_3", scope), pattern)


def _stats_3(tables: Tables, scope: Scope) -> DataFrame:
    clicks = mt.click_log(tables["click_log"], scope.placements, scope.start, scope.end)
    bookings = _bookings(tables, scope, _affiliates_3(tables, scope), False)
    return mt.account_3_stat_facts(clicks, bookings, *_scores(tables, scope), scope.pos)


def _cancels_3(tables: Tables, scope: Scope) -> DataFrame:
    rows = _cancelled(tables, scope, _affiliates_3(tables, scope))
    return mt.account_3_cancel_facts(rows, scope.pos)


def _pos_3(tables: Tables, scope: Scope) -> DataFrame:
    return mt.affiliate_pos_map(
        tables["affiliates"],
        _partner("account_3", scope),
        at.silo_pattern(scope.placements),
        at.POS_BEFORE_FIRST_DOT,
    )


# account 4


def _stats_4(tables: Tables, scope: Scope) -> DataFrame:
    rows = scans.performance(tables["performance"], scope.start, scope.end, scope.max_rpb)
    return mt.account_4_stat_facts(rows, scope.pos)


def _cancels_4(tables: Tables, scope: Scope) -> DataFrame:
    named = scans.affiliates(tables["affiliates"], _partner("account_4", scope))
    return mt.account_4_cancel_facts(_cancelled(tables, scope, named), scope.pos)


def _pos_4(tables: Tables, scope: Scope) -> DataFrame:
    return mt.affiliate_pos_map(
        tables["affiliates"], _partner("account_4", scope), None, at.POS_AFTER_ACCOUNT_4
    )


ACCOUNTS = {
    "account_1": Account("account_1", _stats_1, _cancels_1, _pos_1),
    "account_2": Account("account_2", _stats_2, _cancels_2, _pos_2),
    "account_3": Account("account_3", _stats_3, _cancels_3, _pos_3),
    "account_4": Account("account_4", _stats_4, _cancels_4, _pos_4),
}

METRIC_KEYS = ["yyyy_mm_dd", "pos"]


def account(name: str) -> Account:
    """An account by name."""
    if name not in ACCOUNTS:
        raise ValueError(f"unknown account {name!r}; known: {sorted(ACCOUNTS)}")
    return ACCOUNTS[name]


def metric_source(metric: str) -> tuple[str, str]:
    """(summary, column) of a metric, by class name or by column name."""
    by_column = {column: (source, column) for source, column in METRICS.values()}
    if metric in METRICS:
        return METRICS[metric]
    if metric in by_column:
        return by_column[metric]
    raise ValueError(f"unknown metric {metric!r}; known: {sorted(METRICS)}")


def metric_values(tables: Tables, account_name: str, metric: str, scope: Scope) -> DataFrame:
    """The metric table (date, point of sale, metric) of one account."""
    source, column = metric_source(metric)
    chosen = account(account_name)
    summary = chosen.stats if source == "stats" else chosen.cancellations
    return mt.metric_table(summary(tables, scope, METRIC_KEYS), column)


def metrics_long(
    tables: Tables, account_name: str, metrics: list[str], scope: Scope
) -> DataFrame:
    """Several metrics of one account as rows (series_id, date, pos, value).

    Metrics of one summary come out of the same scan and the same shuffle.
    """
    chosen = account(account_name)
    parts = []
    for source, summary in (("stats", chosen.stats), ("cancellations", chosen.cancellations)):
        columns = [c for s, c in map(metric_source, metrics) if s == source]
        if columns:
            table = summary(tables, scope, METRIC_KEYS).select(
                *METRIC_KEYS, *[F.col(c).cast("double").alias(c) for c in columns]
            )
            parts.append(table.unpivot(METRIC_KEYS, columns, "series_id", "value"))
    return mt.stack_facts(*parts).where(F.col("value").isNotNull())


METRIC_SCHEMA = "pos string, series_id string, value double"


def kept_metrics(
    spark: SparkSession,
    folder: str,
    tables: Tables,
    account_name: str,
    metrics: list[str],
    scope: Scope,
    grain: str = "month",
) -> ds.DailySummary:
    """``metrics_long`` kept by part: built once, and again only where something touched it.

    ``scope`` says all but the days.
    """

    def build(start: date, end: date) -> DataFrame:
        own = replace(scope, start=str(start), end=str(end))
        rows = metrics_long(tables, account_name, metrics, own)
        return rows.select("yyyy_mm_dd", "pos", "series_id", "value")

    return ds.DailySummary(spark, folder, build, METRIC_SCHEMA, ["value"], grain)
