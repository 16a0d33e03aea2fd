"""Metric tables of the four account shapes, at any grain the facts carry.

A metric table is a sum over facts: clicks and costs, bookings, cancellations. Bringing
these together per key with outer joins and summing again is the same as putting all facts
into one union and grouping once, which needs a single, map-side combined shuffle on the
output keys. ``stack_facts`` + ``sum_facts`` do that for all accounts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tidecast.functions import attribution as at
from tidecast.functions import numbers as nm
from tidecast.operators import joins
from tidecast.sources import scans

# --- Fixed values: names of the summed columns ------------------------------------------
STATS_SUMS = {
    "nits_bookings": "nits_bookings",
    "nits_commission": "nits_commission",
    "bookings": "gross_bookings",
    "commission": "gross_commission",
    "cost": "cost",
    "clicks": "clicks",
    "roomnights": "roomnights",
}
CANCELLATION_SUMS = ["cancellations", "cancelled_commission", "cancelled_roomnights"]
# -----------------------------------------------------------------------------------------


def stack_facts(*facts: DataFrame) -> DataFrame:
    """Union of facts by column name; a column one side lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), facts)


def sum_facts(facts: DataFrame, keys: list[str], sums: dict[str, str]) -> DataFrame:
    """Sum fact columns by key and name the results."""
    return facts.groupBy(*keys).agg(*[F.sum(c).alias(name) for c, name in sums.items()])


def with_profits(stats: DataFrame) -> DataFrame:
    """M3 on both commissions."""
    return stats.withColumns(
        {
            "nits_profit": nm.profit(F.col("nits_commission"), F.col("cost")),
            "gross_profit": nm.profit(F.col("gross_commission"), F.col("cost")),
        }
    )


# --- reservations ----------------------------------------------------------------------


def reservation_scan(
    reservations: DataFrame,
    affiliates: DataFrame,
    start: str,
    end: str,
    max_rpb: float,
    cap_inclusive: bool = True,
) -> DataFrame:
    """S3: valid reservations created in the date range, with their affiliate name."""
    rows = scans.timestamp_date_scan(reservations, "created", start, end)
    rows = scans.value_cap(scans.good_status(rows), "commission_amount_euro", max_rpb, cap_inclusive)
    return joins.dimension_join(rows, affiliates, "affiliate_id").select(
        F.col("id").alias("hotelreservation_id"),
        F.to_date("created").alias("yyyy_mm_dd"),
        "affiliate_id",
        "affiliate_name",
        "label",
        "hotel_id",
        "hotel_ufi",
        F.lit(1).alias("bookings"),
        F.col("commission_amount_euro").alias("commission"),
        "roomnights",
    )


def scored_bookings(
    bookings: DataFrame, preferred: DataFrame, fallback: DataFrame, keys: list[str]
) -> DataFrame:
    """J4 + M2: booking facts with gross and score-discounted values."""
    scored = joins.score_fallback_join(
        bookings.select("hotelreservation_id", *keys, "bookings", "commission", "roomnights"),
        preferred,
        fallback,
    )
    return scored.select(
        *keys,
        (F.col("bookings") * F.col("copies")).alias("bookings"),
        (F.col("commission") * F.col("copies")).alias("commission"),
        (F.col("roomnights") * F.col("copies")).alias("roomnights"),
        (F.col("bookings") * F.col("kept")).alias("nits_bookings"),
        (F.col("commission") * F.col("kept")).alias("nits_commission"),
    )


def cancelled_scan(
    reservations: DataFrame, affiliates: DataFrame, start: str, end: str
) -> DataFrame:
    """Valid reservations cancelled in the date range, as cancellation facts."""
    rows = scans.good_status(scans.date_scan(reservations, "date_cancelled", start, end))
    return joins.dimension_join(rows, affiliates, "affiliate_id").select(
        F.col("id").alias("hotelreservation_id"),
        F.col("date_cancelled").alias("yyyy_mm_dd"),
        "affiliate_id",
        "affiliate_name",
        "label",
        "booker_cc1",
        "hotel_id",
        F.lit(1).alias("cancellations"),
        F.col("commission_amount_euro").alias("cancelled_commission"),
        F.col("roomnights").alias("cancelled_roomnights"),
    )


# --- account 1: summaries come in, cancellations are attributed to a campaign -----------


def campaign_scan(campaigns: DataFrame, pos: str | list[str] = "All") -> DataFrame:
    """S9 + J7: campaign id and the point of sale it stands for."""
    named = campaigns.select(F.col("id").alias("campaign_id"), F.col("name").alias("pos"))
    return scans.keep_pos(named, pos)


def account_1_bookings(summary: DataFrame, campaigns: DataFrame, agg_on: list[str]) -> DataFrame:
    """G1: booking sums at the chosen grain."""
    sums = {c: n for c, n in STATS_SUMS.items() if c not in ("cost", "clicks")}
    return sum_facts(joins.dimension_join(summary, campaigns, "campaign_id"), agg_on, sums)


def account_1_stat_facts(report: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Facts behind G2."""
    return joins.dimension_join(report, campaigns, "campaign_id")


def campaign_lookup(country_campaigns: DataFrame) -> DataFrame:
    """One campaign per country code, so that looking it up cannot multiply rows."""
    return country_campaigns.groupBy("cc").agg(F.min("campaign_id").alias("campaign_id"))


def attribute_campaign(rows: DataFrame, country_campaigns: DataFrame) -> DataFrame:
    """campaign from the label, else the affiliate's country, else the booker's."""
    lookup = campaign_lookup(country_campaigns)

    def by_country(df: DataFrame, code: str, result: str) -> DataFrame:
        side = lookup.select(F.col("cc").alias(code), F.col("campaign_id").alias(result))
        return df.join(side, code, "left")

    label = F.col("label")
    keyed = rows.withColumns(
        {
            "label_cid": at.label_value(label, "cid"),
            "label_cc": at.label_value(label, "ucc"),
            "aff_cc": at.affiliate_country(F.col("affiliate_name")),
            "booker_cc": F.upper("booker_cc1"),
        }
    )
    keyed = by_country(keyed, "label_cc", "cid_of_label_cc")
    keyed = by_country(keyed, "aff_cc", "cid_of_aff_cc")
    keyed = by_country(keyed, "booker_cc", "cid_of_booker_cc")
    label_cid = F.coalesce("label_cid", F.col("cid_of_label_cc").cast("string")).try_cast("int")
    return keyed.withColumn(
        "campaign_id",
        F.coalesce(
            label_cid, "cid_of_aff_cc", "cid_of_booker_cc", F.lit(at.DEFAULT_CAMPAIGN)
        ),
    )


def account_1_cancel_facts(
    reservations: DataFrame,
    affiliates: DataFrame,
    device_classes: DataFrame,
    country_campaigns: DataFrame,
    campaigns: DataFrame,
    start: str,
    end: str,
) -> DataFrame:
    """Facts behind G6: cancelled reservations of a known device class, by campaign.

    The campaign is found first, beside broadcast lookups, so that only narrow rows of the
    chosen campaigns are shuffled to meet the device classes.
    """
    rows = cancelled_scan(reservations, affiliates, start, end)
    rows = attribute_campaign(rows, country_campaigns)
    rows = joins.dimension_join(rows, campaigns, "campaign_id").select(
        "hotelreservation_id", "yyyy_mm_dd", "hotel_id", "campaign_id", "pos", *CANCELLATION_SUMS
    )
    rows = joins.inner_join_counted(rows, device_classes)
    return rows.withColumns({c: F.col(c) * F.col("copies") for c in CANCELLATION_SUMS})


# --- account 2: two device cost tables --------------------------------------------------


def device_costs(costs: DataFrame, device: str, start: str, end: str) -> DataFrame:
    """S6 + M1: click and cost facts of one device table."""
    rows = scans.not_null(scans.date_scan(costs, "yyyy_mm_dd", start, end), "hotel_id")
    return rows.select(
        "hotel_id",
        "yyyy_mm_dd",
        "locale",
        F.lit(device).alias("device"),
        nm.null_safe_sum(F.col("clicks_core"), F.col("clicks_bob")).alias("clicks"),
        nm.null_safe_sum(F.col("cost_core"), F.col("cost_bob")).alias("cost"),
    )


def two_device_costs(
    web: DataFrame, mobile: DataFrame, start: str, end: str, devices: list[str] | None = None
) -> DataFrame:
    """Both device tables as one."""
    web_name, mobile_name = devices or ["web", "mobile"]
    return device_costs(web, web_name, start, end).unionByName(
        device_costs(mobile, mobile_name, start, end)
    )


def by_locale(rows: DataFrame, from_label: bool = True) -> DataFrame:
    """Attribute rows to locale and device; the locale is the point of sale."""
    label, name = F.col("label"), F.col("affiliate_name")
    located = rows.withColumns(
        {"locale": at.locale_from_label(label), "device": at.device_from_label(label, name)}
    )
    if from_label:
        located = located.withColumn("hotel_id", at.hotel_from_label(label, F.col("hotel_id")))
    return located


ACCOUNT_2_KEYS = ["hotel_id", "locale", "device", "yyyy_mm_dd"]


def account_2_stat_facts(
    clicks: DataFrame, bookings: DataFrame, preferred: DataFrame, fallback: DataFrame
) -> DataFrame:
    """Facts behind G3."""
    scored = scored_bookings(by_locale(bookings), preferred, fallback, ACCOUNT_2_KEYS)
    return stack_facts(clicks, scored).withColumn("pos", F.col("locale"))


def account_2_cancel_facts(cancelled: DataFrame) -> DataFrame:
    """Facts behind G7. The hotel is not part of them, so no grain may ask for it."""
    rows = by_locale(cancelled, from_label=False)
    return rows.select(
        "yyyy_mm_dd", "affiliate_id", "locale", "device", F.col("locale").alias("pos"),
        *CANCELLATION_SUMS,
    )


# --- account 3: one click log -----------------------------------------------------------


def click_log(
    costs: DataFrame,
    placements: list[str],
    start: str,
    end: str,
    keep_unmatched: bool = False,
) -> DataFrame:
    """S6 + F5: click facts from the log, attributed by silo name."""
    rows = scans.not_null(scans.date_scan(costs, "date", start, end), "hour")
    rows = scans.matching_silo(rows, "siloname", at.silo_pattern(placements), keep_unmatched)
    silo = F.col("siloname")
    return rows.select(
        F.col("partnerpropertyid").alias("hotel_id"),
        at.distribution_from_silo(silo, placements).alias("distribution"),
        at.placement_from_silo(silo, placements).alias("placement"),
        F.to_date("date").alias("yyyy_mm_dd"),
        F.lit(1).alias("clicks"),
        F.col("cost_eur").alias("cost"),
        "length_of_stay",
    )


def by_distribution(rows: DataFrame) -> DataFrame:
    """attribute rows by affiliate name; the distribution is the point of sale."""
    name = F.col("affiliate_name")
    return rows.withColumns(
        {
            "distribution": at.distribution_from_name(name),
            "placement": at.placement_from_name(name),
        }
    )


ACCOUNT_3_KEYS = ["hotel_id", "distribution", "placement", "yyyy_mm_dd"]


def account_3_stat_facts(
    clicks: DataFrame,
    bookings: DataFrame,
    preferred: DataFrame,
    fallback: DataFrame,
    pos: str | list[str] = "All",
) -> DataFrame:
    """Facts behind G4."""
    rows = by_distribution(bookings).withColumn(
        "hotel_id", at.hotel_from_label(F.col("label"), F.col("hotel_id"))
    )
    rows = scans.keep_pos(rows, pos, "distribution")
    scored = scored_bookings(rows, preferred, fallback, ACCOUNT_3_KEYS)
    clicks = scans.keep_pos(clicks, pos, "distribution")
    return stack_facts(clicks, scored).withColumnRenamed("distribution", "pos")


def account_3_cancel_facts(cancelled: DataFrame, pos: str | list[str] = "All") -> DataFrame:
    """Facts behind G8; the point-of-sale filter applies to them as well."""
    rows = by_distribution(cancelled).withColumnRenamed("distribution", "pos")
    return scans.keep_pos(rows, pos).select(
        "yyyy_mm_dd", "hotel_id", "pos", "placement", *CANCELLATION_SUMS
    )


# --- account 4: performance is pre-aggregated --------------------------------------------


def account_4_stat_facts(performance: DataFrame, pos: str | list[str] = "All") -> DataFrame:
    """Facts behind G5."""
    return scans.keep_pos(performance, pos).select(
        "yyyy_mm_dd",
        "hotel_id",
        "pos",
        "nits_bookings",
        F.col("commission_expected_euro").alias("nits_commission"),
        "bookings",
        F.col("commission_amount_euro").alias("commission"),
        F.col("cost_euro").alias("cost"),
        "clicks",
        "roomnights",
    )


def account_4_cancel_facts(cancelled: DataFrame, pos: str | list[str] = "All") -> DataFrame:
    """Facts behind G9."""
    name = F.col("affiliate_name")
    rows = cancelled.withColumn(
        "pos", at.pos_from_name(name, at.POS_AFTER_UNDERSCORE, at.POS_AFTER_UNDERSCORE_GROUP)
    )
    return scans.keep_pos(rows, pos).select("yyyy_mm_dd", "hotel_id", "pos", *CANCELLATION_SUMS)


# --- summaries over facts ----------------------------------------------------------------


def _stats_sums(facts: DataFrame) -> dict[str, str]:
    sums = dict(STATS_SUMS)
    if "length_of_stay" in facts.columns:
        sums["length_of_stay"] = "length_of_stay"
    return sums


def stats_summary(facts: DataFrame, agg_on: list[str]) -> DataFrame:
    """Sums of all facts at the chosen grain, and profits."""
    return with_profits(sum_facts(facts, agg_on, _stats_sums(facts)))


def cancellation_summary(facts: DataFrame, agg_on: list[str]) -> DataFrame:
    """Sums of cancellation facts at the chosen grain."""
    return sum_facts(facts, agg_on, {c: c for c in CANCELLATION_SUMS})


def combined_stats(
    stat_facts: DataFrame,
    cancel_facts: DataFrame,
    agg_on: list[str],
    fill_first: bool = False,
) -> DataFrame:
    """G10 (with J6, M4, M5): performance and cancellations side by side.

    One union and one shuffle stand for both summaries and their outer join. As-booked
    values are computed before NULLs become 0, so a key known to one side only gets 0;
    ``fill_first`` treats the missing side as 0 instead.
    """
    sums = _stats_sums(stat_facts)
    cancel_sums = {c: c for c in CANCELLATION_SUMS}
    side = "side_of_null_key"
    facts = stack_facts(
        stat_facts.select(
            *agg_on, joins.null_key_side(agg_on, "stats").alias(side), *sums
        ),
        cancel_facts.select(
            *agg_on, joins.null_key_side(agg_on, "cancellations").alias(side), *cancel_sums
        ),
    )
    table = with_profits(sum_facts(facts, [*agg_on, side], sums | cancel_sums)).drop(side)
    values = [c for c in table.columns if c not in agg_on]
    if fill_first:
        table = table.na.fill(0, subset=values)
    table = table.withColumns(
        {
            "asbooked_commission": F.col("gross_commission") - F.col("cancelled_commission"),
            "asbooked_roomnights": F.col("roomnights") - F.col("cancelled_roomnights"),
        }
    )
    return table.na.fill(0, subset=[c for c in table.columns if c not in agg_on])


def metric_table(summary: DataFrame, metric: str) -> DataFrame:
    """(date, point of sale, metric)."""
    return summary.select("yyyy_mm_dd", "pos", metric)


# --- point-of-sale maps ------------------------------------------------------------------


def campaign_pos_map(
    campaigns: DataFrame, country_campaigns: DataFrame, override: tuple[str, int]
) -> DataFrame:
    """K13 / J9 / F11, account 1: campaign, its name, and the countries it stands for."""
    pos, campaign_id = override
    countries = country_campaigns.withColumnRenamed("cc", "pos").withColumn(
        "campaign_id",
        F.when(F.col("pos") == pos, F.lit(campaign_id)).otherwise(F.col("campaign_id")),
    )
    named = campaigns.select(
        F.col("id").alias("campaign_id"), F.col("name").alias("campaign_name")
    )
    return countries.join(named, "campaign_id")


def affiliate_pos_map(
    affiliates: DataFrame, partner_id: int, name_pattern: str | None, pos_pattern: str
) -> DataFrame:
    """K13, accounts 3 and 4: distinct points of sale named by the partner's affiliates."""
    named = scans.affiliates(affiliates, partner_id, name_pattern)
    pos = named.select(at.pos_from_name(F.col("affiliate_name"), pos_pattern).alias("pos"))
    return scans.not_empty(pos, "pos").distinct()
