"""Registered queries for scans, filters, joins, attribution and metric tables."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import functions as F

from tidecast.functions import attribution as at
from tidecast.functions import dates as dt
from tidecast.functions import numbers as nm
from tidecast.operators import daily_summary as ds
from tidecast.operators import joins
from tidecast.operators import metrics as mt
from tidecast.plans import registry as rg
from tidecast.plans.catalog import SQL_VIEWS, query
from tidecast.session import shared_folder
from tidecast.sources import bucketed as bk
from tidecast.sources import scans
from tidecast.sources.standin import END, MAX_RPB, STANDIN_PARTNERS, START, Tables

DAYS = f"BETWEEN DATE '{START}' AND DATE '{END}'"
OVERRIDE = ("NATION9", 3)


HOTEL_SQL = (
    f"coalesce(TRY_CAST(nullif(regexp_extract(label, '{at.HOTEL_IN_LABEL}', 1), '')"
    " AS INTEGER), hotel_id)"
)
LOCALE_SQL = (
    f"coalesce(nullif(upper(regexp_extract(label, '{at.LOCALE_IN_LABEL}', 1)), ''),"
    f" '{at.DEFAULT_LOCALE}')"
)
DEVICE_SQL = (
    f"if(coalesce(regexp_matches(label, '{at.MOBILE_IN_LABEL}'), false)"
    f" OR regexp_matches(affiliate_name, '{at.MOBILE_IN_NAME}'), 'mobile', 'web')"
)
GREEDY_POS_SQL = (
    f"regexp_extract(affiliate_name, '{at.POS_AFTER_UNDERSCORE}',"
    f" {at.POS_AFTER_UNDERSCORE_GROUP})"
)
BAD_SQL = ", ".join(f"'{status}'" for status in scans.BAD_STATUSES)
GOOD = f"status NOT IN ({BAD_SQL})"


def name_part(column: str, group: int) -> str:
    return f"regexp_extract({column}, '{at.DOTTED_NAME}', {group})"


def scope(account: str, pos="All") -> rg.Scope:
    return rg.Scope(
        START, END, pos=pos, max_rpb=MAX_RPB, partner_id=STANDIN_PARTNERS[account],
        campaign_override=OVERRIDE,
    )


def stats(t: Tables, account: str, agg_on: list[str], pos="All"):
    return rg.account(account).stats(t, scope(account, pos), agg_on)


def cancellations(t: Tables, account: str, agg_on: list[str], pos="All"):
    return rg.account(account).cancellations(t, scope(account, pos), agg_on)


def partner_affiliates(t: Tables, account: str, pattern: str | None = None):
    return scans.affiliates(t.affiliates, STANDIN_PARTNERS[account], pattern)


SQL_VIEWS.update(
    {
        "aff_1": "SELECT id AS affiliate_id, name AS affiliate_name FROM affiliates"
        " WHERE partner_id = 0",
        "aff_2": "SELECT id AS affiliate_id, name AS affiliate_name FROM affiliates"
        f" WHERE partner_id = 1 AND regexp_matches(name, '{rg.CORE_NAME}')",
        "aff_3": "SELECT id AS affiliate_id, name AS affiliate_name FROM affiliates"
        " WHERE partner_id = 2 AND regexp_matches(name, '(DMeta|Mobile)')",
        "aff_4": "SELECT id AS affiliate_id, name AS affiliate_name FROM affiliates"
        " WHERE partner_id = 3",
        "valid_bookings": f"""
            SELECT id, CAST(created AS DATE) AS yyyy_mm_dd, affiliate_id, label, hotel_id,
                   1 AS bookings, commission_amount_euro AS commission, roomnights
            FROM reservations
            WHERE CAST(created AS DATE) {DAYS} AND {GOOD}""",
        "valid_cancels": f"""
            SELECT *, date_cancelled AS yyyy_mm_dd FROM reservations
            WHERE date_cancelled {DAYS} AND {GOOD}""",
        "pref": f"""
            SELECT CAST(hotelreservation_id AS VARCHAR) AS id, prediction
            FROM preferred_scores WHERE created_date {DAYS}""",
        "fall": f"""
            SELECT hotelreservation_id AS id, nits_score
            FROM fallback_scores WHERE CAST(row_created_at AS DATE) {DAYS}""",
        "book_2": f"""
            SELECT b.id, {HOTEL_SQL} AS hotel_id,
                   yyyy_mm_dd,
                   {LOCALE_SQL} AS locale,
                   {DEVICE_SQL} AS device,
                   bookings, commission, roomnights
            FROM valid_bookings b JOIN aff_2 USING (affiliate_id)
            WHERE commission <= {MAX_RPB}""",
        "scored_2": """
            SELECT b.*, bookings * (1 - coalesce(prediction, nits_score, 0)) AS nits_bookings,
                   commission * (1 - coalesce(prediction, nits_score, 0)) AS nits_commission
            FROM book_2 b LEFT JOIN pref USING (id) LEFT JOIN fall USING (id)""",
        "revenue_2": """
            SELECT hotel_id, locale, device, yyyy_mm_dd, sum(bookings) AS bookings,
                   sum(commission) AS commission, sum(nits_bookings) AS nits_bookings,
                   sum(nits_commission) AS nits_commission, sum(roomnights) AS roomnights
            FROM scored_2 GROUP BY ALL""",
        "clicks_2": f"""
            SELECT hotel_id, locale, device, yyyy_mm_dd,
                   sum(coalesce(clicks_core, 0) + coalesce(clicks_bob, 0)) AS clicks,
                   sum(coalesce(cost_core, 0) + coalesce(cost_bob, 0)) AS cost
            FROM (SELECT *, 'web' AS device FROM web_costs
                  UNION ALL SELECT *, 'mobile' FROM mobile_costs)
            WHERE yyyy_mm_dd {DAYS} AND hotel_id IS NOT NULL GROUP BY ALL""",
        "perf_2": """
            SELECT *, locale AS pos
            FROM clicks_2 FULL JOIN revenue_2 USING (hotel_id, locale, device, yyyy_mm_dd)""",
        "cancel_2": f"""
            SELECT yyyy_mm_dd, affiliate_id,
                   {LOCALE_SQL} AS locale,
                   {DEVICE_SQL} AS device,
                   1 AS cancellations, commission_amount_euro AS cancelled_commission,
                   roomnights AS cancelled_roomnights
            FROM valid_cancels JOIN aff_2 USING (affiliate_id)""",
        "book_3": f"""
            SELECT b.id, {HOTEL_SQL} AS hotel_id,
                   yyyy_mm_dd,
                   {name_part("affiliate_name", 1)} AS distribution,
                   {name_part("affiliate_name", 2)} AS placement,
                   bookings, commission, roomnights
            FROM valid_bookings b JOIN aff_3 USING (affiliate_id)
            WHERE commission < {MAX_RPB}""",
        "revenue_3": """
            SELECT hotel_id, distribution, placement, yyyy_mm_dd, sum(bookings) AS bookings,
                   sum(commission) AS commission,
                   sum(bookings * (1 - coalesce(prediction, nits_score, 0))) AS nits_bookings,
                   sum(commission * (1 - coalesce(prediction, nits_score, 0)))
                       AS nits_commission,
                   sum(roomnights) AS roomnights
            FROM book_3 LEFT JOIN pref USING (id) LEFT JOIN fall USING (id) GROUP BY ALL""",
        "clicks_3": f"""
            SELECT partnerpropertyid AS hotel_id,
                   regexp_extract(siloname, '(.*)(DMeta|Mobile)', 1) AS distribution,
                   regexp_extract(siloname, '(.*)(DMeta|Mobile)', 2) AS placement,
                   date AS yyyy_mm_dd, count(*) AS clicks, sum(cost_eur) AS cost,
                   sum(length_of_stay) AS length_of_stay
            FROM click_log
            WHERE date {DAYS} AND hour IS NOT NULL
              AND regexp_matches(siloname, '(DMeta|Mobile)') GROUP BY ALL""",
        "perf_3": """
            SELECT *, distribution AS pos
            FROM clicks_3 FULL JOIN revenue_3
            USING (hotel_id, distribution, placement, yyyy_mm_dd)""",
        "cancel_3": f"""
            SELECT yyyy_mm_dd, hotel_id,
                   {name_part("affiliate_name", 1)} AS pos,
                   {name_part("affiliate_name", 2)} AS placement,
                   1 AS cancellations, commission_amount_euro AS cancelled_commission,
                   roomnights AS cancelled_roomnights
            FROM valid_cancels JOIN aff_3 USING (affiliate_id)""",
        "perf_4": f"""
            SELECT yyyy_mm_dd, hotel_id, pos, nits_bookings,
                   commission_expected_euro AS nits_commission, bookings,
                   commission_amount_euro AS commission, cost_euro AS cost, clicks, roomnights
            FROM performance
            WHERE yyyy_mm_dd {DAYS} AND clicks > 0
              AND commission_expected_euro <= {MAX_RPB}""",
        "cancel_4": f"""
            SELECT yyyy_mm_dd, hotel_id,
                   {GREEDY_POS_SQL} AS pos,
                   1 AS cancellations, commission_amount_euro AS cancelled_commission,
                   roomnights AS cancelled_roomnights
            FROM valid_cancels JOIN aff_4 USING (affiliate_id)""",
        "label_items": """
            SELECT id, label, item, i, string_split(item, '-') AS parts
            FROM (SELECT id, label, unnest(string_split(label, '_')) AS item,
                         generate_subscripts(string_split(label, '_'), 1) AS i
                  FROM reservations WHERE label IS NOT NULL)""",
        "label_pairs": """
            SELECT id, i, parts[1] AS k, parts[2] AS v FROM label_items WHERE len(parts) = 2
            UNION ALL
            SELECT id, i, 'placement',
                   CASE WHEN contains(lower(item), 'mapresults') THEN 'mapresults'
                        ELSE 'localuniversal' END
            FROM label_items
            WHERE len(parts) <> 2 AND (contains(lower(item), 'mapresults')
                                       OR contains(lower(item), 'localuniversal'))
            UNION ALL
            SELECT id, i, 'hotel_id', string_split(item, 'hotel-')[2]
            FROM label_items WHERE len(parts) <> 2 AND contains(lower(item), 'hotel-')""",
        "label_values": """
            SELECT id, arg_max(v, i) FILTER (k = 'cid') AS cid,
                   arg_max(v, i) FILTER (k = 'ucc') AS ucc,
                   arg_max(v, i) FILTER (k = 'placement') AS placement,
                   arg_max(v, i) FILTER (k = 'hotel_id') AS label_hotel_id
            FROM label_pairs GROUP BY id""",
        "cc_map": "SELECT cc, min(campaign_id) AS cid FROM country_campaigns GROUP BY cc",
        "campaign_chain": """
            SELECT c.id, c.yyyy_mm_dd, c.hotel_id, c.commission_amount_euro, c.roomnights,
                   coalesce(TRY_CAST(coalesce(l.cid, CAST(m1.cid AS VARCHAR)) AS INTEGER),
                            m2.cid, m3.cid, 66) AS campaign_id
            FROM valid_cancels c JOIN aff_1 USING (affiliate_id)
            LEFT JOIN label_values l ON c.id = l.id
            LEFT JOIN cc_map m1 ON l.ucc = m1.cc
            LEFT JOIN cc_map m2
                ON string_split(string_split(affiliate_name, '.')[1], '_')[2] = m2.cc
            LEFT JOIN cc_map m3 ON upper(c.booker_cc1) = m3.cc""",
        "cancel_1": """
            SELECT yyyy_mm_dd, hotel_id, pos, 1 AS cancellations,
                   commission_amount_euro AS cancelled_commission,
                   roomnights AS cancelled_roomnights
            FROM campaign_chain JOIN points_of_sale USING (campaign_id)
            JOIN device_classes d ON d.hotelreservation_id = campaign_chain.id""",
        "report_1": f"""
            SELECT * FROM account_1_report JOIN points_of_sale USING (campaign_id)
            WHERE yyyy_mm_dd {DAYS}""",
    }
)


def stats_sql(source: str, keys: str, extra: str = "") -> str:
    """Reference form of a stats summary over joined rows."""
    return f"""
        SELECT {keys},
               CAST(sum(nits_bookings) AS DOUBLE) AS nits_bookings,
               CAST(sum(nits_commission) AS DOUBLE) AS nits_commission,
               CAST(sum(bookings) AS BIGINT) AS gross_bookings,
               CAST(sum(commission) AS DOUBLE) AS gross_commission,
               CAST(sum(cost) AS DOUBLE) AS cost,
               CAST(sum(clicks) AS BIGINT) AS clicks,
               CAST(sum(roomnights) AS BIGINT) AS roomnights, {extra}
               CAST(sum(nits_commission) - sum(cost) AS DOUBLE) AS nits_profit,
               CAST(sum(commission) - sum(cost) AS DOUBLE) AS gross_profit
        FROM {source} GROUP BY ALL"""


def cancels_sql(source: str, keys: str) -> str:
    return f"""
        SELECT {keys}, CAST(sum(cancellations) AS BIGINT) AS cancellations,
               CAST(sum(cancelled_commission) AS DOUBLE) AS cancelled_commission,
               CAST(sum(cancelled_roomnights) AS BIGINT) AS cancelled_roomnights
        FROM {source} GROUP BY ALL"""


def combined_sql(perf: str, cancels: str, key_names: list[str], extra: str = "") -> str:
    """Reference form of the combined table: two groupings, an outer join, then the fill."""
    keys = ", ".join(key_names)
    extra_sum = "sum(length_of_stay) AS length_of_stay," if extra else ""
    return f"""
        WITH s AS (
            SELECT {keys}, sum(nits_bookings) AS nits_bookings,
                   sum(nits_commission) AS nits_commission, sum(bookings) AS gross_bookings,
                   sum(commission) AS gross_commission, sum(cost) AS cost,
                   sum(clicks) AS clicks, {extra_sum} sum(roomnights) AS roomnights
            FROM {perf} GROUP BY ALL
        ), c AS (
            SELECT {keys}, sum(cancellations) AS cancellations,
                   sum(cancelled_commission) AS cancelled_commission,
                   sum(cancelled_roomnights) AS cancelled_roomnights
            FROM {cancels} GROUP BY ALL
        )
        SELECT {keys.replace('yyyy_mm_dd', 'CAST(yyyy_mm_dd AS VARCHAR) AS yyyy_mm_dd')},
               CAST(coalesce(nits_bookings, 0) AS DOUBLE) AS nits_bookings,
               CAST(coalesce(nits_commission, 0) AS DOUBLE) AS nits_commission,
               CAST(coalesce(gross_bookings, 0) AS BIGINT) AS gross_bookings,
               CAST(coalesce(gross_commission, 0) AS DOUBLE) AS gross_commission,
               CAST(coalesce(cost, 0) AS DOUBLE) AS cost,
               CAST(coalesce(clicks, 0) AS BIGINT) AS clicks,
               CAST(coalesce(roomnights, 0) AS BIGINT) AS roomnights, {extra}
               CAST(coalesce(nits_commission - cost, 0) AS DOUBLE) AS nits_profit,
               CAST(coalesce(gross_commission - cost, 0) AS DOUBLE) AS gross_profit,
               CAST(coalesce(cancellations, 0) AS BIGINT) AS cancellations,
               CAST(coalesce(cancelled_commission, 0) AS DOUBLE) AS cancelled_commission,
               CAST(coalesce(cancelled_roomnights, 0) AS BIGINT) AS cancelled_roomnights,
               CAST(coalesce(gross_commission - cancelled_commission, 0) AS DOUBLE)
                   AS asbooked_commission,
               CAST(coalesce(roomnights - cancelled_roomnights, 0) AS BIGINT)
                   AS asbooked_roomnights
        FROM s FULL JOIN c USING ({keys})"""


DAY = "CAST(yyyy_mm_dd AS VARCHAR) AS yyyy_mm_dd"

# --- scans -------------------------------------------------------------------------------


@query(
    "s1_date_scan",
    """SELECT CAST(date AS VARCHAR) AS date, siloname, CAST(cost_eur AS DOUBLE) AS cost_eur
       FROM click_log WHERE date BETWEEN DATE '1996-02-01' AND DATE '2000-03-31'""",
)
def s1_date_scan(t: Tables):
    rows = scans.date_scan(t.click_log, "date", "1996-02-01", "2000-03-31")
    return rows.select("date", "siloname", "cost_eur")


@query(
    "s2_timestamp_date_scan",
    """SELECT id, CAST(CAST(created AS DATE) AS VARCHAR) AS created FROM reservations
       WHERE CAST(created AS DATE) BETWEEN DATE '1996-02-01' AND DATE '2000-03-31'""",
)
def s2_timestamp_date_scan(t: Tables):
    rows = scans.timestamp_date_scan(t.reservations, "created", "1996-02-01", "2000-03-31")
    return rows.select("id", F.to_date("created").alias("created"))


@query(
    "s3_reservation_scan",
    f"""SELECT b.id, {DAY}, affiliate_name, bookings, CAST(commission AS DOUBLE) AS commission,
               roomnights
        FROM valid_bookings b JOIN aff_2 USING (affiliate_id)
        WHERE commission <= {MAX_RPB}""",
    "bookings roomnights",
)
def s3_reservation_scan(t: Tables):
    named = partner_affiliates(t, "account_2", rg.CORE_NAME)
    rows = mt.reservation_scan(t.reservations, named, START, END, MAX_RPB)
    return rows.select(
        F.col("hotelreservation_id").alias("id"),
        "yyyy_mm_dd", "affiliate_name", "bookings", "commission", "roomnights",
    )


@query("s4_affiliate_scan", "SELECT affiliate_id, affiliate_name FROM aff_3")
def s4_affiliate_scan(t: Tables):
    return partner_affiliates(t, "account_3", at.silo_pattern(rg.PLACEMENTS))


@query(
    "s5_score_scans",
    """SELECT id, 'preferred' AS source, CAST(prediction AS DOUBLE) AS score FROM pref
       UNION ALL SELECT id, 'fallback', CAST(nits_score AS DOUBLE) FROM fall""",
)
def s5_score_scans(t: Tables):
    preferred = scans.preferred_scores(t.preferred_scores, START, END)
    fallback = scans.fallback_scores(t.fallback_scores, START, END)
    key = F.col("hotelreservation_id").alias("id")
    return preferred.select(
        key, F.lit("preferred").alias("source"), F.col("preferred").alias("score")
    ).unionByName(
        fallback.select(key, F.lit("fallback").alias("source"), F.col("fallback").alias("score"))
    )


@query(
    "s6_click_cost",
    f"""SELECT hotel_id, {DAY}, locale, device, CAST(clicks AS BIGINT) AS clicks,
               CAST(cost AS DOUBLE) AS cost FROM clicks_2""",
    "hotel_id",
)
def s6_click_cost(t: Tables):
    facts = mt.two_device_costs(t.web_costs, t.mobile_costs, START, END)
    keys = ["hotel_id", "yyyy_mm_dd", "locale", "device"]
    return mt.sum_facts(facts, keys, {"clicks": "clicks", "cost": "cost"})


@query(
    "s7_performance_scan",
    f"""SELECT {DAY}, hotel_id, pos, clicks, CAST(nits_commission AS DOUBLE) AS expected
        FROM perf_4""",
    "hotel_id clicks",
)
def s7_performance_scan(t: Tables):
    rows = scans.performance(t.performance, START, END, MAX_RPB)
    return rows.select(
        "yyyy_mm_dd", "hotel_id", "pos", "clicks",
        F.col("commission_expected_euro").alias("expected"),
    )


@query(
    "s8_holiday_calendar",
    """SELECT CAST(yyyy_mm_dd AS VARCHAR) AS ds, name AS holiday, upper(cc1) AS pos
       FROM holidays
       WHERE level = 1 AND yyyy_mm_dd BETWEEN DATE '1996-01-01' AND DATE '2001-12-31'""",
)
def s8_holiday_calendar(t: Tables):
    return scans.holiday_calendar(t.holidays, "1996-01-01", "2001-12-31")


@query("s9_campaign_lookup", "SELECT campaign_id, pos FROM points_of_sale", "campaign_id")
def s9_campaign_lookup(t: Tables):
    return mt.campaign_scan(t.campaigns)


# --- filters and projections -------------------------------------------------------------


@query("p1_status_filter", f"SELECT id, status FROM reservations WHERE {GOOD}")
def p1_status_filter(t: Tables):
    return scans.good_status(t.reservations).select("id", "status")


@query(
    "p2_value_cap",
    """SELECT id, 'inclusive' AS mode FROM reservations WHERE commission_amount_euro <= 250000
       UNION ALL SELECT id, 'strict' FROM reservations WHERE commission_amount_euro < 250000""",
)
def p2_value_cap(t: Tables):
    value = "commission_amount_euro"
    return (
        scans.value_cap(t.reservations, value, 250000)
        .select("id", F.lit("inclusive").alias("mode"))
        .unionByName(
            scans.value_cap(t.reservations, value, 250000, inclusive=False).select(
                "id", F.lit("strict").alias("mode")
            )
        )
    )


@query(
    "p3_nonnull",
    f"SELECT hotel_id, {DAY}, locale, clicks_bob FROM web_costs WHERE hotel_id IS NOT NULL",
    "hotel_id clicks_bob",
)
def p3_nonnull(t: Tables):
    return scans.not_null(t.web_costs, "hotel_id").select(
        "hotel_id", "yyyy_mm_dd", "locale", "clicks_bob"
    )


@query(
    "p4_silo_regex",
    """SELECT siloname, 'matching' AS mode, count(*) AS n_rows FROM click_log
       WHERE regexp_matches(siloname, '(DMeta|Mobile)') GROUP BY ALL
       UNION ALL
       SELECT siloname, 'not null', count(*) FROM click_log
       WHERE siloname IS NOT NULL GROUP BY ALL""",
)
def p4_silo_regex(t: Tables):
    pattern = at.silo_pattern(rg.PLACEMENTS)
    count = F.count(F.lit(1)).alias("n_rows")
    matching = scans.matching_silo(t.click_log, "siloname", pattern)
    named = scans.matching_silo(t.click_log, "siloname", pattern, keep_unmatched=True)
    return (
        matching.groupBy("siloname", F.lit("matching").alias("mode")).agg(count)
        .unionByName(named.groupBy("siloname", F.lit("not null").alias("mode")).agg(count))
    )


@query(
    "p5_pos_nonempty",
    r"""SELECT id, regexp_extract(name, 'account_4_(.*?)\.', 1) AS pos FROM affiliates
        WHERE regexp_extract(name, 'account_4_(.*?)\.', 1) <> ''""",
)
def p5_pos_nonempty(t: Tables):
    pos = at.pos_from_name(F.col("name"), at.POS_AFTER_ACCOUNT_4)
    return scans.not_empty(t.affiliates.select("id", pos.alias("pos")), "pos")


@query(
    "p6_pos_filter",
    f"""SELECT {DAY}, pos, CAST(cost AS DOUBLE) AS cost FROM perf_4
        WHERE pos IN ('NATION3', 'NATION7')
        UNION ALL SELECT {DAY}, pos, CAST(cost AS DOUBLE) FROM perf_4""",
)
def p6_pos_filter(t: Tables):
    rows = scans.performance(t.performance, START, END, MAX_RPB).select(
        "yyyy_mm_dd", "pos", F.col("cost_euro").alias("cost")
    )
    return scans.keep_pos(rows, ["NATION3", "NATION7"]).unionByName(scans.keep_pos(rows, "All"))


@query(
    "p7_rename_cast",
    """SELECT CAST(hotelreservation_id AS VARCHAR) AS hotelreservation_id,
              CAST(prediction AS DOUBLE) AS nits_pred, CAST(created_date AS VARCHAR) AS yyyy_mm_dd
       FROM preferred_scores""",
)
def p7_rename_cast(t: Tables):
    return t.preferred_scores.withColumnsRenamed(
        {"prediction": "nits_pred", "created_date": "yyyy_mm_dd"}
    ).withColumn("hotelreservation_id", F.col("hotelreservation_id").cast("string"))


@query(
    "p8_metric_select",
    f"""SELECT {DAY}, pos, CAST(sum(bookings) AS BIGINT) AS gross_bookings
        FROM perf_4 GROUP BY ALL""",
)
def p8_metric_select(t: Tables):
    return rg.metric_values(t, "account_4", "GrossBookings", scope("account_4"))


@query(
    "p9_literals",
    """SELECT id, CAST(yyyy_mm_dd AS VARCHAR) AS yyyy_mm_dd, 1 AS cancellations,
              'web' AS device FROM valid_cancels JOIN aff_4 USING (affiliate_id)""",
    "cancellations",
)
def p9_literals(t: Tables):
    rows = mt.cancelled_scan(t.reservations, partner_affiliates(t, "account_4"), START, END)
    return rows.select(
        F.col("hotelreservation_id").alias("id"), "yyyy_mm_dd", "cancellations",
        F.lit("web").alias("device"),
    )


# --- joins -------------------------------------------------------------------------------


@query(
    "j1_affiliate_join",
    """SELECT id, affiliate_id, affiliate_name FROM reservations JOIN aff_3
       USING (affiliate_id)""",
)
def j1_affiliate_join(t: Tables):
    named = partner_affiliates(t, "account_3", at.silo_pattern(rg.PLACEMENTS))
    return t.reservations.select("id", "affiliate_id").join(named, "affiliate_id")


@query(
    "j2_broadcast_join",
    "SELECT id, affiliate_id, affiliate_name FROM reservations JOIN aff_1 USING (affiliate_id)",
)
def j2_broadcast_join(t: Tables):
    named = partner_affiliates(t, "account_1")
    return joins.dimension_join(t.reservations.select("id", "affiliate_id"), named, "affiliate_id")


@query(
    "j3_existence_join",
    """SELECT r.id, count(*) AS copies, CAST(sum(roomnights) AS BIGINT) AS roomnights
       FROM reservations r JOIN device_classes d ON r.id = d.hotelreservation_id
       GROUP BY r.id""",
)
def j3_existence_join(t: Tables):
    rows = t.reservations.select(F.col("id").alias("hotelreservation_id"), "roomnights")
    return joins.inner_join_counted(rows, t.device_classes).select(
        F.col("hotelreservation_id").alias("id"),
        "copies",
        (F.col("roomnights") * F.col("copies")).alias("roomnights"),
    )


SCORE_FALLBACK_SQL = """
    SELECT r.id, count(*) AS copies,
           CAST(sum(1 - coalesce(prediction, nits_score, 0)) AS DOUBLE) AS kept
    FROM reservations r LEFT JOIN pref USING (id) LEFT JOIN fall USING (id)
    GROUP BY r.id"""


@query("j4_score_fallback", SCORE_FALLBACK_SQL)
def j4_score_fallback(t: Tables):
    rows = t.reservations.select(F.col("id").alias("hotelreservation_id"))
    joined = joins.score_fallback_join(
        rows,
        scans.preferred_scores(t.preferred_scores, START, END),
        scans.fallback_scores(t.fallback_scores, START, END),
    )
    return joined.select(
        F.col("hotelreservation_id").alias("id"), "copies", F.col("kept").cast("double")
    )


@query("j4_bucketed_join", SCORE_FALLBACK_SQL)
def j4_bucketed_join(t: Tables):
    """J3 / J4 on reservations and scores that were written by reservation id."""
    mark, rows = uuid.uuid4().hex[:12], t.reservations.select("id")
    scores = {
        "preferred": scans.preferred_scores(t.preferred_scores, START, END),
        "fallback": scans.fallback_scores(t.fallback_scores, START, END),
    }
    made = [bk.write_bucketed(rows, f"reservations_{mark}", "id", 16)]
    made += [bk.write_bucketed(df, f"{name}_{mark}", bk.ID, 16) for name, df in scores.items()]
    joined = bk.bucketed_score_join(*made)
    return joined.select(F.col(bk.ID).alias("id"), "copies", F.col("kept").cast("double"))


@query(
    "j5_full_outer",
    f"""SELECT hotel_id, locale, device, {DAY}, CAST(clicks AS BIGINT) AS clicks,
               CAST(cost AS DOUBLE) AS cost, CAST(bookings AS BIGINT) AS bookings,
               CAST(commission AS DOUBLE) AS commission
        FROM perf_2""",
    "hotel_id",
)
def j5_full_outer(t: Tables):
    clicks = mt.two_device_costs(t.web_costs, t.mobile_costs, START, END)
    named = partner_affiliates(t, "account_2", rg.CORE_NAME)
    bookings = mt.by_locale(
        mt.reservation_scan(t.reservations, named, START, END, MAX_RPB)
    )
    scored = mt.scored_bookings(
        bookings,
        scans.preferred_scores(t.preferred_scores, START, END),
        scans.fallback_scores(t.fallback_scores, START, END),
        mt.ACCOUNT_2_KEYS,
    )
    sums = {c: c for c in ("clicks", "cost", "bookings", "commission")}
    return mt.sum_facts(mt.stack_facts(clicks, scored), mt.ACCOUNT_2_KEYS, sums)


@query(
    "j6_metric_outer_join",
    combined_sql("perf_4", "cancel_4", ["hotel_id", "yyyy_mm_dd", "pos"]),
    "hotel_id",
)
def j6_metric_outer_join(t: Tables):
    keys = ["hotel_id", "yyyy_mm_dd", "pos"]
    return rg.account("account_4").combined(t, scope("account_4"), keys)


@query(
    "j7_campaign_restrict",
    f"""SELECT campaign_id, pos, {DAY}, CAST(sum(commission) AS DOUBLE) AS commission
        FROM report_1 WHERE pos IN ('NATION1', 'NATION2') GROUP BY ALL""",
    "campaign_id",
)
def j7_campaign_restrict(t: Tables):
    report = scans.date_scan(t.account_1_report, "yyyy_mm_dd", START, END)
    chosen = mt.campaign_scan(t.campaigns, ["NATION1", "NATION2"])
    facts = mt.account_1_stat_facts(report, chosen)
    return mt.sum_facts(facts, ["campaign_id", "pos", "yyyy_mm_dd"], {"commission": "commission"})


@query(
    "j9_campaign_merge",
    """SELECT campaign_id, name AS campaign_name, cc AS pos
       FROM (SELECT cc, CASE WHEN cc = 'NATION9' THEN 3 ELSE campaign_id END AS campaign_id
             FROM country_campaigns) m JOIN campaigns ON campaign_id = id""",
    "campaign_id",
)
def j9_campaign_merge(t: Tables):
    return rg.account("account_1").pos_map(t, scope("account_1"))


@query(
    "u1_union_devices",
    f"""SELECT device, locale, CAST(sum(clicks) AS BIGINT) AS clicks,
               CAST(sum(cost) AS DOUBLE) AS cost FROM clicks_2 GROUP BY ALL""",
)
def u1_union_devices(t: Tables):
    facts = mt.two_device_costs(t.web_costs, t.mobile_costs, START, END)
    return mt.sum_facts(facts, ["device", "locale"], {"clicks": "clicks", "cost": "cost"})


# --- attribution -------------------------------------------------------------------------


@query(
    "f1_label_hotel",
    f"SELECT id, {HOTEL_SQL} AS hotel_id FROM reservations",
    "hotel_id",
)
def f1_label_hotel(t: Tables):
    hotel = at.hotel_from_label(F.col("label"), F.col("hotel_id"))
    return t.reservations.select("id", hotel.alias("hotel_id"))


@query(
    "f2_label_locale",
    f"SELECT id, {LOCALE_SQL} AS locale FROM reservations",
)
def f2_label_locale(t: Tables):
    return t.reservations.select("id", at.locale_from_label(F.col("label")).alias("locale"))


@query(
    "f3_label_device",
    f"SELECT id, {DEVICE_SQL} AS device FROM reservations JOIN aff_2 USING (affiliate_id)",
)
def f3_label_device(t: Tables):
    named = partner_affiliates(t, "account_2", rg.CORE_NAME)
    rows = joins.dimension_join(
        t.reservations.select("id", "label", "affiliate_id"), named, "affiliate_id"
    )
    device = at.device_from_label(F.col("label"), F.col("affiliate_name"))
    return rows.select("id", device.alias("device"))


@query(
    "f4_name_parts",
    f"""SELECT id, {name_part('name', 1)} AS distribution, {name_part('name', 2)} AS placement
        FROM affiliates""",
)
def f4_name_parts(t: Tables):
    name = F.col("name")
    return t.affiliates.select(
        "id",
        at.distribution_from_name(name).alias("distribution"),
        at.placement_from_name(name).alias("placement"),
    )


@query(
    "f5_silo_parts",
    """SELECT siloname, regexp_extract(siloname, '(.*)(DMeta|Mobile)', 1) AS distribution,
              regexp_extract(siloname, '(.*)(DMeta|Mobile)', 2) AS placement,
              count(*) AS n_rows FROM click_log GROUP BY ALL""",
)
def f5_silo_parts(t: Tables):
    silo = F.col("siloname")
    return t.click_log.groupBy(
        "siloname",
        at.distribution_from_silo(silo, rg.PLACEMENTS).alias("distribution"),
        at.placement_from_silo(silo, rg.PLACEMENTS).alias("placement"),
    ).agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "f6_pos_lazy",
    r"""SELECT id, regexp_extract(name, '(.*?)\.', 1) AS before_dot,
               regexp_extract(name, 'account_4_(.*?)\.', 1) AS after_account FROM affiliates""",
)
def f6_pos_lazy(t: Tables):
    name = F.col("name")
    return t.affiliates.select(
        "id",
        at.pos_from_name(name).alias("before_dot"),
        at.pos_from_name(name, at.POS_AFTER_ACCOUNT_4).alias("after_account"),
    )


@query(
    "f7_pos_greedy",
    f"SELECT id, {GREEDY_POS_SQL.replace('affiliate_name', 'name')} AS pos FROM affiliates",
)
def f7_pos_greedy(t: Tables):
    pos = at.pos_from_name(
        F.col("name"), at.POS_AFTER_UNDERSCORE, at.POS_AFTER_UNDERSCORE_GROUP
    )
    return t.affiliates.select("id", pos.alias("pos"))


@query(
    "f8_affiliate_attrs",
    """SELECT id, string_split(string_split(name, '.')[1], '_')[2] AS cc,
              CASE string_split(name, '.')[2] WHEN 'LU' THEN 'localuniversal'
                   WHEN 'MR' THEN 'mapresults' END AS placement,
              CASE string_split(name, '.')[3] WHEN 'PC' THEN 'desktop'
                   WHEN 'Mobile' THEN 'mobile' WHEN 'Tablet' THEN 'tablet' END AS device
       FROM affiliates""",
)
def f8_affiliate_attrs(t: Tables):
    name = F.col("name")
    return t.affiliates.select(
        "id",
        at.affiliate_country(name).alias("cc"),
        at.affiliate_placement(name).alias("placement"),
        at.affiliate_device(name).alias("device"),
    )


@query(
    "f9_label_parse",
    """SELECT r.id, cid, ucc, placement, label_hotel_id
       FROM reservations r LEFT JOIN label_values v ON r.id = v.id""",
)
def f9_label_parse(t: Tables):
    label = F.col("label")
    rows = t.reservations.select("id", "label", at.label_entries(label).alias("entries"))
    return rows.select(
        "id",
        at.label_value(label, "cid").alias("cid"),
        at.label_value(label, "ucc").alias("ucc"),
        at.entry_value(F.col("entries"), "placement").alias("placement"),
        at.entry_value(F.col("entries"), "hotel_id").alias("label_hotel_id"),
    )


@query(
    "f9_label_map",
    """SELECT k AS key, v AS value, count(*) AS n_rows
       FROM (SELECT id, k, arg_max(v, i) AS v FROM label_pairs GROUP BY id, k)
       GROUP BY ALL""",
)
def f9_label_map(t: Tables):
    pairs = t.reservations.select(F.explode(at.label_map(F.col("label"))))
    return pairs.groupBy("key", "value").agg(F.count(F.lit(1)).alias("n_rows"))


@query("f10_campaign_chain", "SELECT id, campaign_id FROM campaign_chain", "campaign_id")
def f10_campaign_chain(t: Tables):
    rows = mt.cancelled_scan(t.reservations, partner_affiliates(t, "account_1"), START, END)
    return mt.attribute_campaign(rows, t.country_campaigns).select(
        F.col("hotelreservation_id").alias("id"), "campaign_id"
    )


@query(
    "f11_override",
    """SELECT campaign_id, count(*) AS n_pos
       FROM (SELECT CASE WHEN cc = 'NATION9' THEN 3 ELSE campaign_id END AS campaign_id
             FROM country_campaigns) JOIN campaigns ON id = campaign_id GROUP BY ALL""",
    "campaign_id",
)
def f11_override(t: Tables):
    pos_map = mt.campaign_pos_map(t.campaigns, t.country_campaigns, OVERRIDE)
    return pos_map.groupBy("campaign_id").agg(F.count(F.lit(1)).alias("n_pos"))


@query("f12_upper_keys", "SELECT id, upper(booker_cc1) AS booker_cc1 FROM reservations")
def f12_upper_keys(t: Tables):
    return t.reservations.select("id", F.upper("booker_cc1").alias("booker_cc1"))


# --- arithmetic --------------------------------------------------------------------------


@query(
    "m1_null_safe_sum",
    """SELECT locale, CAST(sum(coalesce(cost_core, 0) + coalesce(cost_bob, 0)) AS DOUBLE) AS cost,
              CAST(sum(coalesce(clicks_core, 0) + coalesce(clicks_bob, 0)) AS BIGINT) AS clicks
       FROM device_costs GROUP BY ALL""",
)
def m1_null_safe_sum(t: Tables):
    rows = t.web_costs.unionByName(t.mobile_costs)
    return rows.groupBy("locale").agg(
        F.sum(nm.null_safe_sum(F.col("cost_core"), F.col("cost_bob"))).alias("cost"),
        F.sum(nm.null_safe_sum(F.col("clicks_core"), F.col("clicks_bob"))).alias("clicks"),
    )


@query(
    "m2_discounted_value",
    f"""SELECT {DAY}, locale, device, CAST(sum(nits_bookings) AS DOUBLE) AS nits_bookings,
               CAST(sum(nits_commission) AS DOUBLE) AS nits_commission
        FROM scored_2 GROUP BY ALL""",
)
def m2_discounted_value(t: Tables):
    named = partner_affiliates(t, "account_2", rg.CORE_NAME)
    bookings = mt.by_locale(mt.reservation_scan(t.reservations, named, START, END, MAX_RPB))
    keys = ["yyyy_mm_dd", "locale", "device"]
    scored = mt.scored_bookings(
        bookings,
        scans.preferred_scores(t.preferred_scores, START, END),
        scans.fallback_scores(t.fallback_scores, START, END),
        keys,
    )
    sums = {c: c for c in ("nits_bookings", "nits_commission")}
    return mt.sum_facts(scored, keys, sums)


@query(
    "m3_profit",
    """SELECT pos, CAST(sum(nits_commission) - sum(cost) AS DOUBLE) AS nits_profit,
              CAST(sum(commission) - sum(cost) AS DOUBLE) AS gross_profit
       FROM perf_3 GROUP BY ALL""",
)
def m3_profit(t: Tables):
    return stats(t, "account_3", ["pos"]).select("pos", "nits_profit", "gross_profit")


@query(
    "m4_as_booked",
    """WITH s AS (SELECT yyyy_mm_dd, pos, sum(commission) AS gross FROM perf_3 GROUP BY ALL),
            c AS (SELECT yyyy_mm_dd, pos, sum(cancelled_commission) AS cancelled
                  FROM cancel_3 GROUP BY ALL)
       SELECT CAST(yyyy_mm_dd AS VARCHAR) AS yyyy_mm_dd, pos,
              CAST(coalesce(gross, 0) - coalesce(cancelled, 0) AS DOUBLE) AS asbooked_commission
       FROM s FULL JOIN c USING (yyyy_mm_dd, pos)""",
)
def m4_as_booked(t: Tables):
    table = rg.account("account_3").combined(
        t, scope("account_3"), rg.METRIC_KEYS, fill_first=True
    )
    return table.select("yyyy_mm_dd", "pos", "asbooked_commission")


# --- summaries ---------------------------------------------------------------------------


@query(
    "g1_booking_summary",
    f"""SELECT hotel_id, {DAY}, CAST(sum(nits_bookings) AS DOUBLE) AS nits_bookings,
               CAST(sum(nits_commission) AS DOUBLE) AS nits_commission,
               CAST(sum(bookings) AS BIGINT) AS gross_bookings,
               CAST(sum(commission) AS DOUBLE) AS gross_commission,
               CAST(sum(roomnights) AS BIGINT) AS roomnights
        FROM report_1 GROUP BY ALL""",
    "hotel_id",
)
def g1_booking_summary(t: Tables):
    report = scans.date_scan(t.account_1_report, "yyyy_mm_dd", START, END)
    campaigns = mt.campaign_scan(t.campaigns)
    return mt.account_1_bookings(report, campaigns, ["hotel_id", "yyyy_mm_dd"])


@query("g2_stats_full", stats_sql("report_1", f"{DAY}, pos"))
def g2_stats_full(t: Tables):
    return stats(t, "account_1", ["yyyy_mm_dd", "pos"])


@query("g3_stats_two_device", stats_sql("perf_2", f"hotel_id, {DAY}"), "hotel_id")
def g3_stats_two_device(t: Tables):
    return stats(t, "account_2", ["hotel_id", "yyyy_mm_dd"])


STAY = "CAST(sum(length_of_stay) AS BIGINT) AS length_of_stay,"


@query("g4_stats_clicklog", stats_sql("perf_3", f"{DAY}, pos", STAY))
def g4_stats_clicklog(t: Tables):
    return stats(t, "account_3", ["yyyy_mm_dd", "pos"])


@query(
    "g4_stats_clicklog_pos",
    stats_sql("(SELECT * FROM perf_3 WHERE pos IN ('NATION2', 'NATION7'))", f"{DAY}, pos", STAY),
)
def g4_stats_clicklog_pos(t: Tables):
    return stats(t, "account_3", ["yyyy_mm_dd", "pos"], ["NATION2", "NATION7"])


@query("g5_stats_preagg", stats_sql("perf_4", f"{DAY}, pos"))
def g5_stats_preagg(t: Tables):
    return stats(t, "account_4", ["yyyy_mm_dd", "pos"])


@query("g6_cancel_attributed", cancels_sql("cancel_1", f"{DAY}, pos"))
def g6_cancel_attributed(t: Tables):
    return cancellations(t, "account_1", ["yyyy_mm_dd", "pos"])


@query("g7_cancel_locale", cancels_sql("cancel_2", f"{DAY}, affiliate_id, locale, device"))
def g7_cancel_locale(t: Tables):
    return cancellations(t, "account_2", ["yyyy_mm_dd", "affiliate_id", "locale", "device"])


@query(
    "g8_cancel_distribution",
    cancels_sql("cancel_3", f"{DAY}, hotel_id, pos, placement"),
    "hotel_id",
)
def g8_cancel_distribution(t: Tables):
    return cancellations(t, "account_3", ["yyyy_mm_dd", "hotel_id", "pos", "placement"])


@query("g9_cancel_pos", cancels_sql("cancel_4", f"{DAY}, hotel_id, pos"), "hotel_id")
def g9_cancel_pos(t: Tables):
    return cancellations(t, "account_4", ["yyyy_mm_dd", "hotel_id", "pos"])


COMBINED_KEYS = ["yyyy_mm_dd", "pos"]


@query(
    "g10_combined_1",
    combined_sql("report_1", "cancel_1", ["hotel_id", "yyyy_mm_dd", "pos"]),
    "hotel_id",
)
def g10_combined_1(t: Tables):
    keys = ["hotel_id", "yyyy_mm_dd", "pos"]
    return rg.account("account_1").combined(t, scope("account_1"), keys)


@query(
    "g10_combined_2",
    combined_sql(
        "perf_2", "(SELECT *, locale AS pos FROM cancel_2)", ["yyyy_mm_dd", "pos", "device"]
    ),
)
def g10_combined_2(t: Tables):
    keys = ["yyyy_mm_dd", "pos", "device"]
    return rg.account("account_2").combined(t, scope("account_2"), keys)


@query(
    "g10_combined_3",
    combined_sql(
        "perf_3", "cancel_3", ["hotel_id", "yyyy_mm_dd", "pos"],
        "CAST(coalesce(length_of_stay, 0) AS BIGINT) AS length_of_stay,",
    ),
    "hotel_id",
)
def g10_combined_3(t: Tables):
    keys = ["hotel_id", "yyyy_mm_dd", "pos"]
    return rg.account("account_3").combined(t, scope("account_3"), keys)


@query("g10_combined", combined_sql("perf_4", "cancel_4", COMBINED_KEYS))
def g10_combined(t: Tables):
    return rg.account("account_4").combined(t, scope("account_4"), COMBINED_KEYS)


@query("g11_two_stage", stats_sql("perf_3", "hotel_id", STAY), "hotel_id")
def g11_two_stage(t: Tables):
    return stats(t, "account_3", ["hotel_id"])


@query(
    "g14_distinct_pos",
    r"""SELECT DISTINCT regexp_extract(affiliate_name, '(.*?)\.', 1) AS pos FROM aff_3
        WHERE regexp_extract(affiliate_name, '(.*?)\.', 1) <> ''""",
)
def g14_distinct_pos(t: Tables):
    return rg.account("account_3").pos_map(t, scope("account_3"))


@query(
    "k11_all_metrics",
    " UNION ALL ".join(
        f"""SELECT '{account}' AS account, '{metric}' AS series_id, {DAY}, pos,
                   CAST(sum({value}) AS DOUBLE) AS value FROM {source}
            WHERE {value} IS NOT NULL GROUP BY ALL"""
        for account, perf, cancel in (
            ("account_1", "report_1", "cancel_1"),
            ("account_2", "perf_2", "(SELECT *, locale AS pos FROM cancel_2)"),
            ("account_3", "perf_3", "cancel_3"),
            ("account_4", "perf_4", "cancel_4"),
        )
        for metric, value, source in (
            ("gross_bookings", "bookings", perf),
            ("roomnights", "roomnights", perf),
            ("gross_commission", "commission", perf),
            ("cancellations", "cancellations", cancel),
            ("cancelled_commission", "cancelled_commission", cancel),
            ("cancelled_roomnights", "cancelled_roomnights", cancel),
        )
    ),
)
def k11_all_metrics(t: Tables):
    """K11 + K12: all 24 metrics, each account in one pass per summary."""
    parts = [
        rg.metrics_long(t, name, list(rg.METRICS), scope(name)).withColumn(
            "account", F.lit(name)
        )
        for name in rg.ACCOUNTS
    ]
    return mt.stack_facts(*parts)


@query(
    "k13_pos_map",
    r"""SELECT 'account_1' AS account, cc AS pos
        FROM (SELECT cc, CASE WHEN cc = 'NATION9' THEN 3 ELSE campaign_id END AS campaign_id
              FROM country_campaigns) JOIN campaigns ON campaign_id = id
        UNION ALL
        SELECT DISTINCT 'account_2', pos FROM perf_2
        UNION ALL
        SELECT DISTINCT 'account_3', regexp_extract(affiliate_name, '(.*?)\.', 1) FROM aff_3
        UNION ALL
        SELECT DISTINCT 'account_4', regexp_extract(affiliate_name, 'account_4_(.*?)\.', 1)
        FROM aff_4""",
)
def k13_pos_map(t: Tables):
    parts = [
        account.pos_map(t, scope(name)).select(F.lit(name).alias("account"), "pos")
        for name, account in rg.ACCOUNTS.items()
    ]
    return mt.stack_facts(*parts)


@query(
    "m10_date_spine",
    """SELECT pos, CAST(CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS VARCHAR)
              AS ds
       FROM (SELECT pos, min(yyyy_mm_dd) AS a, max(yyyy_mm_dd) AS b FROM perf_4 GROUP BY pos)""",
)
def m10_date_spine(t: Tables):
    rows = scans.performance(t.performance, START, END, MAX_RPB)
    span = rows.groupBy("pos").agg(
        F.min("yyyy_mm_dd").alias("a"), F.max("yyyy_mm_dd").alias("b")
    )
    return span.select("pos", F.explode(dt.date_array(F.col("a"), F.col("b"))).alias("ds"))


@query(
    "m9_minus_days",
    f"""SELECT id, CAST(CAST(created AS DATE) - 1 AS VARCHAR) AS day_before,
               CAST(CAST(created AS DATE) - 365 AS VARCHAR) AS year_before FROM reservations""",
)
def m9_minus_days(t: Tables):
    day = F.to_date("created")
    return t.reservations.select(
        "id",
        dt.minus_days(day, 1).alias("day_before"),
        dt.minus_days(day, 365).alias("year_before"),
    )


@query(
    "m11_week_year",
    """SELECT id, week(created) AS week, year(created) AS calendar_year,
              isoyear(created) AS iso_year, strftime(created, '%Y-%m-%d') AS day
       FROM reservations""",
)
def m11_week_year(t: Tables):
    day = F.to_date("created")
    return t.reservations.select(
        "id",
        dt.iso_week(day).alias("week"),
        dt.week_year(day).alias("calendar_year"),
        dt.week_year(day, "iso").alias("iso_year"),
        dt.date_text(day).alias("day"),
    )


# --- kept summaries ----------------------------------------------------------------------

KEPT_METRICS = ["GrossCommission", "Cancellations"]
RESTATED = (date(1997, 3, 4), date(1997, 3, 5))


@query(
    "g_kept_summary",
    f"""SELECT {DAY}, pos, 'gross_commission' AS series_id,
               CAST(sum(commission) AS DOUBLE) AS value FROM perf_4 GROUP BY ALL
        UNION ALL
        SELECT {DAY}, pos, 'cancellations', CAST(sum(cancellations) AS DOUBLE)
        FROM cancel_4 GROUP BY ALL""",
)
def g_kept_summary(t: Tables):
    """G5 + G9 + K11 kept by month: built before some reservations were made or cancelled and
    two days were restated, then brought up to date in the months these touch."""
    late = F.col("created").cast("date").between("2001-06-01", "2001-06-20")
    new = F.col("created").cast("date") >= "2001-12-01"
    restated = F.col("yyyy_mm_dd").isin(*RESTATED)
    cost = F.col("commission_amount_euro")
    before = {
        **t,
        "reservations": t.reservations.where(~new).withColumn(
            "date_cancelled", F.when(~late, F.col("date_cancelled"))
        ),
        "performance": t.performance.withColumn(
            "commission_amount_euro", F.when(restated, cost * 2).otherwise(cost)
        ),
    }
    folder = f"{shared_folder(t.spark)}/kept_metrics_{uuid.uuid4().hex}"
    first, last = date.fromisoformat(START), date.fromisoformat(END)

    def kept(tables):
        return rg.kept_metrics(
            t.spark, folder, tables, "account_4", KEPT_METRICS, scope("account_4")
        )

    kept(before).refresh(ds.parts_between(first, last, "month"))
    changed = t.reservations.where(late | new)
    touched = ds.touched_days(changed, F.col("created"), F.col("date_cancelled"))
    now = kept(t)
    now.refresh([d for d in (*touched, *RESTATED) if first <= d <= last])
    return now.read(first, last)
