"""The stand-in views of ``sources/standin.py`` as SQL, for the side-by-side check."""

from __future__ import annotations

import re

VIEWS = {
    "points_of_sale": """
        SELECT n_nationkey AS campaign_id, replace(n_name, '_', '') AS pos FROM nation""",
    "reservations": """
        SELECT CAST(o_orderkey AS VARCHAR) AS id,
               o_orderdate AS created,
               CASE WHEN o_orderpriority IN ('1-URGENT', '5-LOW')
                    THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 30 AS INTEGER)
               END AS date_cancelled,
               CASE WHEN o_orderkey % 101 = 0 THEN NULL
                    WHEN o_orderkey % 97 = 0 THEN 'test'
                    WHEN o_orderstatus = 'P' THEN 'fraudulent'
                    ELSE 'ok' END AS status,
               o_custkey AS affiliate_id,
               CASE WHEN o_orderkey % 3 = 0 THEN 'x-hotel-' || hotel || '_xqdz'
                    WHEN o_orderkey % 4 = 0
                    THEN 'linkmob-core'
                         || ['de', 'fr', 'it', 'es', 'uk'][CAST(o_orderkey % 5 AS INTEGER) + 1]
                         || '-hotel-' || hotel || '_xqdz'
                    WHEN o_orderkey % 4 = 1
                    THEN 'cid-1_cid-' || (o_orderkey % 25) || '_ucc-XX_MapResults-a-b'
                    WHEN o_orderkey % 4 = 2
                    THEN 'ucc-NATION' || (o_orderkey % 25) || '_localuniversal'
               END AS label,
               'nation' || (o_custkey % 30) AS booker_cc1,
               CASE WHEN o_orderkey % 211 <> 0 THEN CAST(o_orderkey % 200 AS INTEGER) END
                   AS hotel_id,
               CAST(o_orderkey % 1000 AS INTEGER) AS hotel_ufi,
               CAST(o_orderkey % 7 + 1 AS INTEGER) AS roomnights,
               CAST(o_totalprice AS DECIMAL(18, 2)) AS commission_amount_euro
        FROM (SELECT *, CASE WHEN o_orderkey % 17 = 0 THEN 'abc'
                             ELSE CAST(o_orderkey % 50 AS VARCHAR) END AS hotel
              FROM orders)""",
    "affiliates": """
        SELECT c_custkey AS id, n_regionkey AS partner_id,
               CASE n_regionkey
                   WHEN 0 THEN 'acct_' || pos || '.' || place || '.' || device
                   WHEN 1 THEN 'acct_' || ['Core', 'core', 'Bob'][CAST(c_custkey % 3 AS INTEGER) + 1]
                               || '.' || pos || '.' || device
                   WHEN 2 THEN pos || '.' || place || '.' || device
                   ELSE 'account_4_' || pos || '.' || place || '.' || device END AS name
        FROM (SELECT c_custkey, n_regionkey, replace(n_name, '_', '') AS pos,
                     ['DMeta', 'Mobile', 'LU', 'MR'][CAST(c_custkey % 4 AS INTEGER) + 1] AS place,
                     ['PC', 'Tablet', 'Mobile'][CAST(c_custkey % 3 AS INTEGER) + 1] AS device
              FROM customer JOIN nation ON c_nationkey = n_nationkey)""",
    "preferred_scores": """
        SELECT o_orderkey AS hotelreservation_id,
               CASE WHEN o_orderkey % 7 <> 0
                    THEN CAST(((o_orderkey + 31 * k) % 100) / 100.0 AS DECIMAL(6, 2))
               END AS prediction,
               CAST(o_orderdate AS DATE) AS created_date
        FROM orders JOIN (VALUES (0), (1)) c(k) ON k = 0 OR o_orderpriority = '2-HIGH'
        WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')""",
    "fallback_scores": """
        SELECT CAST(o_orderkey AS VARCHAR) AS hotelreservation_id,
               CAST(((o_orderkey * 7 + k) % 100) / 100.0 AS DECIMAL(6, 2)) AS nits_score,
               o_orderdate AS row_created_at
        FROM orders JOIN (VALUES (0), (1)) c(k) ON k = 0 OR o_orderpriority = '4-NOT SPECIFIED'
        WHERE o_orderpriority IN ('2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED')""",
    "device_classes": """
        SELECT CAST(o_orderkey AS VARCHAR) AS hotelreservation_id,
               CASE WHEN o_orderpriority <> '1-URGENT' THEN 'tablet'
                    WHEN k = 0 THEN 'phone' ELSE 'desktop' END AS device_class
        FROM orders JOIN (VALUES (0), (1)) c(k) ON k = 0 OR o_orderpriority = '1-URGENT'
        WHERE o_orderpriority <> '3-MEDIUM'""",
    "device_costs": """
        SELECT l_linestatus AS linestatus,
               CASE WHEN l_orderkey % 50 <> 0 THEN CAST(l_partkey % 200 AS INTEGER) END AS hotel_id,
               CAST(l_shipdate AS DATE) AS yyyy_mm_dd,
               ['DE', 'FR', 'IT', 'ES', 'UK', 'US'][CAST(l_suppkey % 6 AS INTEGER) + 1] AS locale,
               1 AS clicks_core,
               CASE WHEN l_returnflag <> 'N' THEN 1 END AS clicks_bob,
               CAST(l_quantity AS DECIMAL(18, 2)) AS cost_core,
               CASE WHEN l_returnflag <> 'A' THEN CAST(l_tax AS DECIMAL(18, 2)) END AS cost_bob
        FROM lineitem""",
    "web_costs": "SELECT * EXCLUDE (linestatus) FROM device_costs WHERE linestatus = 'O'",
    "mobile_costs": "SELECT * EXCLUDE (linestatus) FROM device_costs WHERE linestatus = 'F'",
    "click_log": """
        SELECT CAST(l_shipdate AS DATE) AS date,
               CASE WHEN l_orderkey % 40 <> 0 THEN l_linenumber END AS hour,
               'NATION' || (l_suppkey % 25)
                   || ['DMeta', 'Mobile', 'Search', NULL][l_linenumber % 4 + 1] AS siloname,
               CAST(l_partkey % 200 AS INTEGER) AS partnerpropertyid,
               CAST(l_quantity AS DECIMAL(18, 2)) AS cost_eur,
               l_linenumber AS length_of_stay
        FROM lineitem""",
    "performance": """
        SELECT CAST(l_shipdate AS DATE) AS yyyy_mm_dd,
               CAST(l_partkey % 200 AS INTEGER) AS hotel_id,
               'NATION' || (l_suppkey % 25) AS pos,
               l_linenumber % 4 AS clicks,
               l_linenumber % 3 AS bookings,
               (l_linenumber % 3) * (1 - CAST(l_discount AS DECIMAL(18, 2))) AS nits_bookings,
               CAST(l_extendedprice AS DECIMAL(18, 2)) - CAST(l_quantity AS DECIMAL(18, 2))
                   AS commission_expected_euro,
               CAST(l_extendedprice AS DECIMAL(18, 2)) AS commission_amount_euro,
               CAST(l_quantity AS DECIMAL(18, 2)) AS cost_euro,
               l_linenumber + 1 AS roomnights
        FROM lineitem""",
    "account_1_report": """
        SELECT CAST(o_custkey % 30 AS INTEGER) AS campaign_id,
               CAST(o_orderdate AS DATE) AS yyyy_mm_dd,
               CAST(o_orderkey % 200 AS INTEGER) AS hotel_id,
               1 AS bookings,
               CAST(1 - CAST(o_orderkey % 100 AS DECIMAL(10, 2)) / 100 AS DECIMAL(8, 2))
                   AS nits_bookings,
               CAST(o_totalprice AS DECIMAL(18, 2)) AS commission,
               CAST(o_totalprice AS DECIMAL(18, 2)) - CAST(o_orderkey % 100 AS DECIMAL(10, 0))
                   AS nits_commission,
               CAST(o_orderkey % 7 + 1 AS INTEGER) AS roomnights,
               CAST(o_orderkey % 13 AS DECIMAL(10, 2)) AS cost,
               CAST(o_orderkey % 5 AS INTEGER) AS clicks
        FROM orders""",
    "campaigns": "SELECT campaign_id AS id, pos AS name FROM points_of_sale",
    "country_campaigns": """
        SELECT pos AS cc, CASE WHEN campaign_id > 21 THEN 0 ELSE campaign_id END AS campaign_id
        FROM points_of_sale""",
    "holidays": """
        WITH y AS (
            SELECT campaign_id AS n, pos, unnest(generate_series(1995, 2002)) AS yr
            FROM points_of_sale
        )
        SELECT make_date(yr, 12, 24) AS yyyy_mm_dd, 'ChristmasEve' AS name, lower(pos) AS cc1,
               1 AS level FROM y
        UNION ALL SELECT make_date(yr, 1, 1), 'NewYearsDay', lower(pos), 1 FROM y
        UNION ALL
        SELECT make_date(yr, 11, 1)
               + CAST((4 - isodow(make_date(yr, 11, 1)) + 7) % 7 + 21 AS INTEGER),
               'ThanksgivingDay', lower(pos), 1 FROM y WHERE n < 3
        UNION ALL SELECT make_date(yr, 7, 14), 'SummerDay', lower(pos), 1 FROM y WHERE n % 2 = 0
        UNION ALL SELECT make_date(yr, 5, 9), 'SpringDay', lower(pos), 1 FROM y WHERE n % 4 = 1
        UNION ALL SELECT make_date(yr, 3, 1) + n, 'LocalDay' || n, lower(pos), 1 FROM y
        UNION ALL SELECT make_date(yr, 12, 24), 'FamilyDay', lower(pos), 1 FROM y WHERE n < 3
        UNION ALL SELECT make_date(yr, 6, 21), 'Observance', lower(pos), 2 FROM y""",
}


def with_views(body: str, views: dict[str, str]) -> str:
    """Put the views a query needs in front of it, each after those it builds on.

    ``body`` may start with its own ``WITH`` list.
    """
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, definition in views.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(definition)
                if name not in needed:
                    needed.append(name)

    visit(body)
    body = body.strip()
    if not needed:
        return body
    # Views that several others read are computed once.
    read = {name: sum(bool(re.search(rf"\b{name}\b", views[other])) for other in needed) for name in needed}
    once = {name: " MATERIALIZED" if read[name] > 1 else "" for name in needed}
    head = ",\n".join(f"{name} AS{once[name]} ({views[name]})" for name in needed)
    if body.upper().startswith("WITH "):
        return f"WITH {head},\n{body[5:]}"
    return f"WITH {head}\n{body}"
