"""Input tables of the accounts, derived from the given tables.

The given tables hold orders, line items and customers; the accounts read reservations,
affiliates, scores, click costs and a holiday calendar. Each view below derives one of
these, row by row, so that it grows with the tables. ``plans/standin_sql.py`` has the same
views in SQL.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from tidecast.session import cut_lineage

# Partner ids in the stand-in affiliates are region keys.
STANDIN_PARTNERS = {"account_1": 0, "account_2": 1, "account_3": 2, "account_4": 3}
START, END = "1995-01-01", "2001-12-31"
MAX_RPB = 400000.0
HOLIDAY_YEARS = (1995, 2002)

# Known schemas, so that opening a table needs no job to look into its files.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,"
    " c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}

ROLES = [
    "reservations",
    "affiliates",
    "preferred_scores",
    "fallback_scores",
    "device_classes",
    "web_costs",
    "mobile_costs",
    "click_log",
    "performance",
    "account_1_report",
    "campaigns",
    "country_campaigns",
    "holidays",
]


class Tables(Mapping):
    """The given tables under one folder, and the views over them by role name."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.settled: dict[str, DataFrame] = {}

    def settle(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A result several parts of one query read: built and checkpointed once."""
        if name not in self.settled:
            self.settled[name] = cut_lineage(build())
        return self.settled[name]

    def read(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.sf_dir}/{name}.parquet")

    def __getitem__(self, role: str) -> DataFrame:
        if role not in ROLES:
            raise KeyError(role)
        return getattr(self, role)

    def __iter__(self):
        return iter(ROLES)

    def __len__(self) -> int:
        return len(ROLES)

    @cached_property
    def points_of_sale(self) -> DataFrame:
        return self.read("nation").selectExpr(
            "n_nationkey AS campaign_id", "replace(n_name, '_', '') AS pos"
        )

    @cached_property
    def reservations(self) -> DataFrame:
        hotel = "CASE WHEN o_orderkey % 17 = 0 THEN 'abc' ELSE string(o_orderkey % 50) END"
        locale = "array('de', 'fr', 'it', 'es', 'uk')[int(o_orderkey % 5)]"
        nation = "o_orderkey % 25"
        return self.read("orders").selectExpr(
            "string(o_orderkey) AS id",
            "o_orderdate AS created",
            "CASE WHEN o_orderpriority IN ('1-URGENT', '5-LOW')"
            " THEN date_add(date(o_orderdate), int(o_orderkey % 30)) END AS date_cancelled",
            "CASE WHEN o_orderkey % 101 = 0 THEN NULL WHEN o_orderkey % 97 = 0 THEN 'test'"
            " WHEN o_orderstatus = 'P' THEN 'fraudulent' ELSE 'ok' END AS status",
            "o_custkey AS affiliate_id",
            f"CASE WHEN o_orderkey % 3 = 0 THEN concat('x-hotel-', {hotel}, '_xqdz')"
            f" WHEN o_orderkey % 4 = 0"
            f" THEN concat('linkmob-core', {locale}, '-hotel-', {hotel}, '_xqdz')"
            f" WHEN o_orderkey % 4 = 1"
            f" THEN concat('cid-1_cid-', {nation}, '_ucc-XX_MapResults-a-b')"
            f" WHEN o_orderkey % 4 = 2 THEN concat('ucc-NATION', {nation}, '_localuniversal')"
            " END AS label",
            "concat('nation', o_custkey % 30) AS booker_cc1",
            "CASE WHEN o_orderkey % 211 <> 0 THEN int(o_orderkey % 200) END AS hotel_id",
            "int(o_orderkey % 1000) AS hotel_ufi",
            "int(o_orderkey % 7 + 1) AS roomnights",
            "o_totalprice AS commission_amount_euro",
        )

    @cached_property
    def affiliates(self) -> DataFrame:
        place = "array('DMeta', 'Mobile', 'LU', 'MR')[int(c_custkey % 4)]"
        device = "array('PC', 'Tablet', 'Mobile')[int(c_custkey % 3)]"
        core = "array('Core', 'core', 'Bob')[int(c_custkey % 3)]"
        nations = self.read("nation").withColumnRenamed("n_nationkey", "c_nationkey")
        return (
            self.read("customer")
            .join(nations, "c_nationkey")
            .selectExpr("c_custkey", "n_regionkey", "replace(n_name, '_', '') AS pos")
            .selectExpr(
                "c_custkey AS id",
                "n_regionkey AS partner_id",
                f"CASE n_regionkey WHEN 0 THEN concat('acct_', pos, '.', {place}, '.', {device})"
                f" WHEN 1 THEN concat('acct_', {core}, '.', pos, '.', {device})"
                f" WHEN 2 THEN concat(pos, '.', {place}, '.', {device})"
                f" ELSE concat('account_4_', pos, '.', {place}, '.', {device}) END AS name",
            )
        )

    def _scored_orders(self, priorities: str, twice: str) -> DataFrame:
        """Orders of some priorities, those of one priority twice (``copy`` 0 and 1)."""
        return (
            self.read("orders")
            .where(f"o_orderpriority IN ({priorities})")
            .selectExpr(
                "o_orderkey",
                "o_orderdate",
                f"explode(sequence(0, int(o_orderpriority = '{twice}'))) AS copy",
            )
        )

    @cached_property
    def preferred_scores(self) -> DataFrame:
        """Some reservations, '2-HIGH' ones twice, some without a prediction."""
        rows = self._scored_orders("'1-URGENT', '2-HIGH', '3-MEDIUM'", "2-HIGH")
        return rows.selectExpr(
            "o_orderkey AS hotelreservation_id",
            "CASE WHEN o_orderkey % 7 <> 0 THEN ((o_orderkey + 31 * copy) % 100) / 100D END"
            " AS prediction",
            "date(o_orderdate) AS created_date",
        )

    @cached_property
    def fallback_scores(self) -> DataFrame:
        """Other reservations, '4-NOT SPECIFIED' ones twice."""
        rows = self._scored_orders("'2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED'", "4-NOT SPECIFIED")
        return rows.selectExpr(
            "string(o_orderkey) AS hotelreservation_id",
            "((o_orderkey * 7 + copy) % 100) / 100D AS nits_score",
            "o_orderdate AS row_created_at",
        )

    @cached_property
    def device_classes(self) -> DataFrame:
        """Device class of most reservations, '1-URGENT' ones twice."""
        return (
            self.read("orders")
            .where("o_orderpriority <> '3-MEDIUM'")
            .selectExpr(
                "string(o_orderkey) AS hotelreservation_id",
                "explode(CASE WHEN o_orderpriority = '1-URGENT' THEN array('phone', 'desktop')"
                " ELSE array('tablet') END) AS device_class",
            )
        )

    def _device_costs(self, linestatus: str) -> DataFrame:
        return (
            self.read("lineitem")
            .where(f"l_linestatus = '{linestatus}'")
            .selectExpr(
                "CASE WHEN l_orderkey % 50 <> 0 THEN int(l_partkey % 200) END AS hotel_id",
                "date(l_shipdate) AS yyyy_mm_dd",
                "array('DE', 'FR', 'IT', 'ES', 'UK', 'US')[int(l_suppkey % 6)] AS locale",
                "1 AS clicks_core",
                "CASE WHEN l_returnflag <> 'N' THEN 1 END AS clicks_bob",
                "l_quantity AS cost_core",
                "CASE WHEN l_returnflag <> 'A' THEN l_tax END AS cost_bob",
            )
        )

    @cached_property
    def web_costs(self) -> DataFrame:
        return self._device_costs("O")

    @cached_property
    def mobile_costs(self) -> DataFrame:
        return self._device_costs("F")

    @cached_property
    def click_log(self) -> DataFrame:
        silo = "array('DMeta', 'Mobile', 'Search', NULL)[l_linenumber % 4]"
        return self.read("lineitem").selectExpr(
            "date(l_shipdate) AS date",
            "CASE WHEN l_orderkey % 40 <> 0 THEN l_linenumber END AS hour",
            f"concat('NATION', l_suppkey % 25, {silo}) AS siloname",
            "int(l_partkey % 200) AS partnerpropertyid",
            "l_quantity AS cost_eur",
            "l_linenumber AS length_of_stay",
        )

    @cached_property
    def performance(self) -> DataFrame:
        return self.read("lineitem").selectExpr(
            "date(l_shipdate) AS yyyy_mm_dd",
            "int(l_partkey % 200) AS hotel_id",
            "concat('NATION', l_suppkey % 25) AS pos",
            "l_linenumber % 4 AS clicks",
            "l_linenumber % 3 AS bookings",
            "(l_linenumber % 3) * (1 - l_discount) AS nits_bookings",
            "l_extendedprice - l_quantity AS commission_expected_euro",
            "l_extendedprice AS commission_amount_euro",
            "l_quantity AS cost_euro",
            "l_linenumber + 1 AS roomnights",
        )

    @cached_property
    def account_1_report(self) -> DataFrame:
        """Booking summary with costs, at campaign, hotel and day."""
        return self.read("orders").selectExpr(
            "int(o_custkey % 30) AS campaign_id",
            "date(o_orderdate) AS yyyy_mm_dd",
            "int(o_orderkey % 200) AS hotel_id",
            "1 AS bookings",
            "1 - (o_orderkey % 100) / 100D AS nits_bookings",
            "o_totalprice AS commission",
            "o_totalprice - o_orderkey % 100 AS nits_commission",
            "int(o_orderkey % 7 + 1) AS roomnights",
            "double(o_orderkey % 13) AS cost",
            "int(o_orderkey % 5) AS clicks",
        )

    @cached_property
    def campaigns(self) -> DataFrame:
        return self.points_of_sale.selectExpr("campaign_id AS id", "pos AS name")

    @cached_property
    def country_campaigns(self) -> DataFrame:
        """Country to campaign; the last three countries share the first campaign."""
        return self.points_of_sale.selectExpr(
            "pos AS cc", "CASE WHEN campaign_id > 21 THEN 0 ELSE campaign_id END AS campaign_id"
        )

    @cached_property
    def holidays(self) -> DataFrame:
        """Calendar of every point of sale: common, shared, single and minor holidays."""
        first, last = HOLIDAY_YEARS
        thanksgiving = "date_add(next_day(date_sub(make_date(yr, 11, 1), 1), 'THU'), 21)"
        entries = [
            ("'ChristmasEve'", "make_date(yr, 12, 24)", 1, "true"),
            ("'NewYearsDay'", "make_date(yr, 1, 1)", 1, "true"),
            ("'ThanksgivingDay'", thanksgiving, 1, "campaign_id < 3"),
            ("'SummerDay'", "make_date(yr, 7, 14)", 1, "campaign_id % 2 = 0"),
            ("'SpringDay'", "make_date(yr, 5, 9)", 1, "campaign_id % 4 = 1"),
            ("concat('LocalDay', campaign_id)", "date_add(make_date(yr, 3, 1), campaign_id)", 1,
             "true"),
            # falls on the same day as another
            ("'FamilyDay'", "make_date(yr, 12, 24)", 1, "campaign_id < 3"),
            ("'Observance'", "make_date(yr, 6, 21)", 2, "true"),
        ]
        structs = ", ".join(
            f"named_struct('name', {name}, 'day', {day}, 'level', {level}, 'kept', {kept})"
            for name, day, level, kept in entries
        )
        return (
            self.points_of_sale.selectExpr(
                "campaign_id", "pos", f"explode(sequence({first}, {last})) AS yr"
            )
            .selectExpr("pos", f"inline(array({structs}))")
            .where("kept")
            .selectExpr("day AS yyyy_mm_dd", "name", "lower(pos) AS cc1", "level")
        )
