"""Joins and metric tables against brute force on small hand-made rows."""

from datetime import date
from itertools import product

import pytest
from pyspark.sql import functions as F

from tidecast.operators import joins
from tidecast.operators import metrics as mt
from tidecast.plans import registry as rg
from tidecast.sources import scans


def test_repeated_scores_are_counted_like_a_row_multiplying_join(spark):
    preferred = [("a", 0.5), ("a", None), ("a", 0.25), ("b", None), (None, 0.9), ("z", 0.1)]
    fallback = [("a", 0.1), ("a", 0.3), ("b", 0.4), ("c", None), ("c", 0.2), (None, 0.7)]
    ids = ["a", "b", "c", "d", None, "a"]
    expected = []
    for i in ids:
        p = [s for k, s in preferred if k == i and i is not None] or [None]
        f = [s for k, s in fallback if k == i and i is not None] or [None]
        pairs = list(product(p, f))
        kept = sum(1 - (x if x is not None else y if y is not None else 0) for x, y in pairs)
        expected.append((i, len(pairs), round(kept, 9)))
    joined = joins.score_fallback_join(
        spark.createDataFrame([(i,) for i in ids], "hotelreservation_id string"),
        spark.createDataFrame(preferred, "hotelreservation_id string, preferred double"),
        spark.createDataFrame(fallback, "hotelreservation_id string, fallback double"),
    )
    got = [(r[0], r["copies"], round(r["kept"], 9)) for r in joined.collect()]
    key = lambda r: (r[0] or "", r[1], r[2])
    assert sorted(got, key=key) == sorted(expected, key=key)


def test_one_reservation_with_a_third_of_all_rows(spark):
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias(
            "hotelreservation_id"
        )
    )
    scores = rows.select("hotelreservation_id", F.lit(0.5).alias("preferred"))
    none = spark.createDataFrame([], "hotelreservation_id string, fallback double")
    total = joins.score_fallback_join(rows, scores, none).agg(
        F.sum("copies").alias("copies"), F.sum("kept").alias("kept")
    ).first()
    assert total["copies"] == 10_000 * 10_000 + 20_000
    assert total["kept"] == total["copies"] / 2


def test_existence_join_counts_repeated_lookup_rows(spark):
    rows = spark.createDataFrame([("a", 2), ("b", 3), (None, 5)], "hotelreservation_id string, n int")
    lookup = spark.createDataFrame([("a",), ("a",), (None,)], "hotelreservation_id string")
    got = joins.inner_join_counted(rows, lookup).collect()
    assert [(r["hotelreservation_id"], r["n"], r["copies"]) for r in got] == [("a", 2, 2)]


DAY = date(2020, 1, 1)
STAT = "yyyy_mm_dd date, pos string, bookings int, commission double, cost double, clicks int, \
roomnights int, nits_bookings double, nits_commission double"
CANCEL = "yyyy_mm_dd date, pos string, cancellations int, cancelled_commission double, \
cancelled_roomnights int"


@pytest.fixture
def facts(spark):
    stats = [
        (DAY, "A", 1, 10.0, None, None, 2, 0.5, 5.0),
        (DAY, "A", None, None, 3.0, 4, None, None, None),
        (DAY, "B", 1, 7.0, 1.0, 1, 1, 1.0, 7.0),
        (DAY, None, 1, 9.0, 1.0, 1, 1, 1.0, 9.0),
    ]
    cancels = [(DAY, "A", 1, 4.0, 1), (DAY, "C", 1, 6.0, 2), (DAY, None, 1, 2.0, 1)]
    return spark.createDataFrame(stats, STAT), spark.createDataFrame(cancels, CANCEL)


def test_as_booked_is_zero_where_one_side_is_missing(facts):
    table = mt.combined_stats(*facts, ["yyyy_mm_dd", "pos"]).collect()
    got = {(r["pos"], r["gross_commission"]): r["asbooked_commission"] for r in table}
    assert got == {("A", 10.0): 6.0, ("B", 7.0): 0.0, ("C", 0.0): 0.0, (None, 9.0): 0.0,
                   (None, 0.0): 0.0}


def test_fill_first_counts_the_missing_side_as_zero(facts):
    table = mt.combined_stats(*facts, ["yyyy_mm_dd", "pos"], fill_first=True).collect()
    got = {(r["pos"], r["gross_commission"]): r["asbooked_commission"] for r in table}
    assert got == {("A", 10.0): 6.0, ("B", 7.0): 7.0, ("C", 0.0): -6.0, (None, 9.0): 9.0,
                   (None, 0.0): -2.0}


def test_combined_equals_an_outer_join_of_both_summaries(facts):
    keys = ["yyyy_mm_dd", "pos"]
    stats, cancels = facts
    summary = mt.stats_summary(stats, keys)
    joined = summary.join(mt.cancellation_summary(cancels, keys), keys, "outer")
    union = mt.combined_stats(stats, cancels, keys)
    shared = [c for c in joined.columns if c not in keys]
    left = joined.na.fill(0, subset=shared).select(*keys, *shared)
    assert sorted(map(str, left.collect())) == sorted(
        map(str, union.select(*keys, *shared).collect())
    )


def test_profit_is_null_without_cost(spark, facts):
    no_cost = facts[0].where("cost is null")
    assert mt.stats_summary(no_cost, ["pos"]).first()["gross_profit"] is None


def test_status_filter_drops_null_and_bad(spark):
    df = spark.createDataFrame([("ok",), (None,), ("test",), ("unknown",)], "status string")
    assert [r[0] for r in scans.good_status(df).collect()] == ["ok"]


def test_value_cap_bounds(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,)], "v double")
    assert scans.value_cap(df, "v", 2.0).count() == 2
    assert scans.value_cap(df, "v", 2.0, inclusive=False).count() == 1


def test_pos_filter_accepts_scalar_list_and_all(spark):
    df = spark.createDataFrame([("A",), ("B",)], "pos string")
    assert scans.keep_pos(df, "All").count() == 2
    assert scans.keep_pos(df, ["All"]).count() == 2
    assert scans.keep_pos(df, "A").count() == 1
    assert scans.keep_pos(df, ["A", "B"]).count() == 2


def test_dimensions_are_broadcast_by_their_bytes_only(spark):
    dim = spark.range(100).withColumnRenamed("id", "k")
    facts = spark.range(1000).withColumnRenamed("id", "k")
    assert "BroadcastHashJoin" in joins.dimension_join(facts, dim, "k")._jdf.queryExecution().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = joins.dimension_join(facts, dim, "k")
        assert "BroadcastHashJoin" not in joined._jdf.queryExecution().toString()
        assert joined.count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_building_a_metric_query_runs_no_job(spark, tables):
    from tidecast.plans.metric_queries import scope

    spark.sparkContext.setJobGroup("building", "no job may run")
    try:
        for name in rg.ACCOUNTS:
            rg.account(name).combined(tables, scope(name), ["yyyy_mm_dd", "pos"])
        assert not list(spark.sparkContext.statusTracker().getJobIdsForGroup("building"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_registry_knows_accounts_and_metrics():
    assert rg.metric_source("GrossBookings") == rg.metric_source("gross_bookings")
    assert rg.metric_source("Cancellations")[0] == "cancellations"
    with pytest.raises(ValueError):
        rg.metric_source("Nothing")
    with pytest.raises(ValueError):
        rg.account("account_9")
