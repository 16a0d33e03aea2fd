"""Physical plans: what reaches the files, what stays in the JVM, what is shuffled."""

import re

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidecast.operators import joins
from tidecast.plans import registry as rg
from tidecast.plans.metric_queries import scope


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


METRIC_QUERIES = [
    "s2_timestamp_date_scan", "f10_campaign_chain", "g3_stats_two_device", "g4_stats_clicklog",
    "g5_stats_preagg", "g6_cancel_attributed", "g10_combined_3", "c1_rolling_folds",
    "k7_closed_form", "c7_cv_scores_closed", "e6_yoy",
]


@pytest.mark.parametrize("name", METRIC_QUERIES)
def test_no_python_and_no_cross_join(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF_DIR))
    for word in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan


def test_filters_and_columns_reach_the_files(spark):
    plan = plan_of(entry.queries()["s2_timestamp_date_scan"](spark, SF_DIR))
    assert "GreaterThanOrEqual(o_orderdate" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_combined_stats_need_one_shuffle_on_the_output_keys(spark, tables):
    table = rg.account("account_4").combined(tables, scope("account_4"), ["yyyy_mm_dd", "pos"])
    plan = plan_of(table)
    assert plan.count("Exchange hashpartitioning(yyyy_mm_dd") == 1
    assert "SortMergeJoin" not in plan and "FullOuter" not in plan


def test_hot_reservation_partition_is_split(spark):
    """With broadcasts off, AQE splits the partition that holds the hot id."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        number = F.col("id")
        rows = spark.range(0, 300_000, 1, 16).select(
            F.when(number % 3 == 0, "hot").otherwise(number.cast("string")).alias(
                "hotelreservation_id"
            ),
            F.md5(number.cast("string")).alias("payload"),
        )
        scores = rows.select("hotelreservation_id", F.lit(0.5).alias("preferred")).distinct()
        none = scores.select("hotelreservation_id", F.lit(0.1).alias("fallback")).limit(10)
        joined = joins.score_fallback_join(rows, scores, none)
        result = joined.groupBy(F.substring("payload", 1, 2)).agg(F.sum("kept"))
        result.collect()
        assert "skew=true" in plan_of(result)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def test_fits_use_their_own_partition_count(spark):
    plan = plan_of(entry.queries()["k1_additive_default"](spark, SF_DIR))
    assert "FlatMapCoGroupsInPandas" in plan
    assert "REPARTITION_BY_NUM" in plan


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", ["c7_cv_scores_closed", "c8_select_model"])
def test_folds_are_fitted_without_joining_days_with_folds(spark, name):
    """Running sums: no join of a series' days with its folds, by range or filtered after."""
    plan = plan_of(entry.queries()[name](spark, SF_DIR))
    joins = re.findall(r"(?:Join|Product)[^\n]*", plan)
    assert joins and not any("train_start_ds" in join or "<=" in join for join in joins)
    # Days meet actual values by series and day, and folds carry their fits.
    assert not re.search(r"Filter [^\n]*train_start_ds", plan)
    assert "fold_id" not in "".join(joins)
