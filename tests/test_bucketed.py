"""The bucketed layout: same rows as the shuffled join, no exchange, hot ids apart."""

import re
import uuid

import pytest
from pyspark.sql import functions as F

from tidecast.operators import joins
from tidecast.sources import bucketed as bk


@pytest.fixture
def names(spark):
    made = {k: f"bucketed_{k}_{uuid.uuid4().hex[:8]}" for k in ("r", "p", "f")}
    yield made
    for name in made.values():
        for table in (name, f"{name}_hot"):
            spark.sql(f"DROP TABLE IF EXISTS {table}")


@pytest.fixture
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k, None) for k in keys}
    for key in keys:
        spark.conf.set(key, "-1")
    yield
    for key, value in before.items():
        spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def three_tables(spark, hot):
    """Reservations with a repeated id, two score tables with repeated ids and NULL scores."""
    ids = spark.range(400).select(F.when(F.col("id") % 3 == 0, hot).otherwise(F.col("id")).alias("id"), F.col("id").alias("row"))
    odd = spark.createDataFrame([(None, -1), (None, -2)], "id long, row long")
    reservations = ids.unionByName(odd)
    preferred = spark.range(900).selectExpr(
        "id % 350 hotelreservation_id", "IF(id % 5 = 0, NULL, (id % 97) / 100D) preferred"
    )
    fallback = spark.range(700).selectExpr(
        "string(id % 290 + 30) hotelreservation_id", "IF(id % 7 = 0, NULL, (id % 89) / 100D) fallback"
    )
    return reservations, preferred, fallback


def expected(reservations, preferred, fallback):
    rows = reservations.select(F.col("id").cast("string").alias("hotelreservation_id"), "row")
    left = preferred.withColumn("hotelreservation_id", F.col("hotelreservation_id").cast("string"))
    return joins.score_fallback_join(rows, left, fallback)


def rows_of(df):
    return sorted((r.row, str(r.hotelreservation_id), r.copies, round(r.kept, 9)) for r in df.collect())


@pytest.mark.parametrize("hot_rows", [1_000_000, 50, 3])
def test_rows_equal_the_shuffled_join(spark, names, hot_rows):
    tables = three_tables(spark, 45)
    made = [
        bk.write_bucketed(df, names[k], c, 8, hot_rows)
        for k, df, c in zip("rpf", tables, ("id", "hotelreservation_id", "hotelreservation_id"), strict=True)
    ]
    assert rows_of(bk.bucketed_score_join(*made)) == rows_of(expected(*tables))
    assert made[0].hot_rows().where("hotelreservation_id = '45'").count() == (0 if hot_rows > 1000 else 134)


def test_no_exchange_below_the_join(spark, names, no_broadcast):
    tables = three_tables(spark, 45)
    made = [
        bk.write_bucketed(df, names[k], c, 8)
        for k, df, c in zip("rpf", tables, ("id", "hotelreservation_id", "hotelreservation_id"), strict=True)
    ]
    main = bk._with_weights(made[0].rows(), made[1].rows(), made[2].rows())
    plan = main._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 2 and "Exchange" not in plan
    # In the whole join no bucketed table goes through an exchange, only the lists of hot ids do.
    lines = bk.bucketed_score_join(*made)._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = [len(re.match(r"[ :|]*(\+- )?", line).group()) for line in lines]
    main_path = [i for i, line in enumerate(lines) if f".{names['r']}[" in line or f"{names['r']}[" in line]
    assert main_path
    above, level = [], depth[main_path[0]]
    for i in range(main_path[0], -1, -1):
        if depth[i] < level:
            level = depth[i]
            above.append(lines[i])
    assert any("SortMergeJoin" in line for line in above) and not any("Exchange" in line for line in above)


def test_tables_of_other_bucket_counts_are_refused(spark):
    one, two = bk.BucketedTable(spark, "a", 8), bk.BucketedTable(spark, "b", 4)
    with pytest.raises(ValueError):
        bk.bucketed_score_join(one, two, two)
