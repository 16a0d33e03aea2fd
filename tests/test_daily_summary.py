"""Kept summaries and output that can be written again."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tidecast.operators import daily_summary as ds
from tidecast.plans import registry as rg
from tidecast.plans.forecast_job import ForecastOptions, forecast_account
from tidecast.plans.metric_queries import scope
from tidecast.sources import parted_output as po

METRICS = ["GrossCommission", "Cancellations", "CancelledRoomNights"]
FIRST, LAST = date(1996, 1, 1), date(1996, 6, 30)


def days(first, last):
    return [first + timedelta(days=k) for k in range((last - first).days + 1)]


def rows_of(df):
    return sorted((r.yyyy_mm_dd, r.pos, r.series_id, round(r.value, 4)) for r in df.collect())


def test_neighbouring_days_are_one_range():
    d = date(2020, 2, 27)
    found = ds.day_ranges([d + timedelta(days=k) for k in (2, 0, 1, 7, 9, 9, 10)])
    assert [(a.day, b.day) for a, b in found] == [(27, 29), (5, 5), (7, 8)]
    assert ds.day_ranges([]) == []
    assert ds.part_end(date(2020, 2, 1), "month") == date(2020, 2, 29)
    assert len(ds.parts_between(date(2019, 12, 31), date(2020, 2, 1), "month")) == 3


@pytest.mark.parametrize("grain", ds.GRAINS)
def test_append_restate_and_late_cancellation_equal_a_full_build(spark, tables, tmp_path, grain):
    last = LAST if grain == "month" else date(1996, 1, 31)
    own = scope("account_4")
    now = dict(tables)
    late = F.col("created").between(F.lit(FIRST), F.lit(last)) & (F.abs(F.hash("id")) % 9 == 0)
    gone = F.col("created") >= F.lit(last - timedelta(days=2))
    restated = F.col("yyyy_mm_dd") == F.lit(FIRST + timedelta(days=11))
    before = {
        **now,
        "reservations": tables.reservations.where(~gone).withColumn(
            "date_cancelled", F.when(late, None).otherwise(F.col("date_cancelled"))
        ),
        "performance": tables.performance.where(
            F.col("yyyy_mm_dd") < F.lit(last - timedelta(days=2))
        ).withColumn("commission_amount_euro", F.when(restated, 1.0).otherwise(F.col("commission_amount_euro"))),
    }
    build = lambda t: rg.kept_metrics(spark, str(tmp_path), t, "account_4", METRICS, own, grain)
    build(before).refresh(days(FIRST, last))
    changed = tables.reservations.where(late | gone)
    touched = [d for d in ds.touched_days(changed, F.col("created"), F.col("date_cancelled")) if FIRST <= d <= last]
    touched += [FIRST + timedelta(days=11), *days(last - timedelta(days=2), last)]
    kept = build(now)
    assert rows_of(kept.read(FIRST, last)) != rows_of(rg.metrics_long(now, "account_4", METRICS, rg.replace(own, start=str(FIRST), end=str(last))))
    kept.refresh(touched)
    for start, end in ((FIRST, last), (FIRST + timedelta(days=3), FIRST + timedelta(days=20))):
        want = rg.metrics_long(now, "account_4", METRICS, rg.replace(own, start=str(start), end=str(end)))
        assert rows_of(kept.read(start, end, check=True)) == rows_of(want)
    # Again, and nothing: one copy.
    n = kept.read(FIRST, last).count()
    kept.refresh(touched[:1])
    assert kept.refresh([]) is None and kept.read(FIRST, last).count() == n


def test_untouched_parts_are_neither_read_nor_written(spark, tmp_path):
    facts = str(tmp_path / "facts")
    every = days(date(2020, 1, 1), date(2020, 1, 20))
    rows = [(d, "p", float(k)) for k, d in enumerate(every)]
    spark.createDataFrame(rows, "yyyy_mm_dd date, pos string, value double").write.partitionBy("yyyy_mm_dd").parquet(facts)
    asked = []

    def build(start, end):
        part = spark.read.schema("pos string, value double, yyyy_mm_dd date").parquet(facts).where(
            F.col("yyyy_mm_dd").between(F.lit(start), F.lit(end))
        )
        asked.append(part)
        return part.select("yyyy_mm_dd", "pos", F.lit("m").alias("series_id"), "value")

    kept = ds.DailySummary(spark, str(tmp_path / "kept"), build, rg.METRIC_SCHEMA, ["value"])
    kept.refresh(every)
    old = {p: p.stat().st_mtime_ns for p in (tmp_path / "kept").rglob("*.parquet")}
    asked.clear()
    kept.refresh([every[4], every[5], every[12]])
    assert len(asked) == 2
    for part in asked:
        plan = part._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(yyyy_mm_dd" in plan and "PushedFilters: []" in plan
        assert set(r[0] for r in part.select(F.to_date("yyyy_mm_dd")).collect()) <= {every[4], every[5], every[12]}
    new = {p: p.stat().st_mtime_ns for p in (tmp_path / "kept").rglob("*.parquet")}
    kept_files = [p for p in old if p in new and old[p] == new[p] and "_manifest" not in str(p)]
    assert len(kept_files) == 17
    plan = kept.read(every[2], every[3])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part_day" in plan


def test_a_day_that_lost_its_rows_is_empty(spark, tmp_path):
    source = {date(2020, 1, 1): 3, date(2020, 1, 2): 2}

    def build(start, end):
        rows = [(d, "p", "m", 1.0) for d, n in source.items() if start <= d <= end for _ in range(n)]
        return spark.createDataFrame(rows, "yyyy_mm_dd date, pos string, series_id string, value double")

    kept = ds.DailySummary(spark, str(tmp_path), build, rg.METRIC_SCHEMA, ["value"])
    with pytest.raises(Exception, match="_manifest|PATH_NOT_FOUND"):
        kept.read(*source).count()
    kept.refresh(source)
    assert kept.read(*source, check=True).count() == 5
    source[date(2020, 1, 2)] = 0
    kept.refresh([date(2020, 1, 2)])
    assert kept.read(*source, check=True).count() == 3
    with pytest.raises(po.IncompleteOutput, match="2 of 3 parts"):
        kept.read(date(2020, 1, 1), date(2020, 1, 3))


def test_reader_refuses_what_the_manifest_does_not_cover(spark, tmp_path):
    folder, schema = str(tmp_path), "series_id string, yhat double"
    rows = spark.range(100).selectExpr("string(id % 3) series_id", "id / 7 yhat")

    def write(day, df):
        named = df.withColumn("run_date", F.lit(day))
        po.write_parts(named, folder, "run_date", sums=["yhat"], kind="csv", header="true")

    def read():
        return po.read_parts(spark, folder, "run_date", schema, kind="csv", header="true")

    one, two = date(2020, 1, 1), date(2020, 1, 2)
    write(one, rows)
    write(two, rows.limit(40))
    write(one, rows)
    assert sorted(r["count"] for r in read().groupBy("run_date").count().collect()) == [40, 100]
    assert read().agg(F.sum("yhat")).first()[0] == pytest.approx(sum(k / 7 for k in range(100)) + sum(r.yhat for r in rows.limit(40).collect()))
    lost = next((tmp_path / "run_date=2020-01-02").glob("part-*.csv"))
    kept = lost.read_text()
    lost.unlink()
    with pytest.raises(po.IncompleteOutput, match="2020-01-02"):
        read()
    lost.write_text(kept.replace("0.0", "5.0", 1))
    (lost.parent / f".{lost.name}.crc").unlink(missing_ok=True)
    with pytest.raises(po.IncompleteOutput, match="2020-01-02: other sums"):
        read()
    lost.write_text(kept)
    assert read().count() == 140
    spare = tmp_path / "run_date=2020-01-03"
    spare.mkdir()
    (spare / "part-x.csv").write_text("series_id,yhat\na,1.0\n")
    with pytest.raises(po.IncompleteOutput, match="2020-01-03: not in the manifest"):
        read()


def test_job_reads_the_kept_summary_alone(spark, tables, tmp_path):
    own = rg.replace(scope("account_4"), start="1996-01-01", end="1998-06-30")
    options = ForecastOptions(run_date="1998-07-01", horizon=20, start_date="1996-01-01", optimizer="default")
    want = forecast_account(tables, "account_4", ["GrossCommission"], options, own).prediction
    kept = rg.kept_metrics(spark, str(tmp_path), tables, "account_4", ["GrossCommission"], own)
    kept.refresh(days(date(1996, 1, 1), date(1998, 6, 30)))

    class Rest(dict):
        """Only what the calendar and the points of sale need."""

        def __missing__(self, role):
            assert role not in ("performance", "reservations"), role
            return tables[role]

    got = forecast_account(Rest(), "account_4", ["GrossCommission"], options, own, kept=kept).prediction
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
