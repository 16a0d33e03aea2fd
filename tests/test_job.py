"""The forecast job from tables to files."""

import json
import os
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tidecast.operators import series as ts
from tidecast.plans import forecast_job as fj
from tidecast.plans import run_job
from tidecast.plans.metric_queries import scope
from tidecast.sources.csv_files import read_daily_prediction, read_runs


def options(**changes):
    base = dict(run_date="2001-12-01", horizon=28, start_date="1995-01-01", n_iter=3)
    return fj.ForecastOptions(**{**base, **changes})


def test_job_with_search(spark, tables, tmp_path):
    result = fj.forecast_account(
        tables, "account_1", ["GrossCommission"], options(cv_size=3, level_shift=True),
        scope("account_1"),
    )
    rows = result.prediction.collect()
    assert len(rows) == 28 and all(r["yhat"] == round(r["yhat"]) for r in rows)
    chosen = result.selection.first()
    assert chosen["model"] == (
        "baseline" if chosen["baseline_smape"] <= chosen["tuned_smape"] else "tuned"
    )
    assert 0 <= chosen["baseline_smape"] <= 50
    assert 2 <= result.weekly.count() <= 4
    assert result.year_over_year().count() <= result.weekly.count()
    parts = result.components.select(
        F.abs(F.col("trend") + F.col("weekly") + F.col("yearly") + F.col("holidays")
              + F.col("regressor") - F.col("yhat")).alias("gap")
    )
    assert parts.agg(F.max("gap")).first()[0] < 1e-6
    result.write_csv(str(tmp_path / "out"))
    back = read_daily_prediction(
        spark, str(tmp_path / "out" / "daily_prediction"),
        "series_id string, ds string, yhat double",
    )
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows))


def test_job_without_search_per_pos(spark, tables):
    result = fj.forecast_account(
        tables, "account_4", ["Cancellations", "RoomNights"],
        options(optimizer="default", per_pos=True), scope("account_4"),
    )
    series = {r["series_id"].split("/")[0] for r in result.prediction.collect()}
    assert series == {"cancellations", "roomnights"}


def test_options_are_checked():
    with pytest.raises(ValueError):
        options(optimizer="grid")
    with pytest.raises(ValueError):
        options(level="quarterly")


def test_external_regressor_must_know_the_future(spark, tables):
    """History days it does not know are not trained on; all days to come are predicted, and
    those that it does not know are marked."""
    days = spark.sql(
        "SELECT explode(sequence(date'1996-01-01', date'2001-12-10')) AS ds"
    ).withColumn("load", F.dayofmonth("ds"))
    result = fj.forecast_account(
        tables, "account_4", ["GrossCommission"], options(optimizer="default", horizon=7),
        scope("account_4"), regressor=days,
    )
    parts = result.components.agg(
        F.min("ds").alias("first"), F.max(F.abs("regressor")).alias("effect")
    ).first()
    assert str(parts["first"]) >= "1996-01-01" and parts["effect"] > 0
    last = result.history.agg(F.max("ds")).first()[0]
    days = sorted(r["ds"] for r in result.prediction.collect())
    assert days == [last + timedelta(days=k) for k in range(1, 8)]
    unknown = result.components.where("NOT regressor_known").agg(F.min("ds")).first()[0]
    assert unknown is None or str(unknown) > "2001-12-10"


def test_short_regressor_keeps_the_horizon(spark, tables):
    series = ts.daily_series(
        spark.sql("SELECT explode(sequence(date'2001-01-01', date'2001-11-04')) AS yyyy_mm_dd, 3.0 AS y"),
        "y",
    )
    one = series.where("ds = date'2001-11-04'").withColumn("series_id", F.lit("OneDay"))
    days = spark.sql(
        "SELECT explode(sequence(date'2001-01-01', date'2001-11-07')) AS ds"
    ).withColumn("load", F.dayofmonth("ds"))
    holidays = spark.createDataFrame(
        [], "ds date, holiday string, lower_window int, upper_window int"
    )
    result = fj.forecast_series(
        series.unionByName(one), holidays, options(optimizer="default", horizon=7), days
    )
    got = result.prediction.collect()
    assert {r["series_id"] for r in got} == {"All", "OneDay"} and len(got) == 14
    assert all(date(2001, 11, 5) <= r["ds"] <= date(2001, 11, 11) for r in got)
    status = {r["series_id"]: r["status"] for r in result.components.select("series_id", "status").distinct().collect()}
    assert status == {"All": "fitted", "OneDay": "constant"}
    assert result.components.where("NOT regressor_known").count() == 8


def test_scope_ends_before_the_run_date(spark, tables):
    result = fj.forecast_account(
        tables, "account_4", ["GrossCommission"],
        options(run_date="2000-07-01", optimizer="default"), scope("account_4"),
    )
    assert str(result.history.agg(F.max("ds")).first()[0]) <= "2000-06-30"
    assert str(result.prediction.agg(F.min("ds")).first()[0]) <= "2000-07-01"


def test_script_starts_from_any_folder(tmp_path):
    import subprocess
    import sys
    from pathlib import Path

    script = Path(run_job.__file__).resolve()
    done = subprocess.run(
        [sys.executable, str(script), "--help"], cwd=tmp_path, capture_output=True, text=True,
        env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"}, timeout=120,
    )
    assert done.returncode == 0 and "--forecast_horizon" in done.stdout


def test_command_line(spark, tables, tmp_path):
    """Account 1 under its own partner id, from parquet files to CSV files."""
    names = {}
    for role in ("account_1_report", "campaigns", "country_campaigns", "holidays"):
        names[role] = str(tmp_path / role)
        rows = tables[role]
        if "yyyy_mm_dd" in rows.columns:  # move the history into the default date range
            rows = rows.withColumn("yyyy_mm_dd", F.add_months("yyyy_mm_dd", 12 * 21))
        rows.write.parquet(names[role])
    (tmp_path / "tables.json").write_text(json.dumps(names))
    args = run_job.arguments().parse_args(
        ["--account", "account_1", "--tables", str(tmp_path / "tables.json"),
         "--out", str(tmp_path / "out"), "--metric_class", "RoomNights", "GrossBookings",
         "--run_date", "2022-06-01", "--forecast_horizon", "14", "--optimizer", "default",
         "--pos", "NATION1", "NATION2"]
    )
    result = run_job.run(spark, args)
    first = sorted(map(tuple, result.prediction.collect()))
    assert len(first) == 28
    # Again, now with a kept summary: built on the first run, read on the next.
    args.kept = str(tmp_path / "kept")
    for touched in (None, ["2021-02-03"]):
        args.touched = touched
        again = run_job.run(spark, args)
        assert sorted(map(tuple, again.prediction.collect())) == first
    lines = spark.read.option("header", True).csv(str(tmp_path / "out" / "daily_prediction"))
    assert lines.columns == ["series_id", "ds", "yhat", "run_date"] and lines.count() == 28
    back = read_runs(spark, str(tmp_path / "out" / "daily_prediction"), "series_id string, ds date, yhat double")
    assert sorted(map(tuple, back.drop("run_date").collect())) == first


def test_transformed_job_predicts_on_the_given_scale(spark):
    rows = spark.sql(
        "SELECT 'a' AS series_id, explode(sequence(date'2001-01-01', date'2001-06-30')) AS ds"
    ).withColumn("y", F.lit(1000.0) + F.weekday("ds"))
    holidays = spark.createDataFrame(
        [], "ds date, holiday string, lower_window int, upper_window int"
    )
    for kind, lam in (("log", None), ("box_cox", 0.5)):
        made = fj.forecast_series(
            rows, holidays,
            options(optimizer="default", horizon=7, transform=kind, box_cox_lambda=lam),
        )
        assert all(990 < r["yhat"] < 1017 for r in made.prediction.collect())
