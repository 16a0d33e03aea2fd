"""Command line for the forecast job.

    spark-submit run_job.py --account account_3 --tables tables.json --out /shared/out

``tables.json`` maps table roles (see ``registry.py``) to table names, or to parquet paths
when the value contains a slash.
"""

from __future__ import annotations

import argparse
import json
import sys
from datetime import date, timedelta
from pathlib import Path

# A script is started without its package; the session helper then sends it to executors.
sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from tidecast.operators import folds as fd  # noqa: E402
from tidecast.operators import scoring as sc  # noqa: E402
from tidecast.operators.daily_summary import DailySummary  # noqa: E402
from tidecast.plans import forecast_job as fj  # noqa: E402
from tidecast.plans import registry as rg  # noqa: E402
from tidecast.session import get_session  # noqa: E402


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(description="Forecast daily metrics of one account.")
    parser.add_argument("--account", required=True, choices=sorted(rg.ACCOUNTS))
    parser.add_argument("--tables", required=True, help="JSON file: table role to table")
    parser.add_argument("--out", required=True, help="folder for the CSV files")
    parser.add_argument("--metric_class", nargs="+", default=["GrossBookings"])
    parser.add_argument("--run_date", default=str(date.today()))
    parser.add_argument("--forecast_horizon", type=int, default=fj.DEFAULT_HORIZON)
    parser.add_argument("--optimizer", default="random_search", choices=fj.OPTIMIZERS)
    parser.add_argument("--eval_level", default="daily", choices=sc.LEVELS)
    parser.add_argument("--cv_type", default="rolling_window", choices=fd.CV_TYPES)
    parser.add_argument("--pos", nargs="+", default=["All"])
    parser.add_argument("--per_pos", action="store_true", help="one series per point of sale")
    parser.add_argument("--kept", help="folder of the kept summary; built on the first run")
    parser.add_argument(
        "--touched", nargs="*", default=None,
        help="days to build again; without it all days that the kept summary lacks",
    )
    parser.add_argument("--level_shift", action="store_true", help="add the year-end regressor")
    return parser


def open_tables(spark: SparkSession, names: dict[str, str]) -> dict[str, DataFrame]:
    return {
        role: spark.read.parquet(name) if "/" in name else spark.table(name)
        for role, name in names.items()
    }


def kept_history(
    spark: SparkSession, args: argparse.Namespace, tables: dict, options: fj.ForecastOptions
) -> DailySummary:
    """The kept summary of the asked metrics, with missing and touched days built."""
    first = date.fromisoformat(options.start_date)
    last = date.fromisoformat(options.run_date) - timedelta(days=1)
    scope = rg.Scope(str(first), str(last), pos=args.pos)
    folder = f"{args.kept.rstrip('/')}/{args.account}"
    kept = rg.kept_metrics(spark, folder, tables, args.account, args.metric_class, scope)
    days = {date.fromisoformat(day) for day in args.touched or ()}
    # The part of the last day goes on until its month is over.
    kept.refresh(days | set(kept.missing(first, last)) | {last})
    return kept


def run(spark: SparkSession, args: argparse.Namespace) -> fj.ForecastResult:
    with open(args.tables) as file:
        tables = open_tables(spark, json.load(file))
    options = fj.ForecastOptions(
        run_date=args.run_date,
        horizon=args.forecast_horizon,
        optimizer=args.optimizer,
        level=args.eval_level,
        cv_type=args.cv_type,
        level_shift=args.level_shift,
        per_pos=args.per_pos,
    )
    kept = None
    if args.kept:
        kept = kept_history(spark, args, tables, options)
    result = fj.forecast_account(
        tables, args.account, args.metric_class, options, pos=args.pos, kept=kept
    )
    result.write_run(args.out, args.run_date)
    return result


if __name__ == "__main__":
    run(get_session("daily-metrics"), arguments().parse_args())
