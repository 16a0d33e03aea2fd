"""Registered queries for series, holidays, folds, scores, closed forecasts and reports."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidecast.functions import numbers as nm
from tidecast.operators import bands as bd
from tidecast.operators import folds as fd
from tidecast.operators import forecast_closed as fc
from tidecast.operators import holidays as hol
from tidecast.operators import params as pm
from tidecast.operators import reports as rp
from tidecast.operators import scoring as sc
from tidecast.operators import series as ts
from tidecast.operators import tuning as tn
from tidecast.plans import registry as rg
from tidecast.plans.catalog import SQL_VIEWS, query
from tidecast.plans.metric_queries import scope
from tidecast.session import shared_folder
from tidecast.sources import csv_files, scans
from tidecast.sources.standin import END, START, Tables

HORIZON = 91
ORIGIN = START
METRIC = "gross_commission"
ROUND = 2  # digits both engines agree on after different orders of summation


def metric_daily(t: Tables):
    """The metric table. Series, ranks and holidays of one query all start from it, so the
    big tables behind it are read once."""
    return t.settle(
        "metric", lambda: rg.metric_values(t, "account_4", METRIC, scope("account_4"))
    )


def series_all(t: Tables):
    return ts.daily_series(metric_daily(t), METRIC)


def series_pos(t: Tables):
    return ts.daily_series(metric_daily(t), METRIC, F.col("pos"))


def pos_ranks(t: Tables):
    return ts.average_rank(ts.trailing_pos_totals(metric_daily(t), METRIC, END))


def ranked_holidays(t: Tables):
    calendar = scans.holiday_calendar(t.holidays, START)
    return hol.ranked_holidays(calendar, t.points_of_sale, pos_ranks(t))


def job_holidays(t: Tables):
    return hol.with_windows(hol.select_holidays(ranked_holidays(t)))


def rounded(df, *columns: str, digits: int = ROUND):
    return df.withColumns({c: F.round(c, digits) for c in columns})


def index_sql(source: str) -> str:
    return f"""
        SELECT series_id, ds, y,
               row_number() OVER (PARTITION BY series_id ORDER BY ds) - 1 AS rn,
               count(*) OVER (PARTITION BY series_id) AS n FROM {source}"""


def folds_sql(source: str, rolling: bool) -> str:
    start = f"cutoff - {fd.TRAIN_LENGTH}" if rolling else "0"
    return f"""
        SELECT series_id, row_number() OVER (PARTITION BY series_id ORDER BY cutoff) - 1 AS fold_id,
               {start} AS train_start, cutoff
        FROM (SELECT series_id, unnest(range(n - {HORIZON}, {fd.TRAIN_LENGTH}, -{HORIZON}))
                     AS cutoff
              FROM (SELECT series_id, count(*) AS n FROM {source} GROUP BY series_id))"""


SQL_VIEWS.update(
    {
        "metric_daily": "SELECT yyyy_mm_dd, pos, sum(commission) AS gross_commission"
        " FROM perf_4 GROUP BY ALL",
        "series_all": "SELECT 'All' AS series_id, yyyy_mm_dd AS ds,"
        " CAST(sum(gross_commission) AS DOUBLE) AS y FROM metric_daily GROUP BY ALL",
        "series_pos": "SELECT pos AS series_id, yyyy_mm_dd AS ds,"
        " CAST(sum(gross_commission) AS DOUBLE) AS y FROM metric_daily GROUP BY ALL",
        "pos_totals": f"SELECT pos, sum(gross_commission) AS total FROM metric_daily"
        f" WHERE yyyy_mm_dd >= DATE '{END}' - 365 GROUP BY pos",
        "pos_ranks": "SELECT pos, rank() OVER (ORDER BY total DESC)"
        " + (count(*) OVER (PARTITION BY total) - 1) / 2.0 AS pos_rank FROM pos_totals",
        "ranked_holidays": f"""
            SELECT yyyy_mm_dd AS ds, name AS holiday, p.pos, pos_rank
            FROM holidays JOIN points_of_sale p ON upper(cc1) = p.pos
            JOIN pos_ranks r ON r.pos = p.pos
            WHERE level = 1 AND yyyy_mm_dd >= DATE '{START}'""",
        "chosen_holidays": """
            SELECT ds, holiday FROM ranked_holidays WHERE pos_rank <= 5
            UNION
            SELECT ds, holiday FROM ranked_holidays WHERE pos_rank > 5
            GROUP BY ds, holiday HAVING count(*) >= 10""",
        "holiday_windows": """
            SELECT ds, holiday, 0 AS lower_window, 0 AS upper_window FROM chosen_holidays
            WHERE holiday NOT IN ('ChristmasEve', 'ThanksgivingDay', 'NewYearsDay')
            UNION ALL
            SELECT ds, holiday, -1, CASE WHEN holiday = 'ChristmasEve' THEN 0 ELSE 1 END
            FROM chosen_holidays
            WHERE holiday IN ('ChristmasEve', 'ThanksgivingDay', 'NewYearsDay')""",
        "holiday_days": """
            SELECT holiday, k AS "offset", ds + CAST(k AS INTEGER) AS ds
            FROM (SELECT *, unnest(generate_series(lower_window, upper_window)) AS k
                  FROM holiday_windows)""",
        "train_pos": f"SELECT series_id, ds, y FROM ({index_sql('series_pos')})"
        f" WHERE rn < n - {ts.HOLDOUT_DAYS}",
        "holdout_pos": f"SELECT series_id, ds, y FROM ({index_sql('series_pos')})"
        f" WHERE rn >= n - {ts.HOLDOUT_DAYS}",
        "weights": "SELECT (i // 3) * 0.5 AS tw, (i % 3) * 0.5 AS ww, i AS param_id"
        " FROM range(9) r(i)",
        # holdout forecast of the closed form for every weight pair
        "holdout_weighted": f"""
            WITH tr AS (SELECT *, ds - DATE '{ORIGIN}' AS x FROM train_pos),
            g AS (SELECT series_id, avg(y) AS my, avg(x) AS mx,
                         coalesce(regr_slope(y, x), 0) AS b FROM tr GROUP BY series_id),
            e AS (SELECT series_id, param_id, isodow(ds) AS wd,
                         avg(y - my - tw * b * (x - mx)) AS effect
                  FROM tr JOIN g USING (series_id) CROSS JOIN weights GROUP BY ALL)
            SELECT h.series_id, w.param_id, h.ds, h.y,
                   my + tw * b * (h.ds - DATE '{ORIGIN}' - mx) + ww * coalesce(effect, 0) AS yhat
            FROM holdout_pos h JOIN g USING (series_id) CROSS JOIN weights w
            LEFT JOIN e ON e.series_id = h.series_id AND e.param_id = w.param_id
                       AND e.wd = isodow(h.ds)""",
        "holdout_pred": "SELECT series_id, ds, y, yhat FROM holdout_weighted WHERE param_id = 8",
        "fold_rows": f"""
            SELECT i.series_id, fold_id, ds, y, ds - DATE '{ORIGIN}' AS x
            FROM ({index_sql('train_pos')}) i JOIN ({folds_sql('train_pos', True)}) f
            ON i.series_id = f.series_id AND rn >= train_start AND rn < cutoff""",
        "fold_days": f"""
            SELECT series_id, fold_id, CAST(last_ds + CAST(k AS INTEGER) AS DATE) AS ds
            FROM (SELECT series_id, fold_id, max(ds) AS last_ds FROM fold_rows GROUP BY ALL)
            CROSS JOIN range(1, {HORIZON} + 1) r(k)""",
        "fold_pred": f"""
            WITH g AS (SELECT series_id, fold_id, avg(y) AS my, avg(x) AS mx,
                              coalesce(regr_slope(y, x), 0) AS b FROM fold_rows GROUP BY ALL),
            e AS (SELECT series_id, fold_id, isodow(ds) AS wd, param_id,
                         avg(y - my - tw * b * (x - mx)) AS effect
                  FROM fold_rows JOIN g USING (series_id, fold_id) CROSS JOIN weights
                  GROUP BY ALL)
            SELECT d.series_id, d.fold_id, w.param_id, d.ds, s.y,
                   my + tw * b * (d.ds - DATE '{ORIGIN}' - mx) + ww * coalesce(effect, 0) AS yhat
            FROM fold_days d JOIN g USING (series_id, fold_id) CROSS JOIN weights w
            LEFT JOIN e ON e.series_id = d.series_id AND e.fold_id = d.fold_id
                       AND e.param_id = w.param_id AND e.wd = isodow(d.ds)
            LEFT JOIN train_pos s ON s.series_id = d.series_id AND s.ds = d.ds""",
        "fold_scores": """
            SELECT series_id, fold_id, param_id,
                   100 * avg(abs(y - yhat) / nullif(abs(y) + abs(yhat), 0) / 2) AS smape
            FROM fold_pred GROUP BY ALL""",
        # history and future of the closed form, without holidays
        "closed_frame": f"""
            SELECT series_id, ds, y FROM series_pos
            UNION ALL
            SELECT series_id, CAST(last_ds + CAST(k AS INTEGER) AS DATE), NULL
            FROM (SELECT series_id, max(ds) AS last_ds FROM series_pos GROUP BY ALL)
            CROSS JOIN range(1, {HORIZON} + 1) r(k)""",
        "closed_base": f"""
            WITH tr AS (SELECT *, ds - DATE '{ORIGIN}' AS x FROM series_pos),
            g AS (SELECT series_id, avg(y) AS my, avg(x) AS mx,
                         coalesce(regr_slope(y, x), 0) AS b FROM tr GROUP BY series_id),
            e AS (SELECT series_id, isodow(ds) AS wd, avg(y - my - b * (x - mx)) AS effect
                  FROM tr JOIN g USING (series_id) GROUP BY ALL)
            SELECT f.series_id, f.ds, f.y, my + b * (f.ds - DATE '{ORIGIN}' - mx) AS trend,
                   coalesce(effect, 0) AS weekly
            FROM closed_frame f JOIN g USING (series_id)
            LEFT JOIN e ON e.series_id = f.series_id AND e.wd = isodow(f.ds)""",
        "closed_holidays": """
            WITH marked AS (
                SELECT ds, list_sort(list(DISTINCT (holiday, "offset"))) AS marks
                FROM holiday_days GROUP BY ds)
            SELECT series_id, ds,
                   coalesce(avg(CASE WHEN y IS NOT NULL THEN y - trend - weekly END)
                            OVER (PARTITION BY series_id, marks), 0) AS holidays
            FROM closed_base JOIN marked USING (ds)""",
        "closed_forecast": """
            SELECT b.series_id, b.ds, y, trend, weekly, coalesce(h.holidays, 0) AS holidays,
                   trend + weekly + coalesce(h.holidays, 0) AS yhat
            FROM closed_base b LEFT JOIN closed_holidays h
            ON b.series_id = h.series_id AND b.ds = h.ds""",
        "closed_prediction": """
            SELECT series_id, ds, round_even(yhat, 0) AS yhat FROM closed_forecast
            WHERE y IS NULL""",
    }
)

DS = "CAST(ds AS VARCHAR) AS ds"


def split_pos(t: Tables):
    return ts.tail_split(series_pos(t))


def train_pos(t: Tables):
    return split_pos(t).where("is_train").select("series_id", "ds", "y")


def holdout_forecast(t: Tables):
    """Closed form fitted on the training rows, for the holdout rows."""
    split = split_pos(t)
    fitted = fc.fit(split.where("is_train"), ["series_id"], ORIGIN)
    holdout = split.where(~F.col("is_train")).select("series_id", "ds", "y")
    return fc.predict(holdout, fitted, ["series_id"], ORIGIN)


def closed_forecast(t: Tables):
    return fc.forecast(series_pos(t), HORIZON, job_holidays(t), ORIGIN)


def closed_prediction(t: Tables):
    return rp.daily_prediction(ts.tail(closed_forecast(t), HORIZON))


# --- series ------------------------------------------------------------------------------


@query("g12_daily_series", f"SELECT series_id, {DS}, y FROM series_all")
def g12_daily_series(t: Tables):
    values = rg.metric_values(t, "account_4", METRIC, scope("account_4"))
    return ts.daily_series(values, METRIC)


@query(
    "g13_trailing_pos",
    "SELECT pos, CAST(total AS DOUBLE) AS total FROM pos_totals ORDER BY total DESC",
)
def g13_trailing_pos(t: Tables):
    """G13 + T1."""
    return ts.trailing_pos_totals(metric_daily(t), METRIC, END).orderBy(F.desc("total"))


@query(
    "g15_holiday_count",
    f"""SELECT {DS}, holiday, count(*) AS n_rows FROM ranked_holidays WHERE pos_rank > 5
        GROUP BY ds, holiday HAVING count(*) >= 10""",
)
def g15_holiday_count(t: Tables):
    elsewhere = ranked_holidays(t).where(F.col("pos_rank") > hol.TOP_POS)
    counted = elsewhere.groupBy("ds", "holiday").agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.where(F.col("n_rows") >= hol.MIN_ROWS_ELSEWHERE)


@query(
    "g18_bounds",
    """SELECT series_id, round(max(y) * 1.1, 4) AS cap, round(min(y) * 0.9, 4) AS floor
       FROM series_pos GROUP BY series_id""",
)
def g18_bounds(t: Tables):
    return rounded(ts.bounds(series_pos(t)), "cap", "floor", digits=4)


@query("w1_avg_rank", "SELECT pos, CAST(pos_rank AS DOUBLE) AS pos_rank FROM pos_ranks")
def w1_avg_rank(t: Tables):
    return pos_ranks(t).select("pos", "pos_rank")


@query(
    "w1_avg_rank_ties",
    """WITH c AS (SELECT year(yyyy_mm_dd) AS series_id, pos, count(DISTINCT yyyy_mm_dd) AS total
                  FROM performance GROUP BY ALL)
       SELECT series_id, pos, CAST(rank() OVER (PARTITION BY series_id ORDER BY total DESC)
              + (count(*) OVER (PARTITION BY series_id, total) - 1) / 2.0 AS DOUBLE) AS pos_rank
       FROM c""",
)
def w1_avg_rank_ties(t: Tables):
    """Points of sale by active days in each year, which tie often."""
    days = t.performance.select(
        F.year("yyyy_mm_dd").alias("series_id"), "pos", "yyyy_mm_dd"
    ).distinct()
    totals = days.groupBy("series_id", "pos").agg(F.count(F.lit(1)).alias("total"))
    return ts.average_rank(totals, by=["series_id"]).select("series_id", "pos", "pos_rank")


@query(
    "w2_positional_index",
    f"SELECT series_id, {DS}, rn, n FROM ({index_sql('series_pos')})",
)
def w2_positional_index(t: Tables):
    """W2 + T2."""
    return ts.indexed(series_pos(t)).select("series_id", "ds", "rn", "n")


@query(
    "w3_tail_split",
    f"""SELECT series_id, {DS}, rn < n - 14 AS is_train FROM ({index_sql('series_pos')})""",
)
def w3_tail_split(t: Tables):
    return split_pos(t).select("series_id", "ds", "is_train")


@query(
    "w4_tail_h",
    f"""SELECT series_id, {DS}, y FROM ({index_sql('series_pos')}) WHERE rn >= n - {HORIZON}""",
)
def w4_tail_h(t: Tables):
    return ts.tail(series_pos(t), HORIZON)


@query(
    "t3_top_pos",
    "SELECT pos, CAST(pos_rank AS DOUBLE) AS pos_rank FROM pos_ranks WHERE pos_rank <= 5",
)
def t3_top_pos(t: Tables):
    return pos_ranks(t).where(F.col("pos_rank") <= hol.TOP_POS).select("pos", "pos_rank")


@query("m6_log", f"SELECT series_id, {DS}, round(ln(y), 6) AS transformed FROM series_all")
def m6_log(t: Tables):
    """R1 + M6."""
    series = ts.transform(series_all(t), "log").withColumnRenamed("y", "transformed")
    return rounded(series, "transformed", digits=6)


@query(
    "m7_boxcox",
    f"SELECT series_id, {DS}, round((pow(y, 0.25) - 1) / 0.25, 6) AS transformed FROM series_all",
)
def m7_boxcox(t: Tables):
    series = ts.transform(series_all(t), "box_cox", 0.25).withColumnRenamed("y", "transformed")
    return rounded(series, "transformed", digits=6)


@query(
    "r1_transform_round_trip",
    f"""SELECT series_id, {DS}, kind, round(y, 4) AS y
        FROM series_all, (VALUES ('log'), ('box_cox')) k(kind)""",
)
def r1_transform_round_trip(t: Tables):
    """R1 with M6 / M7, there and back."""
    both = []
    for kind, lam in (("log", None), ("box_cox", 0.25)):
        there = ts.transform(series_all(t), kind, lam)
        back = ts.transform_back(there, ["y"], kind, lam)
        both.append(back.select("series_id", "ds", F.lit(kind).alias("kind"), "y"))
    return rounded(both[0].unionByName(both[1]), "y", digits=4)


@query(
    "m8_bround",
    "SELECT id, CAST(round_even(CAST(roomnights / 2.0 AS DOUBLE), 0) AS DOUBLE) AS half"
    " FROM reservations",
)
def m8_bround(t: Tables):
    half = nm.round_half_even((F.col("roomnights") / 2.0).cast("double"))
    return t.reservations.select("id", half.alias("half"))


@query(
    "r2_level_shift",
    f"""SELECT series_id, {DS}, dense_rank() OVER (PARTITION BY series_id ORDER BY year(ds)) - 1
               + CASE WHEN month(ds) >= 12 AND day(ds) >= 28 THEN 1 ELSE 0 END AS level_shift
        FROM series_pos""",
)
def r2_level_shift(t: Tables):
    """R2 + W5."""
    return ts.level_shift(series_pos(t)).select("series_id", "ds", "level_shift")


SQL_VIEWS["daily_cancels"] = (
    "SELECT yyyy_mm_dd AS ds, CAST(sum(cancellations) AS DOUBLE) AS regressor"
    " FROM cancel_4 GROUP BY ALL"
)


@query(
    "r3_regressor_attach",
    f"SELECT series_id, {DS}, y, regressor FROM series_pos JOIN daily_cancels USING (ds)",
)
def r3_regressor_attach(t: Tables):
    """R3 + J11: daily cancellations as an external regressor."""
    cancelled = rg.metric_values(t, "account_4", "Cancellations", scope("account_4"))
    daily = cancelled.groupBy(F.col("yyyy_mm_dd").alias("ds")).agg(
        F.sum("cancellations").alias("cancellations")
    )
    return ts.attach_regressor(series_pos(t), daily)


@query(
    "r4_future_frame",
    f"""SELECT f.series_id, CAST(f.ds AS VARCHAR) AS ds, f.y,
               round(cap, 4) AS cap, round(floor, 4) AS floor
        FROM closed_frame f JOIN (SELECT series_id, max(y) * 1.1 AS cap, min(y) * 0.9 AS floor
                                  FROM series_pos GROUP BY series_id) b USING (series_id)""",
)
def r4_future_frame(t: Tables):
    """R4 + R5."""
    frame = ts.with_future(ts.with_bounds(series_pos(t)), HORIZON)
    return rounded(frame, "cap", "floor", digits=4)


@query(
    "d18_gap_report",
    """SELECT series_id, count(*) AS days_present,
              max(ds) - min(ds) + 1 - count(*) AS days_missing
       FROM series_pos GROUP BY series_id""",
)
def d18_gap_report(t: Tables):
    return ts.gap_report(series_pos(t))


# --- holidays ----------------------------------------------------------------------------


@query(
    "j8_holiday_merge",
    f"""SELECT {DS}, holiday, pos, CAST(pos_rank AS DOUBLE) AS pos_rank FROM ranked_holidays""",
)
def j8_holiday_merge(t: Tables):
    return ranked_holidays(t).select("ds", "holiday", "pos", "pos_rank")


@query("r6_holiday_select", f"SELECT {DS}, holiday FROM chosen_holidays")
def r6_holiday_select(t: Tables):
    """R6 + U2."""
    return hol.select_holidays(ranked_holidays(t))


@query(
    "r7_holiday_windows",
    f"SELECT {DS}, holiday, lower_window, upper_window FROM holiday_windows",
    "lower_window upper_window",
)
def r7_holiday_windows(t: Tables):
    """R7 + U3."""
    return job_holidays(t)


@query("r8_holiday_expand", f'SELECT {DS}, holiday, "offset" FROM holiday_days')
def r8_holiday_expand(t: Tables):
    return hol.expand_windows(job_holidays(t))


# --- folds, search space -----------------------------------------------------------------

FOLD_SQL = """SELECT series_id, fold_id, train_start, cutoff FROM ({folds})"""


@query("c1_rolling_folds", FOLD_SQL.format(folds=folds_sql("train_pos", True)))
def c1_rolling_folds(t: Tables):
    folds = fd.fold_table(train_pos(t), HORIZON)
    return folds.select("series_id", "fold_id", "train_start", "cutoff")


@query("c2_backtest_folds", FOLD_SQL.format(folds=folds_sql("train_pos", False)), "train_start")
def c2_backtest_folds(t: Tables):
    folds = fd.fold_table(train_pos(t), HORIZON, cv_type="backtesting")
    return folds.select("series_id", "fold_id", "train_start", "cutoff")


@query(
    "c3_fold_sample",
    f"""SELECT series_id, cutoff FROM (
            SELECT *, row_number() OVER (PARTITION BY series_id
                                         ORDER BY md5('42:' || cutoff)) AS draw
            FROM ({folds_sql('train_pos', True)}))
        WHERE draw <= 10""",
)
def c3_fold_sample(t: Tables):
    return fd.sample_folds(fd.fold_table(train_pos(t), HORIZON)).select("series_id", "cutoff")


SQL_VIEWS["param_space"] = """
    SELECT i AS space_id, ['linear', 'logistic'][i // 200000 + 1] AS growth,
           round(0.001 + (i // 1000 % 200) * 0.003, 3) AS changepoint_prior_scale,
           15 + i // 40 % 25 AS n_changepoints,
           ['multiplicative', 'additive'][i // 20 % 2 + 1] AS seasonality_mode,
           round(0.8 + (i % 20) * (0.99 - 0.8) / 19, 6) AS changepoint_range
    FROM range(400000) r(i)"""
SQL_VIEWS["param_sample"] = """
    SELECT *, row_number() OVER (ORDER BY md5('1234:' || space_id)) - 1 AS param_id
    FROM param_space ORDER BY md5('1234:' || space_id) LIMIT 30"""


@query(
    "c4_space_count",
    f"""SELECT series_id, growth, n_folds, count(*) AS n_sets, n_folds * count(*) AS n_fits,
               CAST(min(changepoint_prior_scale) AS DOUBLE) AS low_scale,
               CAST(max(changepoint_prior_scale) AS DOUBLE) AS high_scale,
               min(n_changepoints) AS low_points, max(n_changepoints) AS high_points,
               CAST(min(changepoint_range) AS DOUBLE) AS low_range,
               CAST(max(changepoint_range) AS DOUBLE) AS high_range
        FROM (SELECT series_id, count(*) AS n_folds FROM ({folds_sql('train_pos', True)})
              GROUP BY series_id), param_space GROUP BY series_id, growth, n_folds""",
)
def c4_space_count(t: Tables):
    """C4: what a full search would cost each series, by growth."""
    folds = fd.fold_table(train_pos(t), HORIZON)
    per_series = folds.groupBy("series_id").agg(F.count(F.lit(1)).alias("n_folds"))
    scale, points, where = "changepoint_prior_scale", "n_changepoints", "changepoint_range"
    sizes = pm.param_space(t.spark).groupBy("growth").agg(
        F.count(F.lit(1)).alias("n_sets"),
        F.min(scale).alias("low_scale"), F.max(scale).alias("high_scale"),
        F.min(points).alias("low_points"), F.max(points).alias("high_points"),
        F.min(where).alias("low_range"), F.max(where).alias("high_range"),
    )
    growths = F.array(*[F.lit(g) for g in pm.GROWTHS])
    return (
        per_series.withColumn("growth", F.explode(growths))
        .join(F.broadcast(sizes), "growth")
        .withColumn("n_fits", F.col("n_folds") * F.col("n_sets"))
    )


@query(
    "c5_param_sample",
    """SELECT series_id, param_id, space_id, growth,
              CAST(changepoint_prior_scale AS DOUBLE) AS changepoint_prior_scale,
              n_changepoints, seasonality_mode,
              CAST(changepoint_range AS DOUBLE) AS changepoint_range
       FROM (SELECT DISTINCT series_id FROM series_pos), param_sample""",
)
def c5_param_sample(t: Tables):
    """The sets every series gets to try."""
    groups = series_pos(t).select("series_id").distinct()
    params = pm.sample_params(pm.param_space(t.spark))
    return pm.work_list(groups, params).select(
        "series_id", "param_id", "space_id", *pm.PARAM_FIELDS
    )


@query(
    "c6_work_list",
    f"""SELECT series_id, fold_id, cutoff, param_id, growth, n_changepoints, seasonality_mode
        FROM ({folds_sql('train_pos', True)}), param_sample""",
)
def c6_work_list(t: Tables):
    """C6 + J13."""
    params = pm.sample_params(pm.param_space(t.spark))
    return pm.work_list(fd.fold_table(train_pos(t), HORIZON), params).select(
        "series_id", "fold_id", "cutoff", "param_id",
        "growth", "n_changepoints", "seasonality_mode",
    )


# --- closed forecast and scores ----------------------------------------------------------


@query(
    "k7_closed_form",
    f"""SELECT series_id, {DS}, round(trend, 2) AS trend, round(weekly, 2) AS weekly,
               round(holidays, 2) AS holidays, round(yhat, 2) AS yhat FROM closed_forecast
        ORDER BY ALL""",
)
def k7_closed_form(t: Tables):
    parts = ["trend", "weekly", "holidays", "yhat"]
    return rounded(closed_forecast(t).select("series_id", "ds", *parts), *parts)


@query(
    "c7_cv_scores_closed",
    "SELECT series_id, fold_id, param_id, round(smape, 6) AS smape FROM fold_scores",
)
def c7_cv_scores_closed(t: Tables):
    scores = tn.cv_scores_closed(train_pos(t), HORIZON, origin=ORIGIN)
    return rounded(scores, "smape", digits=6)


SQL_VIEWS["lead_scores"] = """
    SELECT p.series_id, p.fold_id, CAST(p.ds - last_ds AS BIGINT) AS lead,
           abs(p.y - yhat) / scale AS score
    FROM fold_pred p
    JOIN (SELECT series_id, fold_id, max(ds) AS last_ds, abs(avg(y)) AS scale
          FROM fold_rows GROUP BY ALL) f
    ON f.series_id = p.series_id AND f.fold_id = p.fold_id
    WHERE param_id = 8 AND p.y IS NOT NULL AND scale > 0"""
SQL_VIEWS["lead_widths"] = f"""
    SELECT lead, count(*) AS n_scores,
           list_sort(list(score))[CAST(ceil({bd.WIDTH} * count(*)) AS BIGINT)] AS half_width
    FROM lead_scores GROUP BY lead"""


@query(
    "k6_lead_bands",
    "SELECT lead, n_scores, round(half_width, 6) AS half_width FROM lead_widths ORDER BY lead",
)
def k6_lead_bands(t: Tables):
    """K6: how wide a band of 95 % is at each lead day, from all folds of all series."""
    widths = bd.half_widths(bd.closed_scores(train_pos(t), HORIZON, origin=ORIGIN))
    return rounded(widths, "half_width", digits=6)


SQL_VIEWS["best_sets"] = """
    SELECT series_id, param_id, cv_smape FROM (
        SELECT series_id, param_id, cv_smape,
               row_number() OVER (PARTITION BY series_id ORDER BY cv_smape, param_id) AS place
        FROM (SELECT series_id, param_id, median(smape) AS cv_smape FROM fold_scores
              GROUP BY ALL))
    WHERE place = 1"""


@query(
    "g17_median_score",
    """SELECT series_id, param_id, round(median(smape), 6) AS smape FROM fold_scores
       GROUP BY ALL""",
)
def g17_median_score(t: Tables):
    scores = tn.cv_scores_closed(train_pos(t), HORIZON, origin=ORIGIN)
    return rounded(tn.median_scores(scores), "smape", digits=6)


@query(
    "t4_best_params",
    "SELECT series_id, param_id, round(cv_smape, 6) AS cv_smape FROM best_sets",
)
def t4_best_params(t: Tables):
    scores = tn.cv_scores_closed(train_pos(t), HORIZON, origin=ORIGIN)
    return rounded(tn.best_params(scores), "cv_smape", digits=6)


@query(
    "c8_select_model",
    """WITH h AS (
           SELECT series_id, param_id,
                  100 * avg(abs(y - round_even(yhat, 0))
                            / nullif(abs(y) + abs(round_even(yhat, 0)), 0) / 2) AS smape
           FROM holdout_weighted GROUP BY ALL)
       SELECT b.series_id, round(b.smape, 6) AS baseline_smape, s.param_id,
              round(u.smape, 6) AS tuned_smape,
              CASE WHEN u.smape IS NULL OR b.smape <= u.smape THEN 'baseline' ELSE 'tuned' END
                  AS model
       FROM (SELECT * FROM h WHERE param_id = 8) b
       LEFT JOIN best_sets s ON b.series_id = s.series_id
       LEFT JOIN h u ON u.series_id = s.series_id AND u.param_id = s.param_id""",
)
def c8_select_model(t: Tables):
    chosen = tn.select_closed_model(series_pos(t), HORIZON, origin=ORIGIN)
    return rounded(chosen, "baseline_smape", "tuned_smape", digits=6)


@query(
    "j10_score_align",
    f"""SELECT f.series_id, CAST(f.ds AS VARCHAR) AS ds, round(yhat, 2) AS yhat, s.y
        FROM closed_forecast f LEFT JOIN series_pos s
        ON f.series_id = s.series_id AND f.ds = s.ds ORDER BY ALL""",
)
def j10_score_align(t: Tables):
    forecast = closed_forecast(t).select("series_id", "ds", "yhat")
    return rounded(sc.align(forecast, series_pos(t)), "yhat")


@query(
    "e1_smape_daily",
    """SELECT series_id, round(100 * avg(abs(y - yhat) / nullif(abs(y) + abs(yhat), 0) / 2), 6)
              AS smape FROM holdout_pred GROUP BY series_id""",
)
def e1_smape_daily(t: Tables):
    return rounded(sc.smape(holdout_forecast(t), ["series_id"], "daily"), "smape", digits=6)


@query(
    "e2_smape_weekly",
    """SELECT series_id, round(100 * avg(abs(y - yhat) / nullif(abs(y) + abs(yhat), 0) / 2), 6)
              AS smape
       FROM (SELECT series_id, week(ds) AS week, sum(y) AS y, sum(yhat) AS yhat
             FROM holdout_pred GROUP BY ALL) GROUP BY series_id""",
)
def e2_smape_weekly(t: Tables):
    return rounded(sc.smape(holdout_forecast(t), ["series_id"], "weekly"), "smape", digits=6)


@query(
    "e3_smape_period",
    """SELECT series_id, round(100 * abs(abs(sum(y)) - abs(sum(yhat)))
              / nullif(abs(sum(y)) + abs(sum(yhat)), 0) / 2, 6) AS smape
       FROM holdout_pred GROUP BY series_id""",
)
def e3_smape_period(t: Tables):
    return rounded(sc.smape(holdout_forecast(t), ["series_id"], "period"), "smape", digits=6)


@query(
    "e4_smape_rounded",
    """SELECT series_id,
              round(400 * avg(abs(y - r) / nullif(abs(y) + abs(r), 0) / 2), 6) AS smape
       FROM (SELECT *, round_even(yhat, 0) AS r FROM holdout_pred) GROUP BY series_id""",
)
def e4_smape_rounded(t: Tables):
    """E4, on the usual 0 .. 200 scale."""
    scores = sc.smape(holdout_forecast(t), ["series_id"], round_first=True, scale="standard")
    return rounded(scores, "smape", digits=6)


# --- reports -----------------------------------------------------------------------------


@query(
    "e5_weekly_full",
    """SELECT series_id, year(ds) AS year, week(ds) AS week, sum(yhat) AS yhat
       FROM closed_prediction GROUP BY ALL HAVING count(*) = 7""",
)
def e5_weekly_full(t: Tables):
    """E5 + G16."""
    return rp.weekly_totals(closed_prediction(t))


@query(
    "e5_weekly_full_iso",
    """SELECT series_id, isoyear(ds) AS year, week(ds) AS week, sum(yhat) AS yhat
       FROM closed_prediction GROUP BY ALL HAVING count(*) = 7""",
)
def e5_weekly_full_iso(t: Tables):
    return rp.weekly_totals(closed_prediction(t), "iso")


@query(
    "e6_yoy",
    """WITH p AS (SELECT series_id, year(ds) AS year, week(ds) AS week, sum(yhat) AS yhat
                  FROM closed_prediction GROUP BY ALL HAVING count(*) = 7),
            a AS (SELECT series_id, year(ds) AS year, week(ds) AS week, sum(y) AS y
                  FROM series_pos GROUP BY ALL)
       SELECT p.series_id, p.year, p.week, yhat, round(y, 2) AS y_last_year,
              round(yhat / nullif(y, 0) - 1, 6) AS yoy
       FROM p JOIN a ON p.series_id = a.series_id AND p.week = a.week AND p.year = a.year + 1""",
)
def e6_yoy(t: Tables):
    """E6 + J12."""
    table = rp.year_over_year(closed_prediction(t), series_pos(t))
    return rounded(rounded(table, "y_last_year"), "yoy", digits=6)


@query(
    "e8_residuals",
    f"""SELECT series_id, {DS}, round(yhat, 2) AS yhat, y, round(yhat - y, 2) AS residual
        FROM closed_forecast WHERE y IS NOT NULL ORDER BY ALL""",
)
def e8_residuals(t: Tables):
    """E8 + J14 + M13."""
    table = rp.residuals(closed_forecast(t), series_pos(t))
    return rounded(table, "yhat", "residual")


@query(
    "w6_winsorize",
    f"""WITH r AS (
            SELECT series_id, ds, yhat - y AS residual,
                   row_number() OVER (PARTITION BY series_id ORDER BY yhat - y) AS place,
                   count(*) OVER (PARTITION BY series_id) AS n
            FROM closed_forecast WHERE y IS NOT NULL),
        k AS (SELECT series_id, min(residual) AS low, max(residual) AS high FROM r
              WHERE place > floor(n * 0.05) AND place <= n - floor(n * 0.05)
              GROUP BY series_id)
        SELECT series_id, {DS}, round(residual, 2) AS residual,
               round(least(greatest(residual, low), high), 2) AS residual2
        FROM r JOIN k USING (series_id)""",
)
def w6_winsorize(t: Tables):
    table = rp.residuals(closed_forecast(t), series_pos(t)).drop("y", "yhat")
    return rounded(rp.winsorize(table, "residual", "residual2"), "residual", "residual2")


def written_twice(t: Tables) -> str:
    """The folder of a daily prediction whose run was written twice."""
    folder = f"{shared_folder(t.spark)}/daily_prediction_{uuid.uuid4().hex}"
    prediction = t.settle("prediction", lambda: closed_prediction(t))
    for _ in range(2):
        csv_files.write_run(prediction, folder, END, ["yhat"])
    return folder


@query("s10_csv_round_trip", f"SELECT series_id, {DS}, yhat FROM closed_prediction ORDER BY ALL")
def s10_csv_round_trip(t: Tables):
    """S10 + S11: write the daily prediction as CSV, twice, and read one copy back."""
    rows = csv_files.read_runs(t.spark, written_twice(t), "series_id string, ds date, yhat double", END)
    return rows.drop(csv_files.RUN)


SQL_VIEWS["flag_series"] = (
    "SELECT yyyy_mm_dd AS ds, CAST(sum(bookings) AS DOUBLE) AS y FROM perf_3 GROUP BY ALL"
)


@query(
    "flagship_weekly_forecast",
    f"""WITH tr AS (SELECT ds, y, ds - DATE '{ORIGIN}' AS x FROM flag_series
                    WHERE y IS NOT NULL),
        g AS (SELECT avg(y) AS my, avg(x) AS mx, coalesce(regr_slope(y, x), 0) AS b FROM tr),
        e AS (SELECT isodow(ds) AS wd, avg(y - my - b * (x - mx)) AS effect FROM tr, g
              GROUP BY ALL),
        f AS (SELECT CAST(last_ds + CAST(k AS INTEGER) AS DATE) AS ds
              FROM (SELECT max(ds) AS last_ds FROM flag_series), range(1, {HORIZON} + 1) r(k)),
        p AS (SELECT ds, round_even(my + b * (ds - DATE '{ORIGIN}' - mx)
                                    + coalesce(effect, 0), 0) AS yhat
              FROM f CROSS JOIN g LEFT JOIN e ON wd = isodow(ds))
        SELECT 'All' AS series_id, year(ds) AS year, week(ds) AS week, sum(yhat) AS yhat
        FROM p GROUP BY ALL HAVING count(*) = 7""",
)
def flagship_weekly_forecast(t: Tables):
    """Reservations, scores and clicks to daily bookings, forecast and weekly totals."""
    bookings = rg.metric_values(t, "account_3", "GrossBookings", scope("account_3"))
    series = t.settle("series", lambda: ts.daily_series(bookings, "gross_bookings"))
    forecast = fc.forecast(series, HORIZON, origin=ORIGIN)
    return rp.weekly_totals(rp.daily_prediction(ts.tail(forecast, HORIZON)))
