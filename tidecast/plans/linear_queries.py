"""Registered queries for the additive model that is fitted from sums, with SQL twins.

The SQL builds the same columns, sums their products, solves the equations by elimination and
takes the same turns with the noise scale, so fitted values are compared, not only promises.
"""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from tidecast.operators import additive_fit as af
from tidecast.operators import linear_fit as lf
from tidecast.operators import series as ts
from tidecast.plans import series_queries as sq
from tidecast.plans.catalog import SQL_VIEWS, query
from tidecast.sources.standin import Tables

# Digits of amounts that both engines agree on after sums in another order.
DIGITS = 1
PARTS = ["trend", "weekly", "yearly", "holidays", "yhat"]


def fourier_sql(day: str, period: float, order: int) -> str:
    angles = [f"{2.0 * math.pi * k / period!r}::DOUBLE * {day}" for k in range(1, order + 1)]
    return ", ".join([f"cos({a})" for a in angles] + [f"sin({a})" for a in angles])


def values_sql(source: str, frame: str) -> str:
    """Fitted values of every row of ``frame``, from the rows of ``source`` with a y.

    ``v`` holds the columns and, last, y; ``a`` the equations under elimination.
    """
    names = "(SELECT list(DISTINCT holiday || '_' || \"offset\" ORDER BY holiday || '_' || \"offset\") FROM holiday_days)"
    terms = (
        f"list_concat([{fourier_sql('d', af.WEEK_DAYS, af.WEEK_ORDER)}, "
        f"{fourier_sql('d', af.YEAR_DAYS, af.YEAR_ORDER)}], "
        "list_transform(names, lambda e: CASE WHEN list_contains(effects, e) THEN 1.0 ELSE 0.0 END::DOUBLE))"
    )
    s = af.NOISE_SCALE**2
    noise = f"greatest({s} * (-m[1][1] + sqrt(m[1][1] * m[1][1] + 4.0 * {{rss}} / {s})) / 2.0, 1e-10)"
    start = (
        "list_transform(range(1, p + 1), lambda i: list_transform(range(1, p + 2), lambda j: m[i][j] + CASE "
        f"WHEN i <> j THEN 0.0 WHEN i <= 2 THEN {{noise}} / {af.BASE_SCALE**2} ELSE {{noise}} / {af.EFFECT_SCALE**2} END))"
    )
    solved = "list_transform(range(1, p + 1), lambda i: a[i][p + 1] / a[i][i])"
    rss = (
        "greatest(m[p + 1][p + 1] - 2.0 * list_sum(list_transform(range(1, p + 1), lambda i: theta[i] * m[i][p + 1])) "
        "+ list_sum(list_transform(range(1, p + 1), lambda i: theta[i] * list_sum("
        "list_transform(range(1, p + 1), lambda j: m[i][j] * theta[j])))), 0.0)"
    )
    week, year = 2 * af.WEEK_ORDER, 2 * af.YEAR_ORDER
    part = "scale * coalesce(list_sum(list_transform(range({low}, {high}), lambda i: theta[i] * v[i])), 0.0)"
    return f"""
        WITH RECURSIVE marked AS (
            SELECT ds, list(DISTINCT holiday || '_' || "offset") AS effects FROM holiday_days GROUP BY ds
        ),
        b AS (
            SELECT series_id, min(ds - DATE '1970-01-01') AS low,
                   greatest(max(ds - DATE '1970-01-01') - min(ds - DATE '1970-01-01'), 1) AS span,
                   CASE WHEN max(abs(y)) > 0 THEN max(abs(y)) ELSE 1.0 END AS scale
            FROM {source} WHERE y IS NOT NULL GROUP BY series_id
        ),
        x AS MATERIALIZED (
            SELECT series_id, ds, y, scale,
                   list_concat([1.0::DOUBLE, (d - low) / span::DOUBLE], {terms}) AS v
            FROM (
                SELECT f.series_id, f.ds, f.y, (f.ds - DATE '1970-01-01')::DOUBLE AS d, low, span, scale,
                       coalesce(effects, []) AS effects, {names} AS names
                FROM {frame} f JOIN b USING (series_id) LEFT JOIN marked ON marked.ds = f.ds
            )
        ),
        products AS (
            SELECT series_id, i, j, sum(w[i] * w[j]) AS g
            FROM (SELECT series_id, list_append(v, y / scale) AS w FROM x WHERE y IS NOT NULL),
                 (SELECT unnest(range(1, (SELECT max(len(v)) FROM x) + 2)) AS i),
                 (SELECT unnest(range(1, (SELECT max(len(v)) FROM x) + 2)) AS j)
            WHERE i <= j GROUP BY ALL
        ),
        sums AS MATERIALIZED (
            SELECT series_id, list(r ORDER BY i) AS m, len(list(r)) - 1 AS p
            FROM (
                SELECT series_id, i, list(g ORDER BY j) AS r
                FROM (SELECT series_id, i, j, g FROM products
                      UNION ALL SELECT series_id, j, i, g FROM products WHERE i < j)
                GROUP BY series_id, i
            )
            GROUP BY series_id
        ),
        steps(series_id, m, p, turn, k, a, theta) AS (
            SELECT series_id, m, p, 1, 0,
                   {start.format(noise="noise")}, CAST([] AS DOUBLE[])
            FROM (SELECT *, {noise.format(rss="m[p + 1][p + 1]")} AS noise FROM sums)
            UNION ALL
            SELECT series_id, m, p, turn + CASE WHEN k > p THEN 1 ELSE 0 END,
                   CASE WHEN k > p THEN 0 ELSE k + 1 END,
                   CASE WHEN k > p THEN {start.format(noise=noise.format(rss=rss))}
                        WHEN k = p THEN a
                        ELSE list_transform(a, lambda row, i: CASE WHEN i = k + 1 THEN row ELSE
                             list_transform(row, lambda one, j: one - row[k + 1] / a[k + 1][k + 1] * a[k + 1][j]) END)
                   END,
                   CASE WHEN k = p THEN {solved} ELSE theta END
            FROM steps WHERE NOT (turn = {lf.TURNS} AND k > p)
        ),
        fitted AS (SELECT series_id, theta, p FROM steps WHERE turn = {lf.TURNS} AND k > p),
        parts AS (
            SELECT series_id, ds, y,
                   {part.format(low=1, high=3)} AS trend,
                   {part.format(low=3, high=3 + week)} AS weekly,
                   {part.format(low=3 + week, high=3 + week + year)} AS yearly,
                   {part.format(low=3 + week + year, high="p + 1")} AS holidays
            FROM x JOIN fitted USING (series_id)
        )
        SELECT *, trend + weekly + yearly + holidays AS yhat FROM parts"""


SQL_VIEWS["linear_values"] = values_sql("series_pos", "closed_frame")


def linear_forecast(t: Tables):
    return lf.forecast(sq.series_pos(t), sq.HORIZON, sq.job_holidays(t), origin=sq.ORIGIN)


@query(
    "k1_linear_values",
    "SELECT series_id, CAST(ds AS VARCHAR) AS ds, "
    + ", ".join(f"round({p}, {DIGITS}) AS {p}" for p in PARTS)
    + " FROM linear_values WHERE y IS NULL ORDER BY ALL",
)
def k1_linear_values(t: Tables):
    """The future days of every point of sale, with all parts."""
    future = linear_forecast(t).where(F.col("y").isNull()).select("series_id", "ds", *PARTS)
    return future.withColumns({p: F.round(p, DIGITS) for p in PARTS})


# Training rows and days to predict of each fold of the account-level series, as series.
SQL_VIEWS["train_all"] = (
    f"SELECT series_id, ds, y FROM ({sq.index_sql('series_all')}) WHERE rn < n - {ts.HOLDOUT_DAYS}"
)
SQL_VIEWS["linear_folds"] = f"""
    SELECT i.series_id || '/' || fold_id AS series_id, ds, y
    FROM ({sq.index_sql('train_all')}) i JOIN ({sq.folds_sql('train_all', True)}) f
    ON i.series_id = f.series_id AND rn >= train_start AND rn < cutoff"""
SQL_VIEWS["linear_fold_frame"] = f"""
    SELECT series_id, ds, y FROM linear_folds
    UNION ALL
    SELECT series_id, CAST(last_ds + CAST(k AS INTEGER) AS DATE), NULL
    FROM (SELECT series_id, max(ds) AS last_ds FROM linear_folds GROUP BY ALL)
    CROSS JOIN range(1, {sq.HORIZON} + 1) r(k)"""
SQL_VIEWS["linear_fold_values"] = values_sql("linear_folds", "linear_fold_frame")


@query(
    "c7_cv_scores_linear",
    """SELECT split_part(v.series_id, '/', 1) AS series_id,
              CAST(split_part(v.series_id, '/', 2) AS BIGINT) AS fold_id,
              round(100 * avg(abs(s.y - yhat) / nullif(abs(s.y) + abs(yhat), 0) / 2), 6) AS smape
       FROM linear_fold_values v
       LEFT JOIN train_all s ON s.series_id = split_part(v.series_id, '/', 1) AND s.ds = v.ds
       WHERE v.y IS NULL GROUP BY ALL ORDER BY ALL""",
)
def c7_cv_scores_linear(t: Tables):
    """C7 + K4 on the account-level series, holidays included, without a day in Python."""
    train = ts.tail_split(sq.series_all(t)).where("is_train").select("series_id", "ds", "y")
    holidays = sq.job_holidays(t)
    design = lf.Design(lf.effect_names(holidays))
    scores = lf.cv_scores_linear(train, sq.HORIZON, design, holidays, origin=sq.ORIGIN)
    return scores.withColumn("smape", F.round("smape", 6))
