"""Bands by lead day against plain Python, and how much of other folds they cover."""

import math
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tidecast.operators import bands as bd
from tidecast.plans import series_queries as sq
from tidecast.sources.standin import Tables

FIRST = date(2020, 1, 1)


def test_half_width_is_the_order_statistic(spark):
    rows = [("s", k % 5, lead, float((k * 37) % 101)) for lead in (1, 2) for k in range(40 * lead)]
    scores = spark.createDataFrame(rows, "series_id string, fold_id int, lead int, score double").repartition(7)
    for width in (0.5, 0.9, 0.95):
        for r in bd.half_widths(scores, width=width).collect():
            own = sorted(s for *_, lead, s in rows if lead == r.lead)
            assert (r.n_scores, r.half_width) == (len(own), own[math.ceil(width * len(own)) - 1])
    with pytest.raises(ValueError):
        bd.half_widths(scores, width=1.0)


def test_bands_widen_where_forecasts_get_worse(spark):
    """A random walk: errors grow with the lead, and so do the bands; a flat series has none."""
    import random

    rnd, level, rows = random.Random(4), 1000.0, []
    for k in range(900):
        level += rnd.gauss(0, 6)
        rows.append(("walk", FIRST + timedelta(days=k), level))
        rows.append(("flat", FIRST + timedelta(days=k), 0.0))
    series = spark.createDataFrame(rows, "series_id string, ds date, y double")
    out = bd.closed_forecast_bands(series, 20, 100, origin="2020-01-01").collect()
    walk = sorted((r for r in out if r.series_id == "walk"), key=lambda r: r.ds)
    sizes = [r.yhat_upper - r.yhat_lower for r in walk]
    assert len(walk) == 20 and sum(sizes[-5:]) > 1.15 * sum(sizes[:5]) > 0
    assert all(r.yhat_lower < r.yhat < r.yhat_upper for r in walk)
    assert all(r.yhat_lower == r.yhat == r.yhat_upper == 0 for r in out if r.series_id == "flat")


def test_bands_cover_held_out_folds(spark):
    """Made from every other fold, the bands hold about 95 % of the errors of the rest."""
    t = Tables(spark, "/root/testdata/sf0.01")
    scores = bd.closed_scores(sq.train_pos(t), sq.HORIZON, origin=sq.ORIGIN).cache()
    known, other = scores.where(F.col("fold_id") % 2 == 0), scores.where(F.col("fold_id") % 2 == 1)
    found = bd.coverage(other, bd.half_widths(known)).collect()
    n = sum(r.n_scores for r in found)
    assert len(found) == sq.HORIZON and n > 3000
    assert abs(sum(r.covered * r.n_scores for r in found) / n - 0.95) < 0.03
