"""Hard-negative mining against plain Python."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidecast.llm import hard_negatives as hn
from tidecast.llm.hard_negatives import Mining, bit_planes, full_scores, hard_negatives, subset_sums


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 20), st.integers(1, 30), st.sampled_from([1, 7, 255, 2**20, 2**28]), st.integers(0, 99))
def test_lookups_give_inner_products(width, n, spread, seed):
    rng = np.random.default_rng(seed)
    vectors, anchors = (rng.integers(-spread, spread + 1, (k, width)) for k in (n, 3))
    planes = int(np.abs(vectors).max()).bit_length() + 1
    assert (full_scores(bit_planes(vectors, planes), subset_sums(anchors)) == vectors @ anchors.T).all()
    least = np.full((1, width), -(2 ** (planes - 1)))
    assert (full_scores(bit_planes(least, planes), subset_sums(anchors)) == least @ anchors.T).all()


def brute(rows, is_anchor, rule=Mining()):
    valid = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        whole = [int(np.floor(x * 256)) for x in v]
        valid[i] = min(valid.get(i, (label, whole)), (label, whole))
    score = lambda a, b: sum(x * y for x, y in zip(valid[a][1], valid[b][1]))  # noqa: E731, B905
    out = []
    for a in filter(is_anchor, valid):
        ranked = sorted((-score(a, i), i) for i in valid if i != a)
        positives = [(i, -s) for s, i in ranked if valid[i][0] == valid[a][0]][: rule.positives]
        others = [(i, -s) for s, i in ranked if valid[i][0] != valid[a][0]]
        for p, top in positives:
            fits = [(i, s) for i, s in others if rule.low * top <= 100 * s <= 100 * top]
            out += [(a, p, k, i, top, s) for k, (i, s) in enumerate(fits[: rule.negatives], 1)]
    return sorted(out)


KINDS = "vec_id long, embedding array<double>, label int"


def mined(spark, rows, **more):
    table = spark.createDataFrame(rows, KINDS).selectExpr("*", "'own' cell", "'own' kind", "1 v").repartition(5)
    return sorted(map(tuple, hard_negatives(table, F.col("vec_id") % 10 == 0, **more).collect()))


@pytest.mark.parametrize("size", [(hn.BLOCK, hn.PART), (30, 4)])
def test_query_equals_brute_force(spark, monkeypatch, size):
    monkeypatch.setattr(hn, "PIECE", 20)
    monkeypatch.setattr(hn, "ANCHORS", 3)
    rng = np.random.default_rng(5)
    centre = rng.normal(size=11)
    rows = [(i, (centre + rng.normal(size=11)).tolist(), int(rng.integers(0, 4))) for i in range(-20, 180)]
    # A third of all rows is one vector, of two labels.
    rows += [(i, [0.5] * 11, 1 + i % 2) for i in range(200, 300)]
    rows += [
        (300, None, 1), (301, [1.0, None], 1), (310, [float("nan")], 2), (320, [float("-inf")], 2),
        (330, [], 2), (340, [1.0, 2.0], 2), (350, [1.0], None), (None, [1.0], 1), (360, [9.0], 77),
        (370, [0.3] * 11, 3), (370, [0.2] * 11, 3), (370, [0.3] * 11, 1),
    ]
    got = mined(spark, rows, block=size[0], part=size[1])
    assert got == brute(rows, lambda i: i % 10 == 0)
    assert len(got) > 100 and not any(r[0] == 360 for r in got)


def test_other_rules_large_numbers_and_empty_tables(spark):
    rng = np.random.default_rng(6)
    rows = [(i, (rng.normal(size=5) * 1e4).tolist(), i % 3) for i in range(60)]
    rule = Mining(positives=2, negatives=3, low=10)
    assert mined(spark, rows, rule=rule) == brute(rows, lambda i: i % 10 == 0, rule)
    assert mined(spark, []) == []
    assert mined(spark, [(10, [1.0], 1)]) == []
    assert mined(spark, [(1, [1.0], 1), (2, [1.0], 1)]) == []
