"""Hyper-parameter space, its random sample, and the list of fits a search has to do."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

# --- Fixed values ---------------------------------------------------------------------
GROWTHS = ["linear", "logistic"]
PRIOR_SCALE_FIRST, PRIOR_SCALE_STEP, PRIOR_SCALES = 0.001, 0.003, 200
CHANGEPOINTS_FIRST, CHANGEPOINTS = 15, 25
MODES = ["multiplicative", "additive"]
RANGE_FIRST, RANGE_LAST, RANGES = 0.8, 0.99, 20
N_ITER = 30
SEARCH_SEED = 1234
# --------------------------------------------------------------------------------------

# Tasks that share the sets of one fold.
SET_BUCKETS = 8

SPACE_SIZE = len(GROWTHS) * PRIOR_SCALES * CHANGEPOINTS * len(MODES) * RANGES
PARAM_FIELDS = [
    "growth",
    "changepoint_prior_scale",
    "n_changepoints",
    "seasonality_mode",
    "changepoint_range",
]


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def param_space(spark: SparkSession) -> DataFrame:
    """C4: every parameter set, numbered; the number's digits select the five values."""
    number = F.col("space_id")
    sizes = [len(GROWTHS), PRIOR_SCALES, CHANGEPOINTS, len(MODES), RANGES]
    digits = []
    for place, size in enumerate(sizes):
        below = reduce(lambda a, b: a * b, sizes[place + 1 :], 1)
        digits.append(F.floor(number / below) % size)
    growth, scale, points, mode, where = digits
    step = (RANGE_LAST - RANGE_FIRST) / (RANGES - 1)
    return spark.range(SPACE_SIZE).select(
        F.col("id").alias("space_id")
    ).select(
        "space_id",
        _pick(GROWTHS, growth).alias("growth"),
        F.round(PRIOR_SCALE_FIRST + scale * PRIOR_SCALE_STEP, 3).alias("changepoint_prior_scale"),
        (CHANGEPOINTS_FIRST + points).cast("int").alias("n_changepoints"),
        _pick(MODES, mode).alias("seasonality_mode"),
        F.round(RANGE_FIRST + where * step, 6).alias("changepoint_range"),
    )


def sample_params(
    space: DataFrame, n_iter: int = N_ITER, seed: int = SEARCH_SEED
) -> DataFrame:
    """``n_iter`` sets without replacement, by a seeded hash; numbered from 0.

    The limit runs as a distributed top-k, so the numbering sees ``n_iter`` rows only.
    """
    draw = F.md5(F.concat(F.lit(f"{seed}:"), F.col("space_id").cast("string")))
    drawn = space.withColumn("draw", draw).orderBy("draw").limit(n_iter)
    number = F.row_number().over(Window.orderBy("draw")) - 1
    return drawn.withColumn("param_id", number).drop("draw")


def set_buckets() -> Column:
    """The numbers of all set buckets, to be exploded."""
    return F.sequence(F.lit(0), F.lit(SET_BUCKETS - 1))


def work_list(folds: DataFrame, params: DataFrame) -> DataFrame:
    """Every parameter set that ``params`` holds, for every fold.

    Sets are dealt into buckets by number; each fold meets each bucket. ``set_bucket`` stays,
    so that fits can be spread by it. The search budget bounds the sets, so they may be
    broadcast.
    """
    dealt = params.withColumn("set_bucket", F.pmod("param_id", F.lit(SET_BUCKETS)).cast("int"))
    spread = folds.withColumn("set_bucket", F.explode(set_buckets()))
    return spread.join(F.broadcast(dealt), "set_bucket")
