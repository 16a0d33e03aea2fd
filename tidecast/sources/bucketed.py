"""Reservations and their scores laid out for a join without a shuffle.

All tables are bucketed and sorted by reservation id into the same number of buckets, so grouping
scores by id and joining them with reservations happen inside a bucket. A bucket cannot be split
afterwards, so rows of ids that many rows share do not go there: the writer counts rows per id
and puts those of hot ids into a table beside it, dealt out evenly. Their scores, of few ids, are
joined with them by a join that Spark may broadcast after measuring it, or split.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

ID = "hotelreservation_id"
# Rows of one id from which on it is hot. The ids beyond it are at most rows / HOT_ROWS.
BUCKETS, HOT_ROWS = 64, 100_000


@dataclass(frozen=True)
class BucketedTable:
    """A table of rows by id, and one of the rows of hot ids."""

    spark: SparkSession
    name: str
    buckets: int = BUCKETS

    @property
    def hot_name(self) -> str:
        return f"{self.name}_hot"

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def hot_rows(self) -> DataFrame:
        return self.spark.table(self.hot_name)

    def every_row(self) -> DataFrame:
        return self.rows().unionByName(self.hot_rows())


def write_bucketed(
    df: DataFrame, name: str, id_column: str, buckets: int = BUCKETS, hot_rows: int = HOT_ROWS
) -> BucketedTable:
    """Write a table by reservation id, kept as text under one name in all tables.

    Rows without an id join with nothing; they are dealt out with those of hot ids.
    """
    rows = df.withColumn(id_column, F.col(id_column).cast("string")).withColumnRenamed(id_column, ID)
    counts = rows.groupBy(ID).agg(F.count(F.lit(1)).alias("n_rows"))
    hot = counts.where((F.col("n_rows") >= hot_rows) | F.col(ID).isNull()).select(F.col(ID).alias("hot_id"))
    same = F.col(ID).eqNullSafe(F.col("hot_id"))
    apart = rows.join(hot, same, "left_semi")
    (
        rows.join(hot, same, "left_anti")
        .repartition(buckets, ID)
        .sortWithinPartitions(ID)
        .write.mode("overwrite")
        .format("parquet")
        .bucketBy(buckets, ID)
        .sortBy(ID)
        .saveAsTable(name)
    )
    table = BucketedTable(df.sparkSession, name, buckets)
    apart.write.mode("overwrite").format("parquet").saveAsTable(table.hot_name)
    return table


def _counted(scores: DataFrame, value: str, prefix: str) -> DataFrame:
    """Rows, known values and their sum per id."""
    return (
        scores.where(F.col(ID).isNotNull())
        .groupBy(ID)
        .agg(
            F.count(F.lit(1)).alias(f"{prefix}_rows"),
            F.count(value).alias(f"{prefix}_known"),
            F.sum(value).alias(f"{prefix}_sum"),
        )
    )


def _with_weights(reservations: DataFrame, preferred: DataFrame, fallback: DataFrame) -> DataFrame:
    """``copies`` and ``kept`` as ``operators.joins.weights_by_reservation`` defines them."""
    joined = reservations.join(_counted(preferred, "preferred", "p"), ID, "left").join(
        _counted(fallback, "fallback", "f"), ID, "left"
    )
    zero = F.lit(0)
    p_rows, f_rows, p_known = (F.coalesce(c, zero) for c in ("p_rows", "f_rows", "p_known"))
    p_sum, f_sum = (F.coalesce(c, zero) for c in ("p_sum", "f_sum"))
    p_copies, f_copies = F.greatest(p_rows, F.lit(1)), F.greatest(f_rows, F.lit(1))
    kept = (p_known - p_sum) * f_copies + (p_copies - p_known) * (f_copies - f_sum)
    return joined.withColumns({"copies": p_copies * f_copies, "kept": kept}).drop(
        *[f"{p}_{c}" for p in "pf" for c in ("rows", "known", "sum")]
    )


def bucketed_score_join(
    reservations: BucketedTable, preferred: BucketedTable, fallback: BucketedTable
) -> DataFrame:
    """J4 + M2 on bucketed tables: reservations with ``copies`` and ``kept``, never NULL.

    ``preferred`` and ``fallback`` carry a column of that name. An id may be hot in any of the
    three tables: rows of ids that are hot in one of the score tables leave the bucketed path
    too, so each reservation finds all its scores.
    """
    if len({reservations.buckets, preferred.buckets, fallback.buckets}) != 1:
        raise ValueError("the tables must have the same number of buckets")
    scores = (preferred, fallback)
    # As many as hot ids, a short list by the writer's bound; Spark measures it itself.
    hot = reservations.hot_rows().select(ID)
    for table in scores:
        hot = hot.union(table.hot_rows().select(ID))
    hot = hot.where(F.col(ID).isNotNull()).distinct()
    hot_scores = [t.every_row().join(hot, ID, "left_semi") for t in scores]
    score_hot = scores[0].hot_rows().select(ID).union(scores[1].hot_rows().select(ID)).distinct()
    # The ids are dealt into the buckets; the reservations stay where they are.
    cold = reservations.rows().join(score_hot, ID, "left_anti")
    moved = reservations.rows().join(score_hot, ID, "left_semi")
    main = _with_weights(cold, *[t.rows() for t in scores])
    beside = _with_weights(reservations.hot_rows().unionByName(moved), *hot_scores)
    return main.unionByName(beside)
