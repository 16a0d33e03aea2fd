"""Joins that stay safe when a key is hot or a lookup turns out large."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def dimension_join(
    facts: DataFrame, dimension: DataFrame, on: str | list[str], how: str = "inner"
) -> DataFrame:
    """Facts with a filtered dimension.

    No hint: AQE broadcasts the dimension once its measured bytes are below
    ``spark.sql.autoBroadcastJoinThreshold``, and joins by shuffle otherwise.
    """
    return facts.join(dimension, on, how)


def weights_by_reservation(preferred: DataFrame, fallback: DataFrame) -> DataFrame:
    """Collapse both score tables to one row per reservation, for J4.

    Joining a reservation with m preferred and n fallback rows gives max(m,1) * max(n,1)
    rows, whose discounts are then summed. That sum needs only counts and totals per table:

    * ``copies``: how many joined rows the reservation has;
    * ``kept``: sum over these rows of 1 - coalesce(preferred, fallback, 0).

    So repeated scores never multiply rows, and the tables are pre-aggregated before their
    shuffle. A reservation without any score row has one joined row and keeps all of it.
    """
    sides = (
        preferred.select(
            "hotelreservation_id",
            F.lit(1).alias("p_rows"),
            F.col("preferred"),
            F.lit(0).alias("f_rows"),
            F.lit(None).cast(fallback.schema["fallback"].dataType).alias("fallback"),
        )
        .unionByName(
            fallback.select(
                "hotelreservation_id",
                F.lit(0).alias("p_rows"),
                F.lit(None).cast(preferred.schema["preferred"].dataType).alias("preferred"),
                F.lit(1).alias("f_rows"),
                F.col("fallback"),
            )
        )
        .where(F.col("hotelreservation_id").isNotNull())
        .groupBy("hotelreservation_id")
        .agg(
            F.sum("p_rows").alias("p_rows"),
            F.count("preferred").alias("p_known"),
            F.coalesce(F.sum("preferred"), F.lit(0)).alias("p_sum"),
            F.sum("f_rows").alias("f_rows"),
            F.coalesce(F.sum("fallback"), F.lit(0)).alias("f_sum"),
        )
    )
    p_copies = F.greatest("p_rows", F.lit(1))
    f_copies = F.greatest("f_rows", F.lit(1))
    # Rows with a known preferred score use it in all their fallback copies; every other
    # row falls back, once per fallback row.
    kept = (F.col("p_known") - F.col("p_sum")) * f_copies + (p_copies - F.col("p_known")) * (
        f_copies - F.col("f_sum")
    )
    return sides.select(
        "hotelreservation_id", (p_copies * f_copies).alias("copies"), kept.alias("kept")
    )


def with_reservation_key(df: DataFrame, column: str = "hotelreservation_id") -> DataFrame:
    """Add the hash of the id as a second join key.

    A lookup that was just grouped by id is already partitioned by id, and Spark would join
    it without another exchange; AQE can only split a hot partition when both sides come
    straight from an exchange. The second key makes it so. The lookup side is narrow, so
    the extra exchange is cheap next to one task that holds a third of all reservations.
    """
    return df.withColumn("id_hash", F.xxhash64(column))


def left_join_on_reservation(reservations: DataFrame, lookup: DataFrame) -> DataFrame:
    """Left join on the reservation id with a lookup that has one row per id."""
    return with_reservation_key(reservations).join(
        with_reservation_key(lookup), ["hotelreservation_id", "id_hash"], "left"
    ).drop("id_hash")


def score_fallback_join(
    reservations: DataFrame, preferred: DataFrame, fallback: DataFrame
) -> DataFrame:
    """J4 + M2: reservations with ``copies`` and ``kept`` (see above), never NULL."""
    joined = left_join_on_reservation(reservations, weights_by_reservation(preferred, fallback))
    return joined.withColumns(
        {
            "copies": F.coalesce("copies", F.lit(1)),
            "kept": F.coalesce("kept", F.lit(1)),
        }
    )


def existence_counts(lookup: DataFrame, column: str = "hotelreservation_id") -> DataFrame:
    """How often each id occurs in a lookup that is joined only to test existence."""
    return (
        lookup.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("copies"))
    )


def inner_join_counted(reservations: DataFrame, lookup: DataFrame) -> DataFrame:
    """Inner join with a lookup; repeated lookup rows become the ``copies`` column."""
    return with_reservation_key(reservations).join(
        with_reservation_key(existence_counts(lookup)), ["hotelreservation_id", "id_hash"]
    ).drop("id_hash")


def null_key_side(keys: list[str], side: str) -> Column:
    """Group label that keeps the two sides of an outer join apart where a key is NULL.

    A full outer join whose sides are unique per key, followed by sums, equals a union
    followed by one grouping: only rows with a NULL key must not meet.
    """
    any_null = F.lit(False)
    for key in keys:
        any_null = any_null | F.col(key).isNull()
    return F.when(any_null, side).otherwise("")
