"""Exact dedup against a persistent digest index, with DataFrame operations only.

The index is a table bucketed and sorted by digest. New rows are hashed, reduced to one row
per digest (combined before the shuffle, so a text that a third of the rows share costs one
row per task), kept if a sort-merge anti-join finds their digest nowhere in the index, and
appended. Since both sides of that join are hashed by digest into the index's buckets, the
index itself is never shuffled.

Defined results: null texts count as empty; texts are equal after each run of
``[\\x20\\x09-\\x0D]`` became one space. Of equal texts the smallest id stays (a null id only
if there is no other; of rows that repeat the id, each is reported with the same decision).
An empty table gives no rows. Other columns are left alone, whatever their names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.llm.common import new_folder, remember, staged

SPACES = r"[\x20\x09-\x0D]+"
# Buckets of a new index: enough for so many rows each of the first batch, and not fewer.
BUCKETS, BUCKET_ROWS = 64, 1 << 20


def normalised(text) -> F.Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def digests(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, digest): the SHA-256 of each normalised text as 32 bytes."""
    digest = F.unhex(F.sha2(normalised(F.col(text)), 256))
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), digest.alias("digest"))


class DigestIndex:
    """Digests seen so far: a table of (digest, keep_id), bucketed and sorted by digest."""

    def __init__(self, spark: SparkSession, table: str, buckets: int = BUCKETS):
        self.spark, self.table, self.buckets = spark, table, buckets

    @classmethod
    def create(
        cls, spark: SparkSession, table: str | None = None, folder: str | None = None,
        buckets: int = BUCKETS,
    ) -> DigestIndex:
        """A new index, or the one whose files are in ``folder`` from an earlier session."""
        table = table or remember(spark, "table", f"digest_index_{uuid.uuid4().hex[:12]}")
        folder = folder or new_folder(spark, "digest-index")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} (digest BINARY, keep_id BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{folder}'"
        )
        return cls(spark, table, buckets)

    def rows(self) -> DataFrame:
        """All entries, also those that another handle has appended since."""
        self.spark.catalog.refreshTable(self.table)
        return self.spark.table(self.table)

    def append(self, found: DataFrame) -> DataFrame:
        """Add the digests that are not in the index yet; returns those added, staged."""
        first = found.groupBy("digest").agg(F.min("doc_id").alias("keep_id"))
        index = self.rows().select("digest")
        fresh = staged(
            first.hint("merge").join(index.hint("merge"), "digest", "left_anti"), "new-digests"
        )
        (
            fresh.repartition(self.buckets, "digest")
            .sortWithinPartitions("digest")
            .write.mode("append")
            .format("parquet")
            .bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .saveAsTable(self.table)
        )
        return fresh


def exact_dedup(
    docs: DataFrame, index: DigestIndex | None = None, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, in_index, digest.

    ``keep_id`` is the document that stays for this text: one of an earlier batch when
    ``in_index`` is true, then no row of this batch is kept. ``group_size`` counts the rows of
    this batch with the text. A given index is extended by the texts that are new.
    """
    spark = docs.sparkSession
    found = staged(digests(docs, text, doc_id), "digests")
    index = index or DigestIndex.create(spark, buckets=max(BUCKETS, -(-found.count() // BUCKET_ROWS)))
    fresh = index.append(found).select("digest", F.lit(False).alias("in_index"))
    groups = found.groupBy("digest").agg(F.count("*").alias("group_size"))
    known = (
        groups.join(index.rows(), "digest")
        .join(fresh, "digest", "left")
        .withColumn("in_index", F.coalesce("in_index", F.lit(True)))
    )
    # The further key makes Spark deal out both sides anew, so that it can split the rows of a
    # text that very many documents have.
    by_text = ["digest", "digest_key"]
    found, known = (df.withColumn("digest_key", F.xxhash64("digest")) for df in (found, known))
    return (
        found.join(known, by_text)
        .withColumn("kept", ~F.col("in_index") & F.col("doc_id").eqNullSafe(F.col("keep_id")))
        .select("doc_id", "keep_id", "group_size", "kept", "in_index", "digest")
    )
