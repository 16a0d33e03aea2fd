"""The corpus pipeline: from all documents to packed training sequences.

Each stage takes the documents that the one before kept, written and read again, and decides
over all of them. Defined results: documents with null or empty texts have no letter, so the
language stage rejects them, and it rejects texts that no learned language fits, but none for
that if no row has a language to learn from; both dedup stages decide by row, so rows without an
id, or with one that other texts have too, are compared like all others; rows that repeat id and
text become one; columns beyond those of documents are dropped, whatever their names; empty
tables pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.llm import queries
from tidecast.llm.common import prepare, staged, table
from tidecast.llm.exact_dedup import exact_dedup, normalised
from tidecast.llm.jaccard_join import near_duplicates

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model predicts to be toxic go."""
    scored = queries.toxicity(docs, table(spark, sf_dir, "labels"), COLUMNS)
    return scored.where("predicted = 0").select(COLUMNS)


# Clean documents fit with 2.6 and more (0.1 GB, 6000 rows); in a language that was left out of
# learning, nine of ten of another fit with less than 1.2.
LEAST_FIT = 1.5


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter go, and those that no learned language fits."""
    found = queries.languages(docs, COLUMNS)
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    # Without a fit (nothing learned, or a short text) nothing speaks against a document.
    return found.where(lettered & F.coalesce(F.col("fit") >= LEAST_FIT, F.lit(True))).select(COLUMNS)


def row_key(*columns: str) -> F.Column:
    """A number for a row's id, which may be null, and text."""
    return F.xxhash64("doc_id", *columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal normalised text, the one with the smallest id stays.

    The decision is carried by id and text: an id may be null, or stand with several texts.
    """
    kept = exact_dedup(docs).where("kept").select(row_key("digest").alias("row_key"), "digest").distinct()
    digest = F.unhex(F.sha2(normalised(F.col("text")), 256))
    named = docs.select(*COLUMNS).withColumn("digest", digest).withColumn("row_key", row_key("digest"))
    found = named.join(kept, ["row_key", "digest"], "left_semi")
    one = found.groupBy("row_key", "digest").agg(F.min(F.struct("doc_id", "text", *COLUMNS[2:])).alias("row"))
    return one.select("row.*")


def with_row_key(docs: DataFrame) -> DataFrame:
    """Adds ``row_key``: the id, or a number for id and text where the id is null or not unique.

    Few ids are like that, as a rule; Spark sees the size of their table before it joins.
    """
    several = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 or doc_id is null")
    several = staged(several.select(F.col("doc_id").alias("odd_id"), F.lit(True).alias("is_odd")), "odd-ids")
    found = docs.join(several, F.col("doc_id").eqNullSafe(F.col("odd_id")), "left")
    key = F.when(F.col("is_odd"), row_key("text")).otherwise(F.col("doc_id"))
    return found.select(*COLUMNS, key.alias("row_key"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by shared word shingles, the one with the smallest id stays.

    Rows are compared, whatever their ids; of linked rows, one without an id goes first.
    """
    named = with_row_key(docs.select(*COLUMNS))
    found = near_duplicates(named, queries.NEAR_COPIES, doc_id="row_key").select(
        F.col("doc_id").alias("row_key"), "component_id"
    )
    ranked = F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")
    best = (
        found.distinct()
        .join(named.select("row_key", "doc_id").distinct(), "row_key")
        .groupBy("component_id")
        .agg(F.min(ranked).alias("best"))
        .select(F.col("best.row_key").alias("row_key"))
    )
    return named.join(best, "row_key", "left_semi").dropDuplicates(["row_key"]).select(COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes in the training sequences."""
    return queries.packed(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", drop_unknown_language),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("best_fit_packing", pack_sequences),
]

# A trained score and a vocabulary have no SQL form; tests hold each stage against plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages one after another over the documents of a folder."""
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet").select(COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
