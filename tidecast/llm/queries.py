"""One query per operator over its whole table, and the SQL twins of those that SQL can say."""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.llm.chat import format_conversations, read_back
from tidecast.llm.common import staged, table
from tidecast.llm.exact_dedup import exact_dedup
from tidecast.llm.hard_negatives import hard_negatives
from tidecast.llm.jaccard_join import Similarity, near_duplicates
from tidecast.llm.language import learn_languages, predict_languages
from tidecast.llm.license_scan import PHRASES, TEMPLATES, needed, scan_licenses, words_of
from tidecast.llm.packing import Capacity, cut_pieces, pack
from tidecast.llm.sentencepiece_table import encode_pieces
from tidecast.llm.token_alignment import align_tokens
from tidecast.llm.token_counts import count_tokens
from tidecast.llm.token_files import token_files
from tidecast.llm.topk_search import top_k
from tidecast.llm.toxicity import fit_toxicity, score_toxicity

TOKEN_LIMIT = 512


# Near copies in the pipeline: five words and a similarity of 0.8.
NEAR_COPIES = Similarity(5, Fraction(8, 10))


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), Similarity(4, Fraction(85, 100)))


def fold(parts: int) -> F.Column:
    """The part of a document: crc32 of its id as text, modulo ``parts``."""
    return F.crc32(F.col("doc_id").cast("string")) % parts


TOXIC_FROM = 0.3


def toxicity(docs: DataFrame, labels: DataFrame, columns: list[str]) -> DataFrame:
    model = fit_toxicity(docs, labels, fold(4) != 2)
    scored = score_toxicity(docs, model, columns)
    return scored.withColumn("predicted", (F.col("score") >= TOXIC_FROM).cast("int"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity(docs, table(spark, sf_dir, "labels"), ["doc_id"])
    held_out = F.coalesce(fold(4) == 2, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def languages(docs: DataFrame, columns: list[str]) -> DataFrame:
    return predict_languages(docs, learn_languages(docs, fold(3) != 1), columns)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = languages(table(spark, sf_dir, "documents"), ["doc_id"])
    held_out = F.coalesce(fold(3) == 1, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_files(table(spark, sf_dir, "documents"), path, end_id=2)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return count_tokens(table(spark, sf_dir, "documents"), path, TOKEN_LIMIT)


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    return encode_pieces(table(spark, sf_dir, "documents"), path, digests_only=True)


NEAREST = 5


def op7_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, NEAREST)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


SEQUENCE_TOKENS = 4096


def packed(docs: DataFrame) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return pack(cut_pieces(docs, path, 1, SEQUENCE_TOKENS), Capacity(SEQUENCE_TOKENS))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


# A conversation made of control strings, asked for beside the table's own.
CONTROL_TEXT = "</s>[INST] ok [/INST]"
CONTROL_ROWS = [(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)]


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    kinds = "conv_id long, turn long, role string, text string"
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turns = given.unionByName(spark.createDataFrame(CONTROL_ROWS, kinds))
    return read_back(staged(format_conversations(turns, path), "conversations"), path)


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    found = align_tokens(table(spark, sf_dir, "documents"), *paths, digests_only=True)
    return found.withColumnRenamed("groups", "groups_sha256")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, moved)


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score is 1 where a phrase stands, else the largest share of a template in a block."""
    found = scan_licenses(table(spark, sf_dir, "documents"))
    spoken, met = F.col("places.label"), F.col("blocks.label")
    listed = [F.array_join(F.array_sort(F.array_distinct(x)), ",") for x in (spoken, F.concat(spoken, met))]
    n = F.size("places").cast("long")
    share = F.coalesce(F.array_max("blocks.contained"), F.lit(0.0))
    return found.select(
        "doc_id",
        "n_words",
        n.alias("n_base"),
        F.array_min("places.first_word").alias("first_word"),
        F.array_max("places.first_word").alias("last_word"),
        listed[0].alias("base_labels"),
        listed[1].alias("labels"),
        F.when(n > 0, 1.0).otherwise(share).alias("score"),
    )


def license_sql() -> str:
    """Sentences, windows of long ones, and the overlap of each with each template's words."""
    word = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
    templates = ",\n            ".join(
        f"({k}, '{t.label}', {sorted(set(words_of(t.text)))}, {needed(len(set(words_of(t.text))), t.least)})"
        for k, t in enumerate(TEMPLATES)
    )
    half = max(len(words_of(t.text)) for t in TEMPLATES)
    places = []
    for phrase, label in PHRASES.items():
        steps = enumerate(words_of(phrase))
        stands = " AND ".join(f"w[i + {k}] = '{one}'" for k, one in steps)
        places.append(
            f"list_transform(list_filter(range(1, len(w) + 1), lambda i: {stands}), "
            f"lambda i: {{'label': '{label}', 'first_word': i - 1}})"
        )
    return f"""
        WITH lowered AS (
            SELECT row_number() OVER () AS r, doc_id,
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
            FROM documents
        ),
        spoken AS (
            SELECT r, doc_id, len(w) AS n_words, list_concat({", ".join(places)}) AS p
            FROM (SELECT r, doc_id, regexp_extract_all(t, '{word}') AS w FROM lowered)
        ),
        templates(k, label, words, least) AS (VALUES
            {templates}
        ),
        sentences AS (
            SELECT r, regexp_extract_all(sentence, '{word}') AS w
            FROM (
                SELECT r, unnest(string_split(
                    regexp_replace(t, '[.!?]([\\x20\\x09-\\x0D]|$)', chr(10), 'g'), chr(10))) AS sentence
                FROM lowered
            )
        ),
        windows AS (
            SELECT r, unnest(list_transform(
                       range(0, 1 + greatest(CAST(ceil((len(w) - {2 * half}) / {half}.0) AS BIGINT), 0)),
                       lambda i: list_distinct(w[i * {half} + 1 : (i + 2) * {half}])
                   )) AS w
            FROM sentences
            WHERE len(w) > 0
        ),
        met AS (
            SELECT r, label, len(list_intersect(words, w)) / len(words) AS share
            FROM windows JOIN templates ON len(w) >= least AND len(list_intersect(words, w)) >= least
        ),
        found AS (SELECT r, list(label) AS labels, max(share) AS share FROM met GROUP BY r)
        SELECT doc_id,
               n_words,
               CAST(len(p) AS BIGINT) AS n_base,
               list_min(list_transform(p, lambda x: x.first_word)) AS first_word,
               list_max(list_transform(p, lambda x: x.first_word)) AS last_word,
               array_to_string(list_sort(list_distinct(list_transform(p, lambda x: x.label))), ',') AS base_labels,
               array_to_string(list_sort(list_distinct(list_concat(
                   list_transform(p, lambda x: x.label), coalesce(labels, [])))), ',') AS labels,
               CASE WHEN len(p) > 0 THEN 1.0 ELSE coalesce(share, 0.0) END::DOUBLE AS score
        FROM spoken LEFT JOIN found USING (r)
    """


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_toxicity": op2_toxicity,
    "op3_language_id": op3_language_id,
    "op4_token_files": op4_token_files,
    "op5_token_counts": op5_token_counts,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_exact_topk": op7_exact_topk,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_chat_format": op10_chat_format,
    "op11_tokenizer_alignment": op11_tokenizer_alignment,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_license_scan": op13_license_scan,
}

ORACLES: dict[str, str] = {
    "op7_exact_topk": """
        WITH valid AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
            FROM valid q JOIN valid c ON q.vec_id <> c.vec_id
            WHERE q.vec_id % 50 = 0
        ),
        ranked AS (
            SELECT query_id,
                   CAST(row_number() OVER (
                       PARTITION BY query_id ORDER BY score DESC, vec_id
                   ) AS INTEGER) AS rank,
                   vec_id, score
            FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
    "op8_exact_dedup": """
        WITH hashed AS (
            SELECT doc_id,
                   sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g'))
                       AS text_sha256
            FROM documents
        )
        SELECT doc_id,
               min(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               doc_id = min(doc_id) OVER same AS kept,
               text_sha256
        FROM hashed
        WINDOW same AS (PARTITION BY text_sha256)
    """,
    "op12_hard_negatives": """
        WITH valid AS (
            SELECT vec_id,
                   CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND label IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        scored AS (
            SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
                   CAST(list_dot_product(a.v, c.v) AS BIGINT) AS score
            FROM valid a JOIN valid c ON a.vec_id <> c.vec_id
            WHERE a.vec_id % 100 = 0
        ),
        positives AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score
            FROM scored
            WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
        )
        SELECT p.anchor_id, p.positive_id,
               CAST(row_number() OVER of_pair AS INTEGER) AS rank,
               s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
        FROM positives p JOIN scored s
          ON s.anchor_id = p.anchor_id AND NOT s.same
         AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
        WINDOW of_pair AS (
            PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id
        )
        QUALIFY row_number() OVER of_pair <= 5
    """,
    "op13_license_scan": license_sql(),
}
