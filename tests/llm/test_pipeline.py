"""The corpus pipeline's stages against plain Python, and the registered queries."""

import re
from fractions import Fraction

import corpus_pipeline
import pytest
from edges import EDGE_ROWS, edge_table
from pyspark.sql import functions as F
from test_duplicates import by_force, copies, normalised

import __spark_entry__ as entry
from tidecast.llm import queries
from tidecast.llm.jaccard_join import Similarity

SF = "/root/testdata/sf0.001"


def documents(spark, texts):
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stages_in_order():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "language_id", "exact_dedup", "ngram_jaccard_join", "best_fit_packing"]


def test_dedup_stages_keep_the_smallest_of_each_group(spark):
    texts = [t for _, t in EDGE_ROWS] + copies(5) + copies(5)[:20]
    docs = documents(spark, texts)
    kept = corpus_pipeline.drop_copies(spark, docs, SF)
    first = {}
    for i, t in enumerate(texts):
        first.setdefault(normalised(t), i)
    assert ids(kept) == sorted(first.values()) and kept.columns == corpus_pipeline.COLUMNS
    rest = [(i, texts[i]) for i in sorted(first.values())]
    near = corpus_pipeline.drop_near_copies(spark, kept, SF)
    want = by_force(rest, Similarity(5, Fraction(8, 10)))
    assert ids(near) == sorted(i for i, (_, top) in want.items() if i == top)
    assert near.columns == corpus_pipeline.COLUMNS


COPY = "one text of seven words and more " * 3


@pytest.mark.parametrize("turn", [1, -1])
def test_rows_without_an_id_or_with_a_shared_one_are_compared(spark, turn):
    rows = [(1, COPY), (None, COPY), (None, "other"), (5, COPY), (5, "another"), (8, "x y"), (8, "x  y"), (8, "x y")]
    docs = spark.createDataFrame(
        [(i, t, "en", "s", 1) for i, t in rows[::turn]], "doc_id long, text string, lang string, source string, n_chars long"
    )
    kept = corpus_pipeline.drop_copies(spark, docs, SF)
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert got == sorted([(1, COPY), (None, "other"), (5, "another"), (8, "x  y")], key=str)
    near = [(None, COPY + "end"), (5, "end " + COPY), (3, COPY), (5, "another"), (None, "other")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in near[::turn]], docs.schema)
    kept = corpus_pipeline.drop_near_copies(spark, docs, SF)
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert got == sorted([(3, COPY), (5, "another"), (None, "other")], key=str)


def test_language_stage_drops_only_texts_without_a_letter(spark):
    docs = documents(spark, [t for _, t in EDGE_ROWS]).withColumn("score", F.lit(1))
    kept = corpus_pipeline.drop_unknown_language(spark, docs, SF)
    assert ids(kept) == [i for i, t in EDGE_ROWS if re.search(r"[^\W\d_]", t or "")]
    assert kept.columns == corpus_pipeline.COLUMNS


def test_language_stage_keeps_an_unlabelled_corpus(spark):
    docs = documents(spark, [t for _, t in EDGE_ROWS]).withColumn("lang", F.lit(None).cast("string"))
    kept = corpus_pipeline.drop_unknown_language(spark, docs, SF)
    assert ids(kept) == [i for i, t in EDGE_ROWS if re.search(r"[^\W\d_]", t or "")]


def test_language_stage_drops_what_no_learned_language_fits(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(corpus_pipeline.COLUMNS)
    foreign = "на дворе трава на траве дрова не руби дрова на траве двора " * 5
    rows = [(-1, foreign, None, "s", len(foreign)), (-2, "ok да", None, "s", 5)]
    kept = corpus_pipeline.drop_unknown_language(
        spark, docs.unionByName(spark.createDataFrame(rows, docs.schema)), SF
    )
    lettered = docs.where(F.col("text").rlike(r"\p{L}"))
    assert ids(kept) == sorted([-2, *ids(lettered)])


def test_toxic_stage_follows_the_scores(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = corpus_pipeline.drop_toxic(spark, docs, SF)
    scored = queries.op2_toxicity(spark, SF).where("predicted = 0")
    assert ids(kept) == ids(scored)


def test_pipeline_runs_and_packs_what_is_left(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
    assert {r.doc_id for r in rows} == set(ids(docs))
    empty = docs.where("false")
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF)
        assert empty.count() == 0
        if "text" not in empty.columns:
            break


def test_all_queries_are_registered():
    names = entry.queries()
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names


def test_edge_rows_survive_the_packing_stage(spark):
    docs = edge_table(spark).select("doc_id", "text")
    assert set(ids(corpus_pipeline.pack_sequences(spark, docs, SF))) == {i for i, _ in EDGE_ROWS}
