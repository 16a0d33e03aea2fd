"""Toxicity and language: accuracy on held-out rows, and edge cases."""

import random
import zlib

import numpy as np
import pyarrow as pa
from edges import EDGE_ROWS, edge_table, empty_table
from pyspark.sql import functions as F

from tidecast.llm import queries
from tidecast.llm.language import LanguageMixture, learn_languages, predict_languages, trigrams
from tidecast.llm.toxicity import (
    FactorizationMachine,
    FactorSettings,
    fit_toxicity,
    score_toxicity,
    term_buckets,
)

SF = "/root/testdata/sf0.01"


def fold(i, parts):
    return zlib.crc32(str(i).encode()) % parts


def test_pairs_equal_the_sum_over_all_pairs():
    rng = np.random.default_rng(0)
    model = FactorizationMachine(np.arange(30), FactorSettings(factors=3))
    model.weights, model.vectors = rng.normal(size=30), rng.normal(size=(30, 3))
    docs = [np.array([1, 5, 9]), np.array([], int), np.array([2]), np.arange(30)]
    doc = np.repeat(np.arange(4), [len(d) for d in docs])
    z, _ = model.sums(np.concatenate(docs), doc, 4)
    for d, got in zip(docs, z, strict=True):
        pairs = sum(model.vectors[i] @ model.vectors[j] for i in d for j in d if i < j)
        assert np.isclose(got, model.weights[d].sum() + pairs)


def test_machine_learns_what_only_a_pair_tells():
    """Either word alone is harmless, both together are not."""
    rnd = random.Random(1)
    docs, labels = [], []
    for _ in range(1200):
        a, b = rnd.random() < 0.5, rnd.random() < 0.5
        docs.append(np.array([1] * a + [2] * b + [3 + rnd.randrange(5)]))
        labels.append(a == b)
    model = FactorizationMachine(np.arange(8), FactorSettings(rate=0.2, epochs=20))
    model.fit(docs, np.array(labels, float))
    doc = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    right = (model.scores(doc, np.concatenate(docs), len(docs)) > 0.5) == np.array(labels)
    assert right.mean() > 0.95


def test_fit_learns_what_only_a_pair_tells(spark):
    """The rows of the test above as texts, through the choice of terms."""
    rnd = random.Random(1)
    rows = []
    for i in range(1200):
        a, b = rnd.random() < 0.5, rnd.random() < 0.5
        words = ["ab"] * a + ["cd"] * b + ["vwxyz"[rnd.randrange(5)]]
        rows.append((i, " ".join(words), int(a == b)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    settings = FactorSettings(rate=0.2, epochs=20)  # as above
    model = fit_toxicity(docs.drop("toxic"), docs.drop("text"), F.lit(True), settings)
    got = {r.doc_id: r.score for r in score_toxicity(docs, model, ["doc_id"]).collect()}
    assert np.mean([(got[i] > 0.5) == bool(y) for i, _, y in rows]) > 0.95


def test_terms_are_distinct_and_fold_case():
    doc, bucket = term_buckets(pa.array(["Idiot idiot", "IDIOT!", None, ""]))
    assert set(bucket[doc == 0]) == set(bucket[doc == 1]) and set(doc) == {0, 1}


def test_toxicity_on_held_out_rows(spark):
    got = {r.doc_id: r for r in queries.op2_toxicity(spark, SF).collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").where("toxic is not null").collect()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (fold(i, 4) == 2) for i, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    held = [(r.toxic, got[r.doc_id].predicted) for r in labels if got[r.doc_id].held_out]
    assert sum(p for y, p in held if y == 0) <= 1
    assert sum(p for y, p in held if y == 1) >= 0.5 * sum(y for y, _ in held)


def test_toxicity_edge_cases(spark):
    docs = edge_table(spark)
    labels = spark.createDataFrame(
        [(4, 1), (4, 0), (5, None), (None, 1), (99, 1)], "doc_id long, toxic int"
    )
    model = fit_toxicity(docs, labels, F.lit(True))
    scored = score_toxicity(docs, model, ["doc_id"]).collect()
    assert sorted(r.doc_id for r in scored) == [i for i, _ in EDGE_ROWS]
    assert all(0 <= r.score <= 1 for r in scored)
    none = fit_toxicity(docs, labels.where("false"), F.lit(True))
    assert none is None
    assert {r.score for r in score_toxicity(docs, none, ["doc_id"]).collect()} == {0.0}
    assert score_toxicity(empty_table(spark), model, ["doc_id"]).count() == 0


def test_language_on_held_out_rows(spark):
    got = {r.doc_id: r for r in queries.op3_language_id(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang", "text").collect()
    assert len(got) == len(docs)
    assert all(got[d.doc_id].held_out == (fold(d.doc_id, 3) == 1) for d in docs)
    held = [d for d in docs if got[d.doc_id].held_out and d.lang and d.text]
    assert np.mean([got[d.doc_id].lang_pred == d.lang for d in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in got.values())


def test_mixture_recovers_proportions():
    rng = np.random.default_rng(0)
    words = {"a": ["kato", "miru", "sane", "tolu"], "b": ["brx", "gwnth", "zzk", "pfl"], "c": ["éàü", "ôîû"]}
    counts = {}
    for lang, own in words.items():
        _, bucket = trigrams(pa.array([" ".join(rng.choice(own, 500))]))
        counts[lang] = np.bincount(bucket, minlength=1 << 14)
    mixture = LanguageMixture(counts)
    text = " ".join([*rng.choice(words["a"], 300), *rng.choice(words["b"], 100)])
    shares = mixture.proportions(pa.array([text, "kato miru", "", None]))
    assert shares[0, 2] == 0 and 0.1 < shares[0, 1] < 0.4 and np.isclose(shares[0].sum(), 1)
    assert shares[1].tolist() == [1, 0, 0] and not shares[2:].any()


def test_proportions_depend_on_the_text_alone():
    """One of the texts gains nothing from two languages, but from more, as others beside it do."""
    rng = np.random.default_rng(9)
    words = ["".join(rng.choice(list("abcdefgh"), 4)) for _ in range(12)]
    counts = {}
    for lang in "pqrs":
        text = " ".join(rng.choice(words, 200, p=rng.dirichlet(np.full(12, 0.3))))
        counts[lang] = np.bincount(trigrams(pa.array([text]))[1], minlength=1 << 14)
    texts = [" ".join(rng.choice(words, 60)) for _ in range(8)]
    mixture = LanguageMixture(counts)
    together = mixture.proportions(pa.array(texts))
    for text, shares in zip(texts, together, strict=True):
        assert np.allclose(mixture.proportions(pa.array([text]))[0], shares)


def test_language_edge_cases(spark):
    docs = edge_table(spark).withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "xx").otherwise(F.lit("yy")))
    counts = learn_languages(docs, F.lit(True))
    assert list(counts) == ["xx", "yy"]
    got = {r.doc_id: r for r in predict_languages(docs, counts, ["doc_id"]).collect()}
    for i, text in EDGE_ROWS:
        letter = any(c.isalpha() for c in text or "")
        assert (got[i].lang_pred != "und") == letter and 0 <= got[i].score <= 1
    nothing = learn_languages(docs.where("false"), F.lit(True))
    assert nothing == {}
    assert {r.lang_pred for r in predict_languages(docs, nothing, ["doc_id"]).collect()} == {"und"}
    assert predict_languages(empty_table(spark), counts, ["doc_id"]).count() == 0
