"""Exact dedup and the Jaccard join against plain Python."""

import hashlib
import itertools
import random
import re
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
from edges import EDGE_ROWS, edge_table, empty_table
from pyspark.sql import functions as F

from tidecast.llm.components import components
from tidecast.llm.exact_dedup import DigestIndex, exact_dedup
from tidecast.llm.jaccard_join import Similarity, bands, near_duplicates, sketch_keys


def normalised(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_exact_dedup_equals_plain_python(spark):
    groups = defaultdict(list)
    for i, text in EDGE_ROWS:
        groups[normalised(text)].append(i)
    want = sorted(
        (i, min(g), len(g), i == min(g), hashlib.sha256(text.encode()).hexdigest())
        for text, g in groups.items()
        for i in g
    )
    got = exact_dedup(edge_table(spark)).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest"))
    )
    assert sorted(map(tuple, got.collect())) == want


def test_exact_dedup_of_nothing_and_of_rows_without_id(spark):
    assert exact_dedup(empty_table(spark)).count() == 0
    rows = spark.createDataFrame([(None, "a"), (3, "a"), (None, "b")], "doc_id long, text string")
    got = {(r.doc_id, r.keep_id, r.kept) for r in exact_dedup(rows).collect()}
    assert got == {(None, 3, False), (3, 3, True), (None, None, True)}


def test_index_persists_and_new_batches_are_deduplicated(spark, tmp_path):
    folder = f"file://{tmp_path}/index"
    index = DigestIndex.create(spark, folder=folder, buckets=4)
    first = spark.createDataFrame([(5, "a"), (6, "b b")], "doc_id long, text string")
    assert exact_dedup(first, index).where("kept").count() == 2
    again = DigestIndex.create(spark, folder=folder, buckets=4)
    second = spark.createDataFrame([(1, "b  b"), (2, "c"), (3, "c")], "doc_id long, text string")
    got = {r.doc_id: (r.keep_id, r.kept, r.in_index) for r in exact_dedup(second, again).collect()}
    assert got == {1: (6, False, True), 2: (2, True, False), 3: (2, False, False)}
    assert index.rows().count() == 3


def test_index_join_does_not_shuffle_the_index(spark):
    index = DigestIndex.create(spark, buckets=4)
    exact_dedup(spark.createDataFrame([(1, "a")], "doc_id long, text string"), index)
    other = spark.createDataFrame([(b"x",)], "digest binary").repartition(4, "digest")
    plan = other.hint("merge").join(index.rows().hint("merge"), "digest", "left_anti")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and "SortMergeJoin" in text


def shingles(text, words):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(found) < words:
        return frozenset([tuple(found)] if found else [])
    return frozenset(tuple(found[i : i + words]) for i in range(len(found) - words + 1))


def by_force(docs, similarity):
    sets = {i: shingles(t, similarity.words) for i, t in docs}
    group = {i: i for i in sets}

    def top(x):
        while group[x] != x:
            x = group[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and similarity.linked(len(x & y), len(x) + len(y)):
            a, b = sorted((top(a), top(b)))
            group[b] = a
    return {i: (len(s), top(i)) for i, s in sets.items()}


def copies(seed):
    """Groups of near copies, and many documents around one passage."""
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = rnd.choices(vocabulary, k=60)
    docs = []
    for size, n in ((1, 2), (2, 3), (4, 3), (9, 6), (30, 10), (80, 30), (250, 8), (700, 4)) * 2:
        base = rnd.choices(vocabulary, k=size)
        for _ in range(n):
            words = list(base)
            for _ in range(rnd.randrange(size // 25 + 2)):
                words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
            docs.append(" ".join(words))
    docs += [" ".join(passage + rnd.choices(vocabulary, k=rnd.randrange(1, 25))) for _ in range(60)]
    rnd.shuffle(docs)
    return docs


@pytest.mark.parametrize(
    "similarity", [Similarity(4, Fraction(85, 100)), Similarity(5, Fraction(8, 10))]
)
def test_near_duplicates_equal_brute_force(spark, similarity):
    texts = [t for _, t in EDGE_ROWS] + copies(similarity.words)
    docs = list(enumerate(texts))
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    table = table.withColumns({"key": F.lit(1), "leader": F.lit("x"), "a": F.lit(2), "n": F.lit(3)})
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(table, similarity).collect()}
    assert got == by_force(docs, similarity)


@pytest.mark.parametrize("block", [512, 8])
def test_every_link_is_counted_also_inside_components(spark, monkeypatch, block):
    """A chain of near copies, copies of them, and many texts around one passage."""
    from tidecast.llm import jaccard_join as module

    monkeypatch.setattr(module, "BLOCK", block)
    similarity = Similarity(4, Fraction(85, 100))
    words = [f"w{i}" for i in range(120)]
    texts = [" ".join(words[i : i + 100]) for i in range(12)]
    docs = list(enumerate(texts + texts[3:5] + [texts[0].upper()] + ["a b", "a b", None, " "] + copies(3)))
    sets = {i: shingles(t, 4) for i, t in docs}
    linked = {
        i: [j for j, y in sets.items() if j != i and x and y and similarity.linked(len(x & y), len(x) + len(y))]
        for i, x in sets.items()
    }
    want = {i: (len(js), len({sets[j] for j in js} - {sets[i]})) for i, js in linked.items()}
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_links, r.n_verified_links) for r in near_duplicates(table, similarity).collect()}
    assert got == want
    # Texts of one component that are linked with some of it only.
    assert {want[0][0], want[11][0]} == {10, 8}


def test_links_of_a_large_group_do_not_become_rows(spark, monkeypatch):
    """Of 300 near copies most pairs are linked; what tasks hand on grows with the copies."""
    from tidecast.llm import jaccard_join as module

    made = []
    staged = module.staged

    def counted(df, name):
        out = staged(df, name)
        made.append((name, out.count()))
        return out

    monkeypatch.setattr(module, "staged", counted)
    similarity = Similarity(4, Fraction(85, 100))
    rnd = random.Random(5)
    base = [f"w{i}" for i in range(400)]
    docs = []
    for i in range(300):
        words = list(base)
        for k in range(i % 5 + 1):
            words[rnd.randrange(len(words))] = f"own{i}.{k}"
        docs.append((i, " ".join(words)))
    sets = {i: shingles(t, 4) for i, t in docs}
    linked = dict.fromkeys(sets, 0)
    for a, b in itertools.combinations(sets, 2):
        if similarity.linked(len(sets[a] & sets[b]), len(sets[a]) + len(sets[b])):
            linked[a] += 1
            linked[b] += 1
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_links, r.component_id) for r in near_duplicates(table, similarity).collect()}
    assert got == {i: (n, 0) for i, n in linked.items()}
    assert sum(linked.values()) / 2 > 25_000
    # Keys that several sets have are as many as a set has, whatever the group.
    assert max(n for name, n in made if name != "shared-keys") < 6_000


def test_near_duplicates_of_nothing_and_without_ids(spark):
    similarity = Similarity(4, Fraction(85, 100))
    assert near_duplicates(empty_table(spark), similarity).count() == 0
    rows = spark.createDataFrame(
        [(None, "a b c d e"), (2, "a b c d e"), (2, "a b c d e")], "doc_id long, text string"
    )
    got = sorted((str(r.doc_id), r.component_id) for r in near_duplicates(rows, similarity).collect())
    assert got == [("2", 2), ("2", 2), ("None", None)]


@pytest.mark.parametrize("size", [7, 40, 333, 2500])
def test_linked_sets_share_a_key(size):
    """Whatever the shingles are: sets at the least similarity have a key in common."""
    similarity = Similarity(4, Fraction(85, 100))
    rng = np.random.default_rng(size)
    for _ in range(60):
        base = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64))
        gone = rng.integers(0, size // 6 + 1)
        other = base[rng.permutation(len(base))[gone:]]
        extra = rng.integers(0, 1 << 63, rng.integers(0, size // 6 + 1)).astype(np.uint64)
        other = np.unique(np.concatenate([other, extra]))
        shared = len(np.intersect1d(base, other))
        if similarity.linked(shared, len(base) + len(other)) and len(base) != shared:
            keys = [sketch_keys(x, similarity) for x in (base, other)]
            assert len(np.intersect1d(*keys))


def test_bands_of_possible_partners_meet():
    similarity = Similarity(4, Fraction(85, 100))
    for small in range(1, 400):
        own = {band for band, _ in bands(small, similarity)}
        for large in range(small, small * 100 // 85 + 1):
            assert own & {band for band, _ in bands(large, similarity)}


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 140)]
    star = [(7, i) for i in range(200, 260)]
    links = spark.createDataFrame(chain + star + [(9, 9)], "a long, b long")
    got = {r.node: r.component for r in components(links).collect()}
    want = {i: 100 for i in range(100, 141)} | {7: 7} | {i: 7 for i in range(200, 260)}
    assert got == want


@pytest.mark.parametrize("turn", [1, -1])
def test_links_do_not_hang_on_texts_of_an_id_that_do_not_count(spark, turn):
    words = [f"w{i}" for i in range(60)]
    first, second = " ".join(words), " ".join(reversed(words))
    rows = [(7, first), (7, second), (9, first), (11, first + " more"), (13, second), (15, "more " + second)]
    rows = spark.createDataFrame(rows[::turn], "doc_id long, text string").coalesce(1)
    found = {(r.doc_id, r.component_id) for r in near_duplicates(rows, Similarity(4, Fraction(85, 100))).collect()}
    # Of the two texts of 7 one counts; the other's documents are linked all the same.
    assert found in (
        {(7, 7), (9, 7), (11, 7), (13, 13), (15, 13)}, {(7, 7), (13, 7), (15, 7), (9, 9), (11, 9)}
    )


def test_a_new_index_has_buckets_for_its_rows(spark, monkeypatch):
    from tidecast.llm import exact_dedup as module

    made = []
    create = module.DigestIndex.create.__func__
    monkeypatch.setattr(module, "BUCKET_ROWS", 2)
    monkeypatch.setattr(module, "BUCKETS", 3)
    monkeypatch.setattr(
        module.DigestIndex, "create", classmethod(lambda cls, *a, **k: made.append(k) or create(cls, *a, **k))
    )
    rows = spark.createDataFrame([(i, str(i % 9)) for i in range(20)], "doc_id long, text string")
    assert module.exact_dedup(rows).where("kept").count() == 9
    assert made == [{"buckets": 10}]
