"""Exact top-k and chat formatting against plain Python."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidecast.llm import chat, topk_search
from tidecast.llm.chat import CONTROLS, escape, format_conversations, read_back, unescape
from tidecast.llm.topk_search import ImpactIndex, top_k

BYTE = public_tokenizers.path("byte_bpe_50k.json")


def best(ids, vectors, query_id, query, k):
    found = sorted((-int(v @ query), i) for i, v in zip(ids.tolist(), vectors, strict=True) if i != query_id)
    return [(-s, i) for s, i in found[:k]]


@pytest.mark.parametrize("spread", [1, 5, 400])
def test_index_equals_brute_force(spread):
    rng = np.random.default_rng(spread)
    for _ in range(40):
        n, width = rng.integers(1, 300), rng.integers(1, 9)
        vectors = rng.integers(-spread, spread + 1, (n, width))
        ids = rng.permutation(3 * n)[:n]
        index = ImpactIndex(ids, vectors)
        for at in rng.integers(0, n, 5):
            want = best(ids, vectors, ids[at], vectors[at], 5)
            assert index.search(ids[at], vectors[at], 5) == want


def test_search_stops_early_where_it_can():
    """Far groups: the own group is proven to hold the answer before the last look."""
    rng = np.random.default_rng(3)
    centres = rng.integers(-200, 200, (40, 16))
    vectors = np.repeat(centres, 20, axis=0) + rng.integers(-3, 4, (800, 16))
    index = ImpactIndex(np.arange(800), vectors)
    seen = []
    real = np.partition
    try:
        topk_search.np.partition = lambda *a, **k: seen.append(1) or real(*a, **k)
        for at in range(0, 800, 50):
            assert index.search(at, vectors[at], 5) == best(np.arange(800), vectors, at, vectors[at], 5)
    finally:
        topk_search.np.partition = real
    assert len(seen) < 16 * len(topk_search.LOOKS)


def test_top_k_query(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "BLOCK", 40)
    monkeypatch.setattr(topk_search, "QUERIES", 7)
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(200)]
    rows += [(i, [0.5] * 6) for i in range(200, 300)]  # a third of all rows is one vector
    odd = [(300, None), (301, [1.0, None]), (302, [float("nan")]), (303, [float("inf"), 1.0]), (304, [])]
    odd += [(350, [0.25]), (None, [1.0])]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").repartition(4)
    table = table.withColumns({"v": F.lit(1), "block": F.lit(2), "rank": F.lit(3)})
    valid = rows + [(304, []), (350, [0.25])]
    ids = np.array([i for i, _ in valid])
    vectors = np.zeros((len(valid), 6), np.int64)
    for at, (_, v) in enumerate(valid):
        vectors[at, : len(v)] = np.floor(256 * np.float32(v).astype(np.float64))
    want = [
        (q, rank, i, s)
        for at, q in enumerate(ids.tolist()) if q % 50 == 0
        for rank, (s, i) in enumerate(best(ids, vectors, q, vectors[at], 5), 1)
    ]
    got = top_k(table, F.col("vec_id") % 50 == 0, 5)
    assert sorted(map(tuple, got.collect())) == want
    assert top_k(table.where("vec_id < 0"), F.col("vec_id") % 50 == 0, 5).count() == 0
    assert top_k(table.where("vec_id = 0"), F.col("vec_id") % 50 == 0, 5).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*CONTROLS, "\\", "<", "s>", "[", "/INST]", "<\\s>", "x"]), max_size=8))
def test_escape_is_reversible_and_leaves_no_control(parts):
    text = "".join(parts)
    assert unescape(escape(text)) == text
    assert not any(c in escape(text) for c in CONTROLS)


TURNS = [
    (1, 2, "user", "b"), (1, 1, "system", "be <s>brief</s>"), (1, 3, "assistant", "ok [INST]"),
    (1, 4, "assistant", None), (1, None, None, "no number"), (1, 3, "assistant", "ok [INST]"),
    (2, 0, "user", ""), (2, 1, "assistant", "  two  lines\n<|endoftext|> 😀"),
    (None, 0, "user", "x"), (None, 1, "assistant", "y"), (None, 2, "[ROLE]", "odd </s> role"),
    (-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]"),
    (9, 0, "user", "long " * 3000),
] + [(9, k, "assistant" if k % 2 else "user", f"turn {k} " * 9) for k in range(1, 400)]


def test_conversations_read_back(spark, monkeypatch):
    monkeypatch.setattr(chat, "ROW_TOKENS", 4000)  # the archive on workers keeps its own
    table = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string")
    table = table.withColumns({"ids": F.lit(1), "part": F.lit("x"), "formatted": F.lit(0)}).repartition(3)
    made = format_conversations(table, BYTE)
    rows = {(r.conv_id, r.part): r for r in made.collect()}
    got = {r.conv_id: r for r in read_back(made, BYTE).collect()}
    order = lambda t: ((t[1] is not None, t[1] or 0), t[2] or "", t[3] or "")
    for conv in {t[0] for t in TURNS}:
        own = sorted((t for t in TURNS if t[0] == conv), key=order)
        text = "".join(f"{t[2] or ''}\n{t[3] or ''}\n" for t in own)
        loss = "".join(t[3] or "" for t in own if t[2] == "assistant")
        row = got[conv]
        assert (row.n_turns, row.turns_sha256) == (len(own), hashlib.sha256(text.encode()).hexdigest())
        assert (row.loss_chars, row.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        parts = [r for (c, _), r in sorted(rows.items(), key=lambda x: x[0][1]) if c == conv]
        assert row.formatted_chars == sum(len(r.formatted) for r in parts)
        assert parts[0].formatted.startswith("<s>") and all(len(r.ids) == len(r.loss_mask) for r in parts)
    assert rows[(-7, 0)].formatted == (
        "<s>[INST]<\\/s>[\\INST] ok [\\/INST][/INST]<\\/s>[\\INST] ok [\\/INST]</s>"
    )
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert read_back(format_conversations(empty, BYTE), BYTE).count() == 0


def test_long_conversation_becomes_several_rows():
    own = chat.chat_coder(BYTE)
    turns = [own.turn("user" if k % 2 == 0 else "assistant", f"text {k}") for k in range(6)]
    held = [
        {"conv_id": 1, "ids": t.ids.astype("<u4").tobytes(), "trained": t.trained[1], "formatted": t.text}
        for t in turns
    ]
    reading = chat.Reading(1)
    for part, low in enumerate((0, 2, 4)):
        (row,) = chat.put_together(own, held[low : low + 2], part).to_pylist()
        assert (row["ids"][0] == own.first_control) == (part == 0)
        reading.add(own, row)
    assert reading.n_turns == 6 and reading.loss_chars == len("text 1text 3text 5")


@pytest.mark.parametrize("scattered", [0, 6, 10**9])
def test_vectors_without_order_take_few_scattered_sums(monkeypatch, scattered):
    """Nothing can be proven early for them: whole dimensions are added up, with the same answer."""
    monkeypatch.setattr(topk_search, "SCATTERED", scattered)
    rng = np.random.default_rng(5)
    vectors = np.floor(40 * rng.standard_normal((900, 32))).astype(np.int64)
    index = ImpactIndex(np.arange(900), vectors)
    for at in range(0, 900, 90):
        assert index.search(at, vectors[at], 5) == best(np.arange(900), vectors, at, vectors[at], 5)


def test_large_components_are_scored_exactly():
    rng = np.random.default_rng(3)
    for size in (1 << 12, 1 << 20, 1 << 27):
        vectors = size + rng.integers(-3, 4, (600, 64))
        vectors[::7] *= rng.choice([-1, 1], 64)
        index = ImpactIndex(np.arange(600), vectors)
        for i in range(0, 600, 60):
            exact = [(sum(int(a) * int(b) for a, b in zip(v, vectors[i])), j) for j, v in enumerate(vectors) if j != i]
            want = sorted(exact, key=lambda x: (-x[0], x[1]))[:5]
            assert index.search(i, vectors[i], 5) == want
