"""Token operators against their libraries, on edge cases and random strings."""

import hashlib
import itertools
import random
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from edges import EDGE_ROWS, EDGE_TEXTS, edge_table, empty_table
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidecast.llm.common import new_folder
from tidecast.llm.packing import Capacity, cut_pieces, pack, plan
from tidecast.llm.sentencepiece_table import PieceCoder, encode_pieces
from tidecast.llm.token_counts import TokenCounter, count_tokens
from tidecast.llm.token_files import (
    TokenFile,
    TokenReader,
    decode_levels,
    encode_levels,
    open_token_file,
    read_token_files,
    token_files,
    write_token_files,
)
from tidecast.llm.tokens import Encoder, WordCache

BYTE, WORD, PIECE = (
    public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model")
)
TRICKY = st.text(
    alphabet=st.sampled_from(list("ab seTHE'dlrv,.!0 7\n\t\r \u0085éñßİΣ日▁😀́<|>endoftx")), max_size=60
)
LIBRARY = {path: Tokenizer.from_file(path) for path in (BYTE, WORD)}


def library_ids(path, text):
    return LIBRARY[path].encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def encoders():
    return {path: Encoder(path) for path in (BYTE, WORD)}


@pytest.fixture(scope="module")
def counter():
    return TokenCounter(BYTE)


@pytest.fixture(scope="module")
def pieces():
    return PieceCoder(PIECE), sentencepiece.SentencePieceProcessor(model_file=PIECE)


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_cached_words_give_the_ids_of_whole_texts(encoders, path):
    @settings(max_examples=400, deadline=None)
    @given(TRICKY)
    def check(text):
        assert np.frombuffer(encoders[path].encode(text), "<u4").tolist() == library_ids(path, text)

    check()
    for text in filter(None, EDGE_TEXTS):
        assert np.frombuffer(encoders[path].encode(text), "<u4").tolist() == library_ids(path, text)


def test_runs_that_a_token_spans_are_not_cut(encoders, counter):
    assert encoders[BYTE].runs == ["  ", "\xa0 "]

    @settings(max_examples=200, deadline=None)
    @given(st.text(alphabet=st.sampled_from(list(" \xa0 \xa0 \xa0\nab'sà")), max_size=40))
    def check(text):
        for path in (BYTE, WORD):
            assert np.frombuffer(encoders[path].encode(text), "<u4").tolist() == library_ids(path, text)
        want = [len(library_ids(BYTE, text[:i])) for i in range(len(text) + 1)]
        assert counter.prefix_counts(text).tolist() == want
        for limit in (0, 1, 5):
            assert counter.fitting(text, limit) == (want[-1], max(i for i, n in enumerate(want) if n <= limit))

    check()
    for text in ("a" + " \xa0" * n + " b" for n in range(1, 20)):
        assert np.frombuffer(encoders[BYTE].encode(text), "<u4").tolist() == library_ids(BYTE, text)


def test_word_cache_forgets_what_is_old():
    cache = WordCache(10)
    for k in range(50):
        for word in cache.missing([f"w{k}", "often"]):
            cache.new[word] = k
        assert "often" in cache.new and f"w{k}" in cache.new
        assert len(cache.new) + len(cache.old) < 12


def test_prefix_counts_are_those_of_encoded_prefixes(counter):
    @settings(max_examples=150, deadline=None)
    @given(TRICKY)
    def check(text):
        want = [len(library_ids(BYTE, text[:i])) for i in range(len(text) + 1)]
        assert counter.prefix_counts(text).tolist() == want
        for limit in (0, 1, 5):
            fit = max(i for i, n in enumerate(want) if n <= limit)
            assert counter.fitting(text, limit) == (want[-1], fit)

    check()


def test_token_count_query(spark):
    got = {r.doc_id: r for r in count_tokens(edge_table(spark), BYTE, 512, with_prefixes=True).collect()}
    assert len(got) == len(EDGE_ROWS)
    for i, text in EDGE_ROWS:
        n = len(library_ids(BYTE, text or ""))
        row = got[i]
        assert (row.n_bytes, row.n_tokens, row.over_limit) == (len((text or "").encode()), n, n > 512)
        assert len(row.prefix_counts) == len(text or "") + 1 and row.prefix_counts[-1] == n
    assert count_tokens(empty_table(spark), BYTE, 512).count() == 0


def test_pieces_equal_the_library(pieces):
    own, library = pieces

    @settings(max_examples=400, deadline=None)
    @given(TRICKY)
    def check(text):
        ids = own.encode(text)
        assert ids.tolist() == library.encode(text)
        assert own.decode(ids) == library.decode(ids.tolist())

    check()
    rnd = random.Random(1)
    for _ in range(300):
        ids = [rnd.randrange(3, 32000) if rnd.random() < 0.5 else rnd.randrange(3, 259) for _ in range(12)]
        assert own.decode(np.array(ids, np.uint32)) == library.decode(ids)
    for n in range(1, 70):
        assert own.encode(" " * n + "x").tolist() == library.encode(" " * n + "x")


def test_piece_query(spark, pieces):
    _, library = pieces
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    want = {}
    for i, text in EDGE_ROWS:
        ids = library.encode(text or "")
        want[i] = (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)))
    got = {r[0]: tuple(r)[1:] for r in encode_pieces(edge_table(spark), PIECE, digests_only=True).collect()}
    assert got == want
    whole = encode_pieces(edge_table(spark).where("doc_id = 12"), PIECE).first()
    assert whole.decoded == EDGE_TEXTS[12] and library.decode(whole.ids) == whole.decoded
    assert encode_pieces(empty_table(spark), PIECE).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=1500))
def test_direct_access_finds_every_token(ids):
    ids = np.array(ids, np.uint32)
    assert decode_levels(encode_levels(ids)).tolist() == ids.tolist()
    file = TokenFile.from_bytes(TokenFile.build([(1, ids.astype("<u4").tobytes())]).to_bytes())
    assert len(file) == len(ids)
    for at in range(0, len(ids), 97):
        assert file.token(at) == ids[at]


def test_token_files_round_trip(spark):
    want, at = [], 0
    for i, text in EDGE_ROWS:
        ids = library_ids(BYTE, text or "") + [2]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(map(tuple, token_files(edge_table(spark), BYTE, 2).collect())) == want
    folder = new_folder(spark, "token-files")
    manifest = write_token_files(edge_table(spark), BYTE, 2, folder, partitions=3)
    assert manifest.agg({"n_ids": "sum"}).first()[0] == at
    first = manifest.orderBy("part", "file").first()
    file = open_token_file(first.path)
    assert file.document(6).tolist() == library_ids(BYTE, EDGE_TEXTS[6]) + [2]
    assert read_token_files(manifest).count() == len(EDGE_ROWS)
    assert token_files(empty_table(spark), BYTE, 2).count() == 0
    two = spark.createDataFrame([(None, "b"), (4, "y"), (4, "x")], "doc_id long, text string")
    got = sorted(map(tuple, token_files(two, BYTE, 2).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [None, 4, 4]


def placed_well(rows, capacity):
    limits = capacity.limits()
    for _, own in itertools.groupby(sorted(rows, key=lambda r: (r.sequence_id, r.offset)), lambda r: r.sequence_id):
        own = list(own)
        at = 0
        for r in own:
            assert r.offset == at
            at += r.length
        assert at <= limits[0] and len(own) <= limits[1] and sum(r.length**2 for r in own) <= limits[2]


@pytest.mark.parametrize(
    "capacity",
    [Capacity(64), Capacity(64, documents=3), Capacity(64, attention=2000, rule="dot", weights=(1, 1, 1))],
)
def test_packing_places_every_piece_within_all_limits(spark, capacity):
    size = 40
    docs = edge_table(spark).union(edge_table(spark))
    pieces = cut_pieces(docs, WORD, 1, size)
    rows = pack(pieces, capacity).collect()
    want = []
    for i, text in EDGE_ROWS * 2:
        ids = library_ids(WORD, text or "") + [1]
        for k, low in enumerate(range(0, len(ids), size)):
            part = ids[low : low + size]
            want.append((i, k, low, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted(tuple(r)[:5] for r in rows) == sorted(want)
    placed_well(rows, capacity)
    assert pack(cut_pieces(empty_table(spark), WORD, 1, size), capacity).count() == 0


def test_plan_is_near_the_least_possible():
    rnd = random.Random(2)
    counts = {n: rnd.randrange(1, 400) for n in range(1, 513)}
    rules = plan(counts, Capacity(512))
    used = max(first + past - low for _, low, past, first, _ in rules)
    least = -(-sum(n * c for n, c in counts.items()) // 512)
    assert least <= used <= least * 1.02
    many = plan({n: 1000 * c for n, c in counts.items()}, Capacity(512))
    assert len(many) < 3 * len(rules)
    with pytest.raises(ValueError):
        plan({600: 1}, Capacity(512))


def test_reader_seeks_tokens_documents_and_ids(tmp_path):
    rng = np.random.default_rng(7)
    docs, ids = [], [None, None, 3, 3, 3, *range(10, 400, 3)]
    for i in ids:
        size = int(rng.integers(0, 300))
        kinds = rng.choice([200, 50_000, 2**24, 2**32 - 1], size)
        docs.append((i, (rng.integers(0, 2**63, size) % kinds).astype("<u4").tobytes()))
    file = TokenFile.build(docs)
    path = tmp_path / "part.dac"
    path.write_bytes(file.to_bytes())
    every = file.tokens()
    with TokenReader(str(path)) as reader:
        assert len(reader) == len(every)
        for at in range(0, len(every), 61):
            before = reader.bytes_read
            assert reader.token(at) == every[at]
            # A byte, a bit, a rank and at most a block per level.
            assert reader.bytes_read - before <= 4 * (1 + 1 + 4 + 64)
        for low, high in ((0, 0), (0, 1), (5, 900), (len(every) - 3, len(every)), (0, len(every))):
            assert reader.tokens(low, high).tolist() == every[low:high].tolist()
        for k, (_, raw) in enumerate(docs):
            assert reader.document(k).astype("<u4").tobytes() == raw
        for i in (3, 10, 397, 11, -5, 1000):
            assert list(reader.find(i)) == [k for k, (own, _) in enumerate(docs) if own == i]
        with pytest.raises(IndexError):
            reader.token(len(every))
    path.write_bytes(b"something else entirely")
    with pytest.raises(ValueError):
        TokenReader(str(path))


def test_clean_up_removes_intermediate_folders_and_tables(spark):
    from tidecast.llm import common
    from tidecast.llm.exact_dedup import exact_dedup

    common.clean_up(spark)
    folder = Path(new_folder(spark, "x").removeprefix("file:")).parent
    before = {p.name for p in folder.iterdir()}
    tables = spark.sql("SHOW TABLES").count()
    rows = exact_dedup(edge_table(spark))
    assert rows.count() == len(EDGE_ROWS)
    assert {p.name for p in folder.iterdir()} - before and spark.sql("SHOW TABLES").count() == tables + 1
    assert common.clean_up(spark) >= 4
    assert {p.name for p in folder.iterdir()} == before and spark.sql("SHOW TABLES").count() == tables
    assert common.clean_up(spark) == 0


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_words_of_a_text_are_looked_at_together(encoders, path, monkeypatch):
    """One look finds that all words are plain; a text with others takes them word by word."""
    own, looks = Encoder(path), []
    real = Encoder.is_plain
    monkeypatch.setattr(Encoder, "is_plain", lambda self, text: looks.append(text) or real(self, text))
    plain = " ".join(f"wörd{i}, it's-{i}\n{i}" for i in range(50))
    odd = plain + " <|endoftext|>x 你好 e\u0301" + "".join(f" new{i}" for i in range(9))
    for text in (plain, odd):
        got = np.frombuffer(own.encode(text), "<u4").tolist()
        assert got == own.library.encode(text, add_special_tokens=False).ids
        if text is plain:
            assert len(looks) <= 2


def test_tasks_without_an_encoder_let_go_of_it():
    from tidecast.llm import tokens
    from tidecast.llm.toxicity import count_terms

    path = public_tokenizers.path("word_bpe_49k.json")
    tokens.encoder(path).encode("a text")
    assert tokens._encoders
    list(count_terms(iter([])))
    assert not tokens._encoders
    assert tokens.encoder(path).encode("a text")


def test_pieces_are_numbered_with_one_sort_and_no_join(spark):
    """Many pieces of few lengths, in more batches than one, each placed once and without gaps."""
    rows = [(i % 700, i // 700, 0, 1 + i % 3, i) for i in range(2100)] * 2
    pieces = spark.createDataFrame(rows, "doc_id long, piece int, start long, length int, ids_crc32 long")
    packed = pack(pieces.repartition(7), Capacity(8))
    plan_text = packed._jdf.queryExecution().sparkPlan().toString()
    assert "Join" not in plan_text and "Window" not in plan_text and plan_text.count("Sort ") == 1
    kept = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        found = packed.collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", kept)
    assert sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in found) == sorted((a, b, n, c) for a, b, _, n, c in rows)
    held = {}
    for r in found:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in held.values():
        ends = [0, *itertools.accumulate(n for _, n in sorted(places))]
        assert [at for at, _ in sorted(places)] == ends[:-1] and ends[-1] <= 8
    assert len(held) == -(-sum(r[3] for r in rows) // 8)
