"""Cross-tokenizer alignment against the libraries and plain Python."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from edges import EDGE_ROWS, EDGE_TEXTS, edge_table, empty_table
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidecast.llm import token_alignment
from tidecast.llm.token_alignment import Aligner, align_tokens
from tidecast.llm.tokens import TO_CHARACTERS

PATHS = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
A = Tokenizer.from_file(PATHS[0])
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
BYTE_OF = {c: b for b, c in TO_CHARACTERS.items()}


def bytes_a(i):
    return bytes(BYTE_OF[c] for c in A.id_to_token(i))


def bytes_b(i):
    piece = B.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if B.is_byte(i) else piece.replace("▁", " ").encode()


def tokens(text):
    """(id, first byte, byte after the last) of both, or nothing."""
    if not text:
        return [], []
    out = []
    for ids, spell in ((A.encode(" " + text, add_special_tokens=False).ids, bytes_a), (B.encode(text), bytes_b)):
        at, own = 0, []
        for i in ids:
            own.append((i, at, at + len(spell(i))))
            at = own[-1][2]
        if b"".join(map(spell, ids)) != (" " + text).encode():
            return [], []
        out.append(own)
    return out


def groups(a, b):
    cuts = sorted({x[2] for x in a} & {x[2] for x in b})
    parts, low = [], 0
    for cut in cuts:
        own = [",".join(str(i) for i, s, e in side if low < e <= cut) for side in (a, b)]
        parts.append("|".join(own))
        low = cut
    return ";".join(parts)


def links(a, b):
    return [(i, j) for i, s, e in a for j, t, f in b if max(s, t) < min(e, f)]


def expected(rows):
    made = [(i, *tokens(text)) for i, text in rows]
    held = Counter(pair for _, a, b in made for pair in set(links(a, b)))
    top = defaultdict(int)
    for (a, _), n in held.items():
        top[a] = max(top[a], n)
    out = []
    for i, a, b in made:
        own, spelt = links(a, b), groups(a, b)
        out.append(
            (i, len(a), len(b), spelt.count(";") + bool(spelt), len(own),
             sum(held[p] == top[p[0]] for p in own), sum(held[p] for p in own), spelt)
        )
    return out


@pytest.fixture(scope="module")
def aligner():
    return Aligner(*PATHS, remembered=2000)


def test_texts_align_as_the_libraries_say(aligner):
    @settings(max_examples=300, deadline=None)
    @given(st.text(alphabet=st.sampled_from(list("ab seTHE'dlrv,.!0 7\n\t\r\xa0\u0085éñß日▁😀<|>endoftx\x00")), max_size=50))
    def check(text):
        a, b = tokens(text)
        made = aligner.text(text)
        if not a:
            assert made is None
            return
        spelt, numbers, distinct, often = made
        own = links(a, b)
        assert spelt == groups(a, b)
        assert numbers.tolist() == [len(a), len(b), spelt.count(";") + 1, len(own)]
        code = [i if aligner.same[i] == j else aligner.n_a + i * aligner.n_b + j for i, j in own]
        assert dict(zip(distinct.tolist(), often.tolist(), strict=True)) == Counter(code)

    check()
    for text in EDGE_TEXTS:
        if text and len(text) < 1000:
            made = aligner.text(text)
            assert (made[0] if made else "") == groups(*tokens(text))


def test_identity_map_names_the_same_bytes(aligner):
    assert (aligner.same >= 0).sum() > 10_000
    for i in range(0, aligner.n_a, 97):
        if aligner.same[i] >= 0:
            assert bytes_b(int(aligner.same[i])) == bytes_a(i)


ROWS = [(i, t) for i, t in EDGE_ROWS if not t or len(t) < 1000]
WORDS = "the tokenisation tokenization of naïve cafés, isn't unbelievable\nxyzzy Zürich 1234".split(" ")
ROWS += [(100 + i, " ".join(WORDS[i % 7 :] + WORDS[: i % 5])) for i in range(30)]
ROWS += [(100, "another text with an id that is there already"), (None, "no id"), (None, "no id")]


@pytest.mark.parametrize("shard_docs", [3, 20_000])
def test_query_equals_brute_force(spark, monkeypatch, shard_docs):
    monkeypatch.setattr(token_alignment, "SHARD_DOCS", shard_docs)
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").selectExpr("*", "'own' pair", "'own' kind")
    got = sorted(map(tuple, align_tokens(docs.repartition(3), *PATHS).collect()), key=str)
    assert got == sorted(expected(ROWS), key=str)
    digests = align_tokens(docs, *PATHS, digests_only=True).collect()
    sha = {hashlib.sha256(r[7].encode()).hexdigest() if r[7] else "" for r in got}
    assert {r.groups for r in digests} == sha


def test_long_texts_and_empty_tables(spark):
    rows = {r.doc_id: r for r in align_tokens(edge_table(spark), *PATHS, digests_only=True).collect()}
    assert len(rows) == len(EDGE_ROWS)
    for i, text in EDGE_ROWS:
        a, b = tokens(text)
        assert (rows[i].n_a, rows[i].n_b) == (len(a), len(b))
    assert align_tokens(empty_table(spark), *PATHS).count() == 0
