"""Rows without an id, ids that stand several times, and clashing columns, for every operator
that answers row by row: each row is answered, and by its own text alone."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidecast.llm.exact_dedup import exact_dedup
from tidecast.llm.language import learn_languages, predict_languages
from tidecast.llm.packing import Capacity, cut_pieces, pack
from tidecast.llm.sentencepiece_table import encode_pieces
from tidecast.llm.token_counts import count_tokens
from tidecast.llm.token_files import token_files
from tidecast.llm.toxicity import fit_toxicity, score_toxicity

BYTE, WORD, PIECE = (
    public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model")
)
ROWS = [
    (None, "you are a stupid fool"), (None, "you are a stupid fool"), (None, "the sea is blue"), (None, None),
    (4, "the same text"), (4, "the same text"), (4, "quite another text, der Hund und die Katze"),
    (5, None), (5, ""), (-9, "the sea is blue"), (6, "a  b"), (7, "a b"),
]
CLASHING = ("digest", "score", "key", "length", "number", "share", "n", "toxic", "piece", "start", "scored_text", "part")


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.createDataFrame(ROWS, "doc_id long, text string")
    return rows.withColumns({name: F.lit("own") for name in CLASHING}).repartition(4)


def ids(path, text):
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids


def crc(numbers):
    return zlib.crc32(np.array(numbers, "<u4").tobytes())


def counted(rows):
    return Counter(map(tuple, rows))


def test_token_counts(docs):
    want = [(i, len((t or "").encode()), len(ids(BYTE, t)), len(ids(BYTE, t)) > 3) for i, t in ROWS]
    got = count_tokens(docs, BYTE, 3).select("doc_id", "n_bytes", "n_tokens", "over_limit").collect()
    assert counted(got) == counted(want)


def test_token_files(docs):
    got = token_files(docs, BYTE, 2).collect()
    assert counted((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == counted(
        (i, len(ids(BYTE, t)) + 1, crc(ids(BYTE, t) + [2])) for i, t in ROWS
    )
    order = sorted(got, key=lambda r: r.start)
    assert [r.start for r in order] == np.cumsum([0, *(r.n_tokens for r in order)])[:-1].tolist()
    assert [r.doc_id for r in order] == [None] * 4 + sorted(i for i, _ in ROWS if i is not None)


def test_pieces(docs):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    want = []
    for i, t in ROWS:
        own = library.encode(t or "")
        want.append((i, len(own), sha(",".join(map(str, own))), sha(library.decode(own))))
    assert counted(encode_pieces(docs, PIECE, digests_only=True).collect()) == counted(want)


def test_packing(docs):
    rows = pack(cut_pieces(docs, WORD, 1, 4), Capacity(4)).collect()
    want = []
    for i, t in ROWS:
        own = ids(WORD, t) + [1]
        want += [(i, k, low, len(own[low : low + 4]), crc(own[low : low + 4])) for k, low in enumerate(range(0, len(own), 4))]
    assert counted(tuple(r)[:5] for r in rows) == counted(want)
    held = Counter()
    for r in rows:
        held[r.sequence_id] += r.length
    assert max(held.values()) <= 4


def test_scores_depend_on_the_text_alone(spark, docs):
    learn = [(k, "you are a stupid fool" if k % 2 else "the sea is blue and calm", k % 2) for k in range(40)]
    known = spark.createDataFrame(learn, "doc_id long, text string, toxic int")
    model = fit_toxicity(known.drop("toxic"), known.drop("text"), F.lit(True))
    rows = score_toxicity(docs, model, ["doc_id", "text"]).collect()
    assert counted((r.doc_id, r.text) for r in rows) == counted(ROWS)
    by_text = {}
    for r in rows:
        assert by_text.setdefault(r.text or "", r.score) == r.score
    assert by_text["you are a stupid fool"] > 0.5 > by_text["the sea is blue"]


def test_languages_depend_on_the_text_alone(spark, docs):
    learn = [("en", "the sea is blue and the same text of another day " * 3), ("de", "der Hund und die Katze sind im Haus " * 3)]
    known = spark.createDataFrame([(k, t, lang) for k, (lang, t) in enumerate(learn * 5)], "doc_id long, text string, lang string")
    rows = predict_languages(docs, learn_languages(known, F.lit(True)), ["doc_id", "text"]).collect()
    assert counted((r.doc_id, r.text) for r in rows) == counted(ROWS)
    by_text = {}
    for r in rows:
        assert by_text.setdefault(r.text or "", (r.lang_pred, r.score)) == (r.lang_pred, r.score)
    assert by_text[""] == ("und", 0.0) and by_text["the sea is blue"][0] == "en"


def test_exact_dedup(docs):
    rows = exact_dedup(docs).collect()
    groups = {}
    for i, t in ROWS:
        groups.setdefault(" ".join((t or "").split(" ")) if t != "a  b" else "a b", []).append(i)
    smallest = {text: min((i for i in own if i is not None), default=None) for text, own in groups.items()}
    want = []
    for i, t in ROWS:
        text = "a b" if t == "a  b" else t or ""
        want.append((i, smallest[text], len(groups[text]), i == smallest[text]))
    assert counted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in rows) == counted(want)
