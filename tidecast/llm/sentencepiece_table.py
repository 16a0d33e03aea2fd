"""SentencePiece encoding and decoding of a merge-type model through a prefix table.

Encoding: blanks become the model's blank sign, one is put in front, and the text is cut in
front of blanks (no entry of the vocabulary spans such a place). Each distinct piece gets its
ids from the prefix table, recovered backwards; characters that the model lacks become byte
tokens. Decoding maps ids to their surfaces and joins byte tokens to characters.

Defined results: null and empty texts have no ids and decode to the empty text; the sign for
blanks decodes to a blank; rows that repeat are each answered; an empty table gives no rows;
only the id and the text are read, whatever other columns are called.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidecast.llm.common import chunks, kept_in_worker, prepare, texts_of
from tidecast.llm.prefix_table import PrefixTable
from tidecast.llm.tokens import BLANKS, WordCache
from tidecast.session import ship_package

BLANK = "▁"


def merge(symbols: list[str], scores: dict[str, float], steps: list | None = None) -> list[str]:
    """Join the neighbours whose union has the best score, the leftmost first, while any has.

    ``steps`` receives place, number of symbols before, score and union of each.
    """
    symbols = list(symbols)
    none = -np.inf
    found = [scores.get(a + b, none) for a, b in zip(symbols, symbols[1:], strict=False)]
    while found:
        best = max(found)
        if best == none:
            break
        at = found.index(best)
        if steps is not None:
            steps.append((at, len(symbols), best, symbols[at] + symbols[at + 1]))
        symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        del found[at]
        # Only the neighbours of the new symbol have other unions now.
        if at < len(found):
            found[at] = scores.get(symbols[at] + symbols[at + 1], none)
        if at:
            found[at - 1] = scores.get(symbols[at - 1] + symbols[at], none)
    return symbols


class Borders:
    """Whether two entries stay two when they meet, from the merges at their border alone.

    Merges go by falling score. Until a merge crosses the border, each side is merged as if it
    stood alone, so the symbols next to the border, and the scores at which they are joined to
    the rest of their own side, are those of each entry by itself. The first crossing union
    whose score comes before both decides. An entry whose own merges do not fall in score has
    no such order; its pairs are merged as a whole.
    """

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.known: dict[str, tuple | None] = {}

    def edges(self, text: str) -> tuple[list, list] | None:
        """(symbol, score at which it is joined) at the left and at the right end, in order."""
        if text not in self.known:
            steps: list[tuple[int, int, float, str]] = []
            merge(list(text), self.scores, steps)
            left, right = [text[0]], [text[-1]]
            at_left, at_right = [], []
            for at, size, score, union in steps:
                if at == 0:
                    at_left.append(score)
                    left.append(union)
                if at + 2 == size:
                    at_right.append(score)
                    right.append(union)
            order = [score for _, _, score, _ in steps]
            falls = all(a >= b for a, b in itertools.pairwise(order)) and left[-1] == right[-1] == text
            ends = [list(zip(x, [*y, -np.inf], strict=True)) for x, y in ((left, at_left), (right, at_right))]
            self.known[text] = tuple(ends) if falls else None
        return self.known[text]

    def apart(self, one: str, two: str) -> bool:
        first, second = self.edges(one), self.edges(two)
        if first is None or second is None:
            return merge(list(one + two), self.scores) == [one, two]
        right, left, i, j = first[1], second[0], 0, 0
        while True:
            (a, until_a), (b, until_b) = right[i], left[j]
            score = self.scores.get(a + b, -np.inf)
            # Of equal scores the one further left comes first.
            if score > until_a and score >= until_b and score > -np.inf:
                return False
            if until_a == until_b == -np.inf:
                return True
            if until_a >= until_b:
                i += 1
            else:
                j += 1


class PieceCoder:
    """Ids of texts and texts of ids for one model file."""

    def __init__(self, path: str, cache_size: int = 5_000_000):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        every = range(model.get_piece_size())
        plain = [
            i for i in every
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
        ]
        entries = {model.id_to_piece(i): i for i in plain}
        scores = {model.id_to_piece(i): model.get_score(i) for i in plain}
        self.known = {text for text in entries if len(text) == 1}
        self.prefixes = PrefixTable(
            entries,
            lambda text: [entries.get(s, -1) for s in merge(list(text), scores)],
            compatible=Borders(scores).apart,
        )
        self.byte_ids = {int(model.id_to_piece(i)[1:-1], 16): i for i in every if model.is_byte(i)}
        self.byte_value = np.zeros(len(every), np.uint8)
        for b, i in self.byte_ids.items():
            self.byte_value[i] = b
        self.surface = ["" for _ in every]
        for text, i in entries.items():
            self.surface[i] = text.replace(BLANK, " ")
        self.is_byte = np.zeros(len(every), bool)
        self.is_byte[list(self.byte_ids.values())] = True
        self.unknown = model.unk_id()
        self.surface[self.unknown] = " ⁇ "
        self.words, self.parts = WordCache(cache_size), WordCache(cache_size // 4)
        # What the model lacks joins with nothing, so what stands before and after is alone.
        signs = "".join(map(re.escape, sorted(self.known)))
        self.runs = re.compile(f"[{signs}]+|[^{signs}]")

    def unknown_ids(self, sign: str) -> list[int]:
        return [self.byte_ids[b] for b in sign.encode()] if self.byte_ids else [self.unknown]

    def fill(self, words: list[str]) -> None:
        """The ids of words, from those of their runs of known characters."""
        absent = self.words.missing(words)
        if not absent:
            return
        split = [self.runs.findall(word.replace(" ", BLANK)) for word in absent]
        parts = self.parts
        for part in parts.missing(itertools.chain.from_iterable(split)):
            ids = self.prefixes.ids(part) if part[0] in self.known else self.unknown_ids(part)
            parts.new[part] = np.array(ids, "<u4").tobytes()
        ids_of = parts.new.__getitem__
        self.words.new.update((w, b"".join(map(ids_of, own))) for w, own in zip(absent, split, strict=True))

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, np.uint32)
        text = text.replace(BLANK, " ")
        if "  " in text or text[0] == " ":
            words = BLANKS.findall(" " + text)
        else:
            words = text.split(" ")
            words = [" " + w for w in words]
        self.fill(words)
        return np.frombuffer(b"".join(map(self.words.new.__getitem__, words)), "<u4")

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; the blank that encoding put in front is dropped."""
        parts = list(map(self.surface.__getitem__, ids.tolist()))
        at = np.flatnonzero(self.is_byte[ids])
        if len(at):
            # A run of byte tokens becomes characters at its first place.
            first = np.flatnonzero(np.diff(at, prepend=-2) > 1)
            values = self.byte_value[ids[at]].tobytes()
            ends = [*first[1:].tolist(), len(at)]
            for place, low, high in zip(at[first].tolist(), first.tolist(), ends, strict=True):
                parts[place] = characters(values[low:high])
        text = "".join(parts)
        return text[1:] if text[:1] == " " else text


@lru_cache(10_000)
def characters(run: bytes) -> str:
    """A byte that is part of no character becomes U+FFFD."""
    return "".join(decoded(run))


def decoded(run: bytes) -> Iterator[str]:
    while run:
        for size in (1, 2, 3, 4):
            try:
                yield run[:size].decode()
                run = run[size:]
                break
            except UnicodeDecodeError:
                continue
        else:
            yield "�"
            run = run[1:]


_coders: dict[str, PieceCoder] = kept_in_worker()


def coder(path: str) -> PieceCoder:
    if path not in _coders:
        _coders[path] = PieceCoder(path)
    return _coders[path]


def encode_pieces(
    docs: DataFrame,
    path: str,
    text: str = "text",
    doc_id: str = "doc_id",
    digests_only: bool = False,
) -> DataFrame:
    """doc_id, n_tokens, ids, decoded; or SHA-256 digests in place of ids and decoded text.

    The digest of the ids is over their decimal forms, joined by commas.
    """
    ship_package(prepare(docs.sparkSession))
    kinds = (
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
        if digests_only
        else "doc_id long, n_tokens long, ids array<int>, decoded string"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path)
        decimal = [str(i) for i in range(len(own.surface))].__getitem__
        for batch in chunks(batches, "text"):
            sizes, codes, back = [], [], []
            for text_ in texts_of(batch.column("text")):
                ids = own.encode(text_)
                decoded = own.decode(ids)
                sizes.append(len(ids))
                if digests_only:
                    codes.append(sha256(",".join(map(decimal, ids.tolist()))))
                    back.append(sha256(decoded))
                else:
                    codes.append(ids.astype(np.int32))
                    back.append(decoded)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(codes, pa.string() if digests_only else pa.list_(pa.int32())),
                    pa.array(back, pa.string()),
                ],
                names=[part.split()[0] for part in kinds.split(", ")],
            )

    slim = docs.selectExpr(f"cast(`{doc_id}` as long) doc_id", f"`{text}` text")
    return slim.mapInArrow(run, kinds)


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
