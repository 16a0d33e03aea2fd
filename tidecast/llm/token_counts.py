"""Exact token counts of every prefix, by dynamic programming over last tokens.

The vocabulary's split pattern cuts a text into parts; within a part the prefix table links
each prefix to the one before its last token, so counts follow without encoding any prefix.
Counts of parts add up. A text is cut in front of blanks that no token joins to what is before
them, distinct pieces repeat, and their totals are kept in a bounded cache.

Defined results: a null or empty text has 0 bytes and 0 tokens; special strings inside a text
count as the library counts them by default; rows that repeat are each answered; an empty
table gives no rows; only the id and the text are read, whatever other columns are called.
"""

from __future__ import annotations

import bisect
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidecast.llm.common import chunks, kept_in_worker, prepare, texts_of
from tidecast.llm.prefix_table import PrefixTable
from tidecast.llm.tokens import PLAIN, TO_CHARACTERS, Encoder, WordCache
from tidecast.session import ship_package

CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")


class TokenCounter(Encoder):
    """Token counts of texts and of all their prefixes, for a byte-level vocabulary."""

    def __init__(self, path: str):
        super().__init__(path)
        special = set(self.special)
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        self.prefixes = PrefixTable(
            {text: i for text, i in vocabulary.items() if text not in special},
            lambda text: [t.id for t in self.model.tokenize(text)],
        )
        self.totals: dict[str, int] = {}

    def part_counts(self, part: str) -> list[int]:
        """Counts of the prefixes of 0..len characters of a part that no pattern cuts."""
        _, count = self.prefixes.last_tokens(part.encode().decode("latin-1").translate(TO_CHARACTERS))
        if part.isascii():
            return count
        ends = itertools.accumulate((len(c.encode()) for c in part), initial=0)
        return [count[end] for end in ends]

    def cut(self, piece: str) -> list[str]:
        if PLAIN.fullmatch(piece):
            return self.pattern.findall(piece)
        cuts = self.library.pre_tokenizer.pre_tokenize_str(piece)
        return [piece[low:high] for _, (low, high) in cuts]

    def part_total(self, part: str) -> int:
        total = self.totals.get(part)
        if total is None:
            if len(self.totals) > 200_000 or len(part) > 1000:
                self.totals.clear()
            total = self.totals[part] = self.part_counts(part)[-1]
        return total

    def piece_total(self, piece: str) -> int:
        if any(s in piece for s in self.special):
            return len(self.library.encode(piece, add_special_tokens=False).ids)
        return sum(map(self.part_total, self.cut(piece)))

    def piece_counts(self, piece: str) -> list[int]:
        """Counts of the prefixes of 0..len characters of a piece, as ``cuts`` makes it."""
        if any(s in piece for s in self.special):
            # Up to its last character a special string is ordinary text.
            return [
                len(self.library.encode(piece[:end], add_special_tokens=False).ids)
                for end in range(len(piece) + 1)
            ]
        out, base, blank_from = [0], 0, 0
        for part in self.cut(piece):
            start = len(out) - 1
            counts = self.part_counts(part)
            if part.isspace():
                # A prefix that ends in blanks has all of them as one part.
                if not start or not piece[start - 1].isspace():
                    blank_from = start
                run = self.part_counts(piece[blank_from : start + len(part)])
                out += [out[blank_from] + n for n in run[start - blank_from + 1 :]]
            elif part in CONTRACTIONS:
                inside = [sum(map(self.part_total, self.cut(part[:i]))) for i in range(1, len(part))]
                out += [base + n for n in inside] + [base + counts[-1]]
            else:
                out += [base + n for n in counts[1:]]
                if part[0] == " " and start and piece[start - 1].isspace():
                    run = self.part_counts(piece[blank_from : start + 1])
                    out[start + 1] = out[blank_from] + run[-1]
            base += counts[-1]
        return out

    def pieces(self, text: str) -> list[str]:
        if self.has_runs(text):
            return self.cuts.findall(text)
        first, *words = text.split(" ")
        return [first, *[" " + word for word in words]]

    def fill_totals(self, cache: WordCache, words: list[str], lead: str) -> None:
        for word in cache.missing(words):
            cache.new[word] = self.piece_total(lead + word)

    def piece_totals(self, text: str) -> list[int]:
        if self.has_runs(text):
            words = self.cuts.findall(text)
            self.fill_totals(self.first, words, "")
            return list(map(self.first.new.__getitem__, words))
        first, *words = text.split(" ")
        self.fill_totals(self.first, [first], "")
        self.fill_totals(self.later, words, " ")
        return [self.first.new[first], *map(self.later.new.__getitem__, words)]

    def total(self, text: str) -> int:
        return sum(self.piece_totals(text))

    def prefix_counts(self, text: str) -> np.ndarray:
        """Exact token counts of the prefixes of 0..len(text) characters."""
        out = [np.zeros(1, np.int64)]
        base = 0
        for piece in self.pieces(text):
            counts = self.piece_counts(piece)
            out.append(np.array(counts[1:], np.int64) + base)
            base += counts[-1]
        return np.concatenate(out)

    def fitting(self, text: str, limit: int) -> tuple[int, int]:
        """(tokens of the text, characters of its longest prefix of at most ``limit`` tokens).

        Counts of later pieces only add up, so only the pieces where the sum passes the limit
        need their prefixes looked at.
        """
        totals = self.piece_totals(text)
        sums = list(itertools.accumulate(totals, initial=0))
        if sums[-1] <= limit:
            return sums[-1], len(text)
        pieces = self.pieces(text)
        k = bisect.bisect_right(sums, limit) - 1
        best = before = sum(map(len, pieces[:k]))
        while k < len(pieces) and sums[k] <= limit:
            counts = self.piece_counts(pieces[k])
            best = max(i + before for i, n in enumerate(counts) if sums[k] + n <= limit)
            before += len(pieces[k])
            k += 1
        return sums[-1], best


_counters: dict[str, TokenCounter] = kept_in_worker()


def counter(path: str) -> TokenCounter:
    if path not in _counters:
        _counters[path] = TokenCounter(path)
    return _counters[path]


def count_tokens(
    docs: DataFrame,
    path: str,
    limit: int,
    text: str = "text",
    doc_id: str = "doc_id",
    with_prefixes: bool = False,
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, fit_chars (longest prefix within ``limit``).

    ``with_prefixes`` adds prefix_counts, the count at every character position.
    """
    ship_package(prepare(docs.sparkSession))
    kinds = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fit_chars long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path)
        for batch in chunks(batches, "text"):
            texts = texts_of(batch.column("text"))
            found = [own.fitting(t, limit) for t in texts]
            columns = {
                "doc_id": batch.column("doc_id"),
                "n_bytes": pa.array([len(t.encode()) for t in texts], pa.int64()),
                "n_tokens": pa.array([n for n, _ in found], pa.int64()),
                "over_limit": pa.array([n > limit for n, _ in found], pa.bool_()),
                "fit_chars": pa.array([n for _, n in found], pa.int64()),
            }
            if with_prefixes:
                columns["prefix_counts"] = pa.array(
                    [own.prefix_counts(t) for t in texts], pa.list_(pa.int64())
                )
            yield pa.RecordBatch.from_pydict(columns)

    slim = docs.selectExpr(f"cast(`{doc_id}` as long) doc_id", f"`{text}` text")
    return slim.mapInArrow(run, kinds + ", prefix_counts array<long>" * with_prefixes)
