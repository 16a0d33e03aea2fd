"""License scan: an exact set-similarity join of text blocks with license templates.

A block is a sentence (it ends at a line feed, or at one of ``.!?`` before white space or the end
of the text). One of more than twice as many words as the longest template is cut into windows
of that size, each beginning half a window after the one before, so every run of words as long
as a template lies in one. A block meets a template if it holds at least the template's share of
its distinct words.

Words that no template has take part in no overlap, so sets are kept without them. The others
are ordered by how often all documents hold them, the rarest first. With an overlap of a or more
to reach, the first common word is among the first n - a + 1 of n in either set (prefix filter),
a block needs a words (length filter), and no more can follow in common than either set has left
(positional filter). Blocks that pass are held against the template in full. So every block that
meets a template is found, and only those. The filters leave hardly a block, because the prefix
of a template holds its rarest words.

Beside it, phrases are found wherever their words stand one after another.

Defined results: null and empty texts have no words and no finds; rows that repeat are each
answered, rows without an id too; an empty table gives no rows; only the id and the text are
read, whatever other columns are called. Words that follow a phrase's words in another document
are never joined to it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import chunks, prepare, span_hashes, text_bytes, word_spans
from tidecast.session import ship_package


@dataclass(frozen=True)
class Template:
    """A text whose distinct words a block must hold to ``least`` hundredths."""

    label: str
    text: str
    least: int = 80


# Phrases and the labels they stand for.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Sentences of public license notices, and statements that name a license.
TEMPLATES = (
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0", 100),
    Template(
        "apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file "
        "except in compliance with the License",
    ),
    Template(
        "apache-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under "
        "the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY "
        "KIND, either express or implied",
    ),
    Template("bsd", "Redistribution and use in source and binary forms, with or without "
             "modification, are permitted provided that the following conditions are met"),
    Template("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 "
             "International License", 100),
    Template("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0", 100),
    Template("gpl-3.0", "Licensed under the GNU General Public License, version 3", 100),
    Template(
        "gpl-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version",
        90,
    ),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any "
             "purpose with or without fee is hereby granted"),
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the Software), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions",
    ),
    Template("mit", "Released under the MIT License", 100),
    Template("mit", "The above copyright notice and this permission notice shall be included in "
             "all copies or substantial portions of the Software"),
    Template("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public "
             "License, v. 2.0"),
    Template("unlicense", "This is free and unencumbered software released into the public domain"),
)
# End of fixed values.

# Bytes between words: ASCII without digits and small letters (capitals are made small before).
BETWEEN = np.zeros(256, bool)
BETWEEN[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?"]] = True
_LINE = ord("\n")


def words_of(text: str) -> list[str]:
    data, starts, ends, _ = word_spans(pa.array([text]), BETWEEN)
    return [data[a:b].tobytes().decode() for a, b in zip(starts, ends, strict=True)]


def needed(words: int, least: int) -> int:
    """The smallest overlap with so many distinct words that is ``least`` hundredths of them."""
    return -(-words * least // 100)


class Vocabulary:
    """The words of all templates and phrases; ``found`` maps the words of texts to them."""

    def __init__(self, templates: tuple[Template, ...], phrases: dict[str, str]):
        texts = [*(t.text for t in templates), *phrases]
        self.words = sorted({w for text in texts for w in words_of(text)})
        data, starts, ends, _ = word_spans(pa.array([" ".join(self.words)]), _BLANK)
        hashes = span_hashes(data, starts, ends)
        self.order = np.argsort(hashes)
        self.hashes, self.lengths = hashes[self.order], (ends - starts)[self.order]

    def found(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The number of each word, -1 for words that are not in the vocabulary."""
        hashes = span_hashes(data, starts, ends)
        at = np.searchsorted(self.hashes, hashes).clip(0, len(self.words) - 1)
        known = (self.hashes[at] == hashes) & (self.lengths[at] == ends - starts)
        return np.where(known, self.order[at], -1)


@dataclass
class Blocks:
    """The blocks of some texts: their vocabulary words by falling rarity, and their places."""

    doc: np.ndarray
    first: np.ndarray
    end: np.ndarray
    token: np.ndarray = field(repr=False)
    block: np.ndarray = field(repr=False)


class LicenseScanner:
    """Templates and phrases, with the words' global order; scans one array of texts at a time."""

    def __init__(self, templates: tuple[Template, ...], phrases: dict[str, str], counts: dict[int, int]):
        self.templates, self.phrases = templates, phrases
        self.vocabulary = Vocabulary(templates, phrases)
        words = self.vocabulary.words
        by_rarity = sorted(range(len(words)), key=lambda i: (counts.get(i, 0), words[i]))
        # The last place of ``rank`` stands for words out of the vocabulary.
        self.rank = np.full(len(words) + 1, -1)
        self.rank[by_rarity] = np.arange(len(words))
        number = {w: int(self.rank[i]) for i, w in enumerate(words)}
        sets = [sorted({number[w] for w in words_of(t.text)}) for t in templates]
        self.size = np.array([len(s) for s in sets], np.int64)
        self.least = np.array([needed(len(s), t.least) for s, t in zip(sets, templates, strict=True)], np.int64)
        self.longest = max((len(words_of(t.text)) for t in templates), default=1)
        self.member = np.zeros((len(templates), len(words)), bool)
        postings: list[list[tuple[int, int]]] = [[] for _ in words]
        for k, own in enumerate(sets):
            self.member[k, own] = True
            for place, token in enumerate(own[: self.size[k] - self.least[k] + 1]):
                postings[token].append((k, place))
        self.posted = np.array([len(p) for p in postings], np.int64)
        self.post_from = np.cumsum(self.posted) - self.posted
        flat = [x for p in postings for x in p]
        self.post_template = np.array([x[0] for x in flat], np.int64)
        self.post_place = np.array([x[1] for x in flat], np.int64)
        self.spoken = [(label, [number[w] for w in words_of(phrase)]) for phrase, label in phrases.items()]

    def blocks(self, texts: pa.Array, data, starts, begin, rank) -> Blocks:
        _, edges = text_bytes(texts)
        after = np.ones(len(data), bool)
        after[:-1] = _BLANK[data[1:]]
        after[edges[1:][edges[1:] > edges[:-1]] - 1] = True
        ended = np.cumsum((data == _LINE) | (_STOP[data] & after))
        doc = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
        name = ended[starts] + doc
        new = np.ones(len(name), bool)
        new[1:] = name[1:] != name[:-1]
        first, number = np.flatnonzero(new), np.cumsum(new) - 1
        length = np.diff(np.append(first, len(name)))
        half = self.longest
        last = np.maximum(-(-(length - 2 * half) // half), 0)
        base = np.cumsum(last + 1) - (last + 1)
        hit = np.flatnonzero(rank >= 0)
        sentence = number[hit]
        window = (hit - first[sentence]) // half
        own, before = window <= last[sentence], window >= 1
        block = np.concatenate([(base[sentence] + window)[own], (base[sentence] + window - 1)[before]])
        token = np.concatenate([rank[hit][own], rank[hit][before]])
        pairs = np.unique(block * self.member.shape[1] + token)
        block, token = np.divmod(pairs, max(self.member.shape[1], 1))
        of = np.repeat(np.arange(len(first)), last + 1)
        from_ = first[of] + (np.arange(len(of)) - base[of]) * half
        end = np.minimum(from_ + 2 * half, first[of] + length[of])
        return Blocks(doc[first[of]], from_ - begin[doc[first[of]]], end - begin[doc[first[of]]], token, block)

    def meeting(self, blocks: Blocks) -> list[tuple[int, int, int]]:
        """(block, template, overlap) of all that meet, by prefix, length and positional filter."""
        block, token = blocks.block, blocks.token
        if not len(block) or not len(self.templates):
            return []
        edge = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
        size = np.diff(np.append(edge, len(block)))
        of = np.repeat(np.arange(len(edge)), size)
        place = np.arange(len(block)) - edge[of]
        posted = self.posted[token]
        row = np.repeat(np.arange(len(block)), posted)
        entry = np.arange(len(row)) - np.repeat(np.cumsum(posted) - posted, posted) + self.post_from[token[row]]
        template, i = self.post_template[entry], self.post_place[entry]
        n, m, j, least = self.size[template], size[of[row]], place[row], self.least[template]
        good = (m >= least) & (j <= m - least) & (np.minimum(n - i, m - j) >= least)
        found = np.unique(of[row[good]] * len(self.templates) + template[good])
        at, template = np.divmod(found, len(self.templates))
        out = []
        for b, k in zip(at.tolist(), template.tolist(), strict=True):
            shared = int(self.member[k, token[edge[b] : edge[b] + size[b]]].sum())
            if shared >= self.least[k]:
                out.append((int(block[edge[b]]), k, shared))
        return out

    def scan(self, texts: pa.Array) -> tuple[np.ndarray, list[list[dict]], list[list[dict]]]:
        """Words, places of phrases and blocks that meet a template, for each text."""
        data, starts, ends, begin = word_spans(texts, BETWEEN)
        rank = self.rank[self.vocabulary.found(data, starts, ends)]
        places: list[list[dict]] = [[] for _ in range(len(texts))]
        blocks: list[list[dict]] = [[] for _ in range(len(texts))]
        for label, phrase in self.spoken:
            at = np.flatnonzero(rank[: max(len(rank) - len(phrase) + 1, 0)] == phrase[0])
            for step, token in enumerate(phrase):
                at = at[rank[at + step] == token]
            doc = np.searchsorted(begin, at, "right") - 1
            for d, a in zip(doc.tolist(), at.tolist(), strict=True):
                if a + len(phrase) <= begin[d + 1]:
                    places[d].append({"label": label, "first_word": a - int(begin[d])})
        if len(starts):
            made = self.blocks(texts, data, starts, begin, rank)
            for b, k, shared in self.meeting(made):
                blocks[made.doc[b]].append(
                    {
                        "label": self.templates[k].label,
                        "template": k,
                        "first_word": int(made.first[b]),
                        "end_word": int(made.end[b]),
                        "contained": shared / int(self.size[k]),
                    }
                )
        return np.diff(begin), places, blocks


PLACES = "array<struct<label: string, first_word: long>>"
BLOCKS = "array<struct<label: string, template: int, first_word: long, end_word: long, contained: double>>"


def word_counts(docs: DataFrame, templates: tuple[Template, ...], phrases: dict[str, str]) -> dict[int, int]:
    """How often all documents hold each word of the vocabulary: a row per word at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Vocabulary(templates, phrases)
        total = np.zeros(len(own.words), np.int64)
        for batch in chunks(batches, "text"):
            data, starts, ends, _ = word_spans(batch.column("text"), BETWEEN)
            number = own.found(data, starts, ends)
            total += np.bincount(number[number >= 0], minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], names=["word", "n"])

    counted = docs.select("text").mapInArrow(run, "word long, n long")
    return {r["word"]: r["n"] for r in counted.groupBy("word").agg(F.sum("n").alias("n")).collect()}


def scan_licenses(
    docs: DataFrame,
    templates: tuple[Template, ...] = TEMPLATES,
    phrases: dict[str, str] = PHRASES,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """doc_id, n_words, places of phrases and blocks that meet a template, for every row.

    Places count words from 0; a block's words are those from first_word up to before end_word.
    """
    ship_package(prepare(docs.sparkSession))
    slim = docs.selectExpr(f"cast(`{doc_id}` as long) doc_id", f"`{text}` text")
    counts = word_counts(slim, templates, phrases)
    kinds = f"doc_id long, n_words long, places {PLACES}, blocks {BLOCKS}"
    place = pa.struct([("label", pa.string()), ("first_word", pa.int64())])
    block = pa.struct(
        [("label", pa.string()), ("template", pa.int32()), ("first_word", pa.int64()),
         ("end_word", pa.int64()), ("contained", pa.float64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = LicenseScanner(templates, phrases, counts)
        for batch in chunks(batches, "text"):
            n, places, blocks = own.scan(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(n, pa.int64()),
                    pa.array(places, pa.list_(place)),
                    pa.array(blocks, pa.list_(block)),
                ],
                names=["doc_id", "n_words", "places", "blocks"],
            )

    return slim.mapInArrow(run, kinds)
