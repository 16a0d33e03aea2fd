"""Vector best-fit packing of tokenised documents into sequences of a fixed length.

A piece asks for three things: tokens, one document place, and attention cost (its length
squared). A sequence has a capacity for each. Pieces go in by falling length, each into the
open sequence that fits best under every constraint: the largest weighted dot product of what
the piece asks for and what the sequence has left ("dot"), or the smallest weighted norm of
what would be left ("norm").

What a piece asks for depends on its length alone, and what a sequence has left on the lengths
in it. So the plan is made on counts: the number of pieces of each length and share (at most
SHARES times as many rows as the sequence length, however many documents there are) and groups
of sequences that
hold the same. Each step places as many pieces of a length as there are sequences in the best
group. The plan is a list of rules "pieces a..b of length n go to sequences c.. at offset o", whose
length follows the number of groups, not of documents; tasks apply it to the pieces, numbered
within their length.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import chunks, prepare, staged, texts_of
from tidecast.llm.tokens import encoder
from tidecast.session import ship_package

PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long"
PLACED = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
)
# Numbers of pieces of one length stay below this.
LENGTH_STEP = 1 << 48
# Pieces of a length are numbered in so many shares, in this order within each.
ORDER = ["doc_id", "piece", "ids_crc32"]
SHARES = 256


@dataclass(frozen=True)
class Capacity:
    """What a sequence can hold, and how much each resource counts in choosing one.

    ``documents`` and ``attention`` of None mean as much as the tokens allow at all.
    """

    tokens: int
    documents: int | None = None
    attention: int | None = None
    weights: tuple[float, float, float] = (1.0, 0.02, 0.02)
    rule: str = "norm"

    def limits(self) -> tuple[int, int, int]:
        return (
            self.tokens,
            self.tokens if self.documents is None else self.documents,
            self.tokens**2 if self.attention is None else self.attention,
        )


def cut_pieces(
    docs: DataFrame, path: str, end_id: int, size: int, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """The pieces of every document: doc_id, piece, start, length, ids_crc32.

    Null texts are empty: one piece with just the end id. Only documents longer than ``size``
    are cut. Rows that repeat give pieces each.
    """
    ship_package(prepare(docs.sparkSession))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, end_id)
        for batch in chunks(batches, "text"):
            rows: list[tuple] = []
            for i, t in zip(batch.column("doc_id").to_pylist(), texts_of(batch.column("text")), strict=True):
                raw = own.encode(t)
                for k, low in enumerate(range(0, len(raw), 4 * size)):
                    part = raw[low : low + 4 * size]
                    rows.append((i, k, low // 4, len(part) // 4, zlib.crc32(part)))
            kinds_ = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds_, strict=True)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    slim = docs.selectExpr(f"cast(`{doc_id}` as long) doc_id", f"`{text}` text")
    return slim.mapInArrow(run, PIECES)


class OpenSequences:
    """Sequences that are not full, grouped by what they have left."""

    def __init__(self, capacity: Capacity):
        self.capacity = capacity
        self.limits = np.array(capacity.limits(), np.float64)
        self.left = np.zeros((64, 3))
        self.row: dict[tuple, int] = {}
        self.free: list[int] = list(range(64))
        self.ranges: dict[tuple, list[tuple[int, int]]] = {}

    def score(self, left: np.ndarray, need: np.ndarray) -> np.ndarray:
        """The lower, the better the fit."""
        if self.capacity.rule == "dot":
            return -(left / self.limits * (need / self.limits) * self.capacity.weights).sum(axis=-1)
        return (self.capacity.weights * ((left - need) / self.limits) ** 2).sum(axis=-1)

    def add(self, key: tuple, low: int, high: int) -> None:
        if key[0] <= 0 or key[1] <= 0:
            return
        if key not in self.row:
            if not self.free:
                self.free = list(range(len(self.left), 2 * len(self.left)))
                self.left = np.concatenate([self.left, np.zeros_like(self.left)])
            self.row[key] = at = self.free.pop()
            self.left[at] = key
            self.ranges[key] = []
        self.ranges[key].append((low, high))

    def take(self, key: tuple) -> list[tuple[int, int]]:
        at = self.row.pop(key)
        self.left[at] = 0
        self.free.append(at)
        return self.ranges.pop(key)

    def fitting(self, need: np.ndarray) -> list[tuple[float, tuple]]:
        at = np.flatnonzero((self.left >= need).all(axis=1))
        found = self.left[at]
        return list(zip(self.score(found, need).tolist(), map(tuple, found.tolist()), strict=True))


def plan(counts: dict[int, int], capacity: Capacity) -> list[tuple[int, int, int, int, int]]:
    """Rules (length, first, past, sequence, offset): pieces first..past-1 of this length, in
    their numbering, go to sequences ``sequence``, ``sequence`` + 1, ... at ``offset``."""
    opened = OpenSequences(capacity)
    rules, new = [], 0
    for length in sorted(counts, reverse=True):
        need = np.array([length, 1, length**2], np.float64)
        if (need > opened.limits).any():
            raise ValueError(f"a piece of {length} tokens fits into no sequence")
        first, past = 0, counts[length]
        # Placing changes only the group that pieces go to and the one it becomes.
        heap = opened.fitting(need)
        heapq.heapify(heap)
        while first < past:
            if heap:
                _, key = heapq.heappop(heap)
                if key not in opened.row:
                    continue
                ranges = opened.take(key)
            else:
                # As few new sequences as hold the rest, if they are filled with this length.
                key = tuple(opened.limits.tolist())
                n = -(-(past - first) // int(min(opened.limits // need)))
                ranges, new = [(new, new + n)], new + n
            after = (key[0] - length, key[1] - 1, key[2] - length**2)
            for low, high in ranges:
                taken = min(high - low, past - first)
                if taken:
                    rules.append((length, first, first + taken, low, int(opened.limits[0] - key[0])))
                    opened.add(after, low, low + taken)
                    first += taken
                if low + taken < high:
                    opened.add(key, low + taken, high)
            if after in opened.row and min(a - n for a, n in zip(after, need.tolist(), strict=True)) >= 0:
                heapq.heappush(heap, (float(opened.score(np.array(after), need)), after))
    return rules


def with_share(pieces: DataFrame) -> DataFrame:
    """Adds ``share``, one of SHARES by hash: pieces are numbered by length, share and ORDER."""
    return pieces.withColumn("share", F.pmod(F.xxhash64(*ORDER), F.lit(SHARES)).cast("int"))


def pack(pieces: DataFrame, capacity: Capacity) -> DataFrame:
    """Adds sequence_id and offset to the pieces (doc_id, piece, start, length, ids_crc32).

    Every piece is placed once; an empty table stays empty. Pieces that tie go by document id,
    so the result is the same each time. No length comes together in one task: a task numbers
    the pieces of its lengths and shares, from the number that each of these begins at.
    """
    pieces = with_share(staged(pieces, "pieces"))
    # One row per length and share: at most SHARES times as many as a sequence has tokens.
    sizes = pieces.groupBy("length", "share").agg(F.count("*").alias("n")).toArrow()
    length, share, n = (sizes.column(c).to_numpy().astype(np.int64) for c in ("length", "share", "n"))
    cell = length * SHARES + share
    by_cell = np.argsort(cell)
    cell, length, n = cell[by_cell], length[by_cell], n[by_cell]
    lengths, edge = np.unique(length, return_index=True)
    before = np.cumsum(n) - n
    before -= np.repeat(before[edge], np.diff([*edge, len(n)]))
    counts = np.add.reduceat(n, edge) if len(n) else n
    rules = np.array(sorted(plan(dict(zip(lengths.tolist(), counts.tolist(), strict=True)), capacity)), np.int64)
    rules = rules.reshape(-1, 5)
    # Rules of a length cover its numbers without a gap, so the last one that begins at or
    # before a piece's number is the piece's.
    begins = rules[:, 0] * LENGTH_STEP + rules[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, passed = -1, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            length, share = (
                batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "share")
            )
            own = length * SHARES + share
            edge = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            many = np.diff([*edge, len(own)])
            number = np.arange(len(own)) - np.repeat(edge, many)
            # The first pieces may go on where the batch before ended.
            if own[0] != last:
                passed = 0
            number[: many[0]] += passed
            passed = int(number[-1]) + 1
            last = own[-1]
            number += before[np.searchsorted(cell, own)]
            rule = rules[np.searchsorted(begins, length * LENGTH_STEP + number, "right") - 1]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in ("doc_id", "piece", "start")],
                    pa.array(length),
                    batch.column("ids_crc32"),
                    pa.array(rule[:, 3] + number - rule[:, 1]),
                    pa.array(rule[:, 4]),
                ],
                names=[part.split()[0] for part in PLACED.split(", ")],
            )

    ordered = pieces.repartition("length", "share").sortWithinPartitions("length", "share", *ORDER)
    return ordered.mapInArrow(run, PLACED)
