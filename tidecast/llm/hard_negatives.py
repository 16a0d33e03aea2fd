"""Hard-negative mining by Four-Russians scoring.

Vectors are whole numbers in two's complement. A candidate is kept as bit planes: for each bit
of its components and each group of eight dimensions, one byte. For an anchor, a table holds
the sums of all 256 subsets of its eight components of a group. Indexed with a candidate's byte
the table gives the inner product of anchor and that plane of the group; sums over the groups,
shifted and added from the highest plane down (the sign plane counts negative), are full exact
scores. No candidate is skipped and nothing is estimated.

Candidates are packed once. Pieces of candidates form blocks and pieces of anchors form parts,
both of bounded size; a task meets one block with one part after the other. The first pass finds
each anchor's positives, its best rows of the same label. The second scores again, since what a
hard negative is depends on the positives: the best rows of other labels whose score lies
between a share of the positive's score and that score.

Defined results: rows with a null id, label or vector, or with a null or non-finite component,
take no part; shorter vectors count as padded with zeros; of rows that share an id, the one with
the smallest label, then vector, counts; ties go to the smaller id; a positive with a negative
score has no negatives; an anchor without another row of its label gives no rows, nor does an
empty table; extra columns are not read. Scaled components and scores must fit a long.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecast.llm.common import prepare, staged
from tidecast.llm.topk_search import whole_numbers
from tidecast.session import ship_package

# Candidates and anchors of one row of packed vectors.
PIECE, ANCHORS = 256, 32
# Candidates of a block and anchors of a part, about.
BLOCK, PART = 2048, 1024
# Cells that are dealt to tasks of their own; beyond, a task takes several one after the other.
MOST_TASKS = 20_000

PACKED = "cell long, kind int, ids binary, labels binary, width int, vectors binary, wanted binary"


@dataclass(frozen=True)
class Mining:
    """How many positives and negatives; a negative's score lies between ``low`` hundredths of the
    positive's score and that score."""

    positives: int = 5
    negatives: int = 5
    low: int = 80


def bit_planes(vectors: np.ndarray, planes: int) -> np.ndarray:
    """Bytes by plane, group of eight dimensions, and vector."""
    bits = (vectors >> np.arange(planes)[:, None, None]) & 1
    return np.ascontiguousarray(np.packbits(bits.astype(np.uint8), axis=2, bitorder="little").transpose(0, 2, 1))


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """By group of eight dimensions and subset: the sum of each anchor's components in it."""
    n, width = anchors.shape
    groups = np.zeros((n, -(-width // 8) * 8), np.int64)
    groups[:, :width] = anchors
    groups = groups.reshape(n, -1, 8).transpose(1, 2, 0)
    out = np.zeros((len(groups), 256, n), np.int64)
    for bit in range(8):
        out[:, 1 << bit : 2 << bit] = out[:, : 1 << bit] + groups[:, bit, None]
    return out


def full_scores(planes: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """Inner products, a row per candidate and a column per anchor."""
    total = np.zeros((planes.shape[2], tables.shape[2]), np.int64)
    found = np.empty_like(total)
    for k, plane in enumerate(planes[::-1]):
        total <<= 1
        for codes, table in zip(plane, tables, strict=True):
            np.take(table, codes, axis=0, out=found, mode="clip")
            if k:
                total += found
            else:
                total -= found
    return total


def as_rows(values: list, width: int) -> np.ndarray:
    out = np.zeros((len(values), width), np.int64)
    for row, value in zip(out, values, strict=True):
        row[: len(value)] = value
    return out


def packed_pieces(points: DataFrame, size: int, cells: int, width: int, planes: int = 0, k: int = 0) -> DataFrame:
    """Rows of at most ``size`` vectors, each dealt to one of ``cells`` by its first id.

    With ``planes`` the vectors are kept as bit planes, else as numbers, with their ``wanted``
    positives (k ids, then k scores; -1 for none).
    """
    names = [part.split()[0] for part in PACKED.split(", ")]

    def packed(rows: list[dict]) -> pa.RecordBatch:
        vectors = as_rows([r["v"] for r in rows], width)
        wanted = np.full((len(rows), 2 * k), -1, np.int64)
        for at, row in enumerate(rows):
            for j, one in enumerate(row.get("wanted") or ()):
                wanted[at, j], wanted[at, k + j] = one["positive_id"], one["positive_score"]
        kept = bit_planes(vectors, planes) if planes else vectors
        # A multiplication spreads neighbouring first ids over the cells.
        cell = rows[0]["vec_id"] * 0x9E3779B97F4A7C15 % (1 << 64) * cells >> 64
        ids, labels = (np.array([r[x] for r in rows], np.int64).tobytes() for x in ("vec_id", "label"))
        row = [cell, int(not planes), ids, labels, width, kept.tobytes(), wanted.tobytes()]
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int32(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, kinds, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            held += batch.to_pylist()
            while len(held) >= size:
                yield packed(held[:size])
                held = held[size:]
        if held:
            yield packed(held)

    return points.mapInArrow(run, PACKED)


@dataclass
class Block:
    """Candidates of one cell."""

    ids: np.ndarray
    labels: np.ndarray
    planes: np.ndarray

    @classmethod
    def of(cls, rows: list[dict], planes: int) -> Block:
        ids = [np.frombuffer(r["ids"], np.int64) for r in rows]
        codes = [
            np.frombuffer(r["vectors"], np.uint8).reshape(planes, -1, len(i)) for r, i in zip(rows, ids, strict=True)
        ]
        labels = [np.frombuffer(r["labels"], np.int64) for r in rows]
        # Indices as numpy takes them, so that no lookup converts them again.
        return cls(np.concatenate(ids), np.concatenate(labels), np.concatenate(codes, axis=2).astype(np.intp))


Chosen = Callable[[Block, int, int, np.ndarray, np.ndarray], list[tuple]]


def over_cells(
    candidates: DataFrame, anchors: DataFrame, blocks: int, parts: int, planes: int, choose: Chosen, kinds: str
) -> DataFrame:
    """What ``choose`` makes of each block and each anchor: a stream of cells, one at a time.

    ``choose`` gets the block, the anchor's id and label, its wanted positives, and its scores.
    """
    every = [F.explode(F.sequence(*(F.lit(x).cast("long") for x in (0, n - 1)))) for n in (parts, blocks)]
    cells = candidates.select(F.col("cell").alias("block"), every[0].alias("part"), "*").unionByName(
        anchors.select(every[1].alias("block"), F.col("cell").alias("part"), "*")
    )
    tasks = min(2 * blocks * parts, MOST_TASKS)
    ordered = cells.repartition(tasks, "block", "part").sortWithinPartitions("block", "part", "kind")
    names = [part.split()[0] for part in kinds.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held, block = None, [], None
        for batch in batches:
            for row in batch.to_pylist():
                if (row["block"], row["part"]) != cell:
                    cell, held, block = (row["block"], row["part"]), [], None
                if not row["kind"]:
                    held.append(row)
                    continue
                if block is None and held:
                    block, held = Block.of(held, planes), []
                if block is None:
                    continue
                ids, labels = (np.frombuffer(row[x], np.int64).tolist() for x in ("ids", "labels"))
                vectors = np.frombuffer(row["vectors"], np.int64).reshape(len(ids), row["width"])
                wanted = np.frombuffer(row["wanted"], np.int64).reshape(len(ids), -1)
                scores = np.ascontiguousarray(full_scores(block.planes, subset_sums(vectors)).T)
                out = [
                    x
                    for i, label, want, score in zip(ids, labels, wanted, scores, strict=True)
                    for x in choose(block, i, label, want, score)
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, pa.int64()) for x in (zip(*out, strict=True) if out else [[]] * len(names))],
                    names=names,
                )

    return ordered.mapInArrow(run, kinds)


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best, best first, ties to the smaller id."""
    at = np.arange(len(ids))
    if len(ids) > 4 * k:
        at = np.flatnonzero(scores >= np.partition(scores, -k)[-k])
    return at[np.lexsort((ids[at], -scores[at]))[:k]]


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    label: Column | None = None,
    rule: Mining = Mining(),
    scale: int = 256,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    block: int = BLOCK,
    part: int = PART,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``is_anchor`` is a condition on the column vec_id; ``label`` an expression over the rows of
    ``vectors``, by default their column label.
    """
    spark = prepare(vectors.sparkSession)
    ship_package(spark)
    named = vectors.select(
        F.col(vec_id).alias("vec_id"),
        F.col(vector).alias("embedding"),
        (F.col("label") if label is None else label).cast("long").alias("label"),
    ).where("label is not null")
    whole = whole_numbers(named, "vec_id", "embedding", scale, "label")
    one = whole.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("own")).select("vec_id", "own.*")
    points = staged(one, "mined-points")
    n, width, low, high = points.agg(
        F.count("*"), F.max(F.size("v")), F.min(F.array_min("v")), F.max(F.array_max("v"))
    ).first()
    width, planes = max(width or 0, 1), max(abs(low or 0), abs(high or 0)).bit_length() + 1
    asking = points.where(is_anchor)
    blocks, parts = -(-max(n, 1) // block), -(-max(asking.count(), 1) // part)
    candidates = staged(packed_pieces(points, min(PIECE, block), blocks, width, planes), "bit-planes")

    def same_label(cell: Block, anchor: int, own: int, wanted: np.ndarray, scores: np.ndarray) -> list[tuple]:
        at = np.flatnonzero((cell.labels == own) & (cell.ids != anchor))
        at = at[best(cell.ids[at], scores[at], rule.positives)]
        return [(anchor, i, s) for i, s in zip(cell.ids[at].tolist(), scores[at].tolist(), strict=True)]

    anchors = packed_pieces(asking, min(ANCHORS, part), parts, width)
    kinds = "anchor_id long, positive_id long, positive_score long"
    found = over_cells(candidates, anchors, blocks, parts, planes, same_label, kinds)
    ranked = Window.partitionBy("anchor_id").orderBy(F.col("positive_score").desc(), "positive_id")
    kept = found.withColumn("place", F.row_number().over(ranked)).where(F.col("place") <= rule.positives)
    wanted = kept.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.collect_list(F.struct("positive_id", "positive_score")).alias("wanted")
    )

    def other_labels(cell: Block, anchor: int, own: int, wanted: np.ndarray, scores: np.ndarray) -> list[tuple]:
        ids, limits = np.split(wanted, 2)
        there = limits >= 0
        if not there.any():
            return []
        # Hundredths rounded up, in whole numbers.
        least = -(-rule.low * limits[there].min() // 100)
        at = np.flatnonzero((scores >= least) & (scores <= limits.max()) & (cell.labels != own))
        at = at[np.lexsort((cell.ids[at], -scores[at]))]
        falling, out = -scores[at], []
        for positive, limit in zip(ids[there].tolist(), limits[there].tolist(), strict=True):
            first = int(np.searchsorted(falling, -limit))
            for j in at[first : first + rule.negatives].tolist():
                if 100 * int(scores[j]) < rule.low * limit:
                    break
                out.append((anchor, positive, int(cell.ids[j]), limit, int(scores[j])))
        return out

    with_wanted = staged(asking.join(wanted, "vec_id"), "mined-anchors")
    anchors = packed_pieces(with_wanted, min(ANCHORS, part), parts, width, k=rule.positives)
    kinds = "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long"
    found = over_cells(candidates, anchors, blocks, parts, planes, other_labels, kinds)
    ranked = Window.partitionBy("anchor_id", "positive_id").orderBy(F.col("negative_score").desc(), "negative_id")
    return (
        found.withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= rule.negatives)
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
