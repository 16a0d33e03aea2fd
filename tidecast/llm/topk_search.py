"""Exact top-k by inner product: an impact-ordered index processed score at a time.

Rows are dealt into blocks of bounded size, each with an index of its own. In it, a vector's
value at a dimension is its impact: how far it lies above the block's smallest value there,
or, for queries whose component is negative, below the largest. So impact times the size of a
query's component is never negative, and the sum of these differs from the inner product by
the same number for all vectors. Impacts are quantised to levels; the postings of a dimension
are in order of falling level, and a segment holds the vectors of one level.

A query takes the segments of all dimensions by falling contribution (size of its component
times level), in steps. After each step a vector's sum bounds its total from below; with the
rounding where it was met, and the next level where it was not, it is bounded from above. When
few vectors can still reach the k-th largest lower bound, no other can be in the answer: only
that proof, or the last segment, ends the search. The possible ones are scored exactly, so
quantising never changes an answer. The blocks' answers are merged per query.

Defined results: vectors that are null or hold nulls or non-finite numbers take no part;
shorter vectors count as padded with zeros; ties go to the smaller id; an empty table, or one
with the query's row only, gives no rows; extra columns are not read. Ids are taken to be
unique: rows that share one are each a candidate, but not for a query of that id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecast.llm.common import prepare, staged
from tidecast.session import ship_package

LEVELS = 64  # a level fits a signed byte
# Candidates of an index, about, and queries that one task puts to it.
BLOCK, QUERIES = 8192, 2048
# Search ends once so few vectors can still be in the answer; they are scored exactly.
FEW = 64
# Postings that make up more than one in so many vectors are added up in the vectors' order.
SCATTERED = 6
# Where the bounds are looked at: shares of all segments.
LOOKS = (0.25, 0.5, 0.7, 0.85, 1.0)


class ImpactIndex:
    """The index of one block of vectors of whole numbers."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        low, high = vectors.min(axis=0), vectors.max(axis=0)
        self.step = (high - low) // LEVELS + 1
        # For positive and negative components: levels, order by falling level, and how many
        # vectors have a level or a higher one.
        self.sides = []
        for impact in (vectors - low, high - vectors):
            level = (impact // self.step).astype(np.int8)
            order = np.argsort(-level, axis=0, kind="stable").astype(np.int32)
            count = np.stack([np.bincount(x, minlength=LEVELS + 1) for x in level.T])
            reached = np.cumsum(count[:, ::-1], axis=1)[:, ::-1]
            sorted_level = np.take_along_axis(level, order, axis=0).astype(np.float64)
            by_dim = (np.ascontiguousarray(x.T) for x in (level.astype(np.intp), order, sorted_level))
            self.sides.append((level, *by_dim, reached))

    def search(self, query_id: int, query: np.ndarray, k: int) -> list[tuple[int, int]]:
        """(score, id) of the k best, best first, ties to the smaller id; not the query's own."""
        dims = np.flatnonzero(query)
        size = np.abs(query[dims]).astype(np.float64)
        side = [self.sides[int(c < 0)] for c in query[dims]]
        unit = size * self.step[dims]
        # All segments by falling contribution: level l of dimension d is worth l * unit[d].
        worth = np.multiply.outer(np.arange(LEVELS), unit)
        ranked = np.sort(worth, axis=None)[::-1]
        slack = 8 * (len(dims) + LEVELS) * np.finfo(np.float64).eps
        score = np.zeros(len(self.ids))
        possible = np.flatnonzero(self.ids != query_id)
        # Levels from ``top`` on are processed.
        top = np.full(len(dims), LEVELS)
        rounding = size * (self.step[dims] - 1)
        for share in LOOKS if len(dims) else ():
            least = ranked[min(int(share * len(ranked)), len(ranked) - 1)] if share < 1 else 0.0
            following = np.minimum(top, np.ceil(least / unit)).astype(np.int64)
            for i in np.flatnonzero(following < top).tolist():
                d, new, old = dims[i], following[i], top[i]
                _, by_dim, order, sorted_level, reached = side[i]
                a, b = reached[d, old] if old < LEVELS else 0, reached[d, new]
                if SCATTERED * (b - a) > len(score):
                    # Segments of many vectors: what each level adds, in the order of vectors.
                    adds = np.zeros(LEVELS)
                    adds[new:old] = worth[new:old, i]
                    score += adds.take(by_dim[d])
                elif b > a:
                    score[order[d, a:b]] += sorted_level[d, a:b] * unit[i]
            top = following
            if len(possible) <= k:
                break
            lower = score[possible]
            kth = np.partition(lower, -k)[-k]
            # A vector met in a dimension lacks the rounding there; one not met has a level
            # below top, so an impact of less than top * step. Sums are off by less than
            # their size times ``slack``.
            below = np.maximum(unit * top - size, 0)
            margin = 1 + slack * (ranked[0] * len(dims) + np.abs(below - rounding).sum() + rounding.sum())
            # First with the larger of both for all dimensions; where that leaves few enough
            # to look at them one by one, with what each has met.
            near = lower + np.maximum(below, rounding).sum() + margin >= kth
            possible, lower = possible[near], lower[near]
            if max(FEW, k) < len(possible) <= len(score) // 2 and top.any():
                levels = [s[0][np.ix_(possible, dims)] for s in self.sides]
                unmet = np.where(query[dims] < 0, levels[1], levels[0]) < top.astype(np.int8)
                rest = unmet.astype(np.float64) @ (below - rounding) + rounding.sum()
                possible = possible[lower + rest + margin >= kth]
            if len(possible) <= max(FEW, k):
                break
        exact = self.vectors[possible] @ query
        found = np.lexsort((self.ids[possible], -exact))[:k]
        return list(zip(exact[found].tolist(), self.ids[possible][found].tolist(), strict=True))


def whole_numbers(vectors: DataFrame, vec_id: str, vector: str, scale: int, *more: str) -> DataFrame:
    """(vec_id, v): floor(scale * component) of every valid vector; and the columns ``more``."""
    x = F.col(vector)
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    valid = vectors.where(x.isNotNull() & F.col(vec_id).isNotNull()).where(~bad)
    v = F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("long"))
    return valid.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v"), *more)


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int,
    scale: int = 256,
    vec_id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id, score of each query's k best among all other rows.

    ``is_query`` is a condition on the column vec_id. Each block of candidates meets each
    block of queries in a task that holds one index and one query at a time.
    """
    spark = prepare(vectors.sparkSession)
    ship_package(spark)
    points = staged(whole_numbers(vectors, vec_id, vector, scale), "whole-vectors")
    queries = points.where(is_query)
    n, width = points.agg(F.count("*"), F.max(F.size("v"))).first()
    blocks, groups = -(-max(n, 1) // BLOCK), -(-max(queries.count(), 1) // QUERIES)
    hashed = F.xxhash64("vec_id")
    kept = points.select(
        F.pmod(hashed, F.lit(blocks)).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("part"),
        F.lit(0).alias("asks"), "vec_id", "v",
    )
    asked = queries.select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
        F.pmod(F.shiftright(hashed, 20), F.lit(groups)).cast("int").alias("part"),
        F.lit(1).alias("asks"), "vec_id", "v",
    )
    cells = kept.unionByName(asked).repartition(2 * blocks * groups, "block", "part")
    ordered = cells.sortWithinPartitions("block", "part", "asks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, ids, values, index = None, [], [], None
        for batch in batches:
            out: list[tuple[int, int, int]] = []
            for row in batch.to_pylist():
                vector_ = np.zeros(width or 0, np.int64)
                vector_[: len(row["v"])] = row["v"]
                if (row["block"], row["part"]) != cell:
                    cell, ids, values, index = (row["block"], row["part"]), [], [], None
                if not row["asks"]:
                    ids.append(row["vec_id"])
                    values.append(vector_)
                    continue
                if index is None and ids:
                    index = ImpactIndex(np.array(ids), np.stack(values))
                    values = []
                for score, found in index.search(row["vec_id"], vector_, k) if index else ():
                    out.append((row["vec_id"], found, score))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in out], pa.int64()) for i in range(3)],
                names=["query_id", "vec_id", "score"],
            )

    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        ordered.mapInArrow(run, "query_id long, vec_id long, score long")
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
