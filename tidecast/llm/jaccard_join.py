"""N-gram Jaccard join by parity sketches.

A document's set of n-word shingles flips bits of a wide sketch, one bit per shingle: shingles
that two documents share cancel, so the Hamming distance of their sketches is at most the size
of the symmetric difference. Sets of a and b shingles with similarity t or more differ in at
most D = (1 - t) / (1 + t) * (a + b) shingles, so in at most D bits.

Pigeonhole: sizes fall into bands; a band's sketch has D + 1 blocks for its largest D, so two
linked documents agree on a whole block. Moreover, on the ring of blocks some agreeing block
is followed by one that differs in at most one bit (the distances of the first l blocks add up
to at most l * D / (D + 1)), and the one after it in at most two. A block with few set bits
says little, so it only counts together with one of the two halves of the next block, and if
that half says little too, with one of the three thirds of the block after. Whether it does is
a property of the value itself, so both documents decide alike. A document sends its keys to
its own band and to the one below, if a partner could lie there.

Keys are those of sets, so copies add none. Sets that share a key are candidates, every two of
them, in blocks of bounded size; keys with the same sets are looked at once, and two sets with
several keys in common meet in the first of them. A short sketch rejects most pairs, and each that
passes is verified on the exact sets of shingle hashes. So all links between different sets are
found. Neither they nor copies become rows: a group of sets is verified in one task, which gives
each set's number of links and the smallest set it reaches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidecast.llm.common import chunks, mix, numbered, prepare, staged, word_hashes
from tidecast.llm.components import components
from tidecast.session import ship_package

BAND_RATIO = 1.6
# Bits of the six parts that a block consists of; fewer in bands whose sketch would have more
# than 2^32 bits. Wide parts cost nothing, since only set bits are kept.
PART_BITS = 4096
PARTS = 6
# At most so many set bits say little: of a block; of a block and a half.
FEW, FEW_BOTH = 1, 2
# Least bits of a short sketch.
SHORT_BITS = 1024
# Sets that one comparison step holds against each other, and sets a task remembers.
BLOCK = 512
REMEMBERED = 200_000
# Sets, and shingles, of either side of a job that verifies links.
PART_SETS, PART_SHINGLES = 128, 1 << 20
# Text bytes that one step hashes: each byte takes many in between.
STEP_BYTES = 1 << 18


@dataclass(frozen=True)
class Similarity:
    """Shingles of ``words`` words; linked at a Jaccard similarity of ``at_least`` or more."""

    words: int
    at_least: Fraction

    def most_apart(self, sizes: int | np.ndarray) -> int | np.ndarray:
        """The largest symmetric difference of linked sets whose sizes add up to ``sizes``."""
        t = self.at_least
        return (t.denominator - t.numerator) * sizes // (t.denominator + t.numerator)

    def linked(self, shared, sizes):
        """``sizes`` is the sum of both; works on numbers and arrays."""
        t = self.at_least
        return t.denominator * shared >= t.numerator * (sizes - shared)


def shingle_sets(texts: pa.Array, words: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; fewer words than one shingle count as
    one, no word as none."""
    hashes, begin = word_hashes(texts)
    factors = numbered(words + 1, 11) | np.uint64(1)
    n = max(len(hashes) - words + 1, 0)
    rolled = np.zeros(n, np.uint64)
    for j in range(words):
        rolled += hashes[j : j + n] * factors[j]
    rolled = mix(rolled)
    out = []
    for low, high in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True):
        if high - low >= words:
            out.append(np.unique(rolled[low : high - words + 1]))
        elif high > low:
            # The number of words is one more summand, so lengths differ too.
            summands = np.append(hashes[low:high], np.uint64(high - low))
            used = np.append(factors[: high - low], factors[words])
            out.append(mix((summands * used).sum(dtype=np.uint64, keepdims=True)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def bands(size: int, similarity: Similarity) -> list[tuple[int, int]]:
    """(band, largest size in it) of the bands that a size takes part in: its own, and those
    in which a smaller partner can lie. A pair meets in the band of its smaller set."""
    t = similarity.at_least
    out, top, band = [], 1, 0
    while True:
        # Largest partner of the largest set of the band.
        if top * t.denominator >= size * t.numerator:
            out.append((band, top))
        if top >= size:
            return out
        band, top = band + 1, max(top + 1, int(top * BAND_RATIO))


def sketch_keys(shingles: np.ndarray, similarity: Similarity) -> np.ndarray:
    """The keys of a set: two linked sets that are not equal have one in common."""
    keys = []
    for band, top in bands(len(shingles), similarity):
        # Of the band's largest set and its largest partner.
        t = similarity.at_least
        apart = similarity.most_apart(top + top * t.denominator // t.numerator)
        if apart:
            keys.append(band_keys(shingles, band, apart + 1))
    return np.unique(np.concatenate(keys)) if keys else np.zeros(0, np.uint64)


def band_keys(shingles: np.ndarray, band: int, blocks: int) -> np.ndarray:
    parts = blocks * PARTS
    width = min(PART_BITS, (1 << 32) // parts)
    bits = np.uint64(parts * width)
    # Positions rise with the sorted hashes. An even number of shingles leaves a bit unset.
    at = ((shingles >> np.uint64(32)) * bits) >> np.uint64(32)
    edge = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    times = np.diff(np.append(edge, len(at)))
    at = at[edge[times & 1 == 1]]
    # A part's value stands for its bits: the exclusive or of a code for each set bit.
    edges = np.searchsorted(at, np.arange(parts + 1, dtype=np.uint64) * np.uint64(width))
    run = np.zeros(len(at) + 1, np.uint64)
    np.bitwise_xor.accumulate(mix(at + np.uint64(1)), out=run[1:])
    value = (run[edges[1:]] ^ run[edges[:-1]]).reshape(blocks, PARTS)
    count = np.diff(edges).reshape(blocks, PARTS)
    block, set_bits = np.bitwise_xor.reduce(value, axis=1), count.sum(axis=1)
    named = mix(block + numbered_blocks(blocks, band))
    few = np.flatnonzero(set_bits <= FEW)
    keys = [named[set_bits > FEW]]
    if len(few) and blocks > 1:
        after = (few + 1) % blocks
        for half in (0, 1):
            cut = slice(3 * half, 3 * half + 3)
            half_value = np.bitwise_xor.reduce(value[after, cut], axis=1)
            known = mix(named[few] + half_value + np.uint64(half + 1))
            both = set_bits[few] + count[after, cut].sum(axis=1)
            still = both <= FEW_BOTH if blocks > 2 else np.zeros(len(few), bool)
            keys.append(known[~still])
            then = (few[still] + 2) % blocks
            for third in (0, 1, 2):
                cut = slice(2 * third, 2 * third + 2)
                third_value = np.bitwise_xor.reduce(value[then, cut], axis=1)
                keys.append(mix(known[still] + third_value + np.uint64(third + 3)))
    return np.concatenate(keys)


def numbered_blocks(blocks: int, band: int) -> np.ndarray:
    return numbered(blocks, 1000 + band)


def short_sketch(shingles: np.ndarray) -> bytes:
    """A parity sketch of at least one bit per shingle, a power of two.

    Its halves, one over the other, are the sketch of half as many bits.
    """
    bits = max(SHORT_BITS, 1 << max(len(shingles) - 1, 0).bit_length())
    flips = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((flips & 1).astype(np.uint8)).tobytes()


def folded(sketch: bytes, size: int) -> np.ndarray:
    """The sketch folded to ``size`` bytes."""
    return np.bitwise_xor.reduce(np.frombuffer(sketch, np.uint64).reshape(-1, size // 8), axis=0)


PROFILE = "doc_id long, text_hash long, n_shingles long, set_low long, set_high long, sketch binary"


def set_names(sets: list[np.ndarray]) -> list[np.ndarray]:
    """Two 64-bit numbers per set that name it."""
    low = [s.sum(dtype=np.uint64) for s in sets]
    high = [mix(s).sum(dtype=np.uint64) for s in sets]
    return [np.array(x, np.uint64).view(np.int64) for x in (low, high)]


def profiles(docs: DataFrame, similarity: Similarity) -> DataFrame:
    """Size, identity (128 bits) and short sketch of every document's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", STEP_BYTES):
            sets = shingle_sets(batch.column("text"), similarity.words)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_hash"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    *map(pa.array, set_names(sets)),
                    pa.array([short_sketch(s) for s in sets], pa.binary()),
                ],
                names=[part.split()[0] for part in PROFILE.split(", ")],
            )

    return docs.mapInArrow(run, PROFILE)


def keys_of_sets(docs: DataFrame, similarity: Similarity) -> DataFrame:
    """(set_low, keys) from the texts: the keys take more room than a second look at the texts
    takes time. A task gives the keys of a set once; rows of it with an equal set have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in chunks(batches, "text", STEP_BYTES):
            sets = shingle_sets(batch.column("text"), similarity.words)
            low, high = set_names(sets)
            keys = []
            for s, name in zip(sets, zip(low.tolist(), high.tolist(), strict=True), strict=True):
                if name in seen or not len(s):
                    keys.append(np.zeros(0, np.int64))
                    continue
                if len(seen) >= REMEMBERED:
                    seen.clear()
                seen.add(name)
                keys.append(sketch_keys(s, similarity).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(low), pa.array(keys, pa.list_(pa.int64()))], names=["set_low", "keys"]
            )

    return docs.mapInArrow(run, "set_low long, keys array<long>")


def sharing_a_key(keys: DataFrame) -> DataFrame:
    """(key, set_low), once each, of the keys that several sets have."""
    within = Window.partitionBy("key").orderBy("set_low")
    # The second set of a key brings the first one along.
    told = F.when(F.col("before") == F.col("least"), F.array("least", "set_low")).otherwise(F.array("set_low"))
    return (
        keys.withColumn("least", F.min("set_low").over(within))
        .withColumn("before", F.lag("set_low").over(within))
        .where("set_low <> least and set_low <> before")
        .select("key", F.explode(told).alias("set_low"))
    )


def possible(n_a, n_b, apart, similarity: Similarity) -> np.ndarray:
    t = similarity.at_least
    low, high = np.minimum(n_a, n_b), np.maximum(n_a, n_b)
    return (apart <= similarity.most_apart(n_a + n_b)) & (t.denominator * low >= t.numerator * high)


def keyed_sets(shared: DataFrame) -> DataFrame:
    """(set_low, keys): the keys of each set with the number of sets that have them, those of
    most sets first. Of keys with the same sets only one counts."""
    once = (
        shared.groupBy("key")
        .agg(
            F.count("*").alias("n"),
            F.bit_xor(F.xxhash64("set_low")).alias("who"),
            F.bit_xor(F.xxhash64("set_low", F.lit(1))).alias("who_too"),
        )
        .groupBy("n", "who", "who_too")
        .agg(F.min("key").alias("key"))
        .select("key", (-F.col("n")).alias("less"))
    )
    keys = F.sort_array(F.collect_list(F.struct("less", "key")))
    return shared.join(once, "key").groupBy("set_low").agg(keys.alias("keys"))


def in_cells(members: DataFrame) -> DataFrame:
    """Splits each key's sets into cells of about BLOCK and pairs the cells.

    A set goes to as many cell pairs as its key has cells, one pair for most. ``earlier`` are
    the set's keys before this one.
    """
    listed = members.select("*", F.posexplode("keys").alias("at", "own"))
    split = listed.select(
        F.col("own.key").alias("key"),
        F.ceil(-F.col("own.less") / BLOCK).cast("int").alias("cells"),
        F.slice("keys.key", F.lit(1), F.col("at")).alias("earlier"),
        "set_id", "n_shingles", "copies", "sketch",
    )
    own = split.withColumn("cell", F.pmod(F.xxhash64("set_id"), F.col("cells")).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("cells") - 1))
    return own.withColumn("other", every).select(
        "key",
        F.least("cell", "other").alias("cell_a"),
        F.greatest("cell", "other").alias("cell_b"),
        (F.col("cell") > F.col("other")).cast("int").alias("side"),
        "set_id", "n_shingles", "copies", "sketch", "earlier",
    )


def runs(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[list[dict]]:
    """The rows of each run of equal ``names`` of a sorted stream. A column ``earlier`` stays an array."""
    held: list[dict] = []
    name = None
    for batch in batches:
        arrays = {c: batch.column(c) for c in batch.schema.names if c == "earlier"}
        rows = batch.select([c for c in batch.schema.names if c not in arrays]).to_pylist()
        for c, array in arrays.items():
            ends, values = array.offsets.to_numpy(), array.values.to_numpy()
            for row, low, high in zip(rows, ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                row[c] = values[low:high]
        for row in rows:
            own = tuple(row[c] for c in names)
            if own != name:
                if held:
                    yield held
                held, name = [], own
            held.append(row)
    if held:
        yield held


CELL = ["key", "cell_a", "cell_b"]
JOB = [*CELL, "part_a", "part_b"]
JOBS = (
    "key long, cell_a int, cell_b int, part_a int, part_b int, set_id long, copies long, partners array<long>"
)


def parts(sizes: np.ndarray) -> np.ndarray:
    """A number of its part for each set: parts have few sets, and few shingles if sets are large."""
    by_shingles = (np.cumsum(sizes) - sizes) // PART_SHINGLES
    return by_shingles + np.arange(len(sizes)) // PART_SETS


def possible_links(cells: DataFrame, similarity: Similarity) -> DataFrame:
    """The possible links between the sets of each cell pair, as jobs of bounded size.

    A job has one row for each of its sets; ``partners`` are those that the set is possibly
    linked with. Two sets that share several keys are held against each other in the first of
    them only. Rows come as a sorted stream; those of a cell pair are bounded by twice BLOCK or so.
    """

    def compare(rows: list[dict]) -> Iterator[tuple]:
        one = [r for r in rows if r["side"] == 0]
        two = [r for r in rows if r["side"] == 1]
        own = rows[0]["cell_a"] == rows[0]["cell_b"]
        if own:
            two = one
        if not one or not two:
            return
        # Sizes in one band differ little, so most sketches have one length already.
        size = min(len(r["sketch"]) for r in rows)
        bits = [np.stack([folded(r["sketch"], size) for r in side]) for side in (one, two)]
        n = [np.array([r["n_shingles"] for r in side]) for side in (one, two)]
        part = [parts(x).tolist() for x in n]
        earlier: dict[int, frozenset] = {}
        jobs: dict[tuple[int, int], dict[int, list[int]]] = {}

        def before(row: dict) -> frozenset:
            if row["set_id"] not in earlier:
                earlier[row["set_id"]] = frozenset(row["earlier"].tolist())
            return earlier[row["set_id"]]

        for i, row in enumerate(one):
            after = i + 1 if own else 0
            apart = np.bitwise_count(bits[0][i] ^ bits[1][after:]).sum(axis=1, dtype=np.int64)
            good = possible(n[0][i], n[1][after:], apart, similarity)
            for j in (np.flatnonzero(good) + after).tolist():
                if before(row).isdisjoint(before(two[j])):
                    job = jobs.setdefault((part[0][i], part[1][j]), {})
                    job.setdefault(i, []).append(j)
        cell = tuple(rows[0][c] for c in CELL)
        for at, partners in jobs.items():
            for i, js in partners.items():
                yield (*cell, *at, one[i]["set_id"], one[i]["copies"], [two[j]["set_id"] for j in js])
            alone = {j for js in partners.values() for j in js}
            for j in alone.difference(partners) if own else alone:
                yield (*cell, *at, two[j]["set_id"], two[j]["copies"], [])

    kinds = [pa.int64(), *[pa.int32()] * 4, pa.int64(), pa.int64(), pa.list_(pa.int64())]
    names = [*JOB, "set_id", "copies", "partners"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []

        def out() -> pa.RecordBatch:
            columns = zip(*found, strict=True) if found else [[]] * len(names)
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            found.clear()
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for rows in runs(batches, CELL):
            found += compare(rows)
            if len(found) > 10_000:
                yield out()
        yield out()

    return cells.repartition(*CELL).sortWithinPartitions(*CELL).mapInArrow(run, JOBS)


def texts_of_sets(docs: DataFrame, nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """(set_id, text) of the documents ``set_id``, once each."""
    ids = sets.select(F.col("set_id").alias("doc_id")).distinct()
    wanted = nodes.select("doc_id", "text_hash").join(ids, "doc_id", "left_semi")
    found = docs.join(wanted, ["doc_id", "text_hash"], "left_semi")
    return found.groupBy(F.col("doc_id").alias("set_id")).agg(F.first("text").alias("text"))


COUNTED = "set_id long, least long, n_sets long, n_documents long"


def counted_links(jobs: DataFrame, texts: DataFrame, similarity: Similarity) -> DataFrame:
    """The links of the sets in each job, found by the exact sets of their texts.

    ``n_sets`` counts a set's links in the job, ``n_documents`` the documents behind them;
    ``least`` is the smallest set that it reaches by them. A set that links with nothing has no row.
    """

    def count(rows: list[dict]) -> Iterator[tuple[int, int, int, int]]:
        text = pa.array([r["text"] for r in rows], pa.large_string())
        one = pa.RecordBatch.from_arrays([text], names=["text"])
        sets = [s for step in chunks([one], "text", STEP_BYTES) for s in shingle_sets(step.column("text"), similarity.words)]
        # Hashes as small numbers: a set is marked, and the marks of others are counted.
        _, small = np.unique(np.concatenate(sets), return_inverse=True)
        own = np.split(small, np.cumsum([len(s) for s in sets])[:-1])
        marked = np.zeros(len(small), bool)
        place = {r["set_id"]: i for i, r in enumerate(rows)}
        least = list(range(len(rows)))
        n_sets, n_documents = [0] * len(rows), [0] * len(rows)

        def top(i: int) -> int:
            while least[i] != i:
                least[i] = i = least[least[i]]
            return i

        for i, row in enumerate(rows):
            if not row["partners"]:
                continue
            marked[own[i]] = True
            for j in map(place.__getitem__, row["partners"]):
                shared = int(np.count_nonzero(marked[own[j]]))
                if similarity.linked(shared, len(own[i]) + len(own[j])):
                    for x, y in ((i, j), (j, i)):
                        n_sets[x] += 1
                        n_documents[x] += rows[y]["copies"]
                    x, y = top(i), top(j)
                    if rows[x]["set_id"] > rows[y]["set_id"]:
                        x, y = y, x
                    least[y] = x
            marked[own[i]] = False
        for i, row in enumerate(rows):
            if n_sets[i]:
                yield (row["set_id"], rows[top(i)]["set_id"], n_sets[i], n_documents[i])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[int, int, int, int]] = []

        def out() -> pa.RecordBatch:
            arrays = [pa.array([row[k] for row in found], pa.int64()) for k in range(4)]
            found.clear()
            return pa.RecordBatch.from_arrays(arrays, names=["set_id", "least", "n_sets", "n_documents"])

        for rows in runs(batches, JOB):
            found += count(rows)
            if len(found) > 10_000:
                yield out()
        yield out()

    ordered = jobs.join(texts, "set_id").repartition(*JOB).sortWithinPartitions(*JOB)
    return ordered.select(*JOB, "set_id", "copies", "partners", "text").mapInArrow(run, COUNTED)


def near_duplicates(
    docs: DataFrame, similarity: Similarity, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """doc_id, n_shingles, set_id, n_links, n_verified_links, component_id for every row.

    ``set_id`` is the smallest document with an equal set; ``n_links`` counts the documents
    that a document is linked with, those with an equal set included; ``n_verified_links``
    counts the other sets that its set is linked with; ``component_id`` is the smallest
    document reachable by links. Documents without words, null texts included, link with
    nothing and form components of their own. Rows without an id get no component and link
    with nothing. Ids are taken to be unique: rows that repeat one are one document, with the
    text of the smallest hash. An empty table gives no rows. Other columns are not read.
    """
    spark = prepare(docs.sparkSession)
    ship_package(spark)
    slim = docs.selectExpr(f"cast(`{doc_id}` as long) doc_id", f"`{text}` text").withColumn(
        "text_hash", F.xxhash64("text")
    )
    profile = staged(profiles(slim, similarity), "profiles")
    full = profile.where("n_shingles > 0 and doc_id is not null")
    same_set = ["n_shingles", "set_low", "set_high"]
    one = full.groupBy("doc_id").agg(
        F.min(F.struct("text_hash", *same_set, "sketch")).alias("own"), F.max("text_hash").alias("last_hash")
    )
    one = one.select("doc_id", "own.*", "last_hash")
    sets = one.groupBy(*same_set).agg(F.min("doc_id").alias("set_id"), F.count("*").alias("copies"))
    # The further key makes Spark deal out both sides anew, so that it can split the rows of a
    # set that very many documents have.
    by_set = [*same_set, "set_hash"]
    one, sets = (df.withColumn("set_hash", F.xxhash64(*same_set)) for df in (one, sets))
    nodes = staged(one.join(sets, by_set).drop("set_hash"), "nodes")
    set_of = nodes.select("doc_id", "set_id")

    # Of an id with several texts only one counts; others must not stand for a set. A table of
    # its own, so that Spark knows that it is small.
    several = staged(
        nodes.where("last_hash <> text_hash").select("doc_id", F.col("text_hash").alias("own_hash")), "several"
    )
    own_text = F.coalesce(F.col("text_hash") == F.col("own_hash"), F.lit(True))
    counting = slim.where("doc_id is not null").join(several, "doc_id", "left").where(own_text)
    keyed = keys_of_sets(counting.select("text"), similarity)
    keys = keyed.select(F.explode("keys").alias("key"), "set_low")
    shared = staged(sharing_a_key(keys), "shared-keys")
    own_sets = nodes.where("doc_id = set_id")
    # Should two sets share one half of their names, both are looked at.
    members = keyed_sets(shared).join(
        own_sets.select("set_low", "set_id", "n_shingles", "copies", "sketch"), "set_low"
    )
    members = staged(members.drop("set_low"), "members")
    jobs = staged(possible_links(in_cells(members), similarity), "jobs")
    counted = staged(counted_links(jobs, texts_of_sets(slim, nodes, jobs), similarity), "links")
    links = counted.where("set_id <> least").select(F.col("least").alias("a"), F.col("set_id").alias("b"))
    labels = components(links)

    sizes = own_sets.select("set_id", "copies")
    n_links = counted.groupBy("set_id").agg(
        F.sum("n_sets").alias("n_verified_links"), F.sum("n_documents").alias("n_linked")
    )
    # A further key, as above: a set may be that of very many documents.
    of_sets = sizes.join(labels.withColumnRenamed("node", "set_id"), "set_id", "left").join(
        n_links, "set_id", "left"
    )
    placed = set_of.withColumn("set_key", F.xxhash64("set_id")).join(
        of_sets.withColumn("set_key", F.xxhash64("set_id")), ["set_id", "set_key"], "left"
    )
    others = F.col("copies") - 1 + F.coalesce("n_linked", F.lit(0))
    return (
        profile.select("doc_id", "n_shingles")
        .join(placed, "doc_id", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.coalesce("set_id", "doc_id").alias("set_id"),
            F.coalesce(others, F.lit(0)).alias("n_links"),
            F.coalesce("n_verified_links", F.lit(0)).alias("n_verified_links"),
            F.coalesce("component", "set_id", "doc_id").alias("component_id"),
        )
    )
