"""Alignment of two tokenizers: which tokens of one cover the bytes of which of the other.

A is a byte-level vocabulary of the tokenizers library, B a SentencePiece model that puts a
blank in front; both then spell the same bytes. Places where tokens of both end cut a text into
groups, and tokens whose bytes overlap are linked. A corpus count says in how many documents a
pair of ids is linked.

Identity map: for each id of A, the id of B with the same bytes is known beforehand, so nearly
all links are one number, an id of A. A task counts those in one vector as long as the
vocabulary. Other pairs get numbers within a shard of documents; a shard sends one row per pair
to the shuffle, with the number of its documents that hold it, and gets the corpus counts of its
pairs back. The links of a document are kept as numbers meanwhile, so texts are encoded once.

Both tokenizers may be cut in front of most blanks, and pieces repeat: each distinct piece is
encoded and aligned once per worker, in a bounded cache.

Defined results: texts that are null or empty, or whose joined token bytes differ from a blank
and the text (the blank sign of B reads as a blank), have no tokens: all numbers are 0 and the
groups are empty. Every row is a document, rows that repeat or have no id too; an empty table
gives no rows; only the id and the text are read, whatever other columns are called.
"""

from __future__ import annotations

import itertools
import re
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import chunks, kept_in_worker, prepare, staged, texts_of
from tidecast.llm.sentencepiece_table import BLANK, sha256
from tidecast.llm.tokens import TO_CHARACTERS, Encoder, WordCache
from tidecast.session import ship_package

# Characters of pieces that a worker remembers, and the documents and pairs of a shard.
REMEMBERED = 3_000_000
SHARD_DOCS, SHARD_PAIRS = 20_000, 1 << 18
LEAD = "a"
FEED = re.compile(r"(?<=\S)(?=\n\S)")

ALIGNED = (
    "kind int, shard long, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
    "groups string, links binary, pair long, place long, docs long"
)
RESULT = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"
)


class Aligner:
    """Groups and links of pieces of texts for one pair of tokenizer files.

    A link is a number: the id of A if B's id has the same bytes, else ``n_a`` and more, for
    ids a and b ``n_a + a * n_b + b``.
    """

    def __init__(self, path_a: str, path_b: str, remembered: int = REMEMBERED):
        import sentencepiece

        self.a = Encoder(path_a, cache_size=remembered // 8, special_is_text=True)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte_of = {c: b for b, c in TO_CHARACTERS.items()}
        vocabulary = self.a.library.get_vocab(with_added_tokens=True)
        self.n_a, self.n_b = max(vocabulary.values()) + 1, self.b.get_piece_size()
        self.bytes_a = [b""] * self.n_a
        for text, i in vocabulary.items():
            if all(c in byte_of for c in text):
                self.bytes_a[i] = bytes(map(byte_of.__getitem__, text))
        pieces = [self.b.id_to_piece(i) for i in range(self.n_b)]
        self.bytes_b = [
            bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace(BLANK, " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.starts_b = np.array([p[:1] == BLANK for p in pieces])
        self.feeds_b = np.array([x == b"\n" for x in self.bytes_b])
        self.size_a, self.size_b = (np.array(list(map(len, x)), np.int64) for x in (self.bytes_a, self.bytes_b))
        # Of entries with the same bytes, pieces go before byte tokens.
        own: dict[bytes, int] = {}
        for i in sorted(range(self.n_b), key=lambda i: (self.b.is_byte(i), i)):
            if not (self.b.is_control(i) or self.b.is_unknown(i) or self.b.is_unused(i)):
                own.setdefault(self.bytes_b[i], i)
        self.same = np.array([own.get(x, -1) if x else -1 for x in self.bytes_a], np.int64)
        self.before = len(self.b.encode(LEAD))
        # Words after a single blank, and whole pieces around runs of blanks.
        self.words, self.runs = WordCache(remembered), WordCache(remembered // 8)
        self.decimal = [f"{i}{sign}" for i in range(max(self.n_a, self.n_b)) for sign in ",|;"]

    def ids_b(self, pieces: list[str]) -> list[list[int]]:
        """Ids of pieces that begin with a blank or a line feed each; many by one library call."""
        out: list[list[int]] = [[]] * len(pieces)
        left = set(range(len(pieces)))
        for sign, first in ((" ", self.starts_b), ("\n", self.feeds_b)):
            own = [i for i in left if pieces[i][0] == sign and len(pieces[i]) > 1 and sign not in pieces[i][1:]]
            if sign == "\n":
                own = [i for i in own if " " not in pieces[i]]
            if not own:
                continue
            joined = "".join([pieces[i] for i in own])
            # The library puts a blank in front of the first one.
            ids = self.b.encode(joined[1:] if sign == " " else joined)
            ids = ids if sign == " " else ids[1:]
            at = np.flatnonzero(first[np.array(ids, np.int64)]).tolist()
            if len(at) == len(own):
                for i, low, high in zip(own, at, [*at[1:], len(ids)], strict=True):
                    out[i] = ids[low:high]
                left.difference_update(own)
        for i in left:
            # Behind another character, so that a piece of blanks only keeps them.
            out[i] = self.b.encode(LEAD + pieces[i])[self.before :]
        return out

    def learn(self, cache: WordCache, words: Iterable[str], lead: str) -> None:
        """word -> (groups, n_a, n_b, n_groups and n_links, links), or None if bytes differ.

        A word follows ``lead``; one that begins with a line feed stands as it is.
        """
        absent = list(cache.missing(words))
        if not absent:
            return
        lines = [w for w in absent if w[:1] == "\n"] if lead else []
        led = [w for w in absent if w[:1] != "\n"] if lead else absent
        absent = [*led, *lines]
        own = self.a.later if lead else self.a.first
        raw_a = []
        for kept, some, before in ((own, led, lead), (self.a.first, lines, "")):
            if some:
                self.a.fill(kept, some, before)
                raw_a += map(kept.new.__getitem__, some)
        pieces = [*[lead + w for w in led], *lines]
        ids_b = self.ids_b(pieces)
        n_a, n_b = np.array(list(map(len, raw_a))) // 4, np.array(list(map(len, ids_b)))
        a = np.frombuffer(b"".join(raw_a), "<u4").astype(np.int64)
        b = np.fromiter(itertools.chain.from_iterable(ids_b), np.int64, int(n_b.sum()))
        raw = [p.encode() for p in pieces]
        good = np.ones(len(pieces), bool)
        spelt_a, spelt_b = list(map(self.bytes_a.__getitem__, a)), list(map(self.bytes_b.__getitem__, b))
        ends = np.cumsum(list(map(len, raw)))
        same_length = all(
            np.array_equal(np.concatenate([[0], np.cumsum(size[ids])])[np.cumsum(n)], ends)
            for size, ids, n in ((self.size_a, a, n_a), (self.size_b, b, n_b))
        )
        if not (same_length and b"".join(spelt_a) == b"".join(spelt_b) == b"".join(raw)):
            for i, (own_raw, cut_a, cut_b) in enumerate(zip(raw, np.cumsum(n_a), np.cumsum(n_b), strict=True)):
                both = b"".join(spelt_a[cut_a - n_a[i] : cut_a]), b"".join(spelt_b[cut_b - n_b[i] : cut_b])
                good[i] = both == (own_raw, own_raw)
            cache.new.update((w, None) for w, fine in zip(absent, good, strict=True) if not fine)
            a, b = a[np.repeat(good, n_a)], b[np.repeat(good, n_b)]
        if good.any():
            made = self.aligned(a, b, n_a[good], n_b[good])
            cache.new.update(zip((w for w, fine in zip(absent, good, strict=True) if fine), made, strict=True))

    def aligned(self, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> Iterator[tuple]:
        """Groups, numbers and links of many pieces at once, on end; n_a and n_b tokens each."""
        end_a, end_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        both = np.intersect1d(end_a, end_b, assume_unique=True)
        low = np.searchsorted(end_b, end_a - self.size_a[a], "right")
        n = np.searchsorted(end_b, end_a, "left") - low + 1
        one = np.repeat(np.arange(len(a)), n)
        other = np.arange(len(one)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
        link = np.where(
            self.same[a[one]] == b[other], a[one], self.n_a + a[one] * self.n_b + b[other]
        ).astype("<i8")
        # Each group's ids of A, then those of B.
        turn = np.concatenate([2 * np.searchsorted(both, end_a), 2 * np.searchsorted(both, end_b) + 1])
        order = np.argsort(turn, kind="stable")
        ids, turn = np.concatenate([a, b])[order], turn[order]
        more = np.append(turn[1:] == turn[:-1], False)
        # The numbers' texts with each sign that may follow.
        sign = np.where(more, 0, 1 + (turn & 1))
        spelt = list(map(self.decimal.__getitem__, (3 * ids + sign).tolist()))
        ends = np.cumsum(n_a)
        cut_text = np.cumsum(n_a + n_b).tolist()
        cut_link = np.cumsum(n)[ends - 1]
        groups = np.searchsorted(both, end_a[ends - 1], "right")
        numbers = np.stack([n_a, n_b, np.diff(groups, prepend=0), np.diff(cut_link, prepend=0)], axis=1)
        raw, packed = link.tobytes(), numbers.astype("<i8").tobytes()
        cuts = zip(
            range(len(n_a)), itertools.pairwise([0, *cut_text]), itertools.pairwise([0, *cut_link.tolist()]), strict=True
        )
        for i, (t0, t1), (l0, l1) in cuts:
            yield "".join(spelt[t0:t1]), packed[32 * i : 32 * i + 32], raw[8 * l0 : 8 * l1]

    def pieces(self, text: str) -> tuple[list[str], bool]:
        """The pieces of a text, and whether runs of blanks keep them longer.

        Words follow a blank each. A line feed between two characters that are no white space
        joins with neither in A or B, so what follows it is a piece of its own.
        """
        lead = " " + text
        if self.a.has_runs(lead) or " \n" in lead:
            return self.a.cuts.findall(lead), True
        words = text.split(" ")
        if "\n" in text:
            words = [part for w in words for part in (FEED.split(w) if "\n" in w else (w,))]
        return words, False

    def texts(self, texts: list[str]) -> list[tuple[str, np.ndarray, np.ndarray, np.ndarray] | None]:
        """Groups, [n_a, n_b, n_groups, n_links], distinct links, how often each stands; by text."""
        cut = [None if not t or BLANK in t else self.pieces(t) for t in texts]
        for cache, lead in ((self.words, " "), (self.runs, "")):
            own = [words for words, runs in filter(None, cut) if runs == (not lead)]
            self.learn(cache, set().union(*own), lead)
        return [made and self.summed(*made) for made in cut]

    def summed(self, words: list[str], runs: bool) -> tuple[str, np.ndarray, np.ndarray, np.ndarray] | None:
        known = (self.runs if runs else self.words).new
        times = Counter(words)
        found = list(map(known.__getitem__, times))
        if None in found:
            return None
        n = np.fromiter(times.values(), np.int64, len(times))
        numbers = np.frombuffer(b"".join(map(itemgetter(1), found)), "<i8").reshape(-1, 4)
        links = np.frombuffer(b"".join(map(itemgetter(2), found)), "<i8")
        distinct, at = np.unique(links, return_inverse=True)
        often = np.bincount(at, np.repeat(n, numbers[:, 3]), len(distinct)).astype(np.int64)
        spelt = "".join(map(itemgetter(0), map(known.__getitem__, words)))[:-1]
        return spelt, n @ numbers, distinct, often

    def text(self, text: str) -> tuple[str, np.ndarray, np.ndarray, np.ndarray] | None:
        return self.texts([text])[0]


_aligners: dict[tuple[str, str], Aligner] = kept_in_worker()


def aligner(path_a: str, path_b: str) -> Aligner:
    key = (path_a, path_b)
    if key not in _aligners:
        _aligners[key] = Aligner(path_a, path_b)
    return _aligners[key]


class Shard:
    """Numbers for the pairs of some documents, and how many of these hold each."""

    def __init__(self, n_a: int):
        self.name = uuid.uuid4().int >> 65
        self.same = np.zeros(n_a, np.int64)
        self.places: dict[int, int] = {}
        self.docs = np.zeros(1024, np.int64)
        self.size = 0

    def add(self, links: np.ndarray) -> np.ndarray:
        """The links as numbers of this shard."""
        split = int(np.searchsorted(links, len(self.same)))
        self.size += 1
        self.same[links[:split]] += 1
        pairs, known = links[split:].tolist(), self.places
        place = np.fromiter(map(known.get, pairs, itertools.repeat(-1)), np.int64, len(pairs))
        for at in np.flatnonzero(place < 0).tolist():
            place[at] = known[pairs[at]] = len(known)
        if len(known) > len(self.docs):
            self.docs = np.concatenate([self.docs, np.zeros(2 * len(known), np.int64)])
        # A document's links are distinct.
        self.docs[place] += 1
        return np.concatenate([links[:split], len(self.same) + place])

    def full(self) -> bool:
        return self.size >= SHARD_DOCS or len(self.places) >= SHARD_PAIRS

    def rows(self) -> dict[str, np.ndarray]:
        """A row per pair and per id of A that stand in the shard."""
        same = np.flatnonzero(self.same)
        return {
            "pair": np.concatenate([same, np.fromiter(self.places, np.int64, len(self.places))]),
            "place": np.concatenate([same, len(self.same) + np.arange(len(self.places))]),
            "docs": np.concatenate([self.same[same], self.docs[: len(self.places)]]),
        }


def table_of(columns: dict, n: int, kinds: str) -> pa.RecordBatch:
    types = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = [part.split() for part in kinds.split(", ")]
    arrays = [
        pa.array(columns[name], types[kind]) if name in columns else pa.nulls(n, types[kind])
        for name, kind in fields
    ]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in fields])


def aligned_shards(docs: DataFrame, path_a: str, path_b: str, digests_only: bool) -> DataFrame:
    """Rows of documents (kind 1) and rows of the pairs of shards (kind 0)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(path_a, path_b)
        shard = Shard(own.n_a)

        def pairs() -> pa.RecordBatch:
            rows = shard.rows()
            n = len(rows["pair"])
            return table_of({"kind": np.zeros(n, np.int32), "shard": np.full(n, shard.name), **rows}, n, ALIGNED)

        for batch in chunks(batches, "text"):
            numbers, groups, links = [], [], []
            for made in own.texts(texts_of(batch.column("text"))):
                if made is None:
                    made = "", np.zeros(4, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
                spelt, n, distinct, often = made
                numbers.append(n)
                groups.append(sha256(spelt) if digests_only and spelt else spelt)
                links.append(np.concatenate([shard.add(distinct), often]).astype("<u4").tobytes())
            n = batch.num_rows
            columns = dict(zip(("n_a", "n_b", "n_groups", "n_links"), np.stack(numbers).T.copy(), strict=True))
            columns |= {"kind": np.ones(n, np.int32), "shard": np.full(n, shard.name)}
            columns |= {"doc_id": batch.column("doc_id"), "groups": groups, "links": links}
            yield table_of(columns, n, ALIGNED)
            if shard.full():
                yield pairs()
                shard = Shard(own.n_a)
        yield pairs()

    return docs.mapInArrow(run, ALIGNED)


def vector_of(rows: list, size: int) -> np.ndarray:
    out = np.zeros(size, np.int64)
    for at, value in rows:
        out[at] = value
    return out


def align_tokens(
    docs: DataFrame,
    path_a: str,
    path_b: str,
    text: str = "text",
    doc_id: str = "doc_id",
    digests_only: bool = False,
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups for every row.

    ``groups`` is ``a1,a2|b1;a3|b2,b3``, or its SHA-256 digest. ``n_best`` counts the links whose
    pair has the highest corpus count of its id of A, ``count_sum`` adds up the counts of all.
    """
    spark = prepare(docs.sparkSession)
    ship_package(spark)
    own = aligner(path_a, path_b)
    n_a, n_b = own.n_a, own.n_b
    slim = docs.selectExpr(f"cast(`{doc_id}` as long) doc_id", f"`{text}` text")
    made = staged(aligned_shards(slim, path_a, path_b, digests_only), "aligned")
    pairs = made.where("kind = 0").select("shard", "pair", "place", "docs")
    # As long as the vocabulary, both.
    same = pairs.where(F.col("pair") < n_a).groupBy("pair").agg(F.sum("docs"))
    totals = staged(
        pairs.where(F.col("pair") >= n_a).groupBy("pair").agg(F.sum("docs").alias("total")), "pair-counts"
    )
    highest = totals.groupBy(F.expr(f"(pair - {n_a}) div {n_b}").alias("a")).agg(F.max("total"))
    count = vector_of(same.collect(), n_a)
    best = np.maximum(count, vector_of(highest.collect(), n_a))
    held = spark.sparkContext.broadcast((count, best))
    shards = pairs.select("shard").distinct().count()

    counted = pairs.where(F.col("pair") >= n_a).join(totals, "pair")
    aligned = made.where("kind = 1").drop("pair", "place", "docs")
    answers = counted.select(F.lit(0).alias("kind"), "shard", "pair", "place", "total")
    rows = aligned.unionByName(answers, allowMissingColumns=True)
    # Far more tasks than shards, so that hardly a task gets several.
    ordered = rows.repartition(max(4 * shards, 1), "shard").sortWithinPartitions("shard", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, best = held.value
        name, totals, tops = None, [], []
        for batch in batches:
            kinds = batch.column("kind").to_numpy()
            names = batch.column("shard").to_numpy()
            cut = np.flatnonzero((kinds[1:] != kinds[:-1]) | (names[1:] != names[:-1])) + 1
            for low, high in itertools.pairwise([0, *cut.tolist(), batch.num_rows]):
                part = batch.slice(low, high - low)
                if names[low] != name:
                    name, totals, tops = names[low], [count], [best]
                if not kinds[low]:
                    # The pairs of a shard come in no order.
                    places = part.column("place").to_numpy() - n_a
                    found = part.column("total").to_numpy()
                    top = best[(part.column("pair").to_numpy() - n_a) // n_b]
                    totals.append((places, found))
                    tops.append((places, top))
                    continue
                if len(totals) > 1:
                    totals, tops = [joined(totals)], [joined(tops)]
                sums, bests = [], []
                for raw in part.column("links").to_pylist():
                    link, often = np.split(np.frombuffer(raw, "<u4").astype(np.int64), 2)
                    sums.append(int(often @ totals[0][link]))
                    bests.append(int(often @ (totals[0][link] == tops[0][link])))
                columns = {c: part.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups")}
                yield table_of({**columns, "n_best": bests, "count_sum": sums}, high - low, RESULT)

    return ordered.mapInArrow(run, RESULT)


def joined(parts: list) -> np.ndarray:
    """A vector over the vocabulary, then the values of a shard's pairs by place."""
    first, *rest = parts
    places, values = (np.concatenate(x) for x in zip(*rest, strict=True))
    out = np.zeros(len(first) + len(places), np.int64)
    out[: len(first)] = first
    out[len(first) + places] = values
    return out
