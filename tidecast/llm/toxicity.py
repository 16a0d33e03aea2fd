"""Toxicity by a factorization machine over hashed terms.

Terms are words (runs of bytes without ASCII non-letters, A-Z lower-cased) and their first
PREFIXES bytes, each once per document. A term has a linear weight and a vector; the product
of two terms' vectors is the weight of their meeting, so an insult counts more beside a group
mention than either alone. With S the sum of the vectors and Q the sum of their squares, all
pairs together are (S * S - Q) / 2.

The machine is fitted by Spark in one task on a bounded sample of labelled rows: each row is
taken by a hash of its id with a chance of SAMPLE_ROWS / (number of labelled rows). The model
has at most one weight and vector per bucket, so its size is bounded too.

Learned are terms that occur clearly more or less often in toxic documents, and terms of which
some pair is clearly more, or clearly less, toxic than either of the two and both odds together.
Pairs are counted before the fit, in several tasks: each takes the pairs of a share of the terms.
A pair can only be clearly more toxic if toxic documents hold it often enough, and clearly less
if others do, so only the pairs within documents of that kind are counted, of terms frequent
enough there, and those that reach the bound are held against the other kind.

Defined results: null and empty texts have no terms and get the score of the intercept; rows
without an id are scored and never learned from; several labels of one document count as the
largest; without labelled rows the score is 0 everywhere; an empty table gives no rows.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import NO_LETTER, chunks, let_go, prepare, span_hashes, staged, word_spans
from tidecast.session import ship_package

SAMPLE_ROWS = 20_000
BUCKETS = 1 << 20
PREFIXES = (4, 5, 6)


@dataclass(frozen=True)
class FactorSettings:
    factors: int = 8
    epochs: int = 8
    batch: int = 256
    rate: float = 0.1
    shrink: float = 1e-3
    # Terms are learned if they are in so many sampled documents, and if their shares in toxic
    # and other documents, or those of a pair, differ by so many standard errors: rare words
    # would be learned by heart otherwise.
    least_documents: int = 4
    least_deviation: float = 4.0
    seed: int = 1


def term_buckets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(document number, bucket) of every distinct term of each text, sorted."""
    data, starts, ends, begin = word_spans(texts, NO_LETTER)
    doc = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
    docs, terms = [doc], [span_hashes(data, starts, ends)]
    for size in PREFIXES:
        long = ends - starts > size
        low = starts[long]
        docs.append(doc[long])
        terms.append(span_hashes(data, low, low + size) * np.uint64(2 * size + 1))
    bucket = np.concatenate(terms) >> np.uint64(44)
    both = np.unique(np.concatenate(docs).astype(np.uint64) << np.uint64(20) | bucket)
    return (both >> np.uint64(20)).astype(np.int64), (both & np.uint64(BUCKETS - 1)).astype(np.int64)


class FactorizationMachine:
    """Weights and vectors of the learned terms; all other terms count nothing."""

    def __init__(self, buckets: np.ndarray, settings: FactorSettings):
        self.place = np.full(BUCKETS, -1, np.int32)
        self.place[buckets] = np.arange(len(buckets))
        self.buckets, self.settings = buckets, settings
        rng = np.random.default_rng(settings.seed)
        self.bias = np.zeros(1)
        self.weights = np.zeros(len(buckets))
        self.vectors = rng.normal(0, 0.01, (len(buckets), settings.factors))

    def sums(self, term: np.ndarray, doc: np.ndarray, n: int):
        """Score before the logistic, and the sum of vectors, per document."""
        linear = np.bincount(doc, self.weights[term], n)
        vectors = self.vectors[term]
        total = np.stack([np.bincount(doc, column, n) for column in vectors.T], axis=1)
        squares = np.bincount(doc, (vectors**2).sum(axis=1), n)
        return self.bias[0] + linear + ((total**2).sum(axis=1) - squares) / 2, total

    def learned(self, doc: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        term = self.place[bucket]
        return doc[term >= 0], term[term >= 0]

    def scores(self, doc: np.ndarray, bucket: np.ndarray, n: int) -> np.ndarray:
        doc, term = self.learned(doc, bucket)
        return logistic(self.sums(term, doc, n)[0])

    def fit(self, docs: list[np.ndarray], labels: np.ndarray) -> None:
        """Stochastic gradients of the log loss, each weight with a step size of its own."""
        own, rng = self.settings, np.random.default_rng(self.settings.seed)
        terms = [t[t >= 0] for t in (self.place[d] for d in docs)]
        rate = min(max(labels.mean(), 1e-6), 1 - 1e-6)
        self.bias[0] = np.log(rate / (1 - rate))
        past = [np.full(x.shape, 1e-2) for x in (self.bias, self.weights, self.vectors)]
        for _ in range(own.epochs):
            order = rng.permutation(len(labels))
            for low in range(0, len(order), own.batch):
                rows = order[low : low + own.batch]
                term = np.concatenate([terms[r] for r in rows])
                doc = np.repeat(np.arange(len(rows)), [len(terms[r]) for r in rows])
                z, total = self.sums(term, doc, len(rows))
                error = (logistic(z) - labels[rows]) / len(rows) ** 0.5
                used, at = np.unique(term, return_inverse=True)
                n = len(used)
                pull = error[doc]
                grads = [
                    error.sum(keepdims=True),
                    np.bincount(at, pull, n) + own.shrink * self.weights[used],
                    np.stack(
                        [
                            np.bincount(at, pull * (total[doc, f] - self.vectors[term, f]), n)
                            for f in range(own.factors)
                        ],
                        axis=1,
                    )
                    + own.shrink * self.vectors[used],
                ]
                for values, seen, grad, where in zip(
                    (self.bias, self.weights, self.vectors), past, grads,
                    (slice(None), used, used), strict=True,
                ):
                    seen[where] += grad**2
                    values[where] -= own.rate * grad / np.sqrt(seen[where])

    def packed(self) -> bytes:
        parts = (self.buckets.astype(np.int32), self.settings, self.bias[0], self.weights.astype(np.float32))
        return pickle.dumps((*parts, self.vectors.astype(np.float32)))

    @classmethod
    def unpacked(cls, data: bytes) -> FactorizationMachine:
        buckets, settings, bias, weights, vectors = pickle.loads(data)
        model = cls(buckets, settings)
        model.bias[0], model.weights, model.vectors = bias, weights, vectors
        return model


@dataclass
class Survey:
    """What the counts of single terms say: which tell, and which may tell in a pair.

    The evidence of a pair in n documents is n times the divergence of its toxic share from the
    nearest share that its terms explain: either of theirs, or that of both odds together. It
    must reach that of ``least_deviation`` for each of the many partners a term has.
    """

    telling: np.ndarray  # buckets
    terms: np.ndarray  # buckets of terms that a pair may need, in the order of ``share``
    share: np.ndarray
    base: float
    bound: float
    least: int

    @classmethod
    def of(cls, bucket: np.ndarray, found: np.ndarray, bad: np.ndarray, n: int, n_bad: int, settings) -> Survey:
        """From the number of documents, and of toxic ones, that hold each term."""
        known = found >= settings.least_documents
        bucket, found, bad = bucket[known], found[known], bad[known]
        good, n_good = found - bad, n - n_bad
        part = found / max(n, 1)
        error = np.sqrt(part * (1 - part) * (1 / max(n_bad, 1) + 1 / max(n_good, 1))) + 1e-12
        deviation = np.abs(bad / max(n_bad, 1) - good / max(n_good, 1)) / error
        rate = (n_bad + 0.5) / (n + 1)
        share = (bad + rate) / (found + 1)
        bound = settings.least_deviation**2 / 2 + np.log(max(len(bucket), 1))
        # In the best case all documents of one kind that hold the term hold its partner too.
        may = np.maximum(-bad * np.log(share), -good * np.log1p(-share)) >= bound
        return cls(
            bucket[deviation >= settings.least_deviation], bucket[may], share[may],
            np.log(rate / (1 - rate)), bound, settings.least_documents,
        )

    def evidence(self, one: np.ndarray, other: np.ndarray, good: np.ndarray, ill: np.ndarray) -> np.ndarray:
        share, seen = self.share, ill / (good + ill)
        odds = np.log(share / (1 - share))
        both = logistic(odds[one] + odds[other] - self.base)
        least = np.minimum(np.minimum(share[one], share[other]), both)
        most = np.maximum(np.maximum(share[one], share[other]), both)
        near = np.clip(seen, least, most)
        with np.errstate(divide="ignore", invalid="ignore"):
            out = np.where(ill > 0, ill * np.log(seen / near), 0)
            return out + np.where(good > 0, good * np.log((1 - seen) / (1 - near)), 0)


@dataclass
class Lists:
    """Sorted terms of documents of one kind on end, and where each document begins."""

    terms: np.ndarray
    begin: np.ndarray

    @classmethod
    def of(cls, docs: list[np.ndarray]) -> Lists:
        terms = np.concatenate([np.zeros(0, np.int32), *docs])
        return cls(terms, np.cumsum([0, *map(len, docs)]))

    def within(self, used: np.ndarray) -> Lists:
        """Only the terms that ``used`` says."""
        kept = used[self.terms]
        return Lists(self.terms[kept], np.concatenate([[0], np.cumsum(kept)])[self.begin])

    def pair_counts(self, low: int, high: int, size: int) -> Iterator[tuple[int, np.ndarray]]:
        """For terms low..high - 1: (first term, documents by term and later term), in steps."""
        at = np.flatnonzero((self.terms >= low) & (self.terms < high))
        at = at[np.argsort(self.terms[at], kind="stable")]
        ends = self.begin[np.searchsorted(self.begin, at, "right")]
        step = max(STEP_CELLS // max(size, 1), 1)
        for first in range(low, high, step):
            rows = min(step, high - first)
            mine = slice(*np.searchsorted(self.terms[at], [first, first + rows]))
            counts = np.zeros(rows * size, np.int64)
            n = ends[mine] - at[mine] - 1
            # Few pairs at a time: documents may be long.
            cuts = np.searchsorted(np.cumsum(n), np.arange(STEP_PAIRS, n.sum(), STEP_PAIRS)) + 1
            for own, n_own in zip(np.split(at[mine], cuts), np.split(n, cuts), strict=True):
                before = np.repeat(np.cumsum(n_own) - n_own, n_own)
                later = np.arange(len(before)) - before + np.repeat(own + 1, n_own)
                key = np.repeat((self.terms[own] - first) * size, n_own)
                key += self.terms[later]
                counts += np.bincount(key, minlength=len(counts))
            yield first, counts.reshape(rows, size)


# Cells and pairs that one step of counting works on, and shares of the terms.
STEP_CELLS, STEP_PAIRS, PAIR_SHARES = 1 << 20, 1 << 20, 16


def telling_pairs(survey: Survey, toxic: Lists, clean: Lists, low: int, high: int) -> np.ndarray:
    """Terms of pairs that tell, of which the first lies in low..high - 1."""
    size, share = len(survey.terms), survey.share
    alone = np.zeros(size, bool)
    alone[np.searchsorted(survey.terms, survey.telling[np.isin(survey.telling, survey.terms)])] = True
    out = [np.zeros(0, np.int64)]
    for kind, scale in ((1, -np.log(share)), (0, -np.log1p(-share))):
        own, other = (toxic, clean) if kind else (clean, toxic)
        # A pair in n documents of one kind has at most this evidence times n.
        need = survey.bound / np.maximum(scale, 1e-300)
        times = np.bincount(own.terms, minlength=size)
        used = times >= need
        own, there = own.within(used), other.within(used)
        steps = zip(own.pair_counts(low, high, size), there.pair_counts(low, high, size), strict=True)
        for (first, counts), (_, more) in steps:
            enough = counts >= np.maximum(need[first : first + len(counts), None], need[None, :])
            one, two = np.nonzero(enough)
            n, m = counts[one, two], more[one, two]
            one += first
            # Nothing depends on pairs of terms that are learned anyway.
            open_ = (n + m >= survey.least) & ~(alone[one] & alone[two])
            one, two, n, m = one[open_], two[open_], n[open_], m[open_]
            ill, good = (n, m) if kind else (m, n)
            hit = survey.evidence(one, two, good.astype(np.float64), ill.astype(np.float64)) >= survey.bound
            out += [one[hit], two[hit]]
    return survey.terms[np.unique(np.concatenate(out))]


def logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    learn_from,
    settings: FactorSettings = FactorSettings(),
    sample_rows: int = SAMPLE_ROWS,
) -> bytes | None:
    """The packed model; ``labels`` has doc_id, toxic; ``learn_from`` is a condition on doc_id."""
    spark = prepare(docs.sparkSession)
    ship_package(spark)
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where(learn_from & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    n = known.count()
    share = min(1.0, sample_rows / max(n, 1))
    chance = F.pmod(F.xxhash64("doc_id", F.lit(settings.seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # About sample_rows ids at most, however many documents there are.
    chosen = F.broadcast(known.where(chance < share))
    sample = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(chosen, "doc_id")

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in chunks(batches, "text"):
            doc, bucket = term_buckets(batch.column("text"))
            cuts = np.searchsorted(doc, np.arange(1, batch.num_rows))
            rows = [x.astype(np.int32) for x in np.split(bucket, cuts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("toxic"), pa.array(rows, pa.list_(pa.int32()))],
                names=["doc_id", "toxic", "terms"],
            )

    made = staged(
        sample.select("doc_id", "toxic", "text").mapInArrow(terms, "doc_id long, toxic int, terms array<int>"),
        "toxic-terms",
    )
    n, n_bad = made.agg(F.count("*"), F.sum(toxic_flag())).first()
    if not n:
        return None
    # One row per bucket at most.
    counts = made.mapInArrow(count_terms, "bucket int, found long, bad long").groupBy("bucket")
    counts = counts.agg(F.sum("found").alias("found"), F.sum("bad").alias("bad"))
    known = counts.where(F.col("found") >= settings.least_documents).orderBy("bucket").toArrow()
    columns = [known.column(c).to_numpy().astype(np.int64) for c in ("bucket", "found", "bad")]
    survey = Survey.of(*columns, n, n_bad, settings)
    learned = np.union1d(survey.telling, paired_terms(made, survey)).astype(np.int64)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        labels_, docs_ = [], []
        for batch in batches:
            labels_ += batch.column("toxic").to_pylist()
            docs_ += [x.values.to_numpy() for x in batch.column("terms")]
        model = FactorizationMachine(learned, settings)
        model.fit(docs_, np.array(labels_, np.float64))
        yield pa.RecordBatch.from_arrays([pa.array([model.packed()], pa.binary())], names=["model"])

    one = with_terms(made, learned).repartition(1).sortWithinPartitions("doc_id").mapInArrow(train, "model binary")
    return bytes(one.first()["model"])


def toxic_flag() -> F.Column:
    return F.when(F.col("toxic") >= 1, 1).otherwise(0)


def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents, and toxic ones, that hold each term: a row per bucket and task at most."""
    let_go()
    found, bad = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for toxic, own in zip(batch.column("toxic").to_pylist(), batch.column("terms"), strict=True):
            own = own.values.to_numpy()
            found[own] += 1
            if toxic >= 1:
                bad[own] += 1
    at = np.flatnonzero(found)
    yield pa.RecordBatch.from_arrays(
        [pa.array(at, pa.int32()), pa.array(found[at]), pa.array(bad[at])], names=["bucket", "found", "bad"]
    )


def with_terms(made: DataFrame, kept: np.ndarray) -> DataFrame:
    """The sample with the terms of ``kept`` only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used = np.zeros(BUCKETS, bool)
        used[kept] = True
        for batch in batches:
            rows = [own[used[own]] for own in (x.values.to_numpy() for x in batch.column("terms"))]
            flags = np.clip(batch.column("toxic").to_numpy(), 0, 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(flags), pa.array(rows, pa.list_(pa.int32()))],
                names=["doc_id", "toxic", "terms"],
            )

    return made.mapInArrow(run, made.schema)


def dealt_terms(made: DataFrame, kept: np.ndarray, cuts: list[int]) -> DataFrame:
    """(part, toxic, places): for each share of the terms, the documents with a term in it.

    A document's terms are places in ``kept`` (sorted), from the share's first on: pairs are
    counted where their first term lies.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.full(BUCKETS, -1, np.int32)
        place[kept] = np.arange(len(kept))
        for batch in batches:
            parts, flags, rows = [], [], []
            for toxic, own in zip(batch.column("toxic").to_pylist(), batch.column("terms"), strict=True):
                at = place[own.values.to_numpy()]
                at = at[at >= 0]
                edges = np.searchsorted(at, cuts)
                for part in np.flatnonzero(np.diff(edges)).tolist():
                    parts.append(part)
                    flags.append(int(toxic >= 1))
                    rows.append(at[edges[part] :])
            yield pa.RecordBatch.from_arrays(
                [pa.array(parts, pa.int32()), pa.array(flags, pa.int32()), pa.array(rows, pa.list_(pa.int32()))],
                names=["part", "toxic", "places"],
            )

    return made.select("toxic", "terms").mapInArrow(run, "part int, toxic int, places array<int>")


def paired_terms(made: DataFrame, survey: Survey) -> np.ndarray:
    """Buckets of terms that tell in a pair what neither of the two, nor their sum, tells."""
    size = len(survey.terms)
    shares = min(PAIR_SHARES, max(size, 1))
    cuts = np.linspace(0, size, shares + 1).astype(int).tolist()
    dealt = dealt_terms(made, survey.terms, cuts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(part: int, docs: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
            kinds = [Lists.of([own for flag, own in docs if flag == kind]) for kind in (1, 0)]
            terms = telling_pairs(survey, *kinds, cuts[part], cuts[part + 1])
            return pa.RecordBatch.from_arrays([pa.array(terms, pa.int32())], names=["bucket"])

        let_go()
        part, docs = None, []
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("part", "toxic")), batch.column("places"), strict=True)
            for at, flag, own in rows:
                if at != part:
                    if docs:
                        yield found(part, docs)
                    part, docs = at, []
                # A copy: the batch it lies in can go.
                docs.append((flag, own.values.to_numpy().copy()))
        if docs:
            yield found(part, docs)

    ordered = dealt.repartition(2 * shares, "part").sortWithinPartitions("part")
    rows = ordered.mapInArrow(run, "bucket int").distinct().toArrow()
    return rows.column("bucket").to_numpy()


def score_toxicity(docs: DataFrame, model: bytes | None, columns: list[str]) -> DataFrame:
    """The given columns and ``score`` (0 to 1) for every row, from its whole text."""
    spark = prepare(docs.sparkSession)
    ship_package(spark)
    held = spark.sparkContext.broadcast(model)
    # A text that is asked for is sent once, and scored as it passes.
    text = "text" if "text" in columns else "scored_text"
    slim = docs.select(*columns, *([] if text in columns else [F.col("text").alias(text)]))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.select(columns).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        own = FactorizationMachine.unpacked(held.value) if held.value else None
        for batch in chunks(batches, text):
            n = batch.num_rows
            score = np.zeros(n)
            if own:
                score = own.scores(*term_buckets(batch.column(text)), n)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in columns], pa.array(score)], names=[*columns, "score"]
            )

    return slim.mapInArrow(run, f"{kinds}, score double")
