"""Language proportions of a document by expectation-maximisation over n-gram likelihoods.

Each language has a distribution over hashed byte trigrams, counted over all documents that
may be learned from. A document's trigrams are taken as drawn from a mixture of languages;
expectation-maximisation finds its proportions. The languages are then ranked by proportion,
and the set of the first k is chosen whose likelihood, less a penalty for each language, is
best. A k is left out only where a bound on the likelihood of any mixture proves that it cannot
be best, so the result depends on the text alone. The prediction is the language with the largest
proportion in the chosen set, and the score is that proportion. ``fit`` says how well the chosen
set explains the text: the mean log likelihood of a trigram, above that of drawing from all
buckets alike. It is null if nothing could be learned or the text has fewer than LEAST_TRIGRAMS.

Defined results: ``und`` with score 0 for null texts and texts without a letter, and for every
text if nothing could be learned; ties go to the first language by name; rows that repeat are
each answered; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import NO_LETTER, chunks, prepare, text_bytes
from tidecast.session import ship_package

BUCKETS = 1 << 14
SMOOTHING = 0.5
ROUNDS = 15
# Cost of one more language, in units of the logarithm of the number of trigrams. Neighbouring
# trigrams share bytes, so their likelihoods overstate what a language adds.
PENALTY = 3.0
UNKNOWN = "und"
# Chances (distinct trigrams times languages) that one step of the mixture works on.
STEP_CELLS = 1 << 19
# Shorter texts do not tell how well a language fits them.
LEAST_TRIGRAMS = 100

_FOLDED = np.arange(256, dtype=np.uint32)
_FOLDED[65:91] += 32
_FOLDED[NO_LETTER] = 32


def trigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(document number, bucket) of every trigram; ASCII non-letters count as blanks, and no
    trigram has a blank in the middle."""
    data, begin = text_bytes(texts)
    if len(data) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = _FOLDED[data]
    gram = (code[:-2] << np.uint32(16)) | (code[1:-1] << np.uint32(8)) | code[2:]
    doc = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
    good = (doc[:-2] == doc[2:]) & (code[1:-1] != 32)
    bucket = (gram * np.uint32(2654435761)) >> np.uint32(18)
    return doc[:-2][good], bucket[good].astype(np.int64)


def learn_languages(docs: DataFrame, learn_from: Column) -> dict[str, np.ndarray]:
    """Trigram counts of each language over every row that meets ``learn_from``.

    Tasks count into one array per language; Spark sums them. What reaches the driver is one
    row per language.
    """
    ship_package(prepare(docs.sparkSession))
    rows = docs.where(learn_from & F.col("lang").isNotNull() & F.col("text").isNotNull())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(BUCKETS, np.int64))

        def out() -> Iterator[pa.RecordBatch]:
            for lang, n in counts.items():
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(n[at])],
                    names=["lang", "bucket", "n"],
                )
            counts.clear()

        for batch in chunks(batches, "text"):
            doc, bucket = trigrams(batch.column("text"))
            langs = np.array(batch.column("lang").to_pylist(), object)
            for lang in set(langs.tolist()):
                mine = (langs == lang)[doc]
                counts[lang] += np.bincount(bucket[mine], minlength=BUCKETS)
            if len(counts) > 200:
                yield from out()
        yield from out()

    found = rows.select("text", "lang").mapInArrow(count, "lang string, bucket int, n long")
    summed = found.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    packed = summed.groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("counts"))
    out = {}
    for row in packed.collect():
        out[row["lang"]] = np.zeros(BUCKETS, np.int64)
        for bucket, n in row["counts"]:
            out[row["lang"]][bucket] = n
    return dict(sorted(out.items()))


class LanguageMixture:
    """Mixtures of learned languages for batches of documents."""

    def __init__(self, counts: dict[str, np.ndarray]):
        self.languages = list(counts)
        table = np.stack(list(counts.values())) + SMOOTHING
        self.chances = (table / table.sum(axis=1, keepdims=True)).T

    def fit(self, p: np.ndarray, n: np.ndarray, starts: np.ndarray, size: np.ndarray, shares: np.ndarray):
        """Proportions and log likelihood per document, from given proportions on.

        ``p``: chances of each distinct trigram by language; ``n``: how often it occurs;
        ``starts``: where a document's trigrams begin.
        """
        doc = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(n))))
        for _ in range(ROUNDS):
            parts = p * shares[doc]
            parts *= (n / parts.sum(axis=1))[:, None]
            shares = np.add.reduceat(parts, starts) / size[:, None]
        return shares, np.add.reduceat(n * np.log((p * shares[doc]).sum(axis=1)), starts)

    def proportions(self, texts: pa.Array) -> np.ndarray:
        """Proportions in the chosen set, a row per text; all 0 for texts without trigrams."""
        return self.fitted(texts)[0]

    def fitted(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Proportions, and how well they fit each text; NaN for short texts."""
        out, fits = np.zeros((len(texts), len(self.languages))), np.full(len(texts), np.nan)
        doc, bucket = trigrams(texts)
        if not len(doc):
            return out, fits
        both, n = np.unique(doc * BUCKETS + bucket, return_counts=True)
        rows, starts = np.unique(both // BUCKETS, return_index=True)
        ends = np.append(starts[1:], len(both))
        low = 0
        # A text has at most BUCKETS distinct trigrams, so a step of one text is bounded too.
        while low < len(rows):
            room = starts[low] + max(STEP_CELLS // len(self.languages), 1)
            high = max(low + 1, int(np.searchsorted(ends, room, "right")))
            part = slice(starts[low], ends[high - 1])
            p = self.chances[both[part] % BUCKETS]
            step = self.best_sets(p, n[part], starts[low:high] - starts[low])
            out[rows[low:high]], fits[rows[low:high]] = step
            low = high
        return out, fits

    def best_sets(self, p: np.ndarray, n: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Proportions in the chosen set, and how well they fit, a row per document."""
        every = len(self.languages)
        size = np.add.reduceat(n, starts).astype(np.float64)
        lengths = np.diff(np.append(starts, len(n)))
        doc = np.repeat(np.arange(len(starts)), lengths)
        shares, likely = self.fit(p, n, starts, size, np.full((len(starts), every), 1 / every))
        # No mixture is likelier than this one by more than the logarithm of the largest slope.
        slopes = np.add.reduceat((n / (p * shares[doc]).sum(axis=1))[:, None] * p, starts) / size[:, None]
        most = likely + size * np.log(np.maximum(slopes.max(axis=1), 1)) + 1e-6 * size
        order = np.argsort(-shares, axis=1, kind="stable")
        best, reached = np.full(len(starts), -np.inf), np.zeros(len(starts))
        chosen = np.zeros_like(shares)
        for k in range(1, every + 1):
            cost = PENALTY * (k - 1) * np.log(size + 1)
            # The cost only grows, so a document that is out stays out.
            open_ = np.flatnonzero(most - cost > best)
            if not len(open_):
                break
            names = order[open_, :k]
            if k == every:
                own, value = np.take_along_axis(shares[open_], names, axis=1), likely[open_]
            else:
                mine = np.isin(doc, open_)
                of = np.repeat(np.arange(len(open_)), lengths[open_])
                from_ = np.concatenate([[0], np.cumsum(lengths[open_])[:-1]])
                chances = np.take_along_axis(p[mine], names[of], axis=1)
                if k == 1:
                    own = np.ones((len(open_), 1))
                    value = np.add.reduceat(n[mine] * np.log(chances[:, 0]), from_)
                else:
                    even = np.full((len(open_), k), 1 / k)
                    own, value = self.fit(chances, n[mine], from_, size[open_], even)
            better = value - cost[open_] > best[open_]
            rows = open_[better]
            chosen[rows] = 0
            chosen[rows[:, None], names[better]] = own[better]
            best[rows], reached[rows] = (value - cost[open_])[better], value[better]
        return chosen, np.where(size >= LEAST_TRIGRAMS, reached / size + np.log(BUCKETS), np.nan)


def predict_languages(docs: DataFrame, counts: dict[str, np.ndarray], columns: list[str]) -> DataFrame:
    """The given columns, ``lang_pred``, ``score`` and ``fit`` for every row, from its whole text."""
    spark = prepare(docs.sparkSession)
    ship_package(spark)
    # One array of BUCKETS counts per language.
    held = spark.sparkContext.broadcast(counts)
    # A text that is asked for is sent once, and scored as it passes.
    text = "text" if "text" in columns else "scored_text"
    own_text = [] if text in columns else [F.col("text").alias(text)]
    letter_ = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("scored_letter")
    slim = docs.select(*columns, *own_text, letter_)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.select(columns).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = LanguageMixture(held.value) if held.value else None
        for batch in chunks(batches, text):
            letter = batch.column("scored_letter").to_numpy(zero_copy_only=False)
            langs, score = np.full(batch.num_rows, UNKNOWN, object), np.zeros(batch.num_rows)
            fits = np.full(batch.num_rows, np.nan)
            if own:
                shares, fits = own.fitted(batch.column(text))
                # A letter too short for a trigram fits all languages alike.
                shares[letter & (shares.sum(axis=1) == 0)] = 1 / len(own.languages)
                first = shares.argmax(axis=1)
                langs[letter] = np.array(own.languages, object)[first[letter]]
                score[letter] = shares.max(axis=1)[letter].clip(0, 1)
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in columns],
                    pa.array(langs, pa.string()),
                    pa.array(score),
                    pa.array(fits, from_pandas=True),
                ],
                names=[*columns, "lang_pred", "score", "fit"],
            )

    return slim.mapInArrow(run, f"{kinds}, lang_pred string, score double, fit double")
