"""What the operators of this subpackage share: staged tables, batches of rows, hashing."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from tidecast.session import shared_folder

# Rows of one Arrow batch: whole texts travel in batches, so a batch must stay small.
BATCH_ROWS = 512
# Text bytes that one vectorised step works on.
CHUNK_BYTES = 1 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Keep Arrow batches of whole texts small; a smaller setting of the session stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
    return spark


# Folders and tables that this driver has made for intermediate results, by application.
_made: dict[str, list[tuple[str, str]]] = {}


def remember(spark: SparkSession, kind: str, name: str) -> str:
    _made.setdefault(spark.sparkContext.applicationId, []).append((kind, name))
    return name


def new_folder(spark: SparkSession, name: str) -> str:
    """A path of its own below the folder that driver and executors share."""
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    return remember(spark, "folder", path)


def clean_up(spark: SparkSession) -> int:
    """Remove the intermediate tables and folders that this application has made so far.

    Call it when the results that were built on them have been written: a DataFrame of an
    operator still reads them. Tables and folders that the caller named stay. Returns how many
    were removed.
    """
    made = _made.pop(spark.sparkContext.applicationId, [])
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for kind, name in reversed(made):
        if kind == "table":
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        else:
            path = jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(conf).delete(path, True)
    return len(made)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage, survives executors."""
    folder = new_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


# What operators keep in a worker from task to task, above all encoders with their caches.
_kept: list[dict] = []


def kept_in_worker() -> dict:
    """For what an operator makes once per worker; see ``let_go``."""
    _kept.append({})
    return _kept[-1]


def let_go() -> None:
    """Drop what other operators keep in this worker: it lives on into tasks that need none of it."""
    for held in _kept:
        held.clear()


def texts_of(column: pa.Array) -> list[str]:
    """The texts of a column; null is empty."""
    return [text or "" for text in column.to_pylist()]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts of a column on end, and where each begins (one more at the end)."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    begin = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[begin[0] : begin[-1]], begin - begin[0]


def chunks(
    batches: Iterator[pa.RecordBatch], text: str, size: int = CHUNK_BYTES
) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``size`` bytes of text each; one long text is one slice."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, begin = text_bytes(batch.column(text))
        low = 0
        while low < batch.num_rows:
            high = int(np.searchsorted(begin, begin[low] + size, "right")) - 1
            high = min(max(high, low + 1), batch.num_rows)
            yield batch.slice(low, high - low)
            low = high


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def numbered(n: int, seed: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit numbers."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


_BASE = 0x9E3779B97F4A7C55
_BASE_BACK = pow(_BASE, -1, 1 << 64)
_BYTE_CODES = numbered(256, 7)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
# ASCII without letters.
NO_LETTER = np.zeros(256, bool)
NO_LETTER[:128] = [not chr(b).isalpha() for b in range(128)]
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, _BASE_BACK)):
            steps = np.full(max(n + n // 4, 1 << 16), base, np.uint64)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans, from prefix sums of a polynomial over byte codes."""
    up, down = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.add.accumulate(_BYTE_CODES[data] * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words ``[^\\x20\\x09-\\x0D]+`` of all texts, A-Z lower-cased.

    Returns them on end, and where each text's words begin (one more at the end).
    """
    data, starts, ends, begin = word_spans(column, _SPACE)
    return span_hashes(data, starts, ends), begin


def word_spans(
    column: pa.Array, between: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes with A-Z lower-cased, starts and ends of words, where each text's words begin).

    ``between`` says of each byte value whether it stands between words.
    """
    data, begin = text_bytes(column)
    data = _LOWER[data]
    inside = ~between[data]
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside
    before[begin] = False
    after = np.zeros(len(data) + 1, bool)
    after[:-1] = inside
    after[begin] = False
    starts = np.flatnonzero(inside & ~before[:-1])
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    return data, starts, ends, np.searchsorted(starts, begin)
