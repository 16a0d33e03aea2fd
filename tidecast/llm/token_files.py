"""Token files with directly addressable codes: any token is read without decoding a block.

An id is split into chunks of fixed widths, the lowest first. Level k holds the k-th chunk of
every id that has one, one byte each, and a bitmap that says which of these ids go on at level
k + 1. A rank directory holds the number of set bits before each block of the bitmap. The
token at position i is read at level 1; while its bit is set, the number of set bits before
it, from the directory and at most one block, is its position at the next level.

A file has a header, the levels, and an index of its documents (id, where it begins). Files
hold whole documents in ascending id order and about TARGET_IDS ids. A manifest row says what
a file holds; the place of its first id in the whole collection follows from the manifest.

Files are written below a temporary name and then moved, so a repeated or lost task leaves
either nothing or the same file. They are read and written through Arrow's file systems: the
folder must be one that all executors reach.
"""

from __future__ import annotations

import itertools
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidecast.llm.common import chunks, new_folder, prepare, staged, texts_of
from tidecast.llm.tokens import encoder
from tidecast.session import ship_package

MAGIC = b"DACTOK01"
TARGET_IDS = 1 << 21
BLOCK_BITS = 512


@dataclass
class Level:
    """One level: a chunk for each id that reaches it, and which of them go on."""

    values: np.ndarray
    more: np.ndarray
    ranks: np.ndarray

    def rank(self, at: int) -> int:
        """Set bits before position ``at``."""
        block = at // BLOCK_BITS
        low = block * BLOCK_BITS // 8
        bits = np.unpackbits(self.more[low : at // 8 + 1], bitorder="little")
        return int(self.ranks[block]) + int(bits[: at - block * BLOCK_BITS].sum())

    def goes_on(self, at: int) -> bool:
        return bool(self.more[at // 8] >> (at % 8) & 1)


def encode_levels(ids: np.ndarray) -> list[Level]:
    levels, rest = [], ids.astype(np.uint32)
    while len(rest) or not levels:
        bits = rest >> 8 > 0
        more = np.packbits(bits, bitorder="little")
        ones = np.add.reduceat(bits, np.arange(0, len(bits), BLOCK_BITS)) if len(bits) else []
        ranks = np.concatenate([[0], np.cumsum(ones)]).astype(np.uint32)
        levels.append(Level((rest & 255).astype(np.uint8), more, ranks))
        rest = rest[bits] >> 8
    return levels


def decode_levels(levels: list[Level]) -> np.ndarray:
    """All ids, from the last level up."""
    ids = np.zeros(0, np.uint32)
    for level in reversed(levels):
        out = level.values.astype(np.uint32)
        bits = np.unpackbits(level.more, bitorder="little", count=len(out)).astype(bool)
        out[bits] |= ids << 8
        ids = out
    return ids


class TokenFile:
    """One file in memory."""

    def __init__(self, levels: list[Level], doc_ids: np.ndarray, has_id: np.ndarray, starts: np.ndarray):
        self.levels, self.doc_ids, self.has_id, self.starts = levels, doc_ids, has_id, starts

    @classmethod
    def build(cls, docs: list[tuple[int | None, bytes]]) -> TokenFile:
        ids = np.frombuffer(b"".join(raw for _, raw in docs), "<u4")
        sizes = [len(raw) // 4 for _, raw in docs]
        return cls(
            encode_levels(ids),
            np.array([i or 0 for i, _ in docs], np.int64),
            np.array([i is not None for i, _ in docs], np.uint8),
            np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64),
        )

    def to_bytes(self) -> bytes:
        arrays = [self.doc_ids, self.has_id, self.starts]
        for level in self.levels:
            arrays += [level.values, level.more, level.ranks]
        head = json.dumps([[a.dtype.str, len(a)] for a in arrays]).encode()
        return b"".join(
            [MAGIC, struct.pack("<I", len(head)), head, *[a.astype(a.dtype.newbyteorder("<")).tobytes() for a in arrays]]
        )

    @classmethod
    def from_bytes(cls, data: bytes) -> TokenFile:
        if data[:8] != MAGIC:
            raise ValueError("not a token file")
        (size,) = struct.unpack_from("<I", data, 8)
        at, arrays = 12 + size, []
        for kind, n in json.loads(data[12:at]):
            arrays.append(np.frombuffer(data, kind, n, at))
            at += arrays[-1].nbytes
        levels = [Level(*arrays[i : i + 3]) for i in range(3, len(arrays), 3)]
        return cls(levels, *arrays[:3])

    def __len__(self) -> int:
        return len(self.levels[0].values)

    def token(self, at: int) -> int:
        """The id at a position, from at most one chunk and one block of bits per level."""
        value = shift = 0
        for level in self.levels:
            value |= int(level.values[at]) << shift
            if not level.goes_on(at):
                break
            at, shift = level.rank(at), shift + 8
        return value

    def tokens(self) -> np.ndarray:
        return decode_levels(self.levels)

    def document(self, k: int) -> np.ndarray:
        return np.array([self.token(i) for i in range(self.starts[k], self.starts[k + 1])], np.uint32)


MANIFEST = "part long, file long, path string, n_docs long, n_ids long, crc32 long"


def write_token_files(
    docs: DataFrame,
    path: str,
    end_id: int,
    folder: str,
    text: str = "text",
    doc_id: str = "doc_id",
    partitions: int | None = None,
) -> DataFrame:
    """Encode all texts, append ``end_id`` to each, write them in ascending id order.

    Returns the manifest, staged. Null texts are empty (just the end id); rows without an id
    come first; rows that share an id follow each other, ordered by text. An empty table has
    an empty manifest. Other columns are not read, whatever they are called.
    """
    spark = prepare(docs.sparkSession)
    ship_package(spark)
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    slim = docs.selectExpr(f"cast(`{doc_id}` as long) doc_id", f"`{text}` text")
    ordered = slim.repartitionByRange(partitions, "doc_id").sortWithinPartitions("doc_id", "text")
    names = [part.split()[0] for part in MANIFEST.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        own, number, held, size = encoder(path, end_id), itertools.count(), [], 0

        def flush() -> pa.RecordBatch:
            k = next(number)
            made = TokenFile.build(held).to_bytes()
            target = f"{folder.rstrip('/')}/part-{part:06d}-{k:06d}.dac"
            put(target, made)
            row = [part, k, target, len(held), size, zlib.crc32(made)]
            return pa.RecordBatch.from_pylist([dict(zip(names, row, strict=True))])

        for batch in chunks(batches, "text"):
            for i, t in zip(batch.column("doc_id").to_pylist(), texts_of(batch.column("text")), strict=True):
                held.append((i, own.encode(t)))
                size += len(held[-1][1]) // 4
                if size >= TARGET_IDS:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return staged(ordered.mapInArrow(run, MANIFEST), "token-manifest")


def put(target: str, data: bytes) -> None:
    system, path = fs.FileSystem.from_uri(as_uri(target))
    system.create_dir(path.rpartition("/")[0], recursive=True)
    draft = f"{path}.{uuid.uuid4().hex}.tmp"
    with system.open_output_stream(draft) as out:
        out.write(data)
    system.move(draft, path)


def as_uri(path: str) -> str:
    """Hadoop writes ``file:/x``; Arrow wants ``file:///x``."""
    return f"file://{path.removeprefix('file:')}" if path.startswith("file:/") and not path.startswith("file://") else path


def positioned(manifest: DataFrame) -> DataFrame:
    """The manifest with ``start``, the ids of all files before each.

    Totals of parts are summed first, so no task sees more than the parts or one part's files.
    """
    totals = manifest.groupBy("part").agg(F.sum("n_ids").alias("total"))
    before = F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    bases = totals.select("part", F.coalesce(before, F.lit(0)).alias("base"))
    within = Window.partitionBy("part").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    return (
        manifest.join(bases, "part")
        .withColumn("start", F.col("base") + F.coalesce(F.sum("n_ids").over(within), F.lit(0)))
        .drop("base")
    )


def read_token_files(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (over little-endian 32-bit ids) of every document.

    A task reads one file at a time and checks it against the manifest.
    """
    spark = manifest.sparkSession
    ship_package(spark)
    files = positioned(manifest)
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, path = fs.FileSystem.from_uri(as_uri(row["path"]))
                with system.open_input_stream(path) as source:
                    data = source.read()
                if zlib.crc32(data) != row["crc32"]:
                    raise ValueError(f"{row['path']} differs from what was written")
                file = TokenFile.from_bytes(data)
                raw = file.tokens().astype("<u4").tobytes()
                cuts = file.starts.tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(file.doc_ids, mask=file.has_id == 0),
                        pa.array(file.starts[:-1] + row["start"]),
                        pa.array(np.diff(file.starts)),
                        pa.array(
                            [zlib.crc32(raw[4 * a : 4 * b]) for a, b in itertools.pairwise(cuts)],
                            pa.int64(),
                        ),
                    ],
                    names=names,
                )

    # Files are few and each is much work: deal them out one by one.
    slots = 4 * spark.sparkContext.defaultParallelism
    dealt = files.repartition(slots, "part", "file")
    return dealt.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(
    docs: DataFrame, path: str, end_id: int, folder: str | None = None, **names: str
) -> DataFrame:
    """Write the token files of a table and read every document back from them."""
    folder = folder or new_folder(docs.sparkSession, "token-files")
    return read_token_files(write_token_files(docs, path, end_id, folder, **names))


def open_token_file(path: str) -> TokenFile:
    system, path = fs.FileSystem.from_uri(as_uri(path))
    with system.open_input_stream(path) as source:
        return TokenFile.from_bytes(source.read())



class TokenReader:
    """A token file that stays where it is: any token or range is read by seeking.

    Only the header is read when it is opened. A token takes, per level, its byte, one entry of
    the rank directory and at most one block of bits; a range of tokens is one range per level.
    ``bytes_read`` counts what was read.
    """

    def __init__(self, path: str):
        system, inner = fs.FileSystem.from_uri(as_uri(path))
        self.file, self.bytes_read = system.open_input_file(inner), 0
        head = self._bytes(0, 12)
        if head[:8] != MAGIC:
            raise ValueError("not a token file")
        (size,) = struct.unpack_from("<I", head, 8)
        at, self.arrays = 12 + size, []
        for kind, n in json.loads(self._bytes(12, size)):
            self.arrays.append((np.dtype(kind), n, at))
            at += np.dtype(kind).itemsize * n
        self.n_levels = (len(self.arrays) - 3) // 3

    def __enter__(self) -> TokenReader:
        return self

    def __exit__(self, *error) -> None:
        self.file.close()

    def __len__(self) -> int:
        return self.arrays[3][1]

    def _bytes(self, at: int, size: int) -> bytes:
        self.file.seek(at)
        self.bytes_read += size
        return self.file.read(size)

    def _part(self, k: int, low: int, high: int) -> np.ndarray:
        kind, n, at = self.arrays[k]
        if not 0 <= low <= high <= n:
            raise IndexError(f"{low} to {high} of {n}")
        return np.frombuffer(self._bytes(at + low * kind.itemsize, (high - low) * kind.itemsize), kind)

    def _bits(self, level: int, low: int, high: int) -> np.ndarray:
        raw = self._part(4 + 3 * level, low // 8, -(-high // 8))
        return np.unpackbits(raw, bitorder="little")[low % 8 : low % 8 + high - low]

    def _rank(self, level: int, at: int) -> int:
        """Set bits before position ``at``."""
        block = at // BLOCK_BITS
        return int(self._part(5 + 3 * level, block, block + 1)[0]) + int(
            self._bits(level, block * BLOCK_BITS, at).sum()
        )

    def tokens(self, low: int, high: int, level: int = 0) -> np.ndarray:
        """The ids at positions low..high - 1."""
        ids = self._part(3 + 3 * level, low, high).astype(np.uint32)
        more = self._bits(level, low, high).astype(bool)
        if more.any():
            first = self._rank(level, low)
            ids[more] |= self.tokens(first, first + int(more.sum()), level + 1) << 8
        return ids

    def token(self, at: int) -> int:
        return int(self.tokens(at, at + 1)[0])

    def document(self, k: int) -> np.ndarray:
        """The ids of the k-th document of the file."""
        low, high = self._part(2, k, k + 2).tolist()
        return self.tokens(low, high)

    def find(self, doc_id: int) -> range:
        """Places of the documents with an id; several may share one. Rows without an id come
        first in a file and are not found by one."""
        n = self.arrays[0][1]
        nameless = self._first(1, n, 1)
        return range(self._first(0, n, doc_id, nameless), self._first(0, n, doc_id + 1, nameless))

    def _first(self, k: int, high: int, value: int, low: int = 0) -> int:
        """The first place from ``low`` on whose entry is ``value`` or more, by halving."""
        while low < high:
            middle = (low + high) // 2
            if int(self._part(k, middle, middle + 1)[0]) < value:
                low = middle + 1
            else:
                high = middle
        return low
