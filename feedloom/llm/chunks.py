"""Documents in chunks, and exchanges of sorted keys between chunks and buckets of keys.

A chunk is a row with some megabytes of whole documents. Where documents have to be compared by
the many keys they hold, a chunk sends each bucket of keys its distinct keys, sorted and packed
into some three bytes each, and gets back an answer per key in the same order. A key that occurs
everywhere so costs a bucket one entry per chunk, however many rows hold it.
"""

from __future__ import annotations

import ctypes
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.session import dropping_shuffles, fresh_path

#: Bytes of documents in a chunk, about; a longer document is a chunk of its own.
CHUNK_BYTES = 4 << 20
#: Bytes of documents whose keys a bucket is meant for, and buckets at least.
BUCKET_BYTES, LEAST_BUCKETS = 16 << 20, 32


def squeeze(values: np.ndarray) -> bytes:
    """Whole numbers from 0 as compressed byte planes: high bytes of small numbers cost nothing."""
    plain = np.ascontiguousarray(values.astype(np.uint64)).view(np.uint8).reshape(-1, 8)
    return zstandard.compress(np.ascontiguousarray(plain.T).tobytes(), 1)


def unsqueeze(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), dtype=np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(np.uint64)


def squeeze_sorted(values: np.ndarray) -> bytes:
    """Ascending 64-bit keys, as differences."""
    return squeeze(np.diff(values, prepend=np.uint64(0)))


def unsqueeze_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unsqueeze(data), dtype=np.uint64)


def pack_bits(bits: np.ndarray) -> bytes:
    return zstandard.compress(np.packbits(bits).tobytes(), 1)


def unpack_bits(data: bytes, count: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zstandard.decompress(data), np.uint8), count=count) == 1


def release() -> None:
    """Give memory that is free back to the system; idle workers else keep what a task needed."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def releasing(run):
    """``run``, a function from batches to batches, giving memory back when it ends."""
    def released(batches):
        try:
            yield from run(batches)
        finally:
            release()

    return released


def releasing_group(run):
    """``run``, a function from a group's frame to a frame, giving memory back after each group."""
    def released(frame: pd.DataFrame) -> pd.DataFrame:
        try:
            return run(frame)
        finally:
            release()

    return released


def pack_rows(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    with pa.ipc.new_stream(sink, table.schema, options=options) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def chunk_table(docs: DataFrame, chunk_bytes: int | None = None, pack=pack_rows) -> DataFrame:
    """``(chunk, size, rows)``, written: ``rows`` is what ``pack`` makes of all columns of ``docs``,
    of which the last one is the text, and ``size`` the bytes of text."""
    limit = chunk_bytes or CHUNK_BYTES

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, held_size = TaskContext.get().partitionId() << 32, [], 0

        def chunk():
            rows = pack(pa.Table.from_batches(held).combine_chunks())
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([held_size], pa.int64()),
                 pa.array([rows], pa.binary())],
                names=["chunk", "size", "rows"])

        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            lengths = np.array([len(text.as_buffer()) if text.is_valid else 0 for text in texts],
                               dtype=np.int64)
            start = 0
            for at, length in enumerate(lengths.tolist()):
                if held_size and held_size + length > limit:
                    held.append(batch.slice(start, at - start))
                    yield chunk()
                    held, held_size, number, start = [], 0, number + 1, at
                held_size += length + 1
            held.append(batch.slice(start))
        if held_size:
            yield chunk()

    return by_chunk(docs.mapInArrow(
        releasing(gather), "chunk long, size long, rows binary"), "chunks")


def by_chunk(df: DataFrame, name: str) -> DataFrame:
    """``df`` written in buckets of ``chunk``, so that joins on it move the other side only.

    The files are in the shared folder; the session's catalog has a name for them, as bucketed
    files need one.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    called = os.path.basename(path).replace("-", "_")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with dropping_shuffles(spark):
        df.write.bucketBy(buckets, "chunk").option("path", path).saveAsTable(called)
    return spark.table(called)


def open_rows(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


def bucket_count(chunks: DataFrame) -> int:
    total = chunks.agg(F.sum("size")).first()[0] or 0
    return max(LEAST_BUCKETS, total // BUCKET_BYTES)


def bucket_edges(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket starts in sorted keys: buckets are ranges of the upper 32 bits."""
    starts = -(-(np.arange(buckets + 1, dtype=object) << 32) // buckets)
    first = np.array([int(s) for s in starts[:-1]], dtype=np.uint64) << np.uint64(32)
    return np.append(np.searchsorted(keys, first), len(keys))


def listed(answers: DataFrame, name: str) -> DataFrame:
    """Answers ``(chunk, bucket, answer, ...)`` as one list per chunk, in order of bucket, in the
    column ``name``; written in buckets of chunk."""
    fields = [c for c in answers.columns if c != "chunk"]
    return by_chunk(answers.groupBy("chunk").agg(
        F.array_sort(F.collect_list(F.struct("bucket", *[c for c in fields if c != "bucket"])))
        .alias(name)), name)


def joined(chunks: DataFrame, *answers: DataFrame) -> DataFrame:
    """``chunks`` with all lists of answers; the chunks themselves stay where they are."""
    for one in answers:
        chunks = chunks.join(one.hint("shuffle_hash"), "chunk", "left")
    return chunks


class WordHashes(dict):
    """64-bit hashes of words, remembered."""

    LIMIT = 200_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def scrambled(value: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them over all bits."""
    value = (value ^ (value >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    value = (value ^ (value >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return value ^ (value >> np.uint64(31))


class Rolling:
    """Hashes of all windows of a word sequence, from sums of hashes times powers."""

    BASE, INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)

    def __init__(self):
        self.up, self.down = (np.ones(1, np.uint64),) * 2

    def _grow(self, count: int) -> None:
        if len(self.up) < count:
            size = max(count, 2 * len(self.up))
            self.up, self.down = (np.concatenate([[np.uint64(1)], np.cumprod(
                np.full(size - 1, base, dtype=np.uint64), dtype=np.uint64)])
                for base in (self.BASE, self.INVERSE))

    def windows(self, hashes: np.ndarray, width: int) -> np.ndarray:
        if len(hashes) < width:
            return hashes[:0]
        self._grow(len(hashes))
        sums = np.concatenate([[np.uint64(0)], np.cumsum(hashes * self.up[:len(hashes)],
                                                         dtype=np.uint64)])
        count = len(hashes) - width + 1
        return scrambled((sums[width:] - sums[:-width]) * self.down[:count])
