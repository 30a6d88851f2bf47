"""Token-id files: whole documents in id order, coded in independent, checksummed blocks."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedloom.llm import range_coder, wordpieces

#: Ids in a segment, about: a row of a file, made of whole documents.
SEGMENT = 8 << 20


def write_token_files(docs: DataFrame, path: str, vocabulary: str, end_id: int) -> None:
    """Encode the texts of ``docs`` (doc_id, text) with a byte-level file and write their ids.

    The files under ``path`` are Parquet with one row per segment: ``part`` and ``seq``, by which
    segments follow one another in ascending ``doc_id`` order, the ids and lengths of its
    documents, and ``coded``, their token ids in the format of ``range_coder``. A document's ids
    end with ``end_id``; a null or empty text gives that id alone. Null doc_ids come first; rows
    that repeat an id follow each other, ordered by a hash of their texts. Further columns are left
    out. No documents give no segments.

    Rows are dealt by ranges of ``doc_id``, which Spark finds from a sample of that column, so
    tasks get about as many documents each; a task holds one segment and one Arrow batch.
    """
    ordered = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ordered = ordered.repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        names: list = []
        ids: list[np.ndarray] = []
        held = 0

        def segment():
            coded = range_coder.encode(np.concatenate(ids), 16)
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()),
                "doc_ids": pa.array([names], pa.list_(pa.int64())),
                "lengths": pa.array([[len(one) for one in ids]], pa.list_(pa.int64())),
                "n_ids": pa.array([held], pa.int64()),
                "coded": pa.array([coded], pa.binary())})

        end = np.array([end_id], dtype="<u4")
        for batch in batches:
            names_of = iter(batch.column(0).to_pylist())
            for few in wordpieces.parts(batch.column(1), wordpieces.GROUP_BYTES):
                texts = [text.as_buffer().to_pybytes() if text.is_valid else b"" for text in few]
                for found, name in zip(wordpieces.byte_level_ids(vocabulary, texts), names_of):
                    if names and held + len(found) + 1 > SEGMENT:
                        yield segment()
                        names, ids, held, seq = [], [], 0, seq + 1
                    names.append(name)
                    ids.append(np.concatenate([found, end]))
                    held += len(found) + 1
        if names:
            yield segment()

    ordered.mapInArrow(run, "part int, seq int, doc_ids array<long>, lengths array<long>, "
                            "n_ids long, coded binary").write.parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: ``doc_id, start, n_tokens, ids``, ``start`` being the number of
    ids in front of it. A damaged block fails the read."""
    return _read(spark, path, "ids array<int>", lambda ids: pa.array(
        [one.view(np.int32) for one in ids], pa.list_(pa.int32())))


def read_token_digests(spark: SparkSession, path: str) -> DataFrame:
    """As ``read_token_files``, with ``ids_crc32`` in place of the ids."""
    return _read(spark, path, "ids_crc32 long", lambda ids: pa.array(
        [zlib.crc32(one.tobytes()) for one in ids], pa.int64()))


def _read(spark: SparkSession, path: str, column: str, give) -> DataFrame:
    files = spark.read.parquet(path)
    # One row per segment, then per part: millions of documents each.
    sizes = files.select("part", "seq", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n")).select(
        "part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("ahead"))
    within = Window.partitionBy("part").orderBy("seq")
    starts = sizes.join(parts, "part").select(
        "part", "seq", (F.col("ahead") + F.sum("n_ids").over(within) - F.col("n_ids"))
        .alias("first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                at = batch.slice(row, 1)
                lengths = at.column("lengths").values.to_numpy()[
                    at.column("lengths").offsets[0].as_py():at.column("lengths").offsets[1].as_py()]
                ids = range_coder.decode(at.column("coded")[0].as_buffer())
                ends = np.cumsum(lengths)
                if int(ends[-1]) != len(ids):
                    raise range_coder.Damaged("documents and ids differ in number")
                cut = [ids[j - n:j] for n, j in zip(lengths.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [at.column("part").take(pa.array([0] * len(cut))),
                     at.column("seq").take(pa.array([0] * len(cut))),
                     at.column("doc_ids").flatten(), pa.array(ends - lengths),
                     pa.array(lengths), give(cut)],
                    names=["part", "seq", "doc_id", "before", "n_tokens", column.split()[0]])

    found = files.select("part", "seq", "doc_ids", "lengths", "coded").mapInArrow(
        run, f"part int, seq int, doc_id long, before long, n_tokens long, {column}")
    return found.join(starts, ["part", "seq"]).select(
        "doc_id", (F.col("first") + F.col("before")).alias("start"), "n_tokens",
        column.split()[0])
