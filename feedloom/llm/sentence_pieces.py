"""SentencePiece ids of whole texts, and texts of ids; giant texts are encoded in parallel."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm import piece_scan
from feedloom.llm.chunks import releasing
from feedloom.session import materialise

#: Characters from which a text is cut into chunks, and of a chunk.
GIANT, CHUNK = 1 << 16, 1 << 14
#: Bytes of text that are encoded together, and ids that are decoded together; lists of ids take
#: some forty times as much as the ids.
TEXTS, IDS = 8 << 20, 1 << 20

ENCODED = "doc_id long, ids array<int>, text_key long"


def _few(batch: pa.RecordBatch, sizes: pa.Array, most: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``most`` together, or of one larger row."""
    start, held = 0, 0
    for at, size in enumerate(sizes.to_pylist()):
        if at > start and held + (size or 0) > most:
            yield batch.slice(start, at - start)
            start, held = at, 0
        held += size or 0
    yield batch.slice(start)


def _cuts(length: int, longest: int, chunk: int) -> list[int]:
    """Chunk ends of a text; the last chunk is not shorter than a piece."""
    cuts = list(range(chunk, length, chunk))
    while cuts and length - cuts[-1] < longest:
        cuts.pop()
    return [*cuts, length]


def encode_pieces(docs: DataFrame, model: str, giant: int = GIANT, chunk: int = CHUNK) -> DataFrame:
    """``(doc_id, ids, text_key)`` per row of ``docs`` (doc_id, text).

    ``ids`` equals what the library gives for the whole text and a BPE ``model`` file; a null or
    empty text has none. ``text_key`` is a hash of the text, for checks. Texts up to ``giant``
    characters go to the library, each distinct unit of a batch once (see ``piece_scan.Units``). A
    longer one is cut into chunks of ``chunk`` characters, which tasks share: they find a matrix
    each, a scan per text finds the states at the cuts, and the chunks are encoded from these, see
    ``piece_scan``. Repeated and null ids give rows as any others; further columns are left out.
    """
    usual, giants = _by_length(docs, giant)
    return usual.mapInArrow(releasing(_encoder(model)), ENCODED).unionByName(
        _encode_giants(giants, model, chunk))


def _by_length(docs: DataFrame, giant: int) -> tuple[DataFrame, DataFrame]:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long"), text.alias("text"))
    rows = rows.withColumn("text_key", F.xxhash64("text"))
    return rows.where(F.length("text") <= giant), rows.where(F.length("text") > giant)


def _encoder(model: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = piece_scan.units_of(model)
        for batch in batches:
            for few in _few(batch, pc.binary_length(batch.column("text")), TEXTS):
                yield pa.RecordBatch.from_arrays(
                    [few.column("doc_id"), units.of(few.column("text")), few.column("text_key")],
                    names=["doc_id", "ids", "text_key"])

    return encode


def _encode_giants(rows: DataFrame, model: str, chunk: int) -> DataFrame:
    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces, number = piece_scan.pieces_of(model), TaskContext.get().partitionId() << 32
        for frame in frames:
            for doc_id, text, text_key in zip(frame["doc_id"].astype("Int64"), frame["text"],
                                              frame["text_key"]):
                spelled, start = pieces.spelled(text), 0
                for k, stop in enumerate(_cuts(len(spelled), pieces.longest, chunk)):
                    begin = max(0, start - pieces.longest)
                    yield pd.DataFrame({
                        "doc_id": pd.array([doc_id], "Int64"), "text_key": text_key,
                        "row": number, "k": k, "start": start - begin, "stop": stop - begin,
                        "piece_text": spelled[begin:stop + pieces.longest]})
                    start = stop
                number += 1

    # Few rows but long work: as many tasks as a shuffle has, whatever their bytes.
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = materialise(rows.mapInPandas(
        cut, "doc_id long, text_key long, row long, k int, start int, stop int, "
             "piece_text string").repartition(tasks, "row", "k"), "chunks")

    def matrix(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = piece_scan.pieces_of(model)
        for frame in frames:
            found = [piece_scan.transfer(pieces, row.piece_text, row.start, row.stop)
                     for row in frame.itertuples()]
            yield frame[["row", "k"]].assign(
                height=[one.shape[0] for one in found],
                open=[np.packbits(one == 0.0).tobytes() for one in found],
                width=[one.shape[1] for one in found])

    def scan(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("k")
        matrices = []
        for row in frame.itertuples():
            size = row.height * row.width
            bits = np.unpackbits(np.frombuffer(row.open, np.uint8), count=size)
            matrices.append(np.where(bits.reshape(row.height, row.width) == 1, 0.0,
                                     piece_scan.NEVER))
        ends = piece_scan.best_states(matrices)
        return frame[["row", "k"]].assign(first=[0, *ends[:-1]], last=ends)

    def trace(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = piece_scan.pieces_of(model)
        for frame in frames:
            yield frame[["row", "k", "doc_id", "text_key"]].assign(ids=[
                piece_scan.backtrace(pieces, row.piece_text, row.start, row.stop, row.first,
                                     row.last) for row in frame.itertuples()])

    found = chunks.select("row", "k", "start", "stop", "piece_text").mapInPandas(
        matrix, "row long, k int, height int, open binary, width int")
    chosen = found.groupBy("row").applyInPandas(scan, "row long, k int, first int, last int")
    parts = chunks.join(materialise(chosen, "states"), ["row", "k"]).mapInPandas(
        trace, "row long, k int, doc_id long, text_key long, ids array<int>")
    whole = parts.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("text_key").alias("text_key"),
        F.array_sort(F.collect_list(F.struct("k", "ids"))).alias("parts"))
    return whole.select("doc_id", F.flatten("parts.ids").alias("ids"), "text_key")


def decode_pieces(encoded: DataFrame, model: str) -> DataFrame:
    """``encoded`` with the ``text`` of its ``ids``; null ids give an empty text.

    A text comes back as it was, but for the sign U+2581, which the vocabulary uses for a blank.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(releasing(_decoder(model)), f"{schema}, text string")


def _decoder(model: str):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = piece_scan.processor(model)
        for batch in batches:
            at = batch.schema.get_field_index("ids")
            for few in _few(batch, pc.list_value_length(batch.column(at)), IDS):
                # One text a call: a call for many makes threads.
                texts = [tool.decode(ids.values.to_numpy(zero_copy_only=False).tolist())
                         if ids.is_valid else "" for ids in few.column(at)]
                yield pa.RecordBatch.from_arrays([*few.columns, pa.array(texts, pa.string())],
                                                 names=[*few.schema.names, "text"])

    return decode


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [ids.values.to_numpy(zero_copy_only=False).astype("<u4")
                 for ids in batch.column("ids")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([len(ids) for ids in found], pa.int64()),
             pa.array([zlib.crc32(ids.tobytes()) for ids in found], pa.int64()),
             batch.column("text_key"), batch.column("text")],
            names=["doc_id", "n_tokens", "ids_crc32", "text_key", "text"])


def piece_digests(docs: DataFrame, model: str, giant: int = GIANT, chunk: int = CHUNK) -> DataFrame:
    """``(doc_id, n_tokens, ids_crc32, restored)``: ids of every text as ``encode_pieces`` gives
    them, counted, summed up as little-endian 32-bit integers, and decoded again.

    A task encodes, decodes and sums up in one Python worker; ids do not pass through Spark.
    """
    usual, giants = _by_length(docs, giant)
    encode, decode, out = _encoder(model), _decoder(model), (
        "doc_id long, n_tokens long, ids_crc32 long, text_key long, text string")
    found = usual.mapInArrow(releasing(lambda rows: _digest(decode(encode(rows)))), out)
    found = found.unionByName(_encode_giants(giants, model, chunk).mapInArrow(
        releasing(lambda rows: _digest(decode(rows))), out))
    return found.select("doc_id", "n_tokens", "ids_crc32",
                        (F.xxhash64("text") == F.col("text_key")).alias("restored"))
