"""Substring dedup: passages that start in an earlier document, found by fixed-block anchors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm import chunks as C

#: Words of a window; one that a smaller document also holds is removed.
WINDOW = 50
#: Bytes of documents in a chunk; a chunk's words and hashes take some thirty times as much.
CHUNK_BYTES = 2 << 20
#: Words of a reference block. Any window holds a whole block of those that do not overlap.
BLOCK = WINDOW // 2


class Opened:
    """The documents of a chunk, with the hashes of their words and of all their blocks.

    Documents are in order of their ids; those without one, or too short for a window, have no
    windows. ``blocks`` are the distinct hashes of all rolling blocks.
    """

    hashes = C.WordHashes()
    rolling = C.Rolling()

    def __init__(self, rows: bytes):
        self.table = C.open_rows(rows)
        texts = self.table.column(self.table.num_columns - 1)
        self.words = [text.as_buffer().to_pybytes().split() if text.is_valid else []
                      for text in texts]
        ids = self.table.column(0).to_pylist()
        self.order = sorted((i for i, words in enumerate(self.words)
                             if len(words) >= WINDOW and ids[i] is not None),
                            key=ids.__getitem__)
        self.ids = np.array([ids[i] for i in self.order], dtype=np.int64)
        self.word_hashes = [self.hashes.of(self.words[i]) for i in self.order]
        rolled = [self.rolling.windows(one, BLOCK) for one in self.word_hashes]
        self.sizes = np.array([len(one) for one in rolled], dtype=np.int64)
        every = np.concatenate(rolled) if rolled else np.empty(0, np.uint64)
        self.blocks, self.first, self.back = np.unique(
            every, return_index=True, return_inverse=True)
        self.holder = np.repeat(np.arange(len(rolled)), self.sizes)
        within = np.arange(len(every)) - np.repeat(np.cumsum(self.sizes) - self.sizes, self.sizes)
        # Reference blocks are those at multiples of their length.
        self.is_reference = np.zeros(len(self.blocks), dtype=bool)
        self.is_reference[self.back[within % BLOCK == 0]] = True

    def anchors(self, elsewhere: np.ndarray) -> np.ndarray:
        """Positions, over all documents, of reference blocks that several documents hold."""
        last = np.zeros(len(self.blocks), dtype=np.int64)
        last[self.back] = self.holder
        here = self.is_reference & (self.holder[self.first] != last)
        return (here | elsewhere)[self.back]

    def candidates(self, elsewhere: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Windows that hold an anchor: hashes, position of the document, first word."""
        at = self.anchors(elsewhere)
        keys, holders, starts = [], [], []
        stop = 0
        for number, size in enumerate(self.sizes.tolist()):
            mine = at[stop:stop + size]
            stop += size
            if not mine.any():
                continue
            sums = np.concatenate([[0], np.cumsum(mine)])
            # A window of two blocks' length has a block at each of its first words and the next.
            reach = WINDOW - BLOCK + 1
            found = np.flatnonzero(sums[reach:] > sums[:-reach])
            keys.append(self.rolling.windows(self.word_hashes[number], WINDOW)[found])
            holders.append(np.full(len(found), number))
            starts.append(found)
        if not keys:
            return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate(keys), np.concatenate(holders), np.concatenate(starts)


def _answer(parts, counts: np.ndarray) -> np.ndarray:
    """The bits of all buckets, in the order of the keys asked for."""
    found = {part["bucket"]: part["answer"] for part in parts or []}
    return np.concatenate([np.zeros(0, dtype=bool), *[
        C.unpack_bits(found[i], n) if i in found else np.zeros(n, dtype=bool)
        for i, n in enumerate(counts.tolist()) if n]])


def _rows(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        yield from batch.to_pylist()


def repeats(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """What of each text of ``docs`` (doc_id, text) an earlier document holds already.

    A window is ``WINDOW`` consecutive words of a document; every word is repeated that a window
    covers whose word sequence also starts in a document with a smaller id. Gives per row:
    ``doc_id``, the columns named in ``carry``, ``n_words``, ``n_removed``, ``spans`` (first and
    behind last word of each maximal repeated stretch) and ``kept`` (the other words, joined by
    one space). A null text has no words. A row without an id keeps its words and takes none from
    others; rows that share an id do not repeat each other; further columns are left out.

    Every document's non-overlapping blocks of ``BLOCK`` words are the reference; every rolling
    block of every document is looked up in it. Where several documents hold a reference block,
    the windows around it are compared by their whole word sequences, over all documents that hold
    them at once, so a passage shared by k documents costs k entries and no pairs; adjoining
    repeated windows make up the maximal repeats. Blocks and windows are compared by 64-bit hashes.
    """
    others = [name for name in carry if name != "text"]
    source = docs.select(F.col("doc_id").cast("long").alias("c0"),
                         *[F.col(name).alias(f"c{i + 1}") for i, name in enumerate(others)],
                         F.col("text").cast("string").alias("words_of"))
    # The text is the last column, and is given back if it is carried.
    names = ["doc_id", *others, *(["text"] if "text" in carry else [])]
    kinds = [field.dataType.simpleString() for field in source.schema.fields[:len(names)]]
    chunks = C.chunk_table(source, CHUNK_BYTES)
    buckets = C.bucket_count(chunks)

    def ask_blocks(batches):
        for row in _rows(batches):
            opened = Opened(row["rows"])
            edges = C.bucket_edges(opened.blocks, buckets)
            spans = [(i, a, b) for i, (a, b) in enumerate(zip(edges[:-1], edges[1:])) if b > a]
            yield pa.RecordBatch.from_pydict({
                "bucket": pa.array([i for i, _, _ in spans], pa.int32()),
                "chunk": pa.array([row["chunk"]] * len(spans), pa.int64()),
                "keys": pa.array([C.squeeze_sorted(opened.blocks[a:b]) for _, a, b in spans],
                                 pa.binary()),
                "reference": pa.array([C.pack_bits(opened.is_reference[a:b])
                                       for _, a, b in spans], pa.binary())})

    def find_blocks(frame: pd.DataFrame) -> pd.DataFrame:
        keys = [C.unsqueeze_sorted(one) for one in frame["keys"]]
        reference = np.unique(np.concatenate([
            one[C.unpack_bits(bits, len(one))] for one, bits in zip(keys, frame["reference"])]))
        every = np.sort(np.concatenate(keys))
        shared = np.unique(every[1:][every[1:] == every[:-1]])
        shared = np.intersect1d(shared, reference, assume_unique=True)
        return frame[["chunk", "bucket"]].assign(answer=[
            C.pack_bits(np.isin(one, shared, assume_unique=True)) for one in keys])

    asked = chunks.select("chunk", "rows").mapInArrow(
        C.releasing(ask_blocks), "bucket int, chunk long, keys binary, reference binary")
    shared = asked.groupBy("bucket").applyInPandas(
        find_blocks, "chunk long, bucket int, answer binary")
    chunks = chunks.select("chunk", "rows")
    shared = C.listed(shared, "shared")

    def ask_windows(batches):
        for row in _rows(batches):
            opened = Opened(row["rows"])
            elsewhere = _answer(row["shared"], np.diff(C.bucket_edges(opened.blocks, buckets)))
            keys, holders, _ = opened.candidates(elsewhere)
            # Documents are in order, so the first holder of a window is the smallest.
            keys, first = np.unique(keys, return_index=True)
            owners = opened.ids[holders[first]] if len(keys) else opened.ids[:0]
            base = int(owners.min()) if len(owners) else 0
            edges = C.bucket_edges(keys, buckets)
            spans = [(i, a, b) for i, (a, b) in enumerate(zip(edges[:-1], edges[1:])) if b > a]
            yield pa.RecordBatch.from_pydict({
                "bucket": pa.array([i for i, _, _ in spans], pa.int32()),
                "chunk": pa.array([row["chunk"]] * len(spans), pa.int64()),
                "base": pa.array([base] * len(spans), pa.int64()),
                "keys": pa.array([C.squeeze_sorted(keys[a:b]) for _, a, b in spans], pa.binary()),
                "owners": pa.array([C.squeeze((owners[a:b] - base).view(np.uint64))
                                    for _, a, b in spans], pa.binary())})

    def find_windows(frame: pd.DataFrame) -> pd.DataFrame:
        keys = [C.unsqueeze_sorted(one) for one in frame["keys"]]
        owners = np.concatenate([C.unsqueeze(one).view(np.int64) + base
                                 for one, base in zip(frame["owners"], frame["base"])])
        every = np.concatenate(keys)
        order = np.argsort(every, kind="stable")
        every, sorted_owners = every[order], owners[order]
        starts = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
        smallest = np.minimum.reduceat(sorted_owners, starts)
        lengths = np.diff(np.append(starts, len(every)))
        earlier = np.empty(len(every), dtype=bool)
        earlier[order] = np.repeat(smallest, lengths) < sorted_owners
        cuts = np.cumsum([len(one) for one in keys])[:-1]
        return frame[["chunk", "bucket"]].assign(
            answer=[C.pack_bits(one) for one in np.split(earlier, cuts)])

    windows = C.joined(chunks, shared).mapInArrow(
        C.releasing(ask_windows), "bucket int, chunk long, base long, keys binary, owners binary")
    earlier = windows.groupBy("bucket").applyInPandas(
        find_windows, "chunk long, bucket int, answer binary")
    earlier = C.listed(earlier, "earlier")

    def remove(batches):
        for row in _rows(batches):
            opened = Opened(row["rows"])
            elsewhere = _answer(row["shared"], np.diff(C.bucket_edges(opened.blocks, buckets)))
            keys, holders, starts = opened.candidates(elsewhere)
            distinct, first, back = np.unique(keys, return_index=True, return_inverse=True)
            before = _answer(row["earlier"], np.diff(C.bucket_edges(distinct, buckets)))
            owners = opened.ids[holders[first]] if len(distinct) else opened.ids[:0]
            gone = before[back] | (opened.ids[holders] > owners[back]) if len(keys) else before
            holders, starts = holders[gone], starts[gone]
            edges = np.searchsorted(holders, np.arange(len(opened.order) + 1))
            spans: list[list] = [[] for _ in opened.words]
            for number, i in enumerate(opened.order):
                mine = starts[edges[number]:edges[number + 1]]
                if not len(mine):
                    continue
                cut = np.flatnonzero(mine[1:] > mine[:-1] + WINDOW) + 1
                spans[i] = [(int(part[0]), int(part[-1]) + WINDOW) for part in np.split(mine, cut)]
            removed = [sum(b - a for a, b in one) for one in spans]
            kept = []
            for words, one in zip(opened.words, spans):
                left, at = [], 0
                for a, b in one:
                    left += words[at:a]
                    at = b
                kept.append(b" ".join(left + words[at:]))
            table = opened.table.combine_chunks()
            columns = [table.column(i) for i in range(len(names))]
            columns = [c.chunk(0) if c.num_chunks else pa.array([], c.type) for c in columns]
            yield pa.RecordBatch.from_arrays([
                *columns, pa.array([len(words) for words in opened.words], pa.int64()),
                pa.array(removed, pa.int64()),
                pa.array([[{"start": a, "end": b} for a, b in one] for one in spans],
                         pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                pa.array(kept, pa.binary()).cast(pa.string())],
                names=[*[f"c{i}" for i in range(len(names))], "n_words", "n_removed", "spans", "kept"])

    schema = ", ".join(f"c{i} {kind}" for i, kind in enumerate(kinds))
    return C.joined(chunks, shared, earlier).mapInArrow(
        C.releasing(remove), f"{schema}, n_words long, n_removed long, "
                "spans array<struct<start:int,end:int>>, kept string").toDF(
        *names, "n_words", "n_removed", "spans", "kept")


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated words taken out of ``text`` and ``n_chars`` counted anew.

    A text without repeats stays as it is, white space and all.
    """
    # Other columns may have any names, so they travel under names of their own.
    others = {c: f"carried_{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    found = repeats(docs.select("doc_id", "text", *[F.col(c).alias(n) for c, n in others.items()]),
                    ("text", *others.values()))
    changed = F.col("n_removed") > 0
    shown = {"doc_id": F.col("doc_id"),
             "text": F.when(changed, F.col("kept")).otherwise(F.col("text")),
             **{c: F.col(n) for c, n in others.items()}}
    if "n_chars" in others:
        shown["n_chars"] = F.when(changed, F.length("kept").cast("long")).otherwise(
            F.col(others["n_chars"]))
    return found.select(*[shown[c].alias(c) for c in docs.columns])
