"""Katz backoff language model: counted, discounted, normalised and applied by exchanges of keys.

The model is a table per order and bucket of keys: distinct n-grams with their training counts,
and distinct histories with their backoff weights. Documents are chunks (see ``chunks``); a chunk
asks each bucket for just the counts and weights that its own tokens need.

An n-gram is a pair of numbers: that of its history, an n-gram of the order below, and that of its
last word. Numbers run through the training vocabulary; 0 stands for what training never saw.

    P(w | h) = d(c(hw)) c(hw) / (c(h) + SPARED)    if hw occurs in training
             = a(h) P(w | h')                      else, h' being h without its first word
    P(w)     = d(c(w)) c(w) / (N + SPARED), and all that is left for unknown words as one class

``d`` is Good and Turing's discount for counts up to ``K``. ``a(h)`` is exact: what the words seen
after h leave, divided by the lower probability of the words not seen after h; both sums are taken
over the stored n-grams. ``SPARED`` leaves something even where no count is discounted.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm import chunks as C
from feedloom.session import discard, materialise

#: Counts up to this are discounted.
K = 5
SPARED = 0.5
#: Added to each count by the base model.
ADDED = 0.1
#: Training tokens of a history from which its n-grams are spread over several buckets.
HOT = 1 << 21
# No word is empty or a blank.
END, BEGIN = xxhash.xxh64_intdigest(b""), xxhash.xxh64_intdigest(b" ")
U32 = np.uint64(32)


@dataclass(frozen=True)
class Discounts:
    """Discount factors of counts 0 to ``K``; larger counts keep theirs."""

    factors: tuple[float, ...]

    @classmethod
    def of(cls, numbers: list[int]) -> Discounts:
        """From the numbers of n-grams that occur 1, 2, ... ``K`` + 1 times.

        A count whose factor would not lie in (0, 1], as with few n-grams, keeps its value.
        """
        n = [0, *numbers]
        factors = [1.0] * (K + 1)
        common = (K + 1) * n[K + 1] / n[1] if n[1] else 1.0
        for r in range(1, K + 1):
            if common < 1 and n[r]:
                factor = ((r + 1) * n[r + 1] / (r * n[r]) - common) / (1 - common)
                if 0 < factor <= 1:
                    factors[r] = factor
        return cls(tuple(factors))

    def discounted(self, counts: np.ndarray) -> np.ndarray:
        counts = counts.astype(np.int64)
        factors = np.array(self.factors)[np.minimum(counts, K)]
        return np.where(counts > K, counts, counts * factors)


@dataclass(frozen=True)
class Level:
    """How the n-grams of an order from 2 on are dealt out and, once counted, numbered."""

    #: Keys at which the buckets of n-grams begin, numbers at which those of histories do.
    edges: np.ndarray
    history_edges: np.ndarray
    discounts: Discounts | None = None
    #: Numbers of n-grams in the buckets before each; None for the last order.
    offsets: np.ndarray | None = None

    @classmethod
    def of(cls, histories: int, words: int, hot: list[tuple[int, int]], buckets: int) -> Level:
        """For histories numbered up to ``histories``; those of a hot one are cut up further."""
        edges = {(i * (histories + 1) // buckets) << 32 for i in range(buckets)}
        for number, count in hot:
            pieces = count // HOT + 1 if count > HOT else 1
            edges |= {(number << 32) + i * (words + 1) // pieces for i in range(pieces)} \
                if pieces > 1 else set()
        return cls(np.array(sorted(edges), dtype=np.uint64),
                   np.array([i * (histories + 1) // buckets for i in range(buckets)],
                            dtype=np.uint64))

    def parts(self, keys: np.ndarray) -> list[tuple[int, int, int]]:
        return _parts(np.append(np.searchsorted(keys, self.edges), len(keys)))

    def history_parts(self, keys: np.ndarray) -> list[tuple[int, int, int]]:
        return _parts(np.append(np.searchsorted(keys, self.history_edges), len(keys)))


def held_out(doc_id) -> bool:
    """Rows whose id, as text, has a checksum divisible by ten; a row without an id is not."""
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10 == 0


def coded(table: pa.Table) -> bytes:
    """The documents (doc_id, text) of a chunk as ids, tokens per text, hashes of distinct tokens,
    and which of them each token is; every step reads these, and the texts only this one."""
    hashes, parts, sizes = C.WordHashes(), [], []
    end = np.array([END], dtype=np.uint64)
    for text in table.column(1):
        words = text.as_buffer().to_pybytes().lower().split() if text.is_valid else []
        parts += [hashes.of(words), end]
        sizes.append(len(words) + 1)
    words, word_of = np.unique(np.concatenate(parts), return_inverse=True)
    return C.pack_rows(pa.table({
        "ids": pa.array([table.column(0).to_pylist()], pa.list_(pa.int64())),
        "sizes": pa.array([C.squeeze(np.array(sizes))], pa.binary()),
        "words": pa.array([C.squeeze_sorted(words)], pa.binary()),
        "word_of": pa.array([C.squeeze(word_of)], pa.binary())}))


class Opened:
    """The tokens of a chunk: hashes of words and text ends, and where each text begins."""

    def __init__(self, rows: bytes):
        row = C.open_rows(rows).combine_chunks()
        sizes, words, word_of = (row.column(name)[0].as_py()
                                 for name in ("sizes", "words", "word_of"))
        self.ids = row.column("ids").chunk(0).flatten()
        self.sizes = C.unsqueeze(sizes).astype(np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.held_out = np.array([held_out(i) for i in self.ids.to_pylist()], dtype=bool)
        self.training = np.repeat(~self.held_out, self.sizes)
        self.words, self.word_of = C.unsqueeze_sorted(words), C.unsqueeze(word_of).astype(np.int64)

    def training_counts(self, back: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(back[self.training], minlength=size)


def pack_floats(values: np.ndarray) -> bytes:
    """Floats of which many are equal."""
    distinct, codes = np.unique(values, return_inverse=True)
    head = zstandard.compress(distinct.astype("<f8").tobytes(), 1)
    return len(head).to_bytes(4, "little") + head + C.squeeze(codes)


def unpack_floats(data: bytes) -> np.ndarray:
    size = int.from_bytes(data[:4], "little")
    distinct = np.frombuffer(zstandard.decompress(data[4:4 + size]), "<f8")
    return distinct[C.unsqueeze(data[4 + size:]).astype(np.int64)]


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _parts(edges: np.ndarray) -> list[tuple[int, int, int]]:
    return [(i, a, b) for i, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist()))
            if b > a]


def _gathered(answers, parts, read, kind) -> np.ndarray:
    """Answers of all buckets, in the order of the keys asked for."""
    found = {one["bucket"]: one for one in answers or []}
    return np.concatenate([np.empty(0, kind), *[read(found[i]) for i, _, _ in parts]]).astype(kind)


def _totals(keys: list[np.ndarray], counts: list[np.ndarray]):
    """Distinct keys with summed counts, and where each given key is among them."""
    distinct, back = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(back, weights=np.concatenate(counts), minlength=len(distinct))
    cuts = np.cumsum([len(one) for one in keys])[:-1]
    return distinct, np.rint(total).astype(np.int64), np.split(back, cuts), back


def _spectrum(counts: np.ndarray) -> list[int]:
    return np.bincount(np.minimum(counts, K + 2), minlength=K + 3)[1:K + 2].tolist()


def _stacked(answers: pd.DataFrame, model: pd.DataFrame) -> pd.DataFrame:
    """Both kinds of rows; each has nulls in the other's columns."""
    for one, other in ((answers, model), (model, answers)):
        for name in other.columns.difference(one.columns):
            one[name] = None
    both = pd.concat([answers.astype(object), model[answers.columns].astype(object)])
    return both.astype({"chunk": "Int64", "tokens": "Int64", "distinct_keys": "Int64"})


STATISTICS = "tokens long, distinct_keys long, spectrum array<long>"


def _statistics(table: DataFrame) -> tuple[int, int, list[int]]:
    """Tokens, distinct n-grams, and n-grams by small counts, over all buckets."""
    row = table.agg(F.sum("tokens").alias("tokens"), F.sum("distinct_keys").alias("distinct"),
                    *[F.sum(F.col("spectrum")[r]).alias(f"n{r}") for r in range(K + 1)]).first()
    return row["tokens"] or 0, row["distinct"] or 0, [row[f"n{r}"] or 0 for r in range(K + 1)]


def _numbered(model: DataFrame, buckets: int) -> tuple[np.ndarray, list[tuple[int, int]], int]:
    """Numbers before each bucket, hot n-grams with their counts, and the last number.

    n-grams are numbered through all buckets; the driver holds a count per bucket.
    """
    offsets = np.zeros(buckets, dtype=np.int64)
    ahead, hot_grams = 0, []
    for bucket, distinct, hot, hot_counts in sorted(
            (row["bucket"], row["distinct_keys"], row["hot"], row["hot_counts"])
            for row in model.select("bucket", "distinct_keys", "hot", "hot_counts").collect()):
        offsets[bucket] = ahead
        hot_grams += [(number + ahead, count) for number, count in zip(hot, hot_counts)]
        ahead += distinct
    return offsets, hot_grams, ahead


def katz_scores(docs: DataFrame, order: int = 2) -> DataFrame:
    """Score each text of ``docs`` (doc_id, text) with a model of n-grams of up to ``order`` words
    (2 at least), counted in the texts not held out.

    Gives per row ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``: the
    tokens are the words in lower case and one end, ``base_score`` is log10 of an add-``ADDED``
    unigram model, ``score`` log10 of the Katz model, in which a text's first word follows its
    beginning; no history reaches before that. A null or empty text is one end. A row without an
    id belongs to training; repeated rows count each; further columns are left out; no rows give no
    rows. Words are told apart by 64-bit hashes.
    """
    chunks = C.chunk_table(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                                       F.col("text").cast("string").alias("text")), pack=coded)
    buckets = C.bucket_count(chunks)
    chunks = chunks.select("chunk", "rows")

    # Words: counts, and numbers for those of training.
    def ask_words(batches):
        for row in _each(batches):
            opened = Opened(row["rows"])
            counts = opened.training_counts(opened.word_of, len(opened.words))
            parts = _parts(C.bucket_edges(opened.words, buckets))
            yield pa.RecordBatch.from_pydict({
                "bucket": pa.array([i for i, _, _ in parts], pa.int32()),
                "chunk": pa.array([row["chunk"]] * len(parts), pa.int64()),
                "keys": pa.array([C.squeeze_sorted(opened.words[a:b]) for _, a, b in parts],
                                 pa.binary()),
                "counts": pa.array([C.squeeze(counts[a:b]) for _, a, b in parts], pa.binary())})

    def count_words(frame: pd.DataFrame) -> pd.DataFrame:
        keys, total, backs, _ = _totals([C.unsqueeze_sorted(one) for one in frame["keys"]],
                                        [C.unsqueeze(one) for one in frame["counts"]])
        number = np.where(total > 0, np.cumsum(total > 0), 0)
        known = total > 0
        hot = np.flatnonzero(total > HOT)
        answers = frame[["chunk", "bucket"]].assign(
            counts=[C.squeeze(total[back]) for back in backs],
            numbers=[C.squeeze(number[back]) for back in backs])
        model = pd.DataFrame({
            "bucket": frame["bucket"].iloc[:1], "keys": [C.squeeze_sorted(keys[known])],
            "counts": [C.squeeze(total[known])], "tokens": int(total.sum()),
            "distinct_keys": int(known.sum()), "spectrum": [_spectrum(total[known])],
            "hot": [number[hot].tolist()], "hot_counts": [total[hot].tolist()]})
        return _stacked(answers, model)

    asked = chunks.mapInArrow(C.releasing(ask_words),
                              "bucket int, chunk long, keys binary, counts binary")
    words = materialise(asked.groupBy("bucket").applyInPandas(
        C.releasing_group(count_words),
        "chunk long, bucket int, counts binary, numbers binary, keys binary, "
        f"{STATISTICS}, hot array<long>, hot_counts array<long>"), "words")
    model1 = words.where("chunk is null")
    tokens, vocabulary, spectrum = _statistics(model1)
    discounts1 = Discounts.of(spectrum)
    offsets, hot_words, _ = _numbered(model1, buckets)
    begin = vocabulary + 1
    kept = tokens - sum((1 - f) * r * n for r, (f, n) in enumerate(
        zip(discounts1.factors[1:], spectrum), 1))
    unknown = 1.0 - kept / (tokens + SPARED)

    def lower(counts: np.ndarray) -> np.ndarray:
        """Unigram probabilities of words by their counts."""
        return np.where(counts > 0, discounts1.discounted(counts) / (tokens + SPARED), unknown)

    texts = docs.select("doc_id").where(
        "doc_id is null or crc32(cast(doc_id as string)) % 10 <> 0").count()

    class Grams:
        """The n-grams of one order that end at each token of a chunk."""

        def __init__(self, first: np.ndarray, after: np.ndarray, last: np.ndarray):
            #: Number of the history, 0 where there is none, and its count in training.
            self.first, self.after = first, after
            # n-grams with a word or history that training lacks are in no model.
            self.in_model = (last > 0) & (first > 0)
            key = (first.astype(np.uint64) << U32) | last.astype(np.uint64)
            self.keys, at, self.key_of = np.unique(
                key[self.in_model], return_index=True, return_inverse=True)
            self.at = np.flatnonzero(self.in_model)[at]

        def answered(self, level: Level, answers) -> None:
            parts = level.parts(self.keys)
            counts = _gathered(answers, parts, lambda one: C.unsqueeze(
                one["counts"]).astype(np.int64), np.int64)
            self.counts = np.zeros(len(self.first), dtype=np.int64)
            self.counts[self.in_model] = counts[self.key_of]
            self.unseen = self.counts == 0
            # Only histories of n-grams that training lacks are ever backed off from. A word that
            # training lacks follows any history.
            self.back_off = self.unseen & (self.first > 0)
            self.histories = np.unique(self.first[self.back_off]).astype(np.uint64)
            if level.offsets is not None:
                found = {one["bucket"]: one["numbers"] for one in answers or []}
                numbers = np.zeros(len(self.keys), dtype=np.int64)
                numbers[counts > 0] = np.concatenate([np.empty(0, np.int64), *[
                    C.unsqueeze_sorted(found[i]).astype(np.int64) + level.offsets[i]
                    for i, _, _ in parts]])
                self.numbers = np.zeros(len(self.first), dtype=np.int64)
                self.numbers[self.in_model] = numbers[self.key_of]

    class Counted(Opened):
        """A chunk whose words, and n-grams of the orders that are counted, have their counts."""

        def __init__(self, row: dict, levels: list[Level]):
            super().__init__(row["rows"])
            parts = _parts(C.bucket_edges(self.words, buckets))
            self.counts = _gathered(row["words"], parts, lambda one: C.unsqueeze(
                one["counts"]).astype(np.int64), np.int64)
            numbers = [C.unsqueeze(one["numbers"]).astype(np.int64) for one in
                       sorted(row["words"] or [], key=lambda one: one["bucket"])]
            numbers = np.concatenate([np.empty(0, np.int64), *[
                np.where(n > 0, n + offsets[i], 0) for (i, _, _), n in zip(parts, numbers)]])
            self.last, self.count = numbers[self.word_of], self.counts[self.word_of]
            self.grams: list[Grams] = []
            for n, level in enumerate(levels, 2):
                grams = self.next_order()
                grams.answered(level, row[f"grams{n}"])
                self.grams.append(grams)

        def next_order(self) -> Grams:
            """The n-grams of the order above those that have their counts."""
            below = self.grams[-1] if self.grams else None
            number, count = (below.numbers, below.counts) if below else (self.last, self.count)
            first, after = (np.concatenate([[0], one[:-1]]) if len(one) else one
                            for one in (number, count))
            # The beginning is a history of one word; none is longer there.
            first[self.starts], after[self.starts] = (0, 0) if below else (begin, texts)
            return Grams(first, after, self.last)

    def column(parts, values: np.ndarray, pack=C.squeeze) -> pa.Array:
        return pa.array([pack(values[a:b]) for _, a, b in parts], pa.binary())

    def gram_counts(chunks: DataFrame, levels: list[Level], level: Level) -> DataFrame:
        """Answers to the chunks, and the model, for the order above ``levels``."""
        numbers_needed = len(levels) + 2 < order

        def ask(batches):
            for row in _each(batches):
                opened = Counted(row, levels)
                grams = opened.next_order()
                counts = np.bincount(grams.key_of[opened.training[grams.in_model]],
                                     minlength=len(grams.keys))
                # The lower order needs no more than the counts of its n-gram and history.
                lower_order = opened.grams[-1] if levels else None
                below = (lower_order.counts if levels else opened.count)[grams.at]
                after = lower_order.after[grams.at] if levels else None
                parts = level.parts(grams.keys)
                yield pa.RecordBatch.from_pydict({
                    "bucket": pa.array([i for i, _, _ in parts], pa.int32()),
                    "chunk": pa.array([row["chunk"]] * len(parts), pa.int64()),
                    "keys": column(parts, grams.keys, C.squeeze_sorted),
                    "counts": column(parts, counts), "below": column(parts, below),
                    "after": column(parts, after) if levels
                    else pa.array([None] * len(parts), pa.binary())})

        def count(frame: pd.DataFrame) -> pd.DataFrame:
            keys, total, backs, back = _totals([C.unsqueeze_sorted(one) for one in frame["keys"]],
                                               [C.unsqueeze(one) for one in frame["counts"]])
            known = total > 0
            answers = frame[["chunk", "bucket"]].assign(
                counts=[C.squeeze(total[back]) for back in backs])
            model = pd.DataFrame({
                "bucket": frame["bucket"].iloc[:1], "keys": [C.squeeze_sorted(keys[known])],
                "counts": [C.squeeze(total[known])], "tokens": int(total.sum()),
                "distinct_keys": int(known.sum()), "spectrum": [_spectrum(total[known])]})
            for name in ("below", "after") if levels else ("below",):
                sent = np.empty(len(keys), dtype=np.uint64)
                sent[back] = np.concatenate([C.unsqueeze(one) for one in frame[name]])
                model[name] = [C.squeeze(sent[known])]
            if numbers_needed:
                number, hot = np.cumsum(known), np.flatnonzero(total > HOT)
                answers["numbers"] = [C.squeeze_sorted(number[one[known[one]]].astype(np.uint64))
                                      for one in backs]
                model["hot"], model["hot_counts"] = [number[hot].tolist()], [total[hot].tolist()]
            out = _stacked(answers, model)
            for name in ("numbers", "after", "hot", "hot_counts"):
                if name not in out:
                    out[name] = None
            return out

        asked = chunks.mapInArrow(
            C.releasing(ask),
            "bucket int, chunk long, keys binary, counts binary, below binary, after binary")
        return materialise(asked.groupBy("bucket").applyInPandas(
            C.releasing_group(count),
            "chunk long, bucket int, counts binary, numbers binary, keys binary, "
            f"below binary, after binary, {STATISTICS}, hot array<long>, "
            "hot_counts array<long>"), f"grams{len(levels) + 2}")

    def history_weights(chunks: DataFrame, model: DataFrame, levels: list[Level]) -> DataFrame:
        """Backoff weights of the last of ``levels``, for the chunks that ask for them."""
        level, kind = levels[-1], "bucket int, chunk long, keys binary, sums binary"

        # Histories: sums over their n-grams, which lie in one bucket but for the hot ones.
        def sum_histories(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                for row in frame.itertuples():
                    keys, counts = C.unsqueeze_sorted(row.keys), C.unsqueeze(row.counts)
                    if not len(keys):
                        continue
                    history = keys >> U32
                    starts = np.flatnonzero(np.concatenate([[True], history[1:] != history[:-1]]))
                    below = C.unsqueeze(row.below).astype(np.int64)
                    chance = lower(below) if len(levels) == 1 else (
                        levels[-2].discounts.discounted(below) / (
                            C.unsqueeze(row.after).astype(np.float64) + SPARED))
                    sums = [np.add.reduceat(one, starts) for one in (
                        counts.astype(np.float64), level.discounts.discounted(counts), chance)]
                    history = history[starts]
                    for i, a, b in level.history_parts(history):
                        yield pd.DataFrame({
                            "bucket": [i], "chunk": pd.array([None], "Int64"),
                            "keys": [C.squeeze_sorted(history[a:b])],
                            "sums": [zstandard.compress(np.stack([s[a:b] for s in sums])
                                                        .astype("<f8").tobytes(), 1)]})

        def ask(batches):
            for row in _each(batches):
                histories = Counted(row, levels).grams[-1].histories
                parts = level.history_parts(histories)
                yield pa.RecordBatch.from_pydict({
                    "bucket": pa.array([i for i, _, _ in parts], pa.int32()),
                    "chunk": pa.array([row["chunk"]] * len(parts), pa.int64()),
                    "keys": column(parts, histories, C.squeeze_sorted),
                    "sums": pa.array([None] * len(parts), pa.binary())})

        def weigh(frame: pd.DataFrame) -> pd.DataFrame:
            ours = frame[frame["chunk"].isna()]
            keys = np.concatenate([np.empty(0, np.uint64),
                                   *[C.unsqueeze_sorted(one) for one in ours["keys"]]])
            sums = np.concatenate([np.empty((3, 0)), *[np.frombuffer(
                zstandard.decompress(one), "<f8").reshape(3, -1) for one in ours["sums"]]], axis=1)
            distinct, back = np.unique(keys, return_inverse=True)
            count, held, covered = (np.bincount(back, weights=one, minlength=len(distinct))
                                    for one in sums)
            # What the seen words leave, over what the lower order gives the others.
            weight = (1.0 - held / (count + SPARED)) / (1.0 - covered)
            asked = frame[frame["chunk"].notna()]
            out = []
            for one in asked["keys"]:
                wanted = C.unsqueeze_sorted(one)
                at = np.minimum(np.searchsorted(distinct, wanted), max(len(distinct) - 1, 0))
                found = distinct[at] == wanted if len(distinct) else np.zeros(len(wanted), bool)
                out.append(pack_floats(np.where(found, weight[at], 1.0) if len(distinct)
                                       else np.ones(len(wanted))))
            return asked[["chunk", "bucket"]].assign(weights=out).astype({"chunk": "int64"})
        sums = model.select("keys", "counts", "below", "after").mapInPandas(
            C.releasing(sum_histories), kind)
        return chunks.mapInArrow(C.releasing(ask), kind).unionByName(sums).groupBy("bucket") \
            .applyInPandas(C.releasing_group(weigh), "chunk long, bucket int, weights binary")

    answers = [C.listed(words.where("chunk is not null").select(
        "chunk", "bucket", "counts", "numbers"), "words")]
    discard(words)
    weights, levels = [], []
    histories, hot = begin, [*hot_words, (begin, texts)]
    for n in range(2, order + 1):
        level = Level.of(histories, begin, hot, buckets)
        grams = gram_counts(C.joined(chunks, *answers), list(levels), level)
        model = grams.where("chunk is null")
        level = replace(level, discounts=Discounts.of(_statistics(model)[2]))
        fields = ["chunk", "bucket", "counts"]
        if n < order:
            numbers_before, hot, histories = _numbered(model, len(level.edges))
            level, fields = replace(level, offsets=numbers_before), [*fields, "numbers"]
        levels.append(level)
        answers.append(C.listed(grams.where("chunk is not null").select(*fields), f"grams{n}"))
        weights.append(C.listed(history_weights(
            C.joined(chunks, *answers), model, list(levels)), f"weights{n}"))
        # The chunks have their answers, and weights are all that is asked of the model later.
        discard(grams)

    def score(batches):
        for row in _each(batches):
            opened = Counted(row, levels)
            count = opened.count
            # From the lowest order up: a word alone, then after ever longer histories.
            chance = lower(opened.counts)[opened.word_of]
            for n, (level, grams) in enumerate(zip(levels, opened.grams), 2):
                found = _gathered(row[f"weights{n}"], level.history_parts(grams.histories),
                                  lambda one: unpack_floats(one["weights"]), np.float64)
                chance[grams.back_off] *= found[np.searchsorted(
                    grams.histories, grams.first[grams.back_off].astype(np.uint64))]
                seen = ~grams.unseen
                chance[seen] = level.discounts.discounted(grams.counts[seen]) / (
                    grams.after[seen] + SPARED)
            base = (count + ADDED) / (tokens + ADDED * (vocabulary + 1))
            add = [np.add.reduceat(one, opened.starts) if len(one) else np.empty(0) for one in (
                np.log10(base), np.log10(chance), (count > 0).astype(np.int64))]
            yield pa.RecordBatch.from_arrays(
                [opened.ids, pa.array(opened.held_out),
                 pa.array(opened.sizes), pa.array(add[2].astype(np.int64)),
                 pa.array(np.full(len(opened.sizes), tokens, dtype=np.int64)),
                 pa.array(add[0]), pa.array(add[1])],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score",
                       "score"])

    return C.joined(chunks, *answers, *weights).mapInArrow(
        C.releasing(score),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double")
