"""Spelling variants: frequent words that differ by one code point, found by asymmetric q-chunks."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.chunks import releasing
from feedloom.session import materialise

#: Code points and occurrences that a word has at least.
LENGTH, TIMES = 6, 5
#: How many times more frequent than a word its form is.
RATIO = 5
#: One in so many runs of a document loses a code point.
NOISE = 199
#: Distinct words that a task counts before it passes them on.
HELD = 1 << 18
#: Code points of a text that are cut into runs at once.
PIECE = 1 << 20
LETTERS = "A-Za-zÀ-ÿ"
BETWEEN = re.compile(f"[^{LETTERS}]")


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """The text in parts that end where a run does."""
    start = 0
    while start < len(text):
        end = BETWEEN.search(text, start + size) if start + size < len(text) else None
        stop = end.start() if end else len(text)
        yield text[start:stop]
        start = stop


def thinned(run: str, state: int, noise: int) -> str:
    """A run, or in one of ``noise`` cases the run without one code point."""
    found = zlib.crc32(run.encode(), state)
    if found % noise:
        return run
    at = found % len(run)
    return run[:at] + run[at + 1:]


def vocabulary(docs: DataFrame, length: int = LENGTH, times: int = TIMES,
               noise: int = NOISE) -> DataFrame:
    """``(word, n)`` of the words with enough code points and occurrences, stored."""
    # A run only ever gets shorter, so that shorter ones need not be looked at.
    runs = re.compile(f"[{LETTERS}]{{{length},}}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def passed_on() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                names=["word", "n"])
            held.clear()
            return batch

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if not text.is_valid:
                    continue
                # Lower case of bytes is that of A-Z.
                plain = text.as_buffer().to_pybytes().lower().decode("utf-8", "replace")
                state = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for part in pieces(plain):
                    for run, n in Counter(runs.findall(part)).items():
                        word = thinned(run, state, noise)
                        if len(word) >= length:
                            held[word] += n
                    if len(held) >= HELD:
                        yield passed_on()
        if held:
            yield passed_on()

    counts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        releasing(count), "word string, n long")
    return materialise(counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= times),
                       "vocabulary")


def near_pairs(words: DataFrame) -> DataFrame:
    """``(a, n_a, b, n_b)``: pairs of the distinct ``words`` (word, n) one code point apart, once.

    The longer word (of equals the greater) gives two disjoint chunks, its first and its last
    ``length div 2`` code points; one edit leaves one of them whole and moves it by one place at
    most. The other word gives all its positional grams of the lengths such a chunk can have. They
    meet by text and place; the edit distance is checked inside the join.
    """
    sized = words.withColumn("size", F.char_length("word"))
    half = F.expr("size div 2")
    place = lambda at: F.struct(F.expr(f"substring(word, {at} + 1, size div 2)").alias("gram"),
                                F.expr(at).alias("pos"))
    chunks = sized.select("word", "n", "size", F.explode(F.array(
        place("0"), place("size - size div 2"))).alias("chunk"))
    chunks = chunks.select(
        F.col("word").alias("a"), F.col("n").alias("n_a"), F.col("size").alias("size_a"),
        F.col("chunk.gram").alias("gram"),
        F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)),
                              lambda shift: F.col("chunk.pos") + shift)).alias("pos"))
    lengths = F.array_distinct(F.array(half, F.expr("(size + 1) div 2")))
    grams = sized.select("word", "n", "size", F.explode(lengths).alias("q"))
    grams = grams.select(
        F.col("word").alias("b"), F.col("n").alias("n_b"), F.col("size").alias("size_b"), "q",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - F.col("q"))).alias("pos"))
    grams = grams.select("b", "n_b", "size_b", F.col("pos").cast("int").alias("pos"),
                         F.expr("substring(b, int(pos) + 1, int(q))").alias("gram"))
    longer = (F.col("size_a") - F.col("size_b") == 1) | (
        (F.col("size_a") == F.col("size_b")) & (F.col("a") > F.col("b")))
    met = chunks.withColumn("pos", F.col("pos").cast("int")).alias("c").join(
        grams.alias("g"), (F.col("c.gram") == F.col("g.gram")) & (F.col("c.pos") == F.col("g.pos"))
        & longer & (F.levenshtein("a", "b", 1) == 1))
    return met.select("a", "n_a", "b", "n_b").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)``: the last word that the steps ``(word, form)`` lead to.

    Each round doubles the length of the steps. A form is more frequent than its word by a factor,
    so there are no circles and a chain is as long as the logarithm of the largest count at most.
    """
    steps = forms.select("word", F.col("form").alias("root"))
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        steps = materialise(steps.join(ahead, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"),
            F.col("further").isNotNull().alias("moved")), "steps")
        if steps.where("moved").isEmpty():
            return steps.select("word", "root")
        steps = steps.drop("moved")


def spelling_variants(docs: DataFrame, length: int = LENGTH, times: int = TIMES,
                      ratio: int = RATIO, noise: int = NOISE) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of the frequent words of ``docs``.

    Words are runs of the letters A-Z, a-z and U+00C0 to U+00FF, with A-Z in lower case, of which
    one in ``noise`` (by the checksum of id and run) loses a code point. ``n_near`` words are one
    code point away; the most frequent of them (of equals the smallest) is the ``form`` if it
    occurs ``ratio`` times as often, else there is none. ``root`` is where forms lead to.

    Null and empty texts have no words; a null id counts as an empty text before the colon; rows
    that repeat count again; no documents, or none with frequent words, give no rows; other
    columns are ignored. A word has a bounded number of neighbours, so no group grows with the
    corpus but the words that share a chunk, whose pairs are checked in the join and not kept.
    """
    words = vocabulary(docs, length, times, noise)
    pairs = materialise(near_pairs(words), "near-words")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"),
                        F.col("n_b").alias("other_n")).unionByName(pairs.select(
                            F.col("b").alias("word"), F.col("a").alias("other"),
                            F.col("n_a").alias("other_n")))
    near = both.groupBy("word").agg(
        F.count("*").alias("n_near"),
        F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other"))).alias("best"))
    fits = -F.col("best.less") >= F.col("n") * ratio
    named = materialise(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(fits, F.col("best.other")).alias("form"),
        F.when(fits, -F.col("best.less")).alias("form_n")), "forms")
    ends = roots(named.where("form is not null"))
    return named.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
