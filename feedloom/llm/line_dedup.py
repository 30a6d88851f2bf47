"""Lines that an earlier document holds already, in DataFrame functions only.

Hashes of lines are dealt by ranges and sorted by document and position within them, so that the
first occurrence of each streams past before all others. What comes back is no text but one
compressed bitmap per document that loses lines.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.operators.joins import hot_keys, lookup_join
from feedloom.session import materialise

#: Code points of the shortest key that can be lost.
LEAST = 10
#: What is stripped from both ends of a line.
BLANKS = " \t\n\x0b\x0c\r"
#: Parts that the documents of a hot line are dealt into.
SLICES = 64
#: Lines that a word of a bitmap stands for.
WORD = 64


def line_rows(docs: DataFrame) -> DataFrame:
    """``(doc_id, row, text)``; ``row`` tells rows apart that repeat an id. A null text is empty."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("row"),
                       text.alias("text"))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case and nothing else. Plain ASCII has a faster way to the same."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def hashed_lines(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``(h1, h2, doc_id, row, pos)`` of the lines that can be lost: 128 bits of the line's key."""
    each = line_rows(docs).where("doc_id is not null").select(
        "doc_id", "row", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    stripped = each.withColumn("line", F.btrim("line", F.lit(BLANKS))).where(
        F.char_length("line") >= least)
    keyed = stripped.withColumn("line", lower_ascii(F.col("line")))
    return keyed.select(F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"),
                        "doc_id", "row", "pos")


def lost_lines(lines: DataFrame) -> DataFrame:
    """``(doc_id, row, pos)`` of the lines that stand in a document with a smaller id too.

    Ranges of hashes go to tasks and are sorted by hash, document and position there; the first
    row of a hash names the document that keeps it. A hash with a large share of all lines is
    dealt by document into ``SLICES`` parts with a first row each; the few lines of those are then
    compared with the smallest first. Which hashes count as hot does not change the result.
    """
    hot = hot_keys(lines, F.col("h1"))
    is_hot = F.col("h1").isin(hot)
    parts = ["h1", "h2"]
    if hot:
        slices = F.pmod(F.xxhash64("doc_id"), F.lit(SLICES)).cast("int")
        lines = lines.withColumn("slice", F.when(is_hot, slices).otherwise(0))
        parts.append("slice")
    stream = Window.partitionBy(*parts).orderBy("doc_id", "pos").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    seen = lines.repartitionByRange(*parts).withColumn("first", F.first("doc_id").over(stream))
    later = F.col("doc_id") > F.col("first")
    if not hot:
        return seen.where(later).select("doc_id", "row", "pos")
    marked = materialise(seen.where(later | is_hot).select(
        "h1", "h2", "doc_id", "row", "pos", later.alias("later")), "marked-lines")
    heads = marked.where(~F.col("later"))
    # One row per hot hash, and there are few.
    smallest = F.broadcast(heads.groupBy("h1", "h2").agg(F.min("doc_id").alias("first")))
    return marked.where("later").unionByName(
        heads.join(smallest, ["h1", "h2"]).where(later), allowMissingColumns=True).select(
            "doc_id", "row", "pos")


def keep_bitmaps(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``(doc_id, row, n_dropped, keep)`` of each document that loses lines.

    ``keep`` holds ``(word, bits)``: bit b of word w stands for line ``64 w + b`` and is 1 if the
    line stays. Words whose lines all stay are left out, which is the compression: a bitmap costs
    what the document loses.

    A line is lost if its key (stripped of ``BLANKS``, A-Z in lower case) has ``least`` code points
    or more and stands in a document with a smaller id. All lines of the smallest id stay, also if
    several rows have that id. Documents without an id lose nothing and take nothing away. Rows
    that repeat id and text share one bitmap; no documents give none; other columns are ignored.
    """
    lost = lost_lines(materialise(hashed_lines(docs, least), "lines"))
    bit = F.expr(f"shiftleft(1L, pos % {WORD})")
    words = lost.groupBy("doc_id", "row", F.expr(f"pos div {WORD}").cast("int").alias("word")) \
        .agg(F.bit_or(bit).alias("gone"))
    return words.groupBy("doc_id", "row").agg(
        F.sum(F.bit_count("gone")).cast("long").alias("n_dropped"),
        F.collect_list(F.struct("word", F.bitwise_not("gone").alias("bits"))).alias("keep"))


def kept_lines(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``(doc_id, n_lines, n_dropped, kept)`` per row of ``docs``, from their bitmaps."""
    gone = F.flatten(F.transform("keep", lambda w: F.transform(
        F.filter(F.sequence(F.lit(0), F.lit(WORD - 1)), lambda b: F.getbit(w["bits"], b) == 0),
        lambda b: w["word"] * WORD + b)))
    split = lookup_join(line_rows(docs), bitmaps, ["doc_id", "row"]).select(
        "doc_id", "text", "n_dropped", gone.alias("gone"), F.split("text", "\n").alias("lines"))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    kept = F.array_join(F.transform(stay, lambda i: F.get(F.col("lines"), i)), "\n")
    return split.select(
        "doc_id", F.size("lines").cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept).alias("kept"))
