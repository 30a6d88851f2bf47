"""Benchmark decontamination through a positional inverted index, in DataFrame functions only."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.operators.joins import lookup_join, small_side
from feedloom.session import materialise

#: Words in a test window.
WINDOW = 10
#: What stands between words, once A-Z are lower case.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Marks the end of a document in its postings; no word is empty.
END = ""


def words(text: Column) -> Column:
    """Words of a text; none for a null."""
    lower = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.filter(F.split(F.coalesce(lower, F.lit("")), BETWEEN), lambda w: w != END)


def content_key() -> Column:
    """Rows that repeat an id stay apart unless they repeat the text too."""
    return F.xxhash64("doc_id", "text")


def item_windows(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(window, terms)`` of the distinct windows of the test items, and ``(window, item_id)``.

    An item of fewer words than a window is one window; one without words has none.
    """
    found = words(F.col("text").cast("string"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - WINDOW + 1, F.lit(1)))
    cut = items.select("item_id", found.alias("words")).where(F.size("words") > 0).select(
        "item_id", F.explode(F.transform(starts, lambda i: F.slice("words", i, WINDOW)))
        .alias("terms"))
    cut = materialise(cut.distinct(), "item-windows")
    numbered = materialise(cut.select("terms").distinct().withColumn(
        "window", F.monotonically_increasing_id()), "windows")
    return numbered, materialise(cut.join(numbered, "terms").select("window", "item_id"), "items")


def postings(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """``(term_id, doc_id, key, pos)`` for the ``terms`` (term, term_id) in ``docs``, stored with
    each file sorted by term, so that a term's list is one stretch per file.

    Each document adds one posting of ``END`` behind its last word, which holds its word count.
    Terms that no test item uses are never looked up and not stored.
    """
    text = F.col("text").cast("string")
    marked = F.concat(words(text), F.array(F.lit(END)))
    each = docs.select("doc_id", content_key().alias("key"), F.posexplode(marked)
                       .alias("pos", "term"))
    return materialise(lookup_join(each, terms, "term", "inner")
                       .select("term_id", "doc_id", "key", "pos")
                       .sortWithinPartitions("term_id"), "postings")


def matches(index: DataFrame, windows: DataFrame, slop: int = 0) -> DataFrame:
    """``(key, window, start, length)``: where windows occur in the indexed documents.

    ``windows`` has ``(window, offset, term_id)``. With ``slop`` 0 these are exact phrases; else
    proximity matches: every term within ``slop`` words of its place. Lists are intersected from
    the rarest terms on: the two rarest of each window give the candidates, in positions moved
    back by their offsets, and only the documents that hold one are searched for the other terms.
    """
    times = materialise(index.groupBy("term_id").agg(F.count("*").alias("times")), "times")
    by_rarity = Window.partitionBy("window").orderBy(F.coalesce("times", F.lit(0)), "offset")
    ranked = windows.join(times, "term_id", "left").select(
        "window", "offset", "term_id", F.row_number().over(by_rarity).alias("rank"),
        F.count("*").over(Window.partitionBy("window")).alias("length"))
    ranked = materialise(ranked, "ranked")
    shifts = F.sequence(F.lit(-slop), F.lit(slop))

    def seen(postings: DataFrame, wanted: DataFrame, on: list[str]) -> DataFrame:
        return lookup_join(postings, wanted, on, "inner", unique=False)

    # A window's rarest term fixes the start; the second has to agree with it.
    first = seen(index, ranked.where("rank = 1"), ["term_id"]).select(
        "key", "window", "length", (F.col("pos") - F.col("offset")).alias("start"),
        F.lit(1).alias("found"))
    second = seen(index, ranked.where("rank = 2"), ["term_id"]).select(
        "key", "window", "length",
        F.explode(F.transform(shifts, lambda d: F.col("pos") - F.col("offset") + d))
        .alias("start"), F.lit(2).alias("found"))
    place = ["key", "window", "length", "start"]
    pairs = first.unionByName(second).groupBy(place).agg(F.bit_or("found").alias("found"))
    pairs = materialise(pairs.where("found = if(length = 1, 1, 3)").drop("found"), "pairs")
    rest = pairs.join(ranked.where("rank > 2").drop("length"), "window").select(
        *place, "term_id", "offset",
        F.explode(F.transform(shifts, lambda d: F.col("start") + F.col("offset") + d))
        .alias("pos"))
    holders = materialise(pairs.select("key").distinct(), "holders")
    held = lookup_join(index, holders, "key", "left_semi")
    whole = rest.join(held.select("key", "term_id", "pos"), ["key", "term_id", "pos"]) \
        .groupBy(place).agg(F.bit_count(F.bit_or(F.expr("shiftleft(1, offset)"))).alias("n")) \
        .where("n = length - 2").drop("n")
    return pairs.where("length <= 2").unionByName(whole)


def covered(spans: Column) -> Column:
    """Positions inside a list of (start, end) spans, each counted once."""
    zero = F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).alias("reach"))
    return F.aggregate(F.array_sort(spans), zero, lambda acc, span: F.struct(
        (acc["total"] + F.greatest(span["end"] - F.greatest(span["start"], acc["reach"]),
                                   F.lit(0))).cast("long").alias("total"),
        F.greatest(acc["reach"], span["end"]).alias("reach")))["total"]


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per row of ``docs``: ``n_words``, words inside an occurrence of a test window, and items.

    Columns ``doc_id, key, n_words, n_hit, item_ids`` (sorted as strings). A null or empty text
    has no words; a null text of an item gives no window, and a null item id hits words without
    being listed. Rows that repeat id and text get the same result each; further columns of
    either table are ignored; no items mean no hits.
    """
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    windows, of_items = item_windows(items.select("item_id", "text"))
    entries = windows.select("window", F.posexplode("terms").alias("offset", "term"))
    vocabulary = materialise(
        entries.select("term").distinct().withColumn("term_id", F.monotonically_increasing_id())
        .unionByName(docs.sparkSession.range(1).select(
            F.lit(END).alias("term"), F.lit(-1).cast("long").alias("term_id"))), "terms")
    index = postings(docs, vocabulary)
    wanted = entries.join(vocabulary, "term").select("window", "offset", "term_id")
    found = materialise(matches(index.where("term_id >= 0"), wanted), "matches")
    hit = found.groupBy("key").agg(F.collect_set(F.struct(
        F.col("start").alias("start"), (F.col("start") + F.col("length").cast("int")).alias("end")
    )).alias("spans")).select("key", covered(F.col("spans")).alias("n_hit"))
    named = found.select("key", "window").distinct().join(of_items, "window").groupBy("key").agg(
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids"))
    per_key = materialise(hit.join(named, "key", "left"), "hits")
    ends = index.where("term_id = -1").select("doc_id", "key",
                                              F.col("pos").cast("long").alias("n_words"))
    return lookup_join(ends, per_key, "key", "left").select(
        "doc_id", "key", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"))


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no test window occurs."""
    hit = contamination(docs, items).where("n_hit > 0").select("key").distinct()
    hit = materialise(hit.withColumnRenamed("key", "hit_key"), "hit-keys")
    key = F.xxhash64(F.col("doc_id"), F.col("text").cast("string"))
    return docs.join(small_side(hit), key == F.col("hit_key"), "left_anti")
