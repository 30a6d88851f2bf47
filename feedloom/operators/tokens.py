"""Token tables: rows (doc_id, field, kind, pos, term) and roll-ups over them.

Words are exploded first and grams are cut from one word at a time, so no array of all grams of
a text is ever built. Nothing here shuffles before a roll-up.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from feedloom.functions import tokens as t


def _words(df: DataFrame, doc_id: Column, words: Column) -> DataFrame:
    return df.select(doc_id.alias("doc_id"), F.posexplode(words).alias("pos", "word"))


def _grams(rows: DataFrame, grams: Column) -> DataFrame:
    return rows.select("doc_id", "pos", F.explode(grams).alias("term"))


def word_tokens(df: DataFrame, doc_id: Column, text: Column) -> DataFrame:
    return _words(df, doc_id, t.simple_words(text)).withColumnRenamed("word", "term")


def prefix_tokens(df: DataFrame, doc_id: Column, text: Column) -> DataFrame:
    return _grams(_words(df, doc_id, t.simple_words(text)), t.prefix_grams(F.col("word")))


def suffix_tokens(df: DataFrame, doc_id: Column, text: Column) -> DataFrame:
    return _grams(_words(df, doc_id, t.simple_words(text)), t.suffix_grams(F.col("word")))


def shingle_tokens(df: DataFrame, doc_id: Column, text: Column) -> DataFrame:
    """Words and shingles; only a token that is a stop word as a whole is left out."""
    # The word array is a column of its own: the shingle expression reads it several times.
    cut = df.select(doc_id.alias("doc_id"), t.standard_words(text).alias("words"))
    starts = cut.select("doc_id", F.posexplode(t.shingles(F.col("words"))).alias("pos", "grams"))
    terms = starts.select("doc_id", "pos", F.explode("grams").alias("term"))
    return terms.where(~t.is_stopword(F.col("term")))


def reversed_tokens(df: DataFrame, doc_id: Column, text: Column) -> DataFrame:
    """Words spelt backwards. The stop list sees them that way round."""
    rows = _words(df, doc_id, t.standard_words(text))
    return rows.select("doc_id", "pos", F.reverse("word").alias("term")).where(
        ~t.is_stopword(F.col("term")))


def label_tokens(df: DataFrame, doc_id: Column, text: Column) -> DataFrame:
    return _grams(_words(df, doc_id, t.label_words(text)), t.label_grams(F.col("word")))


# The token tables of each field of an ad.
FIELD_PLAN = {
    "headline": ["words", "prefix", "suffix"],
    "description.text": ["words", "prefix", "suffix"],
    "keywords.enriched.compound": ["shingles", "reversed"],
    "keywords.enriched_typeahead_terms.compound": ["shingles", "reversed"],
}


def _tagged(kind: str, terms: Column) -> Column:
    return F.transform(terms, lambda term: F.struct(F.lit(kind).alias("kind"), term.alias("term")))


def _simple_kinds(df: DataFrame, doc_id: Column, text: Column, kinds: list[str]) -> DataFrame:
    """Words, prefixes and suffixes of a text that is cut once."""
    of = {"words": F.array("word"), "prefix": t.prefix_grams(F.col("word")),
          "suffix": t.suffix_grams(F.col("word"))}
    none = F.array().cast("array<string>")
    terms = F.concat(*[_tagged(k, F.coalesce(of[k], none)) for k in kinds])
    return _words(df, doc_id, t.simple_words(text)).select("doc_id", "pos", F.inline(terms))


def _standard_kinds(df: DataFrame, doc_id: Column, text: Column, kinds: list[str]) -> DataFrame:
    """Shingles and reversed words of a text that is cut once."""
    cut = df.select(doc_id.alias("doc_id"), t.standard_words(text).alias("words"))
    starts = cut.select("doc_id", F.posexplode(t.shingles(F.col("words"))).alias("pos", "grams"))
    of = {"shingles": F.col("grams"), "reversed": F.array(F.reverse(F.get("grams", F.lit(0))))}
    terms = F.concat(*[_tagged(k, of[k]) for k in kinds])
    return starts.select("doc_id", "pos", F.inline(terms)).where(~t.is_stopword(F.col("term")))


def _label_kinds(df: DataFrame, doc_id: Column, text: Column, kinds: list[str]) -> DataFrame:
    return label_tokens(df, doc_id, text).select("doc_id", "pos", F.lit("label").alias("kind"), "term")


# Kinds that are cut from the same words, and so from one pass over the text.
FAMILIES = [(_simple_kinds, ["words", "prefix", "suffix"]),
            (_standard_kinds, ["shingles", "reversed"]), (_label_kinds, ["label"])]


def token_table(df: DataFrame, plan: dict[str, list[str]] | None = None,
                doc_id: str = "id") -> DataFrame:
    """Union of the token tables a plan names. A field holding an array is taken per element.

    A field is read once for all kinds that share its words.
    """
    parts = []
    for field, wanted in (plan or FIELD_PLAN).items():
        one = df.select(F.col(doc_id).alias("__id"), F.col(field).alias("__text"))
        if one.schema["__text"].dataType.typeName() == "array":
            one = one.select("__id", F.explode("__text").alias("__text"))
        for cut, members in FAMILIES:
            kinds = [k for k in members if k in wanted]
            if kinds:
                rows = cut(one, F.col("__id"), F.col("__text"), kinds)
                parts.append(rows.select("doc_id", F.lit(field).alias("field"), "kind", "pos", "term"))
    return reduce(DataFrame.unionByName, parts)


def term_frequency(tokens: DataFrame, *by: str) -> DataFrame:
    return tokens.groupBy(*by, "term").agg(F.count(F.lit(1)).alias("occurrences"))


def gram_frequency(df: DataFrame, by: dict[str, Column], words: Column, grams) -> DataFrame:
    """How often the grams of words occur, as :func:`term_frequency` over all of them gives it.

    Words are counted first, so that a word is cut once for all its occurrences.
    """
    counted = df.select(*[c.alias(n) for n, c in by.items()], F.explode(words).alias("word")).groupBy(
        *by, "word").agg(F.count(F.lit(1)).alias("n"))
    return counted.select(*by, "n", F.explode(grams(F.col("word"))).alias("term")).groupBy(
        *by, "term").agg(F.sum("n").alias("occurrences"))


def term_dictionary(terms: DataFrame) -> DataFrame:
    """(list, term, documents) for completion. A common term is merged per task before it moves."""
    return terms.select("doc_id", "list", "term").distinct().groupBy("list", "term").agg(
        F.count(F.lit(1)).alias("documents"))
