"""Enrichment candidates: which count, what keywords they give, and joining them to the ads.

A candidate table has ``doc_id, type, concept_label, term, term_misspelled, prediction,
sentence_index``. All steps work on rows; lists are formed only where an ad document needs them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from feedloom import settings
from feedloom.functions.text import null_safe
from feedloom.operators.joins import lookup_join, small_side


def _by_type(values: dict) -> Column:
    """Literal chosen by the candidate's type; four types need no join."""
    chosen = F.lit(None)
    for name, value in values.items():
        chosen = F.when(F.col("type") == name, F.lit(value)).otherwise(chosen)
    return chosen


def counting(thresholds: dict[str, float] | None = None) -> Column:
    """Whether a candidate counts: sure enough for its type, or in the headline where that does."""
    sure = F.col("prediction") >= _by_type(thresholds or settings.CANDIDATE_THRESHOLDS)
    headline = F.col("type").isin(settings.HEADLINE_TYPES) & (F.col("sentence_index") == 0)
    return null_safe(sure | headline, False)


def candidate_filter(candidates: DataFrame, thresholds: dict[str, float] | None = None) -> DataFrame:
    return candidates.where(counting(thresholds))


def _listed(candidates: DataFrame) -> DataFrame:
    return candidate_filter(candidates).withColumn("list", _by_type(settings.KEYWORD_LISTS))


def enriched_terms(candidates: DataFrame) -> DataFrame:
    """Distinct (doc_id, list, term) of lower-cased concept labels."""
    return _listed(candidates).select(
        "doc_id", "list", F.lower("concept_label").alias("term")).distinct()


def typeahead_terms(candidates: DataFrame) -> DataFrame:
    """As :func:`enriched_terms`, with every correctly spelt term too."""
    spelt = F.when(~F.col("term_misspelled"), F.lower("term"))
    return _listed(candidates).select(
        "doc_id", "list", F.explode(F.array(F.lower("concept_label"), spelt)).alias("term"),
    ).where("term is not null").distinct()


def compound_terms(terms: DataFrame) -> DataFrame:
    """Rows of the compound list. A term found in two lists is there twice, as ``list`` shows."""
    return terms.where(F.col("list").isin(settings.COMPOUND_LISTS))


def headline_input(ads: DataFrame) -> Column:
    """city | municipality | region | country | occupation labels | headline, nulls as empty."""
    place = [null_safe(F.col(f"workplace_address.{f}"), "")
             for f in ("city", "municipality", "region", "country")]
    labels = F.transform(F.col("occupation"), lambda o: null_safe(o["label"], ""))
    return F.concat_ws(" | ", *place, null_safe(F.array_join(labels, " "), ""),
                       null_safe(F.col("headline"), ""))


def enrichment_input(ads: DataFrame) -> DataFrame:
    """(doc_id, doc_headline, doc_text) for ads with a text. An ad without an id is an error."""
    doc_id = F.when(null_safe(F.col("id"), "") == "",
                    F.raise_error(F.lit("ad with a text but no id")).cast("string")
                    ).otherwise(F.col("id"))
    return ads.where(null_safe(F.col("description.text_formatted"), "") != "").select(
        doc_id.alias("doc_id"), headline_input(ads).alias("doc_headline"),
        F.col("description.text_formatted").alias("doc_text"))


def answered_lists(candidates: DataFrame, typeahead: bool = True) -> DataFrame:
    """One row per answered document with ``enriched`` and ``enriched_typeahead_terms``.

    The candidates are read once and shuffled once; sets are merged per task before that. A
    document none of whose candidates counts has empty lists.
    """
    spelt = F.when(~F.col("term_misspelled"), F.lower("term"))
    seen = F.when(counting(), F.struct(
        _by_type(settings.KEYWORD_LISTS).alias("list"), F.lower("concept_label").alias("label"),
        spelt.alias("spelt")))
    # One set of distinct entries per document; the lists are cut from it afterwards.
    found = candidates.groupBy("doc_id").agg(F.collect_set(seen).alias("seen"))

    def lists(fields: list[str]) -> str:
        """SQL of the struct of lists, each holding the named fields of its entries."""
        named = {}
        for name in settings.KEYWORD_LISTS.values():
            here = f"filter(seen, s -> s.list = '{name}')"
            values = ", ".join(f"transform({here}, s -> s.{f})" for f in fields)
            named[name] = f"array_sort(array_distinct(array_compact(concat({values}))))"
        return "named_struct({})".format(", ".join(f"'{n}', {sql}" for n, sql in named.items()))

    columns = {"enriched": ["label"]}
    if typeahead:
        columns["enriched_typeahead_terms"] = ["label", "spelt"]
    found = found.select("doc_id", *[F.expr(lists(f)).alias(c) for c, f in columns.items()])
    compound = lambda c: F.concat(*[F.col(f"{c}.{n}") for n in settings.COMPOUND_LISTS])
    return found.withColumns({c: F.col(c).withField("compound", compound(c)) for c in columns})


def enrichment_attach(ads: DataFrame, candidates: DataFrame, typeahead: bool = True) -> DataFrame:
    """Add ``keywords.enriched`` and ``keywords.enriched_typeahead_terms``.

    A document the enrichment answered gets lists, empty if nothing counted; any other ad passes
    unchanged, with nulls there.
    """
    asked = ads.select(F.col("id").alias("doc_id")).distinct()
    candidates = candidates.join(small_side(asked), "doc_id", "left_semi")
    lists = answered_lists(candidates, typeahead).withColumnRenamed("doc_id", "id")
    columns = [c for c in lists.columns if c != "id"]
    keywords = F.col("keywords")
    for c in columns:
        keywords = keywords.withField(c, F.col(c))
    return lookup_join(ads, lists, "id").withColumn("keywords", keywords).drop(*columns)
