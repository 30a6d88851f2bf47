"""Concept lookups as equi-joins on the concept table.

The concept table has one row per concept: ``concept_id, type, label, legacy_ams_taxonomy_id`` and
optionally a nested ``parent``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from feedloom import settings
from feedloom.operators.joins import lookup_join

ENTRY_FIELDS = ["concept_id", "label", "legacy_ams_taxonomy_id"]


def concept_entry(concepts: DataFrame, parent: bool = False) -> Column:
    fields = ENTRY_FIELDS + (["parent"] if parent and "parent" in concepts.columns else [])
    return F.struct(*[concepts[f].alias(f) for f in fields])


def lookup_table(concepts: DataFrame) -> DataFrame:
    """(lookup_type, concept_id, entry), with one extra type per family of levels.

    An id known to several levels of a family gets the entry of the lowest level.
    """
    own = concepts.select(
        F.col("type").alias("lookup_type"), "concept_id", concept_entry(concepts).alias("entry"))
    family = F.lit(None).cast("string")
    for name, types in settings.TYPE_FAMILIES.items():
        family = F.when(F.col("type").isin(types), name).otherwise(family)
    families = (
        concepts.withColumn("lookup_type", family)
        .where("lookup_type is not null")
        .groupBy("lookup_type", "concept_id")
        .agg(F.min_by(concept_entry(concepts), F.col("type")).alias("entry")))
    return own.unionByName(families)


def _typed(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def _keyed(df: DataFrame, table: DataFrame, keys: dict[str, Column], into: str, how: str,
           limit: int | None) -> DataFrame:
    """Join ``table``, which holds the key columns and ``entry``, on expressions over ``df``."""
    names = {k: f"__{k}" for k in keys}
    left = df.withColumns({names[k]: c for k, c in keys.items()})
    right = table.select(*[F.col(k).alias(names[k]) for k in keys], F.col("entry").alias(into))
    return lookup_join(left, right, list(names.values()), how, limit).drop(*names.values())


def concept_lookup(df: DataFrame, concepts: DataFrame, type_, concept_id: Column,
                   into: str = "concept", how: str = "left", parent: bool = False,
                   limit: int | None = None) -> DataFrame:
    """(type, concept id) -> entry; a miss gives null (or drops the row with ``how="inner"``)."""
    table = concepts.select("type", "concept_id", concept_entry(concepts, parent).alias("entry"))
    return _keyed(df, table, {"type": _typed(type_), "concept_id": concept_id}, into, how, limit)


def legacy_lookup(df: DataFrame, concepts: DataFrame, type_, legacy_id: Column,
                  into: str = "concept", how: str = "left",
                  limit: int | None = None) -> DataFrame:
    """(type, legacy id) -> entry. Of several concepts with one legacy id the lowest id answers."""
    table = concepts.groupBy("type", "legacy_ams_taxonomy_id").agg(
        F.min_by(concept_entry(concepts), F.col("concept_id")).alias("entry"))
    return _keyed(df, table, {"type": _typed(type_), "legacy_ams_taxonomy_id": legacy_id},
                  into, how, limit)


def term_lookup(df: DataFrame, concepts: DataFrame, type_, legacy_id: Column,
                into: str = "term", limit: int | None = None) -> DataFrame:
    """Only the label of :func:`legacy_lookup`."""
    found = legacy_lookup(df, concepts, type_, legacy_id, "__entity", limit=limit)
    return found.withColumn(into, F.col("__entity.label")).drop("__entity")


def label_lookup(df: DataFrame, concepts: DataFrame, label: Column, type_=None,
                 into: str = "concept", limit: int | None = None) -> DataFrame:
    """Label in any case, optionally within one type; the lowest concept id answers."""
    keys = {"label": F.lower(label)}
    lowered = concepts.withColumn("__label", F.lower("label"))
    by = [F.col("__label").alias("label")]
    if type_ is not None:
        keys["type"] = _typed(type_)
        by.append(F.col("type"))
    table = lowered.groupBy(*by).agg(
        F.min_by(concept_entry(concepts), F.col("concept_id")).alias("entry"))
    return _keyed(df, table, keys, into, "left", limit)


def weighted_concepts(mentions: DataFrame, concepts: DataFrame, type_="skill",
                      concept_id: str = "concept_id", weight: str = "weight",
                      limit: int | None = None) -> DataFrame:
    """Resolve weighted mentions in long form. A miss stays, with null id and label."""
    found = concept_lookup(
        mentions.withColumnRenamed(concept_id, "__mention"), concepts, type_,
        F.col("__mention"), "__entry", limit=limit)
    return found.select(
        *[c for c in mentions.columns if c not in (concept_id, weight)],
        *[F.col("__entry")[f].alias(f) for f in ENTRY_FIELDS],
        F.col(weight).alias("weight"))


def coded_value(df: DataFrame, concepts: DataFrame, type_, concept_id: Column, into: str,
                limit: int | None = None) -> DataFrame:
    """A coded value as an entry, or null if it is empty or unknown."""
    return concept_lookup(df, concepts, type_, F.when(concept_id != "", concept_id), into,
                          limit=limit)


def known_concepts(mentions: DataFrame, concepts: DataFrame, type_="driving-licence",
                   concept_id: str = "concept_id", limit: int | None = None) -> DataFrame:
    """Resolve mentions in long form and drop those the taxonomy does not know."""
    return concept_lookup(
        mentions.withColumnRenamed(concept_id, "__mention"), concepts, type_,
        F.col("__mention"), "__entry", how="inner", limit=limit,
    ).select(*[c for c in mentions.columns if c != concept_id],
             *[F.col("__entry")[f].alias(f) for f in ENTRY_FIELDS])
