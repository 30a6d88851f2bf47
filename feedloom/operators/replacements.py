"""Replaced-by expansion: a concept stands for its successor and for its predecessors too.

A pair table has one row per list entry: ``list_pos, concept_id, preferred_label,
successor_id, successor_label``. One hop is followed, and results keep the list order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from feedloom.operators.joins import lookup_join, small_side
from feedloom.session import materialise


def first_successors(listed: DataFrame) -> DataFrame:
    """Pair table of a landed list whose ``replaced_by`` is an array; only its first entry counts."""
    first = F.get("replaced_by", F.lit(0))
    return listed.select(
        "list_pos", "concept_id", "preferred_label",
        first["concept_id"].alias("successor_id"),
        first["preferred_label"].alias("successor_label"))


def equivalents(pairs: DataFrame) -> DataFrame:
    """(for_id, list_pos, concept_id, label, new_version): both directions of every pair."""
    forward = pairs.select(
        F.col("concept_id").alias("for_id"), "list_pos",
        F.col("successor_id").alias("concept_id"),
        F.col("successor_label").alias("label"), F.lit(True).alias("new_version"))
    # A concept replaced by itself is answered by the forward row alone.
    backward = pairs.where(~F.col("successor_id").eqNullSafe(F.col("concept_id"))).select(
        F.col("successor_id").alias("for_id"), "list_pos", "concept_id",
        F.col("preferred_label").alias("label"), F.lit(False).alias("new_version"))
    return forward.unionByName(backward).where("for_id is not null")


def replaced_by_expand(mentions: DataFrame, pairs: DataFrame, concept_id: str = "concept_id",
                       limit: int | None = None) -> DataFrame:
    """The added rows only: one per mention and equivalent concept, in long form."""
    found = equivalents(pairs).select(
        F.col("for_id").alias(concept_id), "list_pos",
        F.col("concept_id").alias("added_id"), F.col("label").alias("added_label"), "new_version")
    return lookup_join(mentions, found, concept_id, "inner", limit, unique=False)


def occupation_rows(concepts: DataFrame, pairs: DataFrame,
                    type_: str = "occupation-name") -> DataFrame:
    """What an ad with a given occupation shows, as rows per occupation concept.

    (for_id, kind, pos, concept_id, label, legacy_ams_taxonomy_id) with kind ``occupation``,
    ``occupation_group`` or ``occupation_field``. Position 0 is the occupation itself, the
    replacements follow by list position. Group and field are those of the last newer version
    that has parents, else the occupation's own. All of this happens at the size of the taxonomy,
    so an ad needs one join and no regrouping.
    """
    names = concepts.where((F.col("type") == type_) & F.col("parent").isNotNull()).select(
        "concept_id", "label", "legacy_ams_taxonomy_id", F.col("parent").alias("grp"))
    added = equivalents(pairs).join(
        small_side(names.select(F.col("concept_id").alias("for_id"))), "for_id", "left_semi")
    newer = lookup_join(
        added.where("new_version"), names.select("concept_id", F.col("grp").alias("new_grp")),
        "concept_id", "inner", unique=False,
    ).groupBy("for_id").agg(F.max_by("new_grp", "list_pos").alias("new_grp"))
    cards = lookup_join(names.withColumnRenamed("concept_id", "for_id"), newer, "for_id")
    cards = cards.withColumn("grp", F.coalesce("new_grp", "grp"))

    def level(kind, entry, pos=0):
        return F.struct(
            F.lit(kind).alias("kind"), F.lit(pos).alias("pos"),
            entry["concept_id"].alias("concept_id"), entry["label"].alias("label"),
            entry["legacy_ams_taxonomy_id"].alias("legacy_ams_taxonomy_id"))

    own = F.struct(F.col("for_id").alias("concept_id"), "label", "legacy_ams_taxonomy_id")
    fixed = cards.select("for_id", F.inline(F.array(
        level("occupation", own),
        level("occupation_group", F.col("grp")),
        level("occupation_field", F.col("grp.parent")))))
    replaced = added.select(
        "for_id", F.lit("occupation").alias("kind"),
        (F.col("list_pos") + 1).cast("int").alias("pos"), "concept_id", "label",
        F.lit(None).cast("string").alias("legacy_ams_taxonomy_id"))
    return fixed.unionByName(replaced)


def occupation_hierarchy(ads: DataFrame, concepts: DataFrame, pairs: DataFrame,
                         concept_id: str = "concept_id", limit: int | None = None) -> DataFrame:
    """Occupation, group and field rows per ad, in long form. Unknown occupations give none."""
    # Written first, so that the size of the file and not a guess decides how it is joined.
    rows = materialise(occupation_rows(concepts, pairs), "occupation-rows")
    keyed = ads.withColumnRenamed(concept_id, "for_id")
    return lookup_join(keyed, rows, "for_id", "inner", limit, unique=False).drop("for_id")


def occupation_cards(concepts: DataFrame, pairs: DataFrame,
                     type_: str = "occupation-name") -> DataFrame:
    """:func:`occupation_rows` folded to one row per occupation concept."""
    rows = occupation_rows(concepts, pairs, type_)
    entry = F.struct("pos", F.struct("concept_id", "label", "legacy_ams_taxonomy_id").alias("e"))
    kinds = ["occupation", "occupation_group", "occupation_field"]
    return rows.groupBy("for_id").agg(*[
        F.transform(F.array_sort(F.collect_list(F.when(F.col("kind") == k, entry))),
                    lambda x: x["e"]).alias(k)
        for k in kinds])
