"""Landed files: taxonomy extracts, the replaced-by list, lookup dumps and saved ads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feedloom.operators.replacements import first_successors
from feedloom.operators.snapshot import upsert
from feedloom.operators.taxonomy import (
    CATEGORIES, BY_NAME, concept_to_legacy, legacy_to_concept)

REPLACED_BY_SCHEMA = ("list_pos int, concept_id string, preferred_label string, "
                      "replaced_by array<struct<concept_id:string,preferred_label:string>>")
IDS_SCHEMA = "line_no bigint, id string"


def land_json(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").json(path)
    return path


def read_extract(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One category extract. The schema is the category's own, never inferred."""
    return spark.read.schema(BY_NAME[name].ddl()).json(f"{root}/{name}")


def read_extracts(spark: SparkSession, root: str, names: list[str] | None = None
                  ) -> dict[str, DataFrame]:
    return {n: read_extract(spark, root, n) for n in (names or [c.name for c in CATEGORIES])}


def read_replacements(spark: SparkSession, path: str) -> DataFrame:
    return first_successors(spark.read.schema(REPLACED_BY_SCHEMA).json(path))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(IDS_SCHEMA).json(path)


def write_lookup_dumps(concepts: DataFrame, order: list[str], root: str) -> tuple[str, str]:
    """Both lookups as JSON; the one by type has a folder per type."""
    there, back = f"{root}/concept_to_taxonomy", f"{root}/taxonomy_to_concept"
    land_json(concept_to_legacy(concepts, order), there)
    legacy_to_concept(concepts, order).write.mode("overwrite").partitionBy("type").json(back)
    return there, back


def read_lookup_dumps(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    there = spark.read.schema(
        "concept_id string, legacyAmsTaxonomyId string, type string, label string"
    ).json(f"{root}/concept_to_taxonomy")
    back = spark.read.schema(
        "legacyAmsTaxonomyId string, conceptId string, preferredTerm string, type string"
    ).json(f"{root}/taxonomy_to_concept")
    return there, back


def taxonomy_values(spark: SparkSession, path: str) -> DataFrame:
    """The prebuilt concept list."""
    return spark.read.parquet(path)


def save_enriched(ads: DataFrame, path: str) -> str:
    ads.write.mode("errorifexists").parquet(path)
    return path


def load_enriched(spark: SparkSession, path: str, current: DataFrame | None = None,
                  key: str = "id") -> DataFrame:
    """Saved ads as a snapshot, over ``current`` if given. Nothing is converted again."""
    saved = spark.read.parquet(path)
    return saved if current is None else upsert(current, saved, key)
