"""Building the taxonomy from landed extracts and publishing versions of it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from feedloom.operators.snapshot import batch_dedup, max_version
from feedloom.operators.taxonomy import all_concepts, assign_extract_ids, build_categories
from feedloom.plans.snapshots import path_exists, point_view, view_paths
from feedloom.sources.landing import read_extracts, read_ids, write_lookup_dumps

CONCEPT_ORDER = ["ordinal", "pos"]


def build_concepts(extracts: dict[str, DataFrame], ids: DataFrame) -> DataFrame:
    return all_concepts(build_categories(assign_extract_ids(extracts, ids)))


def taxonomy_build(spark: SparkSession, landed: str, out: str,
                   names: list[str] | None = None) -> DataFrame:
    """Extracts and id list -> concept table and both lookup dumps under ``out``."""
    extracts = read_extracts(spark, landed, names)
    build_concepts(extracts, read_ids(spark, f"{landed}/ids")).write.mode("overwrite").parquet(
        f"{out}/concepts")
    concepts = spark.read.parquet(f"{out}/concepts")
    write_lookup_dumps(concepts, CONCEPT_ORDER, out)
    return concepts


def taxonomy_publish(spark: SparkSession, concepts: DataFrame, versions: DataFrame, root: str,
                     name: str = "taxonomy") -> tuple[str, bool]:
    """Load the highest version and move the name to it; a new one archives what was current.

    Documents are keyed by concept id, so the last row of a repeated id is kept. Every load has a
    folder of its own, so readers of the version before are not disturbed.
    """
    version = max_version(versions).first()[0]
    home = f"{root}/{name}-{version}"
    existed = path_exists(spark, home)
    path = f"{home}/{uuid.uuid4().hex}"
    batch_dedup(concepts, "concept_id", CONCEPT_ORDER).write.parquet(path)
    before = [p for p in view_paths(spark, name) if not p.startswith(f"{home}/")]
    select = lambda p: f"SELECT * FROM parquet.`{p}`"
    point_view(spark, name, [select(path)], [path])
    if before and not existed:
        archive = f"{name}_archive"
        paths = list(dict.fromkeys(view_paths(spark, archive) + before))
        point_view(spark, archive, [select(p) for p in paths], paths)
    return path, existed
