"""Building the concept table from category extracts.

Each category is a projection over one landed extract, described by a :class:`Category`. Extracts
carry ``pos``, the place of a row in its source.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from feedloom.functions.text import slugify
from feedloom.operators.joins import lookup_join
from feedloom.operators.snapshot import batch_dedup
from feedloom.session import materialise


@dataclass(frozen=True)
class Category:
    """How the rows of one extract become concepts."""

    name: str
    type: str
    key: str  # natural key: the last row per value wins
    legacy: str | None = None  # column of the legacy id, if not the key
    label: str = "Term"
    number: str | None = None  # column of the numeric legacy id
    description: str | None = None
    extra: tuple[str, ...] = ()
    parent: str | None = None  # name of the parent category
    parent_key: str | None = None  # column holding the parent's natural key

    @property
    def legacy_column(self) -> str:
        return self.legacy or self.key

    def columns(self) -> list[str]:
        named = [self.key, self.legacy, self.label, self.number, self.description,
                 self.parent_key, *self.extra]
        return list(dict.fromkeys(c for c in named if c))

    def ddl(self) -> str:
        return ", ".join(["pos bigint", *[f"{c} string" for c in self.columns()]])


def _numbered(name, type_, key, **more) -> Category:
    return Category(name, type_, key, number=more.pop("number", key), **more)


def _education(kind: str, title: str) -> list[Category]:
    """Three levels, keyed by ID while the legacy id is the code."""
    out = []
    for level in (1, 2, 3):
        id_, code = f"SUN{title}{level}ID", f"SUN{title}{level}Code"
        above = f"SUN{title}{level - 1}ID" if level > 1 else None
        # Level 3 of the fields takes its number from the ID; its code holds letters.
        number = id_ if (kind, level) == ("field", 3) else code
        out.append(Category(
            f"education_{kind}_{level}", f"sun-education-{kind}-{level}", id_, legacy=code,
            number=number, parent=f"education_{kind}_{level - 1}" if above else None,
            parent_key=above))
    return out


# The categories in the order of the finished list.
CATEGORIES: list[Category] = [
    _numbered("job_terms", "occupation-name", "OccupationNameID",
              parent="job_groups", parent_key="LocaleCode"),
    _numbered("job_groups", "occupation-group", "LocaleCode", description="Description",
              parent="job_fields", parent_key="LocaleFieldID"),
    _numbered("job_fields", "occupation-field", "LocaleFieldID", description="Description"),
    Category("places", "place", "kommunkod", label="label",
             extra=("type", "legacy_ams_taxonomy_id", "concept_id"),
             parent="municipalities", parent_key="kommunkod"),
    _numbered("municipalities", "municipality", "NationalNUTSLAU2Code",
              parent="regions", parent_key="NationalNUTSLevel3Code"),
    _numbered("regions", "region", "NationalNUTSLevel3Code"),
    _numbered("countries", "country", "CountryID", extra=("CountryCode",)),
    _numbered("languages", "language", "LanguageID"),
    Category("work_time_extent", "worktime-extent", "WorkTimeExtentID"),
    Category("skills", "skill", "SkillID", description="Term"),
    _numbered("employment_types", "employment-type", "EmploymentTypeID"),
    _numbered("driving_licences", "driving-licence", "DrivingLicenceID",
              description="Description"),
    _numbered("wage_types", "wage-type", "WageTypeID"),
    _numbered("old_education_levels", "deprecated-education-level", "EducationLevelID"),
    _numbered("old_education_fields", "deprecated-education-field", "EducationFieldID",
              description="Description"),
    *_education("field", "Field"),
    *_education("level", "Level"),
    _numbered("durations", "employment-duration", "EmploymentDurationID", extra=("EURESCode",)),
    _numbered("experience_years", "occupation-experience-year", "OccupationExperienceYearID",
              label="ExperienceYearCandidate"),
]
# The order in which ids are handed out.
ID_ORDER = [
    "job_fields", "job_groups", "job_terms", "countries", "regions", "municipalities",
    "languages", "work_time_extent", "skills", "employment_types", "driving_licences",
    "wage_types", "old_education_levels", "old_education_fields",
    "education_field_1", "education_field_2", "education_field_3",
    "education_level_1", "education_level_2", "education_level_3",
    "durations", "experience_years", "places",
]
BY_NAME = {c.name: c for c in CATEGORIES}

ENTRY = "struct<legacy_ams_taxonomy_id:string,type:string,label:string,concept_id:string"
NO_PARENT = f"{ENTRY},parent:{ENTRY}>>"


def last_per_key(df: DataFrame, key: list[str] | str, pos: str = "pos") -> DataFrame:
    """The last row per natural key."""
    return batch_dedup(df, key, [pos])


def global_positions(df: DataFrame, ordinal: str, pos: str, into: str = "n") -> DataFrame:
    """Number rows 0, 1, 2, ... by (ordinal, pos) without sorting them in one task.

    Rows are dealt by ranges and written in order, each with its place in its partition; a running
    total over the partitions, one short row each, says where each of them starts.
    """
    placed = materialise(
        df.repartitionByRange(ordinal, pos).sortWithinPartitions(ordinal, pos)
        .withColumn("__at", F.monotonically_increasing_id()), "positions")
    part = F.shiftright("__at", 33).alias("__part")
    sizes = placed.groupBy(part).agg(F.count(F.lit(1)).alias("__rows"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__part", F.coalesce(F.sum("__rows").over(before), F.lit(0))
                          .alias("__start"))
    at = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    return (lookup_join(placed.withColumn("__part", part), starts, "__part", "inner")
            .withColumn(into, F.col("__start") + at).drop("__part", "__start", "__at"))


def concept_id_assign(rows: DataFrame, ids: DataFrame, ordinal: str = "ordinal",
                      pos: str = "pos") -> DataFrame:
    """Pair the n-th row, over all categories, with line n of the id list (``line_no, id``)."""
    return lookup_join(
        global_positions(rows, ordinal, pos, "line_no"),
        ids.select("line_no", F.col("id").alias("uuid_id")), "line_no", "left")


def assign_extract_ids(extracts: dict[str, DataFrame], ids: DataFrame) -> dict[str, DataFrame]:
    """The extracts with ``uuid_id``, handed out in :data:`ID_ORDER`."""
    order = [n for n in ID_ORDER if n in extracts]
    places = reduce(DataFrame.unionByName, [
        extracts[n].select(F.lit(i).alias("ordinal"), "pos") for i, n in enumerate(order)])
    # Read once per category below, so it is worked out once and written.
    given = materialise(
        concept_id_assign(places, ids).select("ordinal", "pos", "uuid_id"), "concept-ids")
    return {
        n: lookup_join(extracts[n], given.where(F.col("ordinal") == i).drop("ordinal"), "pos")
        for i, n in enumerate(order)}


def place_legacy_id(municipality_code: Column, label: Column) -> Column:
    return F.concat(municipality_code, F.lit("-"), F.coalesce(slugify(label), F.lit("None")))


def attach_parent(rows: DataFrame, parents: DataFrame, parent_key: str,
                  orphan_label: str = "concept", limit: int | None = None) -> DataFrame:
    """Add ``parent`` from ``parents`` (``key, parent``). A missing parent fails the job."""
    found = lookup_join(
        rows.withColumn("__parent_key", F.col(parent_key)),
        parents.select(F.col("key").alias("__parent_key"), F.col("parent").alias("__parent")),
        "__parent_key", "left", limit)
    message = F.concat(F.lit(f"{orphan_label} without a parent: "),
                       F.coalesce(F.col("__parent_key").cast("string"), F.lit("null")))
    parent_type = parents.schema["parent"].dataType
    checked = F.when(F.col("__parent").isNull(), F.raise_error(message).cast(parent_type)
                     ).otherwise(F.col("__parent"))
    return found.withColumn("parent", checked).drop("__parent", "__parent_key")


def build_category(extract: DataFrame, spec: Category,
                   parents: DataFrame | None = None) -> DataFrame:
    """Concept rows of one category, plus ``key`` and ``pos`` for what follows."""
    text = lambda c: F.col(c).cast("string")
    if spec.name == "places":
        key = place_legacy_id(text("kommunkod"), F.col("label"))
    else:
        key = text(spec.key)
    rows = last_per_key(extract.withColumn("key", key), "key")
    if parents is not None:
        rows = attach_parent(rows, parents, spec.parent_key, spec.name)
    else:
        rows = rows.withColumn("parent", F.lit(None).cast(NO_PARENT))
    columns = {
        "legacy_ams_taxonomy_id": text(spec.legacy_column),
        "type": F.lit(spec.type),
        "label": F.col(spec.label),
        "concept_id": text("uuid_id"),
        "description": F.col(spec.description) if spec.description else F.lit(None).cast("string"),
        "legacy_ams_taxonomy_num_id":
            (F.col(spec.number) if spec.number else F.lit(None)).cast("int"),
        "country_code": F.col("CountryCode") if "CountryCode" in spec.extra
            else F.lit(None).cast("string"),
        "EURESCode": F.col("EURESCode") if "EURESCode" in spec.extra
            else F.lit(None).cast("string"),
    }
    if spec.name == "places":
        # What the places file says itself goes before what is computed.
        columns["legacy_ams_taxonomy_id"] = F.coalesce(text("legacy_ams_taxonomy_id"), F.col("key"))
        columns["concept_id"] = F.coalesce(text("concept_id"), text("uuid_id"))
        columns["type"] = F.coalesce(F.col("type"), F.lit(spec.type))
    return rows.select(
        "key", "pos", *[c.alias(n) for n, c in columns.items()],
        F.col("parent").cast(NO_PARENT).alias("parent"))


def parent_entries(concepts: DataFrame) -> DataFrame:
    """(key, parent) of built concepts, to hang the next level on. One grandparent is kept."""
    fields = ["legacy_ams_taxonomy_id", "type", "label", "concept_id"]
    above = F.when(F.col("parent").isNotNull(),
                   F.struct(*[F.col("parent")[f].alias(f) for f in fields]))
    return concepts.select("key", F.struct(*fields, above.alias("parent")).cast(NO_PARENT).alias("parent"))


def build_categories(extracts: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Concepts of every given category; parents are built before their children.

    A category others hang on is written when it is built: it is read again by each of them, and
    its size on disk decides how it is joined.
    """
    built: dict[str, DataFrame] = {}
    shared = {BY_NAME[n].parent for n in extracts}

    def build(name: str) -> DataFrame:
        if name not in built:
            spec = BY_NAME[name]
            parents = parent_entries(build(spec.parent)) if spec.parent else None
            rows = build_category(extracts[name], spec, parents)
            built[name] = materialise(rows, name) if name in shared else rows
        return built[name]

    for spec in CATEGORIES:
        if spec.name in extracts:
            build(spec.name)
    return built


def all_concepts(built: dict[str, DataFrame]) -> DataFrame:
    """One list of all categories; ``(ordinal, pos)`` is its order."""
    return reduce(DataFrame.unionByName, [
        built[spec.name].withColumn("ordinal", F.lit(i))
        for i, spec in enumerate(CATEGORIES) if spec.name in built]).drop("key").withColumn(
            "parent_concept_id", F.col("parent.concept_id"))


def concept_to_legacy(concepts: DataFrame, order: list[str]) -> DataFrame:
    """concept id -> (legacy id, type, label); the last row of a repeated id counts."""
    return concepts.groupBy("concept_id").agg(F.max_by(
        F.struct(F.col("legacy_ams_taxonomy_id").alias("legacyAmsTaxonomyId"), "type", "label"),
        F.struct(*order)).alias("e")).select("concept_id", "e.*")


def legacy_to_concept(concepts: DataFrame, order: list[str]) -> DataFrame:
    """(type, legacy id) -> (concept id, label); the last row of a repeated pair counts."""
    return concepts.groupBy("type", F.col("legacy_ams_taxonomy_id").alias("legacyAmsTaxonomyId")).agg(
        F.max_by(F.struct(F.col("concept_id").alias("conceptId"),
                          F.col("label").alias("preferredTerm")), F.struct(*order)).alias("e")
    ).select("type", "legacyAmsTaxonomyId", "e.*")
