"""Keywords taken from the structured fields of a normalised ad."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from feedloom.functions.text import employer_names, labels_split, trim_location

# Where the keywords of each list come from.
KEYWORD_PATHS = {
    "occupation": ["occupation.label", "occupation_group.label", "occupation_field.label"],
    "skill": ["must_have.skills.label", "must_have.languages.label",
              "nice_to_have.skills.label", "nice_to_have.languages.label"],
    "location": ["workplace_address.city", "workplace_address.municipality",
                 "workplace_address.region", "workplace_address.country"],
    "employer": ["employer.name", "employer.workplace"],
}


def _strings(*items: Column) -> Column:
    return F.array(*items).cast("array<string>")


def _leaf(names: list[str]):
    def leaf(item):
        for name in names:
            item = item[name]
        return item.cast("string")

    return leaf


def nested_values(schema: T.StructType, path: str) -> Column:
    """Strings at a dotted path through structs and arrays of structs.

    The path is resolved against the schema once, so Spark reads only the named leaf. Missing
    leaves are left out, empty strings kept.
    """
    names = path.split(".")
    column, data_type = None, schema
    for depth, name in enumerate(names):
        if isinstance(data_type, T.ArrayType):
            return F.coalesce(F.array_compact(F.transform(column, _leaf(names[depth:]))), _strings())
        if not isinstance(data_type, T.StructType) or name not in data_type.fieldNames():
            return _strings()
        column = F.col(name) if column is None else column[name]
        data_type = data_type[name].dataType
    if isinstance(data_type, T.ArrayType):
        return F.coalesce(F.array_compact(column.cast("array<string>")), _strings())
    return F.array_compact(_strings(column))


def as_set(values: Column) -> Column:
    """Distinct values, sorted so that results can be compared."""
    return F.array_sort(F.array_distinct(values))


def extracted_keywords(schema: T.StructType) -> Column:
    """Struct of the four keyword sets of an ad with this schema."""
    values = {name: F.concat(*[nested_values(schema, p) for p in paths])
              for name, paths in KEYWORD_PATHS.items()}
    places = F.filter(F.transform(values["location"], trim_location), lambda p: p != "")
    return F.struct(
        as_set(labels_split(values["occupation"])).alias("occupation"),
        as_set(labels_split(values["skill"])).alias("skill"),
        as_set(places).alias("location"),
        as_set(employer_names(values["employer"])).alias("employer"))


def with_keywords(ads: DataFrame) -> DataFrame:
    return ads.withColumn("keywords", F.struct(extracted_keywords(ads.schema).alias("extracted")))


def keyword_rows(ads: DataFrame, key: str = "id") -> DataFrame:
    """(key, list, keyword) rows of ``keywords.extracted``."""
    lists = F.explode(F.array(*[
        F.struct(F.lit(name).alias("list"), F.col(f"keywords.extracted.{name}").alias("keywords"))
        for name in KEYWORD_PATHS])).alias("l")
    return ads.select(key, lists).select(
        key, "l.list", F.explode("l.keywords").alias("keyword"))
