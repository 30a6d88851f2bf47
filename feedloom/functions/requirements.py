"""Expressions over the structured part of a raw ad."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from feedloom import settings
from feedloom.functions.text import null_if_empty, null_safe, strip


def is_must(weight: Column) -> Column:
    """Must-have from the limit on. A missing weight is always nice-to-have."""
    return null_safe(weight, 0) >= settings.MUST_HAVE_WEIGHT


def weight_split(mentions: Column) -> tuple[Column, Column]:
    """An array of weighted mentions as (must, nice): disjoint, and nothing is lost."""
    items = F.coalesce(mentions, F.filter(mentions, lambda m: F.lit(False)))
    return (F.filter(items, lambda m: is_must(m["vikt"])),
            F.filter(items, lambda m: ~is_must(m["vikt"])))


def scope_default(working_hours: Column) -> tuple[Column, Column]:
    """Least and most scope of work implied by a working-hours concept."""
    full = working_hours.isin(settings.FULL_TIME_CONCEPTS)
    part = working_hours.isin(settings.PART_TIME_CONCEPTS)
    least = F.when(full, 100.0).when(part, 0.0)
    most = F.when(full | part, 100.0)
    return least, most


def experience_required(no_experience_needed: Column) -> Column:
    return ~null_safe(no_experience_needed, False)


def own_car(given: Column, access: Column) -> Column:
    """Access to a car of one's own: no if the key is missing, unknown if it is null."""
    return F.when(given, access).otherwise(False)


def licence_required(licences: Column) -> Column:
    return null_safe(F.size(licences) > 0, False)


def contact(person: Column) -> Column:
    name = F.concat(null_safe(person["fornamn"], ""), F.lit(" "),
                    null_safe(person["efternamn"], ""))
    phones = F.concat(null_safe(person["telefonnummer"], ""), F.lit(", "),
                      null_safe(person["mobilnummer"], ""))
    return F.struct(
        null_if_empty(strip(name)).alias("name"),
        person["beskrivning"].alias("description"),
        person["epost"].alias("email"),
        null_if_empty(F.btrim(phones, F.lit(", "))).alias("telephone"),
        F.when(null_safe(person["fackligRepresentant"], False), settings.UNION_CONTACT_TYPE)
        .otherwise(person["befattning"]).alias("contactType"),
    )


def contacts(people: Column) -> Column:
    return F.transform(people, contact)


def coordinate(c: Column) -> Column:
    return F.when(c != "", c.try_cast("double"))
