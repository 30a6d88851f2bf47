"""From raw ads to normalised ads.

All coded values of all slots of an ad are one array of mentions. It is resolved where it stands
against a table of codes whose size is checked, or beyond that bound with one join of a row per
mention, folded back per ad. An ad is one document, so what is folded is bounded by the document.
``id`` must be unique (``batch_dedup`` before).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from feedloom import settings
from feedloom.functions.dates import lenient_timestamp
from feedloom.functions.html import clean_html
from feedloom.functions.requirements import (
    contacts, coordinate, experience_required, licence_required, own_car, scope_default)
from feedloom.functions.text import null_safe, remote_work
from feedloom.operators.joins import fits_broadcast, lookup_join
from feedloom.operators.keywords import with_keywords
from feedloom.operators.lookup import lookup_table
from feedloom.operators.replacements import equivalents, occupation_cards
from feedloom.operators.snapshot import FILTER_TYPE
from feedloom.session import materialise
from feedloom.sources.feed import PERSON

CONCEPT = "struct<concept_id:string,label:string,legacy_ams_taxonomy_id:string>"
WEIGHTED = "struct<concept_id:string,label:string,weight:int,legacy_ams_taxonomy_id:string>"
MENTION = "struct<slot:string,lookup_type:string,pos:int,concept_id:string,weight:int>"

# Single coded values: output field -> (raw field, slot type).
CODED = {
    "employment_type": ("anstallningTyp", "anstallningstyp"),
    "salary_type": ("lonTyp", "lonetyp"),
    "duration": ("varaktighetTyp", "varaktighet"),
    "working_hours_type": ("arbetstidTyp", "arbetstidstyp"),
}
PLACES = {"municipality": "kommun", "region": "lan", "country": "land"}
# Weighted lists: output field -> (raw field, slot type).
WEIGHTED_LISTS = {
    "skills": ("kompetenser", "kompetens"),
    "languages": ("sprak", "sprak"),
    "work_experiences": ("yrkeserfarenheter", "yrkesroll"),
}
SIDES = ("must_have", "nice_to_have")
# Codes that are compared one by one once the hash has led to them, about.
CODES_PER_BUCKET = 4


def _empty(element: str) -> str:
    return f"CAST(array() AS array<{element}>)"


def _mention(slot: str, type_: str, pos: str, value: str, weight: str = "NULL") -> str:
    return (f"named_struct('slot', {slot}, 'lookup_type', '{settings.SLOT_TYPES[type_]}', "
            f"'pos', {pos}, 'concept_id', {value}, 'weight', CAST({weight} AS INT))")


def mentions_sql() -> str:
    """All coded values of ``ad`` as one array. Its rows name the slot they belong to."""
    single = [_mention(f"'{out}'", type_, "0", f"ad.{raw}.varde")
              for out, (raw, type_) in CODED.items()]
    single += [_mention(f"'{out}'", raw, "0", f"ad.arbetsplatsadress.{raw}.varde")
               for out, raw in PLACES.items()]
    licence = _mention("'driving_license'", "korkort", "i", "v.varde")
    parts = [f"transform(ad.korkort, (v, i) -> {licence})"]
    must = f"coalesce(m.vikt, 0) >= {settings.MUST_HAVE_WEIGHT}"
    for out, (raw, type_) in WEIGHTED_LISTS.items():
        for side, test in zip(SIDES, (must, f"NOT ({must})")):
            item = _mention(f"'{side}.{out}'", type_, "i", "v.varde", "v.vikt")
            parts.append(f"transform(filter(ad.{raw}, m -> {test}), (v, i) -> {item})")
    # The weight of the education field decides where field and level go.
    field = "ad.utbildningsinriktning"
    side = (f"if(coalesce({field}.vikt, 0) >= {settings.MUST_HAVE_WEIGHT}, "
            f"'{SIDES[0]}', '{SIDES[1]}')")
    education = ", ".join(
        _mention(f"{side} || '.{out}'", raw, "0", f"ad.{raw}.varde", f"ad.{raw}.vikt")
        for out, raw in (("education", "utbildningsinriktning"),
                         ("education_level", "utbildningsniva")))
    given = f"coalesce({field}.varde, {field}.namn, CAST({field}.vikt AS STRING)) IS NOT NULL"
    parts.append(f"if({given}, array({education}), NULL)")
    optional = ", ".join(f"coalesce({p}, {_empty(MENTION)})" for p in parts)
    return f"concat(array({', '.join(single)}), {optional})"


def mention_table(concepts: DataFrame, pairs: DataFrame) -> DataFrame:
    """(lookup_type, concept_id, entry, equivalents): all a mention needs to know.

    Made at the size of the taxonomy and written: its size on disk then decides the join, and the
    ads are not read to find that out.
    """
    swaps = equivalents(pairs).groupBy("for_id").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("list_pos", "new_version", F.struct(
            "concept_id", "label", F.lit(None).cast("int").alias("weight"),
            F.lit(None).cast("string").alias("legacy_ams_taxonomy_id")).alias("e")))),
        lambda x: x["e"]).alias("equivalents")).withColumn("lookup_type", F.lit("skill"))
    table = lookup_join(lookup_table(concepts), swaps.withColumnRenamed("for_id", "concept_id"),
                        ["lookup_type", "concept_id"])
    return materialise(table.select(
        "lookup_type", "concept_id", F.col("entry").cast(CONCEPT).alias("entry"),
        F.coalesce("equivalents", F.expr(_empty(WEIGHTED))).alias("equivalents")), "mention-table")


def _bucket(type_: str, value: str, buckets: int) -> str:
    return f"int(pmod(xxhash64({type_}, {value}), {buckets}))"


def code_table(table: DataFrame, limit: int | None = None) -> CodeTable | None:
    """The mention table as one value: an array of small maps, in which a code is found by its hash.

    None if the written table is larger than ``limit`` in memory; mentions are joined then.
    """
    if not fits_broadcast(table, settings.IN_PLACE_BYTES if limit is None else limit):
        return None
    buckets = max(1, table.count() // CODES_PER_BUCKET)
    spark = table.sparkSession
    filled = table.where("lookup_type IS NOT NULL AND concept_id IS NOT NULL").groupBy(
        F.expr(_bucket("lookup_type", "concept_id", buckets)).alias("bucket")).agg(
        F.map_from_entries(F.collect_list(F.struct(
            F.struct("lookup_type", "concept_id").alias("key"),
            F.struct("entry", "equivalents").alias("value")))).alias("codes"))
    every = spark.range(buckets).select(F.col("id").cast("int").alias("bucket")).join(
        filled, "bucket", "left")
    # One row, of a size that was checked above. Maps have no order: sort by the number alone.
    whole = every.agg(F.transform(F.array_sort(
        F.collect_list(F.struct("bucket", "codes")),
        lambda x, y: x["bucket"] - y["bucket"]), lambda x: x["codes"]).alias("codes"))
    return CodeTable(materialise(whole, "code-table"), buckets)


@dataclass
class CodeTable:
    codes: DataFrame
    buckets: int


@dataclass
class Taxonomy:
    """What ads are joined with, written once per run however many batches it has."""

    cards: DataFrame
    mentions: DataFrame
    in_place: CodeTable | None = None


def prepare_taxonomy(concepts: DataFrame, pairs: DataFrame, limit: int | None = None) -> Taxonomy:
    cards = occupation_cards(concepts, pairs, settings.SLOT_TYPES["yrkesroll"])
    mentions = mention_table(concepts, pairs)
    return Taxonomy(materialise(cards, "occupation-cards"), mentions, code_table(mentions, limit))


# Slots with one value, in the order in which they start the mentions, and those with several.
SINGLE = [*CODED, *PLACES]
LISTED = ["driving_license", *[f"{side}.{field}" for side in SIDES
                               for field in (*WEIGHTED_LISTS, "education", "education_level")]]


def _found(slot: str) -> str:
    return "found_" + slot.replace(".", "_")


def _looked_up(ads: DataFrame, table: CodeTable) -> DataFrame:
    """``ads`` with the array ``mentions``, resolved where it stands: nothing is moved."""
    where = _bucket("m.lookup_type", "m.concept_id", table.buckets)
    known = (f"element_at(get(codes, {where}), named_struct('lookup_type', m.lookup_type, "
             "'concept_id', m.concept_id))")
    answered = (f"transform(transform({mentions_sql()}, m -> struct(m, {known} AS k)), x -> "
                "named_struct('slot', x.m.slot, 'weight', x.m.weight, 'entry', x.k.entry, "
                f"'equivalents', coalesce(x.k.equivalents, {_empty(WEIGHTED)})))")
    return ads.withColumn("codes", table.codes.scalar()).withColumn(
        "mentions", F.expr(answered)).drop("codes")


def _joined(ads: DataFrame, table: DataFrame, limit: int | None) -> DataFrame:
    """The same by a join: a row per mention, one join, and one list per ad."""
    rows = ads.select("id", F.posexplode(F.expr(mentions_sql())).alias("nth", "m")).select(
        "id", "nth", "m.slot", "m.weight", "m.lookup_type", "m.concept_id").where(
        "concept_id IS NOT NULL OR slot LIKE '%.%'")
    found = lookup_join(rows, table, ["lookup_type", "concept_id"], "left", limit)
    mention = F.struct("nth", "slot", "weight", "entry", F.coalesce(
        "equivalents", F.expr(_empty(WEIGHTED))).alias("equivalents"))
    listed = found.groupBy("id").agg(F.array_sort(F.collect_list(mention)).alias("mentions"))
    return ads.join(listed, "id", "left")


def resolve_mentions(ads: DataFrame, taxonomy: Taxonomy, limit: int | None = None) -> DataFrame:
    """``ads`` with a column per slot: the entry of a single value, else the resolved mentions in
    order of position. A slot nobody asks for is never cut out.

    Equivalents of skills come along with the skill they belong to.
    """
    here = lambda slot: f"filter(mentions, m -> m.slot = '{slot}')"
    if taxonomy.in_place is None:
        known = _joined(ads, taxonomy.mentions, limit)
        one = {slot: f"get({here(slot)}, 0).entry" for slot in SINGLE}
    else:
        known = _looked_up(ads, taxonomy.in_place)
        one = {slot: f"mentions[{place}].entry" for place, slot in enumerate(SINGLE)}
    return known.withColumns({
        **{_found(slot): F.expr(sql) for slot, sql in one.items()},
        **{_found(slot): F.expr(here(slot)) for slot in LISTED}}).drop("mentions")


def _weighted(slot: str) -> str:
    """Resolved list of a slot. Unknown values stay, with null id and label."""
    items = _found(slot)
    listed = (f"transform({items}, m -> CAST(named_struct('concept_id', m.entry.concept_id, "
              f"'label', m.entry.label, 'weight', m.weight, 'legacy_ams_taxonomy_id', "
              f"m.entry.legacy_ams_taxonomy_id) AS {WEIGHTED}))")
    if slot.endswith(".skills"):
        listed = f"concat({listed}, flatten(transform({items}, m -> m.equivalents)))"
    return f"coalesce({listed}, {_empty(WEIGHTED)})"


def _requirements(side: str) -> Column:
    fields = [*WEIGHTED_LISTS, "education", "education_level"]
    return F.expr("named_struct({})".format(", ".join(
        f"'{f}', {_weighted(f'{side}.{f}')}" for f in fields))).alias(side)


def _coded(slot: str) -> str:
    return _found(slot)


def _or_default(value: str, default: str) -> str:
    return f"coalesce(nullif({value}, ''), '{default}')"


def workplace_address() -> Column:
    """Ids and names come from the ad, codes from the taxonomy; Sweden is the default country."""
    address = "ad.arbetsplatsadress"
    fields = {}
    for out, raw in PLACES.items():
        fields[f"{out}_code"] = f"{_coded(out)}.legacy_ams_taxonomy_id"
        fields[f"{out}_concept_id"] = f"{address}.{raw}.varde"
        fields[out] = f"{address}.{raw}.namn"
    for name, default in (("country_code", settings.DEFAULT_COUNTRY_CODE),
                          ("country_concept_id", settings.DEFAULT_COUNTRY_CONCEPT),
                          ("country", settings.DEFAULT_COUNTRY_NAME)):
        fields[name] = _or_default(fields[name], default)
    fields["street_address"] = f"if(given.street, {address}.gatuadress, '')"
    fields["postcode"] = f"{address}.postnr"
    fields["city"] = f"{address}.postort"
    columns = [F.expr(sql).alias(name) for name, sql in fields.items()]
    place = F.array(coordinate(F.col(f"{address}.longitud")), coordinate(F.col(f"{address}.latitud")))
    return F.struct(*columns, place.alias("coordinates")).alias("workplace_address")


def normalise_ads(raw: DataFrame, taxonomy: Taxonomy, run_date: dt.date,
                  limit: int | None = None) -> DataFrame:
    """Normalised ads of parsed raw ads (``id, ad, given`` and, for tombstones, a filter).

    Where the taxonomy's codes fit the measured bound, ``raw`` is read once and no ad is moved.
    Beyond it the coded values become rows: ``raw`` is then read twice, so store it parsed.
    """
    if "removed_ad_filter" not in raw.columns:
        raw = raw.withColumn("removed_ad_filter", F.lit(None).cast(FILTER_TYPE))
    ads = lookup_join(raw.withColumn("for_id", F.col("ad.yrkesroll.varde")), taxonomy.cards,
                      "for_id", "left", limit).drop("for_id")
    # Python sees only the text and the odd date; what follows works on its result.
    ad = F.col("ad")
    ads = ads.withColumns({
        "text": clean_html(ad["annonstextFormaterad"]),
        "application_deadline": lenient_timestamp(ad["sistaAnsokningsdatum"], run_date),
        "publication_date": lenient_timestamp(ad["publiceringsdatum"], run_date),
        "last_publication_date": lenient_timestamp(ad["sistaPubliceringsdatum"], run_date),
        "removed_date": lenient_timestamp(ad["avpubliceringsdatum"], run_date),
    })
    ads = resolve_mentions(ads, taxonomy, limit)
    given = F.col("given")
    hours = ad["arbetstidTyp"]["varde"]
    least, most = scope_default(hours)
    pick = lambda **names: F.expr("named_struct({})".format(
        ", ".join(f"'{n}', ad.{key}" for n, key in names.items())))
    live = ~null_safe(ad["avpublicerad"], False)
    licences = F.expr(f"transform(filter({_found('driving_license')}, m -> m.entry IS NOT NULL), "
                      "m -> m.entry)")
    needs_licence = licence_required(ad["korkort"])
    out = ads.select(
        "id", ad["externtAnnonsId"].alias("external_id"), ad["annonsrubrik"].alias("headline"),
        "application_deadline", ad["antalPlatser"].alias("number_of_vacancies"),
        F.when(live, remote_work(F.col("text"), ad["annonsrubrik"])).alias("remote_work"),
        F.struct(
            F.col("text").alias("text"), ad["annonstextFormaterad"].alias("text_formatted"),
            ad["ftgInfo"].alias("company_information"), ad["beskrivningBehov"].alias("needs"),
            ad["beskrivningKrav"].alias("requirements"),
            ad["villkorsbeskrivning"].alias("conditions")).alias("description"),
        *[F.expr(_coded(c)).alias(c) for c in CODED],
        ad["lonebeskrivning"].alias("salary_description"),
        F.struct(
            F.when(given["scope_min"], ad["arbetstidOmfattningFran"]).otherwise(least).alias("min"),
            F.when(given["scope_max"], ad["arbetstidOmfattningTill"]).otherwise(most).alias("max"),
        ).alias("scope_of_work"),
        ad["tilltrade"].alias("access"),
        pick(phone_number="telefonnummer", email="epost", url="webbadress",
             organization_number="organisationsnummer", name="arbetsgivareNamn",
             workplace="arbetsplatsNamn", workplace_id="arbetsplatsId").alias("employer"),
        pick(information="informationAnsokningssatt", reference="referens",
             email="ansokningssattEpost", via_af="ansokningssattViaAF",
             url="ansokningssattWebbadress", other="ansokningssattAnnatSatt")
        .alias("application_details"),
        experience_required(ad["ingenErfarenhetKravs"]).alias("experience_required"),
        own_car(given["own_car"], ad["tillgangTillEgenBil"]).alias("access_to_own_car"),
        needs_licence.alias("driving_license_required"),
        F.when(needs_licence, licences).alias("driving_license"),
        "occupation", "occupation_group", "occupation_field",
        workplace_address(), *[_requirements(s) for s in SIDES],
        contacts(F.coalesce(ad["kontaktpersoner"], F.expr(_empty(PERSON))))
        .alias("application_contact"),
        "publication_date", "last_publication_date", ad["avpublicerad"].alias("removed"),
        "removed_date", ad["kallaTyp"].alias("source_type"), ad["updatedAt"].alias("timestamp"),
        ad["logo_url"].alias("logo_url"), "removed_ad_filter",
    )
    return with_keywords(out)
