"""The change feed and the ad bodies it points to."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from feedloom import settings
from feedloom.functions.text import mask_org_number, null_safe, strip_nul_json
from feedloom.operators.joins import lookup_join, small_side
from feedloom.operators.snapshot import batch_dedup
from feedloom.session import materialise

FEED_SCHEMA = "annonsId bigint, avpublicerad boolean, uppdateradTid bigint, avpubliceringsdatum string"


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """Landed feed files, one JSON row per change."""
    return spark.read.schema(FEED_SCHEMA).json(path)


def is_unpublished() -> Column:
    return null_safe(F.col("avpublicerad"), False)


def feed_changes(feed: DataFrame, cursor: int = 0, inclusive: bool = False) -> DataFrame:
    """Rows changed since ``cursor``. Cursor 0 asks for everything that is published now."""
    if cursor == 0:
        return feed.where(~is_unpublished())
    time = F.col("uppdateradTid")
    return feed.where(time >= cursor if inclusive else time > cursor)


def batch_rows(feed: DataFrame) -> DataFrame:
    """One feed row per ad. The last one counts, so only its body has to be fetched."""
    order = [c for c in ("uppdateradTid", "seq") if c in feed.columns]
    return batch_dedup(feed, "annonsId", order)


def attach_details(feed: DataFrame, details: DataFrame, limit: int | None = None) -> DataFrame:
    """Bodies (``annonsId, sistaPubliceringsdatum, ...``) of the live feed rows."""
    live = feed.where(~is_unpublished())
    own = [c for c in details.columns if c not in ("annonsId", *feed.columns)]
    joined = lookup_join(live, details.select("annonsId", *own), "annonsId", "inner", limit)
    return joined.withColumns({
        "id": F.col("annonsId").cast("string"),
        "updatedAt": F.col("uppdateradTid"),
        "expiresAt": F.col("sistaPubliceringsdatum")})


# --- Bodies, landed by day and bucket of their id ---

def body_bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col("annonsId").cast("bigint")), F.lit(buckets)).cast("int")


def land_bodies(bodies: DataFrame, path: str, buckets: int = settings.BODY_BUCKETS,
                landed: Column | None = None) -> str:
    """Add bodies (``annonsId, body, ...``) to a landing folder, under the day they landed (today
    unless given) and the bucket of their id. Each bucket of a call is one task's file per day."""
    day = F.current_date() if landed is None else landed
    rows = bodies.withColumns({"landed": day.cast("date"), "bucket": body_bucket(buckets)})
    rows.repartition("landed", "bucket").sortWithinPartitions("landed", "bucket", "annonsId") \
        .write.mode("append").partitionBy("landed", "bucket").parquet(path)
    return path


def landed_bodies(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The bodies of a landing folder; ``schema`` names their columns without day and bucket."""
    return spark.read.schema(f"{schema}, landed date, bucket int").parquet(path)


def of_batch(raw: DataFrame, wanted: DataFrame, buckets: int, limit: int | None = None) -> DataFrame:
    """Landed bodies that a batch (``annonsId, updatedAt``) can ask for: of its ids, from the day
    of its oldest change on.

    A body is fetched after the change that announces it. Days and buckets are folders, of which
    no others are read: the batch is asked for its oldest change and its buckets, which are no more
    than there are folders a day.
    """
    asked = wanted.agg(F.min("updatedAt").alias("oldest"),
                       F.collect_set(body_bucket(buckets)).alias("buckets")).first()
    if asked["oldest"] is not None:
        # Landing days may be counted in another zone than the feed's times.
        first = dt.datetime.fromtimestamp(asked["oldest"] / 1000, dt.UTC).date()
        raw = raw.where(F.col("landed") >= F.lit(first - dt.timedelta(days=1)))
    keys = wanted.select("annonsId").distinct()
    return raw.where(F.col("bucket").isin(asked["buckets"])).join(
        small_side(keys, limit), "annonsId", "left_semi")


def attach_raw(feed: DataFrame, raw: DataFrame, limit: int | None = None,
               buckets: int = settings.BODY_BUCKETS) -> DataFrame:
    """Raw JSON bodies (``annonsId, body``) of the live feed rows: (annonsId, body, updatedAt).

    A body that landed more than once counts in its last ``version``, or without such a column in
    the greatest text. The bodies are filtered by the ids of the feed before anything is shuffled;
    of those that ``land_bodies`` wrote only the folders that the batch can ask for are read.
    """
    live = feed.where(~is_unpublished()).select(
        "annonsId", F.col("uppdateradTid").alias("updatedAt"))
    wanted = live.select("annonsId").distinct()
    if {"landed", "bucket"} <= set(raw.columns):
        # Written, as it is read three times.
        live = materialise(live, "live-rows")
        bodies = of_batch(raw, live, buckets, limit).drop("landed", "bucket")
    else:
        bodies = raw.join(small_side(wanted, limit), "annonsId", "left_semi")
    order = F.struct(F.col("version"), F.col("body")) if "version" in raw.columns else F.col("body")
    bodies = bodies.groupBy("annonsId").agg(F.max_by("body", order).alias("body"))
    return lookup_join(live, bodies, "annonsId", "inner")


# --- Raw ads ---

PERSON = ("struct<fornamn:string,efternamn:string,befattning:string,beskrivning:string,"
          "epost:string,telefonnummer:string,mobilnummer:string,fackligRepresentant:boolean>")
PLACE = "struct<varde:string,namn:string>"
WEIGHTED = "struct<varde:string,namn:string,vikt:int>"
AD_TYPE = f"""struct<
annonsId:string, externtAnnonsId:string, kallaTyp:string, annonsrubrik:string,
annonstextFormaterad:string, publiceringsdatum:string, sistaPubliceringsdatum:string,
sistaAnsokningsdatum:string, avpublicerad:boolean, avpubliceringsdatum:string, updatedAt:bigint,
antalPlatser:int, webbadress:string, epost:string, telefonnummer:string, referens:string,
tilltrade:string, ftgInfo:string, beskrivningBehov:string, beskrivningKrav:string,
villkorsbeskrivning:string, lonebeskrivning:string, logo_url:string,
anstallningTyp:{PLACE}, varaktighetTyp:{PLACE}, arbetstidTyp:{PLACE}, lonTyp:{PLACE},
yrkesroll:{PLACE}, arbetstidOmfattningFran:double, arbetstidOmfattningTill:double,
organisationsnummer:string, arbetsgivareNamn:string, arbetsplatsId:string, arbetsplatsNamn:string,
informationAnsokningssatt:string, ansokningssattEpost:string, ansokningssattViaAF:boolean,
ansokningssattWebbadress:string, ansokningssattAnnatSatt:string,
ingenErfarenhetKravs:boolean, tillgangTillEgenBil:boolean,
korkort:array<{PLACE}>, kompetenser:array<{WEIGHTED}>, sprak:array<{WEIGHTED}>,
yrkeserfarenheter:array<{WEIGHTED}>, utbildningsniva:{WEIGHTED}, utbildningsinriktning:{WEIGHTED},
kontaktpersoner:array<{PERSON}>,
arbetsplatsadress:struct<gatuadress:string,postnr:string,postort:string,land:{PLACE},lan:{PLACE},
  kommun:{PLACE},latitud:string,longitud:string>
>""".replace("\n", " ")
# Keys for which a missing key and an explicit null mean different things.
PRESENCE = {
    "scope_min": "$.arbetstidOmfattningFran",
    "scope_max": "$.arbetstidOmfattningTill",
    "own_car": "$.tillgangTillEgenBil",
    "street": "$.arbetsplatsadress.gatuadress",
    "occupation": "$.yrkesroll",
}


def parse_raw(df: DataFrame, body: str = "body", ad: str = "ad", given: str = "given") -> DataFrame:
    """Replace JSON text by the typed ``ad`` and the booleans ``given``: which keys are there.

    The text becomes one VARIANT, which tells a missing key from an explicit null. A value of the
    wrong type is null, it does not fail the batch. NULs are removed on the way in.
    """
    parsed = df.withColumn("__v", F.try_parse_json(strip_nul_json(F.col(body)))).drop(body)
    typed = F.try_variant_get("__v", "$", AD_TYPE)
    there = F.struct(*[
        F.try_variant_get("__v", path, "variant").isNotNull().alias(n)
        for n, path in PRESENCE.items()])
    return parsed.withColumns({ad: typed, given: there}).drop("__v")


def mask_ad(df: DataFrame, ad: str = "ad") -> DataFrame:
    """Mask personal organisation numbers. Logos are looked up before, by the full number."""
    masked = mask_org_number(F.col(f"{ad}.organisationsnummer"))
    return df.withColumn(ad, F.col(ad).withField("organisationsnummer", masked))


def logo_resolve(ads: DataFrame, logos: DataFrame, workplace_id: Column, org_number: Column,
                 into: str = "logo_url", limit: int | None = None) -> DataFrame:
    """Logo by workplace, else by organisation, from a catalogue (``kind, key, url``).

    The catalogue stands in for asking the logo service about each pair.
    """
    number = workplace_id.try_cast("bigint")
    keyed = ads.withColumns({
        "__workplace": F.when(number > 0, number.cast("string")),
        "__org": org_number.cast("string")})
    for kind, key in (("workplace", "__workplace"), ("organisation", "__org")):
        side = logos.where(F.col("kind") == kind).select(
            F.col("key").cast("string").alias(key), F.col("url").alias(f"{key}_url"))
        keyed = lookup_join(keyed, side, key, "left", limit)
    return keyed.withColumn(into, F.coalesce("__workplace_url", "__org_url")).drop(
        "__workplace", "__org", "__workplace_url", "__org_url")
