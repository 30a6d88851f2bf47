"""Feeds, upserts, tombstones and checks over snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from feedloom import settings
from feedloom.functions.text import epoch_to_local, null_if_empty
from feedloom.operators.joins import lookup_join, small_side


def batch_dedup(df: DataFrame, keys: list[str] | str, order: list[str]) -> DataFrame:
    """One row per key: the one with the greatest order columns.

    An aggregate rather than a window: all but one row per key and task are dropped before the
    shuffle, so a key with a third of all rows costs no more than another.
    """
    keys = [keys] if isinstance(keys, str) else keys
    row = F.max_by(F.struct(*df.columns), F.struct(*order)).alias("__row")
    return df.groupBy(*[F.col(k).alias(f"__{i}") for i, k in enumerate(keys)]).agg(row).select("__row.*")


def upsert(current: DataFrame, changes: DataFrame, key: str = "id",
           newer_by: str | None = None) -> DataFrame:
    """Whole-row replace by key. ``changes`` holds one row per key and wins.

    Only the keys of ``changes`` travel: with a small change set the current table is read,
    filtered and never shuffled. With ``newer_by`` a change loses to a row with a greater value.
    """
    if newer_by is None:
        kept = current.join(small_side(changes.select(key)), key, "left_anti")
        return kept.unionByName(changes, allowMissingColumns=True)
    offered = changes.select(key, F.col(newer_by).alias("__offered"))
    kept = lookup_join(current, offered, key).where(
        F.col("__offered").isNull() | (F.col("__offered") < F.col(newer_by))).drop("__offered")
    stored = current.select(key, F.col(newer_by).alias("__stored"))
    taken = lookup_join(changes, stored, key).where(
        F.col("__stored").isNull() | (F.col("__stored") <= F.col(newer_by))).drop("__stored")
    return kept.unionByName(taken, allowMissingColumns=True)


def document_key(key_columns: list[str], concept_id: str | None = "concept_id") -> Column:
    """The concept id if there is one, else the key columns joined by ``-``.

    A missing key column is an error; ``concat_ws`` would skip it without a word.
    """
    part = lambda k: F.coalesce(
        F.col(k).cast("string"), F.raise_error(F.lit(f"document without {k}")).cast("string"))
    joined = F.concat_ws("-", *[part(k) for k in key_columns])
    return joined if concept_id is None else F.coalesce(F.col(concept_id), joined)


# --- Tombstones ---

FILTER_TYPE = ("struct<occupation_concept_id:array<string>,occupation_field_concept_id:array<string>,"
               "occupation_group_concept_id:array<string>,municipality_concept_id:string,"
               "region_concept_id:string,country_concept_id:string>")


def tombstone_enrich(unpublished: DataFrame, snapshot: DataFrame,
                     zone: str = settings.LOCAL_ZONE, limit: int | None = None) -> DataFrame:
    """Unpublished feed rows with the filter ids their ad has in the current snapshot."""
    ids = lambda c: F.transform(c, lambda o: o["concept_id"])
    place = lambda f: F.col(f"workplace_address.{f}").alias(f)
    known = snapshot.select(
        F.col("id").alias("__id"),
        F.struct(
            ids(F.col("occupation")).alias("occupation_concept_id"),
            ids(F.col("occupation_field")).alias("occupation_field_concept_id"),
            ids(F.col("occupation_group")).alias("occupation_group_concept_id"),
            place("municipality_concept_id"), place("region_concept_id"),
            place("country_concept_id")).alias("removed_ad_filter"))
    feed = unpublished.withColumn("__id", F.col("annonsId").cast("string"))
    # The snapshot is filtered by the removed ids where it lies; only what is left is joined.
    known = known.join(small_side(feed.select("__id").distinct(), limit), "__id", "left_semi")
    date = F.coalesce(null_if_empty(F.col("avpubliceringsdatum")),
                      epoch_to_local(F.col("uppdateradTid"), zone))
    return lookup_join(feed, known, "__id", "left", limit).select(
        F.col("__id").alias("id"), "annonsId", F.lit(True).alias("removed"),
        F.lit(True).alias("avpublicerad"), date.alias("avpubliceringsdatum"),
        date.alias("removed_date"), "uppdateradTid", F.col("uppdateradTid").alias("updatedAt"),
        F.col("uppdateradTid").alias("timestamp"), "removed_ad_filter")


def is_removed() -> Column:
    return F.coalesce(F.col("removed"), F.lit(False))


def tombstones(documents: DataFrame) -> DataFrame:
    """The slim form of removed documents."""
    return documents.where(is_removed()).select(*slim_columns())


def slim_columns() -> list:
    f = F.col("removed_ad_filter")
    one = lambda name: F.struct(f[name].alias("concept_id"))
    return [
        "id", F.lit(True).alias("removed"), "removed_date", "timestamp",
        F.lit(None).cast("timestamp_ntz").alias("last_publication_date"),
        F.lit(None).cast("timestamp_ntz").alias("publication_date"),
        one("occupation_concept_id").alias("occupation"),
        one("occupation_group_concept_id").alias("occupation_group"),
        one("occupation_field_concept_id").alias("occupation_field"),
        F.struct(*[f[n].alias(n) for n in (
            "municipality_concept_id", "region_concept_id", "country_concept_id")])
        .alias("workplace_address")]


def shaped_sql(removed: T.StructType, ad: T.StructType, within: str = "") -> list[str]:
    """Select list that shows a slim row in the columns of an ad. Filter ids take the place of the
    fields they came from, so both kinds of row answer the same filters. ``within`` names a struct
    that holds the slim row."""
    out = []
    for f in ad.fields:
        if f.name in ("occupation", "occupation_group", "occupation_field"):
            fields = ", ".join(f"'{e.name}', " + ("i" if e.name == "concept_id" else "NULL")
                               for e in f.dataType.elementType.fields)
            value = f"transform({within}{f.name}.concept_id, i -> named_struct({fields}))"
        elif f.name == "workplace_address":
            held = removed[f.name].dataType.fieldNames()
            value = "named_struct({})".format(", ".join(
                f"'{e.name}', " + (f"{within}{f.name}.{e.name}" if e.name in held else "NULL")
                for e in f.dataType.fields))
        else:
            value = f"{within}`{f.name}`" if f.name in removed.fieldNames() else "NULL"
        out.append(f"CAST({value} AS {f.dataType.simpleString()}) AS `{f.name}`")
    return out


def shaped_like(removed: DataFrame, schema: T.StructType) -> DataFrame:
    return removed.selectExpr(*shaped_sql(removed.schema, schema))


def route_tombstones(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows for the main table, rows for the table of removed ads).

    A removed document goes to both, in its slim form.
    """
    removed = tombstones(documents)
    # One pass: each row is shown in one of its two forms.
    both = documents.withColumn("__slim", F.struct(*slim_columns()))
    shaped = shaped_sql(removed.schema, documents.schema, "__slim.")
    main = both.select(*[
        F.when(is_removed(), F.expr(sql.rsplit(" AS ", 1)[0])).otherwise(F.col(name)).alias(name)
        for name, sql in zip(documents.columns, shaped)])
    return main.drop("removed_ad_filter"), removed


# --- Reads of a snapshot ---

def active_ads(ads: DataFrame, as_of: Column) -> DataFrame:
    """Ads published at ``as_of``, which is cut to the minute, and not removed."""
    minute = F.date_trunc("minute", as_of)
    return ads.where((F.col("publication_date") <= minute)
                     & (F.col("last_publication_date") >= minute)
                     & (F.col("removed") == F.lit(False)))


def missing_description(ads: DataFrame, as_of: Column, text: str = "description.text") -> DataFrame:
    return active_ads(ads, as_of).where(F.coalesce(F.col(text), F.lit("")) == "")


def by_id(ads: DataFrame, ad_id: str) -> DataFrame:
    return ads.where(F.col("id") == ad_id).limit(1)


def ids_with_timestamp(ads: DataFrame, timestamp: int) -> DataFrame:
    """All ids with one exact timestamp."""
    return ads.where(F.col("timestamp") == timestamp).select("id")


def missing_ids(wanted: DataFrame, snapshot: DataFrame, key: str = "id",
                unique: bool = True) -> DataFrame:
    """Rows of ``wanted`` whose key the snapshot does not hold.

    With ``unique=False`` the snapshot side repeats keys, which are then merged before the shuffle.
    """
    held = snapshot.select(key)
    return wanted.join(small_side(held if unique else held.distinct()), key, "left_anti")


def missing_live_rows(feed: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Live feed rows that are not in the snapshot, one per id."""
    live = feed.where(~F.coalesce(F.col("avpublicerad"), F.lit(False))).withColumn(
        "id", F.col("annonsId").cast("string"))
    order = [c for c in ("uppdateradTid", "seq") if c in feed.columns]
    # One row per id first: an ad that changes all the time costs the join no more than another.
    return missing_ids(batch_dedup(live, "id", order), snapshot)


def stream_view(main: DataFrame, deleted: DataFrame) -> DataFrame:
    """Main and removed rows behind one name. A removed id is in both, and stays so."""
    return main.unionByName(shaped_like(deleted, main.schema))


# --- Counts ---

def last_timestamp(ads: DataFrame) -> DataFrame:
    return ads.agg(F.coalesce(F.max("timestamp"), F.lit(0).cast("bigint")).alias("last_timestamp"))


def top_by_timestamp(ads: DataFrame, *columns: str) -> DataFrame:
    ties = [F.col(c) for c in columns if c != "timestamp"]
    return ads.orderBy(F.desc_nulls_last("timestamp"), *ties).select(*columns).limit(1)


def document_count(ads: DataFrame) -> DataFrame:
    return ads.agg(F.count(F.lit(1)).alias("documents"))


def live_count(ads: DataFrame) -> DataFrame:
    """Documents whose ``removed`` is false; a null is not counted."""
    return ads.agg(F.count_if(F.col("removed") == F.lit(False)).alias("live"))


def size_gate(new: DataFrame, current: DataFrame | None,
              share: float = settings.NEW_SNAPSHOT_SHARE) -> DataFrame:
    """One row (documents, live, passed). Without a current snapshot the gate passes."""
    total = document_count(new)
    if current is None:
        return total.select("documents", F.lit(None).cast("bigint").alias("live"),
                            F.lit(True).alias("passed"))
    both = total.unionByName(live_count(current), allowMissingColumns=True)
    return both.agg(F.max("documents").alias("documents"), F.max("live").alias("live")).select(
        "documents", "live", (F.col("documents") >= F.col("live") * F.lit(share)).alias("passed"))


def max_version(versions: DataFrame, column: str = "version") -> DataFrame:
    return versions.agg(F.max(column).alias("max_version"))


def batch_stats(documents: DataFrame, *by: str) -> DataFrame:
    return documents.groupBy(*by).agg(
        F.count(F.lit(1)).alias("imported"), F.count_if(~is_removed()).alias("live"))
