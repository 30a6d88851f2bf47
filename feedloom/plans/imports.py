"""Import runs: incremental, full rebuild, reconciliation and rebuild from saved ads."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from feedloom import settings
from feedloom.functions.dates import lenient_timestamp
from feedloom.operators.candidates import enrichment_attach
from feedloom.operators.joins import lookup_join, small_side
from feedloom.operators.snapshot import (
    FILTER_TYPE, batch_dedup, is_removed, missing_live_rows, route_tombstones, tombstone_enrich,
    tombstones)
from feedloom.plans.commits import Conflict, State, read_state
from feedloom.plans.normalise import Taxonomy, normalise_ads
from feedloom.plans.snapshots import (
    Written, append, ensure_table, fold, holds, known_table, located, publish_snapshot, published_path,
    read_current, read_part, table_state, write_base, write_batch, write_part)
from feedloom.session import materialise
from feedloom.sources.feed import (
    attach_raw, batch_rows, feed_changes, is_unpublished, logo_resolve, mask_ad, parse_raw)

log = logging.getLogger(__name__)


@dataclass
class Inputs:
    """Landed tables a run reads. ``raw`` holds ``annonsId, body``."""

    raw: DataFrame
    taxonomy: Taxonomy
    logos: DataFrame | None = None
    candidates: DataFrame | None = None
    run_date: dt.date = dt.date(1970, 1, 1)
    zone: str = settings.LOCAL_ZONE


def live_documents(batch: DataFrame, inputs: Inputs, store: bool = True) -> DataFrame:
    """Normalised, enriched ads of the live rows of a batch (one row per id).

    Where ads are read twice (see ``normalise_ads``) the typed ads are stored, so that JSON is
    parsed once. ``store=False`` is for a look at the schema.
    """
    raw = parse_raw(attach_raw(batch, inputs.raw))
    raw = raw.select(F.col("annonsId").cast("string").alias("id"), "given", F.col("ad")
                     .withField("updatedAt", F.col("updatedAt")).alias("ad"))
    if inputs.logos is not None:
        raw = logo_resolve(raw, inputs.logos, F.col("ad.arbetsplatsId"),
                           F.col("ad.organisationsnummer"))
        raw = raw.withColumn("ad", F.col("ad").withField("logo_url", F.col("logo_url"))).drop(
            "logo_url")
    typed = mask_ad(raw)
    if store and inputs.taxonomy.in_place is None:
        typed = materialise(typed, "typed-ads")
    ads = normalise_ads(typed, inputs.taxonomy, inputs.run_date)
    if inputs.candidates is not None:
        ads = enrichment_attach(ads, inputs.candidates)
    return ads


def removed_documents(batch: DataFrame, current: DataFrame, inputs: Inputs) -> DataFrame:
    """What a removed ad keeps: its id, times and filter ids."""
    gone = tombstone_enrich(batch.where(is_unpublished()), current, inputs.zone)
    return gone.select(
        "id", "removed", lenient_timestamp(F.col("removed_date"), inputs.run_date)
        .alias("removed_date"), "timestamp", F.col("removed_ad_filter").cast(FILTER_TYPE)
        .alias("removed_ad_filter"))


def documents(feed: DataFrame, current: DataFrame | None, inputs: Inputs, store: bool = True
              ) -> tuple[DataFrame, DataFrame]:
    """(main rows, removed rows) of a set of feed rows.

    The last rows per ad are stored: the feed is read once for the bodies, live and removed ads, and
    the size of the batch decides how it is joined. ``store=False`` stores nothing.
    """
    batch = batch_rows(feed)
    if store:
        batch = materialise(batch, "batch-rows")
    live = live_documents(batch, inputs, store)
    known = live.limit(0) if current is None else current
    gone = removed_documents(batch, known, inputs)
    both = live.unionByName(gone, allowMissingColumns=True)
    # The table of removed ads needs nothing of the live ones.
    return route_tombstones(both)[0], tombstones(gone)


def document_schemas(feed: DataFrame, inputs: Inputs):
    """Columns of both tables, from no rows: else hot keys would be looked for in the whole feed."""
    none = {name: df.limit(0) for name in ("raw", "logos", "candidates")
            if (df := getattr(inputs, name)) is not None}
    main, removed = documents(feed.limit(0), None, replace(inputs, **none), store=False)
    return main.schema, removed.schema


def ensure_tables(spark: SparkSession, feed: DataFrame, main: str, deleted: str,
                  inputs: Inputs) -> None:
    """Empty main and removed tables, where there are none."""
    if table_state(spark, main) and table_state(spark, deleted):
        return
    main_schema, deleted_schema = document_schemas(feed, inputs)
    ensure_table(spark, main, main_schema)
    ensure_table(spark, deleted, deleted_schema)


def cursor(spark: SparkSession, main: str, manual: int | None = None) -> int:
    """Feed time to load from: the newest that a batch of the snapshot held, unless one is given.

    The log knows it; no row is read.
    """
    if manual is not None:
        return manual
    table = table_state(spark, main)
    return table.newest if table else 0


# --- Ads without an answer of the enrichment ---

LEDGER = "id string, timestamp bigint, open boolean"


def ledger_path(main: str) -> str:
    """The table of ads that wait for their enrichment, next to the ads."""
    return f"{main}-pending"


def ledger_rows(ads: DataFrame, waiting: DataFrame) -> DataFrame:
    """What a batch changes in the ledger: ads without an answer are open, and those that were
    open before and are answered or removed now are not."""
    unanswered = ~is_removed() & F.col("keywords.enriched").isNull()
    now = ads.select("id", "timestamp", unanswered.alias("open"))
    known = waiting.where("open").select("id", F.lit(True).alias("known"))
    return lookup_join(now, known, "id").where("open OR known").select(
        "id", "timestamp", "open")


# --- Type-ahead dictionary ---

DICTIONARY = "list string, term string, documents bigint"


def dictionary_path(main: str) -> str:
    """The table of type-ahead terms and the ads that hold them, next to the ads."""
    return f"{main}-terms"


def ad_terms(ads: DataFrame) -> DataFrame:
    """(list, term) of each ad's type-ahead terms; removed and unanswered ads have none."""
    lists = F.explode(F.array(*[
        F.struct(F.lit(name).alias("list"), F.col(f"keywords.enriched_typeahead_terms.{name}")
                 .alias("terms")) for name in settings.KEYWORD_LISTS.values()]))
    return ads.select(lists.alias("l")).select("l.list", F.explode("l.terms").alias("term"))


def term_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """What replacing ads changes in the dictionary: the old ones take their terms back."""
    both = ad_terms(before).withColumn("documents", F.lit(-1).cast("long")).unionByName(
        ad_terms(after).withColumn("documents", F.lit(1).cast("long")))
    return both.groupBy("list", "term").agg(F.sum("documents").alias("documents")).where(
        "documents <> 0")


def ensure_side_tables(spark: SparkSession, main: str) -> None:
    ensure_table(spark, ledger_path(main), spark.createDataFrame([], LEDGER).schema)
    ensure_table(spark, dictionary_path(main), spark.createDataFrame([], DICTIONARY).schema,
                 ("documents",))


def side_parts(spark: SparkSession, state: State, main: str, ads: Written, replaced: DataFrame
               ) -> list[Written]:
    """Parts of the ledger and the dictionary that belong to a written part of ads.

    ``replaced`` holds the ads that it replaces.
    """
    rows = read_part(spark, ads, known_table(state, main))
    ledger, terms = ledger_path(main), dictionary_path(main)
    waiting = read_current(spark, ledger, state=state)
    return [write_part(ledger_rows(rows, waiting), ledger, known_table(state, ledger)),
            write_part(term_changes(replaced, rows), terms, known_table(state, terms))]


def replaced_ads(spark: SparkSession, state: State, main: str, ads: Written) -> DataFrame:
    """The current ads that a written part replaces, found in the range of its keys."""
    own = read_part(spark, ads, known_table(state, main)).select("id")
    return read_current(spark, main, state=state).where(
        F.col("id").between(ads.least, ads.most)).join(small_side(own), "id", "left_semi")


def attach_late_answers(spark: SparkSession, main: str, candidates: DataFrame) -> int:
    """Enrich the ads that were imported before their answers landed; returns how many.

    Only open ads of the ledger are looked up, in the answers first and then in the snapshot. The
    patched ads, the closed entries and their terms are one commit. If an import changed the tables
    meanwhile, the patch is made again from the newer ads, so that no older ad comes back.
    """
    while True:
        state = read_state(spark, located(main)[0])
        waiting = read_current(spark, ledger_path(main), state=state).where("open")
        answered = candidates.select(F.col("doc_id").alias("id")).join(
            small_side(waiting.select("id")), "id", "left_semi").distinct()
        answered = materialise(answered, "answered")
        ads = read_current(spark, main, state=state).join(small_side(answered), "id", "left_semi")
        patched = write_part(enrichment_attach(ads, candidates), main, known_table(state, main))
        if not patched.rows:
            return 0
        written = [patched, *side_parts(spark, state, main, patched, ads)]
        try:
            append(spark, written, seen=state)
        except Conflict:
            continue
        return patched.rows


def load_batch(spark: SparkSession, feed: DataFrame, main: str, deleted: str, inputs: Inputs,
               writer: str | None = None, number: int = 0) -> dict[str, int]:
    """Import feed rows as one batch of a snapshot; returns counts taken as the batch is written.

    Ads, removed ads, the ledger of pending ones and the dictionary change in one commit: a run
    that stops before it has changed nothing. Repeated after that, as the same number of the same
    writer, it finds its batch there and does nothing. Without a writer the batch is one of its
    own. What a batch changes in the dictionary depends on the ads it replaces, so with candidates
    it is made again if another writer was faster.
    """
    if writer and holds(spark, main, writer, number):
        log.info("batch %s of %s is there already", number, writer)
        return {"imported": 0, "live": 0}
    if inputs.candidates is not None:
        ensure_side_tables(spark, main)
    while True:
        state = read_state(spark, located(main)[0])
        main_rows, removed_rows = documents(feed, read_current(spark, main, state=state), inputs)
        ads = write_part(main_rows, main, known_table(state, main),
                         live_ads=F.count_if(~is_removed()))
        written = [ads, write_part(removed_rows, deleted, known_table(state, deleted))]
        if inputs.candidates is not None:
            written += side_parts(spark, state, main, ads, replaced_ads(spark, state, main, ads))
        try:
            append(spark, written, writer, number,
                   seen=None if inputs.candidates is None else state)
        except Conflict:
            continue
        counts = {"imported": ads.rows, "live": ads.counts["live_ads"]}
        log.info("batch %s of %s: %s", number, main, counts)
        return counts


def reconcile(load: Callable[[DataFrame], object], feed: DataFrame,
              snapshot: Callable[[], DataFrame]) -> int:
    """Load live rows that are still missing until none are, or their number no longer falls.

    Each pass is one anti-join and one load. Returns how many ads are missing at the end.
    """
    load(feed)
    missing = None
    while True:
        pending = materialise(missing_live_rows(feed, snapshot()), "pending")
        before, missing = missing, pending.count()
        if missing == 0 or before is not None and missing >= before:
            break
        load(pending)
    if missing:
        log.error("%s ads stay missing", missing)
    return missing


def incremental_import(spark: SparkSession, feed: DataFrame, main: str, deleted: str,
                       inputs: Inputs, manual_cursor: int | None = None,
                       prefix: str | None = None, fold_after: int = settings.FOLD_AFTER) -> bool:
    """Import what changed since the snapshot's newest row. False if the size gate fails.

    The gate compares with what is published under ``prefix``, or else with what was last
    published from the folder that ``main`` lies in. Tables with ``fold_after`` batches get a new
    base at the end.
    """
    ensure_tables(spark, feed, main, deleted, inputs)
    changed = feed_changes(feed, cursor(spark, main, manual_cursor))
    reconcile(lambda rows: load_batch(spark, rows, main, deleted, inputs), changed,
              lambda: read_current(spark, main))
    if inputs.candidates is not None:
        attach_late_answers(spark, main, inputs.candidates)
    for path in (main, deleted, ledger_path(main), dictionary_path(main)):
        if table_state(spark, path):
            fold(spark, path, least=fold_after)
    return gate(spark, main, prefix)


def gate(spark: SparkSession, main: str, prefix: str | None = None,
         share: float = settings.NEW_SNAPSHOT_SHARE, needed: bool = False) -> bool:
    """Size of a snapshot against the published one, as the log has them: no row is read.

    With nothing published yet it passes, unless a published one is ``needed``.
    """
    live = published_path(spark, located(main)[0], prefix)
    if live is None:
        log.warning("nothing is published next to %s, so its size is not checked", main)
        return not needed
    state = read_state(spark, located(main)[0])
    return known_table(state, main).documents >= known_table(state, live).live * share


def version_name(prefix: str, at: dt.datetime) -> str:
    return f"{prefix}-{at:%Y%m%d-%H.%M}"


def full_rebuild(spark: SparkSession, feed: DataFrame, root: str, prefix: str, at: dt.datetime,
                 inputs: Inputs, gate_needed: bool = False) -> tuple[str, bool]:
    """A new snapshot of everything published now; names move only if the size gate passes.

    Ads whose bodies land meanwhile are loaded by further passes, as in an import. The first
    rebuild of a folder has nothing to be compared with and passes, unless a gate is needed.
    """
    main, deleted = f"{root}/{version_name(prefix, at)}", f"{root}/{prefix}-deleted"
    published = feed_changes(feed, 0)

    def load(rows: DataFrame) -> None:
        if table_state(spark, main):
            load_batch(spark, rows, main, deleted, inputs)
            return
        live, removed = documents(rows, None, inputs)
        ensure_table(spark, deleted, removed.schema)
        write_base(live, main)
        if inputs.candidates is not None:
            ensure_side_tables(spark, main)
            ads = read_current(spark, main)
            write_batch(ledger_rows(ads, read_current(spark, ledger_path(main))), ledger_path(main))
            write_batch(term_changes(ads.limit(0), ads), dictionary_path(main))

    reconcile(load, published, lambda: read_current(spark, main))
    passed = gate(spark, main, prefix, needed=gate_needed)
    if passed:
        publish_snapshot(spark, prefix, main, deleted)
    return main, passed


def rebuild_from_saved(spark: SparkSession, saved: str, main: str) -> None:
    """A snapshot of saved ads, without converting them again."""
    write_base(batch_dedup(spark.read.parquet(saved), "id", ["timestamp"]), main)
