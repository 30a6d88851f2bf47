"""Whole-ad normalisation and the import jobs, over raw ads made from orders or customers."""

from __future__ import annotations

import dataclasses
import datetime as dt
import functools

from pyspark.sql import DataFrame, functions as F

from feedloom.functions import requirements as r
from feedloom.functions.text import words
from feedloom.lens import tables as t
from feedloom.lens.feeds import MIDDLE
from feedloom.lens.lookups import EQUIVALENT_SQL
from feedloom.lens.registry import query
from feedloom.lens.texts import DATE_TEXT, RUN_DATE, TYPEAHEAD_SQL
from feedloom.operators import snapshot as s
from feedloom.operators.joins import lookup_join
from feedloom.operators.keywords import keyword_rows
from feedloom.plans import imports, normalise as n, snapshots
from feedloom.session import fresh_path, materialise
from feedloom.sources import feed as f, landing
from feedloom.streaming import feed_stream as stream

WEIGHT_SQL = """CASE o_orderpriority WHEN '1-URGENT' THEN 10 WHEN '2-HIGH' THEN 12
                WHEN '3-MEDIUM' THEN 5 WHEN '4-NOT SPECIFIED' THEN NULL ELSE 0 END"""
HOURS_SQL = """CASE o_orderpriority WHEN '1-URGENT' THEN '6YE1_gAC_R2G'
               WHEN '2-HIGH' THEN '947z_JGS_Uk2' END"""

RAW = f"""
    to_json(named_struct(
        'annonsId', o_orderkey, 'annonsrubrik', c_name, 'externtAnnonsId', '' || o_custkey,
        'annonstextFormaterad', '<p>' || o_orderpriority || '</p><p>Remote Work: ' ||
            c_mktsegment || '</p>',
        'avpublicerad', CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END,
        'yrkesroll', named_struct('varde', 'C' || o_custkey),
        'kompetenser', array(
            named_struct('varde', 'P' || o_custkey, 'vikt', {WEIGHT_SQL}),
            named_struct('varde', 'P' || day(o_orderdate), 'vikt', 5)),
        'sprak', array(named_struct('varde', 'R' || (c_nationkey % 5), 'vikt', {WEIGHT_SQL})),
        'korkort', CASE WHEN o_orderstatus <> 'P' THEN
            array(named_struct('varde', 'D' || day(o_orderdate)), named_struct('varde', 'none')) END,
        'utbildningsinriktning', CASE WHEN o_orderstatus <> 'P' THEN
            named_struct('varde', 'E' || c_nationkey, 'vikt', {WEIGHT_SQL}) END,
        'utbildningsniva', named_struct('varde', 'E0', 'vikt', 3),
        'arbetstidTyp', named_struct('varde', {HOURS_SQL}),
        'arbetstidOmfattningFran', CASE WHEN o_orderstatus = 'O' THEN 40.0D END,
        'arbetsplatsadress', named_struct(
            'kommun', named_struct('varde', 'N' || c_nationkey, 'namn', 'Kommun ' || c_nationkey),
            'postort', '1234' || c_nationkey || ' ' || c_mktsegment, 'longitud', '' || c_nationkey,
            'latitud', c_mktsegment),
        'ingenErfarenhetKravs', CASE c_nationkey % 3 WHEN 0 THEN true WHEN 1 THEN false END,
        'tillgangTillEgenBil', CASE WHEN c_nationkey % 2 = 0 THEN true END,
        'arbetsgivareNamn', c_mktsegment || ' AB', 'arbetsplatsNamn', 'AB ' || c_name,
        'organisationsnummer', reverse(substr(c_name, 10)) || '0',
        'publiceringsdatum', {DATE_TEXT},
        'updatedAt', unix_millis(CAST(o_orderdate AS TIMESTAMP))))
"""


def raw_ads(spark, sf_dir) -> DataFrame:
    """(id, body): one JSON ad per order; medium priority says its scope has no upper end."""
    customer = t.table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey")
    orders = t.texts(spark, sf_dir, "orders", "o_orderkey")
    rows = lookup_join(orders, customer, "o_custkey", "inner").withColumn("body", F.expr(RAW))
    open_end = F.expr("left(body, length(body) - 1) || ', \"arbetstidOmfattningTill\": null}'")
    body = F.when(F.col("o_orderpriority") == "3-MEDIUM", open_end).otherwise(F.col("body"))
    return rows.select(t.text("o_orderkey").alias("id"), body.alias("body"))


def parsed(spark, sf_dir) -> DataFrame:
    return f.mask_ad(f.parse_raw(raw_ads(spark, sf_dir)))


def normalised(spark, sf_dir) -> DataFrame:
    """Concepts are stored first, as they would be."""
    concepts = materialise(t.concepts(spark, sf_dir), "concepts")
    pairs = t.skill_pairs(spark, sf_dir).unionByName(t.occupation_pairs(spark, sf_dir))
    taxonomy, ads = n.prepare_taxonomy(concepts, pairs), parsed(spark, sf_dir)
    if taxonomy.in_place is None:  # read more than once: JSON is parsed once
        ads = materialise(ads, "typed-ads")
    return n.normalise_ads(ads, taxonomy, RUN_DATE)


JOINED = """
    SELECT *, CAST(o_orderkey AS VARCHAR) AS id,
           CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS removed,
           'P' || o_custkey AS skill_1, 'P' || day(o_orderdate) AS skill_2,
           {weight} AS weight
    FROM orders JOIN ({places}) ON o_custkey = c_custkey
""".format(weight=WEIGHT_SQL, places=t.PLACES_SQL)
SKILLS = f"SELECT concept_id, label FROM ({t.SKILLS_SQL})"
CARDS = f"""
    SELECT c.c_custkey AS k, coalesce(w.n_name, c.n_name) AS group_label,
           coalesce(w.r_name, c.r_name) AS field_label
    FROM ({t.PLACES_SQL}) c
    LEFT JOIN ({t.PLACES_SQL}) w ON c.c_mktsegment = 'MACHINERY' AND w.c_custkey = c.c_custkey + 1
"""


@query("p1_normalise_ad", f"""
    WITH a AS ({JOINED}), sk AS ({SKILLS}), cards AS ({CARDS}),
    swaps AS (SELECT for_id, count(*) AS n FROM ({EQUIVALENT_SQL}) GROUP BY 1)
    SELECT a.id, c_name AS headline, CAST(o_custkey AS VARCHAR) AS external_id,
           o_orderpriority || chr(10) || 'Remote Work: ' || c_mktsegment AS text,
           CASE WHEN NOT coalesce(removed, false) THEN true END AS remote_work,
           a.removed, group_label, field_label,
           CASE WHEN o_orderstatus = 'O' THEN 40.0::DOUBLE
                WHEN o_orderpriority = '1-URGENT' THEN 100.0::DOUBLE
                WHEN o_orderpriority = '2-HIGH' THEN 0.0::DOUBLE END AS scope_min,
           CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 100.0::DOUBLE END AS scope_max,
           CAST(CASE WHEN coalesce(weight, 0) >= 10 THEN 1 + CASE WHEN s1.concept_id IS NOT NULL
                THEN coalesce(w1.n, 0) ELSE 0 END ELSE 0 END AS INTEGER) AS must_skills,
           CAST(1 + CASE WHEN s2.concept_id IS NOT NULL THEN coalesce(w2.n, 0) ELSE 0 END
                + CASE WHEN coalesce(weight, 0) < 10 THEN 1 + CASE WHEN s1.concept_id IS NOT NULL
                  THEN coalesce(w1.n, 0) ELSE 0 END ELSE 0 END AS INTEGER) AS nice_skills,
           CASE WHEN coalesce(weight, 0) >= 10 THEN s1.label END AS first_must,
           CAST(CASE WHEN o_orderstatus = 'P' THEN NULL
                WHEN day(o_orderdate) IN (SELECT s_suppkey FROM supplier) THEN 1
                ELSE 0 END AS INTEGER) AS licences,
           o_orderstatus <> 'P' AS licence_required, c_nationkey % 3 <> 0 AS experience_required,
           c_nationkey % 2 = 0 AS own_car,
           CASE WHEN regexp_matches(substr(reverse(substr(c_name, 10)), 3, 1), '[2-9]')
                THEN reverse(substr(c_name, 10)) || '0' END AS org_number,
           CASE WHEN o_orderpriority <> '4-NOT SPECIFIED'
                THEN epoch_ms(o_orderdate) END AS published,
           epoch_ms(o_orderdate) AS timestamp
    FROM a JOIN cards ON k = o_custkey
    LEFT JOIN sk s1 ON s1.concept_id = skill_1 LEFT JOIN sk s2 ON s2.concept_id = skill_2
    LEFT JOIN swaps w1 ON w1.for_id = skill_1 LEFT JOIN swaps w2 ON w2.for_id = skill_2
""")
def normalise_ad(spark, sf_dir):
    ads = normalised(spark, sf_dir)
    return ads.select(
        "id", "headline", "external_id", F.col("description.text").alias("text"), "remote_work",
        "removed", F.col("occupation_group")[0]["label"].alias("group_label"),
        F.col("occupation_field")[0]["label"].alias("field_label"),
        F.col("scope_of_work.min").alias("scope_min"), F.col("scope_of_work.max").alias("scope_max"),
        F.size("must_have.skills").alias("must_skills"),
        F.size("nice_to_have.skills").alias("nice_skills"),
        F.get("must_have.skills", F.lit(0))["label"].alias("first_must"),
        F.when(F.col("driving_license").isNotNull(), F.size("driving_license")).alias("licences"),
        F.col("driving_license_required").alias("licence_required"), "experience_required",
        F.col("access_to_own_car").alias("own_car"),
        F.col("employer.organization_number").alias("org_number"),
        t.millis("publication_date").alias("published"), "timestamp")


@query("p4_requirement_flags", f"""
    SELECT id, c_nationkey % 3 <> 0 AS experience_required, o_orderstatus <> 'P' AS licence_required,
           c_nationkey % 2 = 0 AS own_car
    FROM ({JOINED})
""")
def requirement_flags(spark, sf_dir):
    """All flags, from keys that are there, null or missing."""
    ad = F.col("ad")
    return parsed(spark, sf_dir).select(
        "id", r.experience_required(ad["ingenErfarenhetKravs"]).alias("experience_required"),
        r.licence_required(ad["korkort"]).alias("licence_required"),
        r.own_car(F.col("given.own_car"), ad["tillgangTillEgenBil"]).alias("own_car"))


@query("p6_education_split", f"""
    WITH a AS ({JOINED})
    SELECT id, CASE WHEN coalesce(weight, 0) >= 10 THEN 'must_have' ELSE 'nice_to_have' END
           || '.' || part AS slot, concept_id, CAST(w AS INTEGER) AS weight
    FROM (SELECT *, 'education' AS part, 'E' || c_nationkey AS concept_id, weight AS w FROM a
          UNION ALL SELECT *, 'education_level', 'E0', 3 FROM a)
    WHERE o_orderstatus <> 'P'
""")
def education_split(spark, sf_dir):
    rows = parsed(spark, sf_dir).select("id", F.inline(F.expr(n.mentions_sql())))
    return rows.where(F.col("slot").contains(".education")).select(
        "id", "slot", "concept_id", "weight")


@query("p8_workplace_address", f"""
    SELECT id, CAST(c_nationkey AS VARCHAR) AS municipality_code,
           'N' || c_nationkey AS municipality_concept_id, 'Kommun ' || c_nationkey AS municipality,
           '199' AS country_code, 'i46j_HmG_v64' AS country_concept_id, 'Sverige' AS country,
           '' AS street_address, '1234' || c_nationkey || ' ' || c_mktsegment AS city,
           CAST(c_nationkey AS DOUBLE) AS longitude, CAST(NULL AS DOUBLE) AS latitude
    FROM ({JOINED})
""")
def workplace_address(spark, sf_dir):
    address = normalised(spark, sf_dir).select("id", "workplace_address.*")
    return address.select(
        "id", "municipality_code", "municipality_concept_id", "municipality", "country_code",
        "country_concept_id", "country", "street_address", "city",
        F.col("coordinates")[0].alias("longitude"), F.col("coordinates")[1].alias("latitude"))


KEYWORDS = f"""
    WITH a AS ({JOINED}), sk AS ({SKILLS}), cards AS ({CARDS}), e AS ({EQUIVALENT_SQL}),
    found AS (
        SELECT id, concept_id, label FROM a JOIN sk ON concept_id = skill_1
        UNION SELECT id, concept_id, label FROM a JOIN sk ON concept_id = skill_2),
    old AS (
        SELECT id, o_custkey AS k, o_custkey + 1 AS other, 'after ' || c_name AS label
        FROM a WHERE c_mktsegment = 'MACHINERY'
        UNION ALL SELECT id, o_custkey, p.c_custkey, p.c_name
        FROM a JOIN customer p ON p.c_custkey = o_custkey - 1 AND p.c_mktsegment = 'MACHINERY')
    SELECT id, 'occupation' AS list, lower(c_name) AS keyword FROM a
    UNION SELECT id, 'occupation', lower(label) FROM old
    UNION SELECT id, 'occupation', lower(group_label) FROM a JOIN cards ON k = o_custkey
    UNION SELECT id, 'occupation', lower(trim(p)) FROM (
        SELECT id, unnest(CASE WHEN contains(field_label, '-') THEN [field_label]
                          ELSE string_split(field_label, '/') END) AS p
        FROM a JOIN cards ON k = o_custkey)
    UNION SELECT id, 'skill', lower(label) FROM found
    UNION SELECT id, 'skill', lower(added_label) FROM found JOIN e ON concept_id = for_id
    UNION SELECT id, 'skill', lower(r.r_name) FROM a JOIN region r ON r.r_regionkey = c_nationkey % 5
    UNION SELECT id, 'location', lower(c_mktsegment) FROM a
    UNION SELECT id, 'location', 'kommun' FROM a
    UNION SELECT id, 'location', 'sverige' FROM a
    UNION SELECT id, 'employer', lower(c_mktsegment) FROM a
    UNION SELECT id, 'employer', lower(c_name) FROM a
"""


@query("k7_extracted_keywords", KEYWORDS)
def extracted_keywords(spark, sf_dir):
    return keyword_rows(normalised(spark, sf_dir))


@query("a8_keyword_sets", """
    SELECT doc_id, count(DISTINCT w) AS keywords FROM (
        SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[ \n]+')) AS w FROM documents)
    GROUP BY 1
""")
def keyword_sets(spark, sf_dir):
    """The documents hold no white space but blanks and line ends."""
    values = F.array_distinct(words(F.lower("text")))
    return t.texts(spark, sf_dir, "documents", "doc_id").select(
        "doc_id", F.size(values).cast("long").alias("keywords"))


# --- Import jobs: customers are the ads the feed's users stand for ---

BODY = """
    to_json(named_struct(
        'annonsId', c_custkey, 'annonsrubrik', c_name, 'avpublicerad', false,
        'annonstextFormaterad', '<p>' || c_mktsegment || '</p>',
        'yrkesroll', named_struct('varde', 'C' || c_custkey),
        'publiceringsdatum', '2024-01-01 00:00:00'))
"""


def inputs(spark, sf_dir) -> imports.Inputs:
    customer = t.table(spark, sf_dir, "customer")
    raw = customer.select(F.col("c_custkey").alias("annonsId"), F.expr(BODY).alias("body"))
    concepts = materialise(t.occupations(spark, sf_dir), "occupations")
    none = t.occupation_pairs(spark, sf_dir).where("false")
    return imports.Inputs(raw, n.prepare_taxonomy(concepts, none), run_date=RUN_DATE)


def import_feed(spark, sf_dir) -> DataFrame:
    return t.feed(spark, sf_dir).drop("event_type")


def shown(ads: DataFrame) -> DataFrame:
    return ads.select(
        "id", F.coalesce(F.col("removed"), F.lit(False)).alias("removed"), "timestamp", "headline",
        F.get("occupation", F.lit(0))["concept_id"].alias("occupation_id"))


# First everything live before the middle, then all that changed after the newest row of that.
FIRST = t.latest_sql(f"ms <= {MIDDLE} AND NOT avpublicerad")
IMPORTED = f"""
    WITH first AS ({FIRST}),
    later AS ({t.latest_sql(f"ms > (SELECT max(ms) FROM ({t.FEED_SQL}) WHERE ms <= {MIDDLE} AND NOT avpublicerad)")}),
    merged AS (SELECT * FROM later UNION ALL
               SELECT * FROM first WHERE annonsId NOT IN (SELECT annonsId FROM later)),
    known AS (SELECT annonsId FROM first)
    SELECT CAST(m.annonsId AS VARCHAR) AS id, avpublicerad AS removed, ms AS timestamp,
           CASE WHEN NOT avpublicerad THEN c_name END AS headline,
           CASE WHEN NOT avpublicerad OR m.annonsId IN (SELECT annonsId FROM known)
                THEN 'C' || c_custkey END AS occupation_id
    FROM merged m LEFT JOIN customer ON c_custkey = m.annonsId
    WHERE avpublicerad OR c_custkey IS NOT NULL
"""


@query("r1_incremental_import", IMPORTED)
def incremental_import(spark, sf_dir):
    feed, given = import_feed(spark, sf_dir), inputs(spark, sf_dir)
    root = fresh_path(spark, "import")
    main, deleted = f"{root}/ads", f"{root}/deleted"
    before = feed.where(F.col("uppdateradTid") <= MIDDLE)
    for rows in (before, feed):
        imports.incremental_import(spark, rows, main, deleted, given)
    return shown(snapshots.read_current(spark, main))


LATEST_IMPORT = f"""
    SELECT CAST(annonsId AS VARCHAR) AS id, avpublicerad AS removed, ms AS timestamp,
           CASE WHEN NOT avpublicerad THEN c_name END AS headline
    FROM ({t.latest_sql()}) LEFT JOIN customer ON c_custkey = annonsId
    WHERE avpublicerad OR c_custkey IS NOT NULL
"""


@query("r1_stream_import", LATEST_IMPORT)
def stream_import(spark, sf_dir):
    """The same upsert fed by a stream over the landed feed file."""
    rows = event_stream(spark, sf_dir)
    root = fresh_path(spark, "stream")
    stream.stream_import(spark, rows, f"{root}/ads", f"{root}/deleted", inputs(spark, sf_dir),
                         f"{root}/checkpoint").awaitTermination()
    return shown(snapshots.read_current(spark, f"{root}/ads")).drop("occupation_id")


def event_stream(spark, sf_dir) -> DataFrame:
    source = t.table(spark, sf_dir, "events")
    events = (spark.readStream.schema(source.schema).option("pathGlobFilter", "events.parquet")
              .parquet(sf_dir))
    return events.select(
        F.col("user_id").alias("annonsId"), (F.col("event_type") == "error").alias("avpublicerad"),
        t.millis("ts").alias("uppdateradTid"), F.lit(None).cast("string").alias("avpubliceringsdatum"),
        F.col("event_id").alias("seq"))


@query("r1_stream_then_reconcile", LATEST_IMPORT)
def stream_then_reconcile(spark, sf_dir):
    """A stream meets the bodies of building firms only, a load brings the other ads, and a stream
    with a new checkpoint repeats some of them: each keeps its own batches of the one table."""
    given = inputs(spark, sf_dir)
    some = dataclasses.replace(given, raw=given.raw.where("body LIKE '%BUILDING%'"))
    root = fresh_path(spark, "shared")
    main, deleted, rows = f"{root}/ads", f"{root}/deleted", event_stream(spark, sf_dir)
    stream.stream_import(spark, rows, main, deleted, some, f"{root}/first").awaitTermination()
    late = s.missing_live_rows(f.batch_rows(import_feed(spark, sf_dir)),
                               snapshots.read_current(spark, main))
    imports.load_batch(spark, materialise(late, "late"), main, deleted, given)
    stream.stream_import(spark, rows.where("annonsId % 10 = 0"), main, deleted, given,
                         f"{root}/second").awaitTermination()
    return shown(snapshots.read_current(spark, main)).drop("occupation_id")


REBUILT = f"""
    SELECT CAST(annonsId AS VARCHAR) AS id, false AS removed, ms AS timestamp, c_name AS headline,
           'C' || c_custkey AS occupation_id
    FROM ({t.latest_sql("NOT avpublicerad")}) JOIN customer ON c_custkey = annonsId
"""


def _rebuild(spark, sf_dir) -> str:
    root = fresh_path(spark, "rebuild")
    prefix = "ads_" + root.rsplit("-", 1)[1]
    imports.full_rebuild(spark, import_feed(spark, sf_dir), root, prefix,
                         dt.datetime(2024, 2, 1, 3, 0), inputs(spark, sf_dir))
    return prefix


@query("r2_full_rebuild", REBUILT)
def full_rebuild(spark, sf_dir):
    return shown(spark.table(_rebuild(spark, sf_dir) + "_read"))


@query("s8_rebuild_from_saved", REBUILT)
def rebuild_from_saved(spark, sf_dir):
    """The ads of two runs, saved one after the other, become a snapshot; no ad is made again."""
    feed, given = import_feed(spark, sf_dir).where("NOT avpublicerad"), inputs(spark, sf_dir)
    root = fresh_path(spark, "saved")
    for name, rows in (("first", feed.where(F.col("uppdateradTid") <= MIDDLE)), ("second", feed)):
        live, _ = imports.documents(f.feed_changes(rows, 0), None, given)
        landing.save_enriched(live, f"{root}/saved/run={name}")
    imports.rebuild_from_saved(spark, f"{root}/saved", f"{root}/ads")
    return shown(snapshots.read_current(spark, f"{root}/ads"))


@query("r1_rebuild_then_import", f"""
    WITH live AS ({t.latest_sql(f"ms <= {MIDDLE} AND NOT avpublicerad")})
    SELECT CAST(annonsId AS VARCHAR) AS id, ms AS timestamp FROM ({t.latest_sql(
        "ms > (SELECT max(ms) FROM live JOIN customer ON c_custkey = annonsId)")})
    WHERE avpublicerad
""")
def rebuild_then_import(spark, sf_dir):
    """Ads removed after a rebuild stay known as removed, whatever is rebuilt and imported later."""
    feed, given = import_feed(spark, sf_dir), inputs(spark, sf_dir)
    root = fresh_path(spark, "rebuilds")
    prefix = "ads_" + root.rsplit("-", 1)[1]
    before = feed.where(F.col("uppdateradTid") <= MIDDLE)
    for day, rows in ((1, before), (2, feed)):
        main, _ = imports.full_rebuild(spark, rows, root, prefix, dt.datetime(2024, 2, day, 3, 0),
                                       given)
        imports.incremental_import(spark, feed, main, f"{root}/{prefix}-deleted", given)
    return snapshots.read_current(spark, f"{root}/{prefix}-deleted").select("id", "timestamp")


@query("r4_publish_snapshot", " UNION ALL ".join(
    f"SELECT '{name}' AS name, count(*) AS documents FROM ({REBUILT})"
    for name in ("read", "write", "stream")))
def publish_snapshot(spark, sf_dir):
    """Nothing is removed in a rebuild, so all three names show the same number of ads."""
    prefix = _rebuild(spark, sf_dir)
    counts = [s.document_count(spark.table(f"{prefix}_{name}")).select(
        F.lit(name).alias("name"), "documents") for name in ("read", "write", "stream")]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query("r3_reconcile", """
    SELECT DISTINCT CAST(user_id AS VARCHAR) AS id, c_name AS headline
    FROM events JOIN customer ON c_custkey = user_id WHERE event_type <> 'error'
""")
def reconcile(spark, sf_dir):
    """At first only the bodies of building firms have landed; a further pass imports the rest."""
    feed, given = import_feed(spark, sf_dir).where("NOT avpublicerad"), inputs(spark, sf_dir)
    some = dataclasses.replace(given, raw=given.raw.where("body LIKE '%BUILDING%'"))
    root, passes = fresh_path(spark, "reconcile"), []
    main, deleted = f"{root}/ads", f"{root}/deleted"
    imports.ensure_tables(spark, feed, main, deleted, given)

    def load(rows):
        passes.append(imports.load_batch(spark, rows, main, deleted, given if passes else some))

    imports.reconcile(load, feed, lambda: snapshots.read_current(spark, main))
    return snapshots.read_current(spark, main).select("id", "headline")


@query("r7_ensure_tables", f"SELECT CAST(annonsId AS VARCHAR) AS id FROM ({t.latest_sql()})")
def ensure_tables(spark, sf_dir):
    """Tables are made where there are none, and left alone where there are."""
    rows = f.batch_rows(t.feed(spark, sf_dir)).select(F.col("annonsId").cast("string").alias("id"))
    path = fresh_path(spark, "ensure") + "/ids"
    snapshots.ensure_table(spark, path, rows.schema)
    snapshots.write_batch(rows, path)
    snapshots.ensure_table(spark, path, rows.schema)
    return snapshots.read_current(spark, path)


# --- One step, folding, late answers ---

REMOVED_LATER = f"""
    SELECT CAST(annonsId AS VARCHAR) AS id, ms AS timestamp FROM ({t.latest_sql(
        f"ms > (SELECT max(ms) FROM ({t.FEED_SQL}) WHERE ms <= {MIDDLE} AND NOT avpublicerad)")})
    WHERE avpublicerad
"""


@query("s4_compacted_import", f"""
    SELECT 'ads' AS held_in, id, removed, timestamp, headline, occupation_id FROM ({IMPORTED})
    UNION ALL SELECT 'deleted', id, true, timestamp, NULL, NULL FROM ({REMOVED_LATER})
""")
def compacted_import(spark, sf_dir):
    """Both tables get a new base after each import; what they hold is what it was without."""
    feed, given = import_feed(spark, sf_dir), inputs(spark, sf_dir)
    root = fresh_path(spark, "folded")
    main, deleted = f"{root}/ads", f"{root}/deleted"
    for rows in (feed.where(F.col("uppdateradTid") <= MIDDLE), feed):
        imports.incremental_import(spark, rows, main, deleted, given, fold_after=1)
    gone = snapshots.read_current(spark, deleted).select(
        F.lit("deleted").alias("held_in"), "id", "removed", "timestamp",
        F.lit(None).cast("string").alias("headline"),
        F.lit(None).cast("string").alias("occupation_id"))
    return shown(snapshots.read_current(spark, main)).select(
        F.lit("ads").alias("held_in"), "id", "removed", "timestamp", "headline", "occupation_id"
    ).unionByName(gone)


COUNTED_NAMES = ("read", "write", "stream", "deleted")


@query("r4_publish_after_crash", f"""
    WITH early AS ({t.latest_sql(f"ms <= {MIDDLE} AND NOT avpublicerad")}),
    late AS ({t.latest_sql("NOT avpublicerad")}),
    sizes AS (
        SELECT 'stopped' AS step, count(c_custkey) AS n FROM early JOIN customer ON c_custkey = annonsId
        UNION ALL SELECT 'published', count(c_custkey) FROM late JOIN customer ON c_custkey = annonsId)
    SELECT step, name, CASE name WHEN 'deleted' THEN 0 ELSE n END AS documents
    FROM sizes, (VALUES ('read'), ('write'), ('stream'), ('deleted')) v(name)
""")
def publish_after_crash(spark, sf_dir):
    """A rebuild that stops with everything written but its commit moves none of the four names;
    the commit then moves all."""
    feed, given = import_feed(spark, sf_dir), inputs(spark, sf_dir)
    root = fresh_path(spark, "commits")
    prefix = "ads_" + root.rsplit("-", 1)[1]
    early = feed.where(F.col("uppdateradTid") <= MIDDLE)
    imports.full_rebuild(spark, early, root, prefix, dt.datetime(2024, 2, 1, 3, 0), given)
    live, _ = imports.documents(f.feed_changes(feed, 0), None, given)
    snapshots.write_base(live, f"{root}/next")
    counts = [_documents_shown(spark, prefix, "stopped")]
    snapshots.publish_snapshot(spark, prefix, f"{root}/next", f"{root}/{prefix}-deleted")
    counts.append(_documents_shown(spark, prefix, "published"))
    return counts[0].unionByName(counts[1])


def _documents_shown(spark, prefix, step) -> DataFrame:
    """Counted now: a name that is read later shows what it shows then."""
    counts = [s.document_count(spark.table(f"{prefix}_{name}")).select(
        F.lit(step).alias("step"), F.lit(name).alias("name"), "documents") for name in COUNTED_NAMES]
    return materialise(functools.reduce(DataFrame.unionByName, counts), "shown")


ENRICHED_BODY = """
    to_json(named_struct(
        'annonsId', c_custkey, 'annonsrubrik', {headline}, 'avpublicerad', false,
        'annonstextFormaterad', '<p>' || c_mktsegment || '</p>',
        'arbetsplatsId', '' || c_custkey, 'organisationsnummer', '' || c_nationkey,
        'yrkesroll', named_struct('varde', 'C' || c_custkey),
        'publiceringsdatum', '2024-01-01 00:00:00'))
"""
KEPT_TERMS = f"""
    SELECT doc_id, string_agg(list || ':' || term, '|' ORDER BY list, term) AS terms FROM (
        SELECT DISTINCT doc_id, list, lower(concept_label) AS term
        FROM ({t.KEPT_CANDIDATES_SQL})) GROUP BY 1
"""


@query("r1_import_enriched", f"""
    WITH first AS ({FIRST}),
    later AS ({t.latest_sql(f"ms > (SELECT max(ms) FROM ({t.FEED_SQL}) WHERE ms <= {MIDDLE} AND NOT avpublicerad)")}),
    merged AS (SELECT *, true AS again FROM later UNION ALL
               SELECT *, false FROM first WHERE annonsId NOT IN (SELECT annonsId FROM later)),
    answered AS (SELECT DISTINCT l_orderkey FROM lineitem JOIN part ON l_partkey = p_partkey),
    logos AS (SELECT c_custkey AS k, coalesce(
        CASE WHEN s_suppkey > 0 AND s_acctbal > 5000 THEN 'logo/w/' || s_suppkey END,
        'logo/o/' || p_partkey) AS url FROM customer
        LEFT JOIN supplier ON s_suppkey = c_custkey
        LEFT JOIN part ON p_partkey = c_nationkey AND p_type = 'SMALL')
    SELECT CAST(m.annonsId AS VARCHAR) AS id, avpublicerad AS removed, ms AS timestamp,
           CASE WHEN NOT avpublicerad THEN CASE WHEN again THEN '' ELSE 'old ' END || c_name END
               AS headline,
           CASE WHEN NOT avpublicerad THEN url END AS logo_url,
           CASE WHEN NOT avpublicerad AND l_orderkey IS NOT NULL THEN coalesce(terms, '') END
               AS enriched,
           NOT avpublicerad AND l_orderkey IS NULL AS waiting
    FROM merged m LEFT JOIN customer ON c_custkey = m.annonsId LEFT JOIN logos ON k = m.annonsId
    LEFT JOIN answered ON l_orderkey = m.annonsId
    LEFT JOIN ({KEPT_TERMS}) ON doc_id = CAST(m.annonsId AS VARCHAR)
    WHERE avpublicerad OR c_custkey IS NOT NULL
""")
def import_enriched(spark, sf_dir):
    """Ads with logos and enrichment. The answers for open orders land after the first import and
    are patched in by the second; ads that changed have a second body by then."""
    main = _enriched_import(spark, sf_dir)
    lists = F.expr("concat({})".format(", ".join(
        f"transform(keywords.enriched.{name}, x -> '{name}:' || x)"
        for name in ("location", "occupation", "skill", "trait"))))
    waiting = snapshots.read_current(spark, imports.ledger_path(main)).where("open").select(
        "id", F.lit(True).alias("waiting"))
    return lookup_join(snapshots.read_current(spark, main), waiting, "id").select(
        "id", s.is_removed().alias("removed"), "timestamp", "headline", "logo_url",
        F.array_join(lists, "|").alias("enriched"),
        F.coalesce("waiting", F.lit(False)).alias("waiting"))


def _enriched_import(spark, sf_dir, **options) -> str:
    customer, orders = t.table(spark, sf_dir, "customer"), t.table(spark, sf_dir, "orders")
    body = lambda headline, version: customer.select(
        F.col("c_custkey").alias("annonsId"), F.lit(version).alias("version"),
        F.expr(ENRICHED_BODY.format(headline=headline)).alias("body"))
    supplier, part = t.table(spark, sf_dir, "supplier"), t.table(spark, sf_dir, "part")
    logos = supplier.where("s_acctbal > 5000").select(
        F.lit("workplace").alias("kind"), t.text("s_suppkey").alias("key"),
        t.text("s_suppkey", "logo/w/").alias("url")).unionByName(
            part.where("p_type = 'SMALL'").select(
                F.lit("organisation").alias("kind"), t.text("p_partkey").alias("key"),
                t.text("p_partkey", "logo/o/").alias("url")))
    answers = t.candidates(spark, sf_dir)
    early = answers.join(orders.where("o_orderstatus = 'F'").select(
        t.text("o_orderkey").alias("doc_id")), "doc_id", "left_semi")
    first = dataclasses.replace(inputs(spark, sf_dir), raw=body("'old ' || c_name", 1), logos=logos,
                                candidates=early)
    second = dataclasses.replace(first, raw=first.raw.unionByName(body("c_name", 2)),
                                 candidates=answers)
    feed, root = import_feed(spark, sf_dir), fresh_path(spark, "enriched")
    main, deleted = f"{root}/ads", f"{root}/deleted"
    for rows, given in ((feed.where(F.col("uppdateradTid") <= MIDDLE), first), (feed, second)):
        imports.incremental_import(spark, rows, main, deleted, given, **options)
    return main


@query("t9_dictionary_by_batches", f"""
    WITH ads AS (SELECT id FROM ({IMPORTED}) WHERE NOT removed)
    SELECT list, term, count(*) AS documents FROM ({TYPEAHEAD_SQL}) JOIN ads ON id = doc_id
    GROUP BY 1, 2
""")
def dictionary_by_batches(spark, sf_dir):
    """Each batch takes back the terms of the ads it replaces and adds those of its own; a late
    answer adds its terms when it is patched in. The sums are what counting all ads gives."""
    main = _enriched_import(spark, sf_dir, fold_after=2)
    return snapshots.read_current(spark, imports.dictionary_path(main))
