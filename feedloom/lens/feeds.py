"""Feed, upsert, tombstone and snapshot queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom.lens import tables as t
from feedloom.lens.registry import query
from feedloom.operators.joins import lookup_join
from feedloom.operators import snapshot as s
from feedloom.plans import snapshots
from feedloom.session import fresh_path
from feedloom.sources import feed as f, landing

# The middle of the feed's month: what came before is the snapshot, what came after the change.
MIDDLE = 1705276800000


def _flat(df):
    return df.select("annonsId", "avpublicerad", F.col("uppdateradTid").alias("ms"), "seq")


@query("s1_feed_changes", f"""
    SELECT annonsId, avpublicerad, ms, seq FROM ({t.FEED_SQL}) WHERE ms > {MIDDLE}
""")
def feed_changes(spark, sf_dir):
    return _flat(f.feed_changes(t.feed(spark, sf_dir), MIDDLE))


@query("s1_feed_bootstrap", f"""
    SELECT annonsId, avpublicerad, ms, seq FROM ({t.FEED_SQL}) WHERE NOT avpublicerad
""")
def feed_bootstrap(spark, sf_dir):
    return _flat(f.feed_changes(t.feed(spark, sf_dir), 0))


@query("s2_attach_details", f"""
    SELECT CAST(annonsId AS VARCHAR) AS id, ms AS "updatedAt", c_mktsegment AS "expiresAt",
           c_name AS name
    FROM ({t.latest_sql()}) JOIN customer ON c_custkey = annonsId WHERE NOT avpublicerad
""")
def attach_details(spark, sf_dir):
    bodies = t.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("annonsId"), F.col("c_mktsegment").alias("sistaPubliceringsdatum"),
        F.col("c_name").alias("name"))
    rows = f.attach_details(f.batch_rows(t.feed(spark, sf_dir)), bodies)
    return rows.select("id", "updatedAt", "expiresAt", "name")


@query("s2_landed_bodies", f"""
    SELECT annonsId, ms AS "updatedAt", 'body ' || seq || ' of ' || c_name AS body
    FROM ({t.latest_sql(f"ms > {MIDDLE}")}) JOIN customer ON c_custkey = annonsId
    WHERE NOT avpublicerad
""")
def landed_bodies(spark, sf_dir):
    """Every change lands a body on its day; the changes of the second half of the month find
    theirs without reading the days before."""
    feed = t.feed(spark, sf_dir)
    customer = t.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("annonsId"), "c_name")
    bodies = lookup_join(feed, customer, "annonsId", "inner").select(
        "annonsId", F.struct("uppdateradTid", "seq").alias("version"),
        F.concat(F.lit("body "), "seq", F.lit(" of "), "c_name").alias("body"),
        F.timestamp_millis("uppdateradTid").cast("date").alias("day"))
    path = f.land_bodies(bodies, fresh_path(spark, "bodies"), 4, F.col("day"))
    raw = f.landed_bodies(
        spark, path, "annonsId bigint, version struct<uppdateradTid:bigint,seq:bigint>, body string")
    batch = f.batch_rows(feed.where(F.col("uppdateradTid") > MIDDLE))
    return f.attach_raw(batch, raw, buckets=4)


@query("s3_batch_dedup", f"""
    SELECT ms // 86400000 AS day, annonsId, avpublicerad, ms, seq FROM (
    {t.latest_sql(partition="annonsId, ms // 86400000")})
""")
def batch_dedup(spark, sf_dir):
    feed = t.feed(spark, sf_dir).withColumn("day", F.expr("uppdateradTid div 86400000"))
    rows = s.batch_dedup(feed, ["annonsId", "day"], ["uppdateradTid", "seq"])
    return rows.select("day", "annonsId", "avpublicerad", F.col("uppdateradTid").alias("ms"), "seq")


@query("s4_upsert_index", f"""
    SELECT annonsId, avpublicerad, ms, seq FROM ({t.latest_sql()})
""")
def upsert_index(spark, sf_dir):
    feed = t.feed(spark, sf_dir)
    before = f.batch_rows(feed.where(F.col("uppdateradTid") <= MIDDLE))
    after = f.batch_rows(feed.where(F.col("uppdateradTid") > MIDDLE))
    return _flat(s.upsert(before, after, "annonsId"))


LATE = "event_type IN ('purchase', 'error')"


@query("s4_upsert_newer", f"""
    SELECT coalesce(c.annonsId, o.annonsId) AS annonsId,
           CASE WHEN c.ms IS NULL OR o.ms > c.ms THEN o.ms ELSE c.ms END AS ms,
           CASE WHEN c.ms IS NULL OR o.ms > c.ms THEN o.seq ELSE c.seq END AS seq
    FROM ({t.latest_sql("NOT " + LATE)}) o FULL JOIN ({t.latest_sql(LATE)}) c
      ON o.annonsId = c.annonsId
""")
def upsert_newer(spark, sf_dir):
    feed = t.feed(spark, sf_dir)
    old, new = f.batch_rows(feed.where(f"NOT {LATE}")), f.batch_rows(feed.where(LATE))
    rows = s.upsert(old, new, "annonsId", newer_by="uppdateradTid")
    return rows.select("annonsId", F.col("uppdateradTid").alias("ms"), "seq")


@query("s5_document_key", """
    SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN p_type || '-' || p_partkey
                           ELSE 'P' || p_partkey END AS doc_key
    FROM part
""")
def document_key(spark, sf_dir):
    part = t.table(spark, sf_dir, "part").withColumn(
        "concept_id", F.when(F.col("p_type") != "PROMO", t.text("p_partkey", "P")))
    return part.select("p_partkey", s.document_key(["p_type", "p_partkey"]).alias("doc_key"))


@query("s6_route_tombstones", f"""
    WITH d AS ({t.DOCUMENTS_SQL})
    SELECT 'main' AS target, id, removed, timestamp, occupation_id,
           'N' || c_nationkey AS municipality_id,
           CASE WHEN NOT coalesce(removed, false) THEN headline END AS headline
    FROM d
    UNION ALL
    SELECT 'deleted', id, removed, timestamp, occupation_id, 'N' || c_nationkey, NULL
    FROM d WHERE removed
""")
def route_tombstones(spark, sf_dir):
    main, removed = s.route_tombstones(t.documents(spark, sf_dir))
    row = lambda target, occupation, headline: [
        F.lit(target).alias("target"), "id", "removed", "timestamp",
        occupation.alias("occupation_id"),
        F.col("workplace_address.municipality_concept_id").alias("municipality_id"),
        headline.alias("headline")]
    return main.select(*row("main", F.col("occupation")[0]["concept_id"], F.col("headline"))
                       ).unionByName(removed.select(*row(
                           "deleted", F.col("occupation.concept_id")[0],
                           F.lit(None).cast("string"))))


@query("s7_save_enriched", f"""
    SELECT id, headline, occupation_id, n_name AS municipality FROM ({t.DOCUMENTS_SQL})
""")
def save_enriched(spark, sf_dir):
    path = landing.save_enriched(t.documents(spark, sf_dir), fresh_path(spark, "saved"))
    return landing.load_enriched(spark, path).select(
        "id", "headline", F.col("occupation")[0]["concept_id"].alias("occupation_id"),
        F.col("workplace_address.municipality").alias("municipality"))


@query("s8_load_enriched", """
    SELECT CAST(o_orderkey AS VARCHAR) AS id,
           CASE WHEN o_orderstatus = 'O' THEN 'saved' ELSE 'current' END AS origin
    FROM orders
""")
def load_enriched(spark, sf_dir):
    ads = t.ads(spark, sf_dir).select("id", "removed")
    saved = ads.where("NOT removed").select("id", F.lit("saved").alias("origin"))
    path = landing.save_enriched(saved, fresh_path(spark, "saved"))
    current = ads.select("id", F.lit("current").alias("origin"))
    return landing.load_enriched(spark, path, current)


@query("j10_tombstone_enrich", f"""
    SELECT CAST(annonsId AS VARCHAR) AS id, ms AS timestamp, true AS removed,
           strftime(make_timestamp_ms(ms) + INTERVAL 1 HOUR, '%Y-%m-%dT%H:%M:%S') AS removed_date,
           CASE WHEN c_custkey IS NOT NULL THEN 'C' || c_custkey END AS occupation_id,
           n_name AS municipality_id
    FROM ({t.latest_sql()}) LEFT JOIN ({t.PLACES_SQL}) ON c_custkey = annonsId
         AND c_mktsegment <> 'BUILDING'
    WHERE avpublicerad
""")
def tombstone_enrich(spark, sf_dir):
    """Customers stand for the ads of the current snapshot; those in building are not in it."""
    entry = lambda c: F.array(F.struct(c.alias("concept_id")))
    known = t.places(spark, sf_dir).where("c_mktsegment <> 'BUILDING'").select(
        t.text("c_custkey").alias("id"), entry(t.text("c_custkey", "C")).alias("occupation"),
        entry(F.col("n_name")).alias("occupation_group"),
        entry(F.col("r_name")).alias("occupation_field"),
        F.struct(F.col("n_name").alias("municipality_concept_id"),
                 F.col("r_name").alias("region_concept_id"),
                 F.lit("SE").alias("country_concept_id")).alias("workplace_address"))
    gone = f.batch_rows(t.feed(spark, sf_dir)).where("avpublicerad")
    return s.tombstone_enrich(gone, known).select(
        "id", "timestamp", "removed", "removed_date",
        F.col("removed_ad_filter.occupation_concept_id")[0].alias("occupation_id"),
        F.col("removed_ad_filter.municipality_concept_id").alias("municipality_id"))


MISSING_SQL = """
    SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority FROM orders
    WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
"""


@query("j11_missing_ids", MISSING_SQL)
def missing_ids(spark, sf_dir):
    held = t.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    rows = s.missing_ids(t.table(spark, sf_dir, "orders"), held, "o_orderkey", unique=False)
    return rows.select(t.text("o_orderkey").alias("id"), "o_orderpriority")


@query("u3_id_difference", """
    SELECT CAST(user_id AS VARCHAR) AS id FROM events WHERE event_type <> 'error'
    EXCEPT SELECT CAST(s_suppkey AS VARCHAR) FROM supplier
""")
def id_difference(spark, sf_dir):
    held = t.table(spark, sf_dir, "supplier").select(t.text("s_suppkey").alias("id"))
    return s.missing_live_rows(t.feed(spark, sf_dir), held).select("id")


@query("j12_logo_resolve", """
    SELECT l_orderkey, l_linenumber, l_partkey,
           coalesce(CASE WHEN l_suppkey > 0 THEN w.url END, o.url) AS logo_url
    FROM lineitem
    LEFT JOIN (SELECT s_suppkey, 'logo/w/' || s_suppkey AS url FROM supplier WHERE s_acctbal > 5000) w
      ON l_suppkey = s_suppkey
    LEFT JOIN (SELECT p_partkey, 'logo/o/' || p_partkey AS url FROM part WHERE p_type = 'SMALL') o
      ON l_partkey = p_partkey
""")
def logo_resolve(spark, sf_dir):
    supplier, part = t.table(spark, sf_dir, "supplier"), t.table(spark, sf_dir, "part")
    logos = supplier.where("s_acctbal > 5000").select(
        F.lit("workplace").alias("kind"), t.text("s_suppkey").alias("key"),
        t.text("s_suppkey", "logo/w/").alias("url")).unionByName(
            part.where("p_type = 'SMALL'").select(
                F.lit("organisation").alias("kind"), t.text("p_partkey").alias("key"),
                t.text("p_partkey", "logo/o/").alias("url")))
    rows = f.logo_resolve(t.table(spark, sf_dir, "lineitem"), logos, t.text("l_suppkey"),
                          t.text("l_partkey"))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "logo_url")


# --- Counts and checks ---

@query("a1_last_timestamp", f"SELECT coalesce(max(ms), 0) AS last_timestamp FROM ({t.FEED_SQL})")
def last_timestamp(spark, sf_dir):
    return s.last_timestamp(t.feed(spark, sf_dir).withColumnRenamed("uppdateradTid", "timestamp"))


@query("a2_document_count", "SELECT count(*) AS documents FROM orders")
def document_count(spark, sf_dir):
    return s.document_count(t.ads(spark, sf_dir))


@query("a3_live_count", "SELECT count(*) AS live FROM orders WHERE o_orderstatus = 'O'")
def live_count(spark, sf_dir):
    return s.live_count(t.ads(spark, sf_dir))


@query("a4_size_gate", f"""
    WITH n AS (SELECT count(*) AS documents FROM ({t.latest_sql()})),
         c AS (SELECT count(*) AS live FROM orders WHERE o_orderstatus = 'O')
    SELECT documents, live, documents >= live * 0.8 AS passed FROM n, c
""")
def size_gate(spark, sf_dir):
    return s.size_gate(f.batch_rows(t.feed(spark, sf_dir)), t.ads(spark, sf_dir))


@query("a5_max_version", "SELECT max(p_size) AS max_version FROM part")
def max_version(spark, sf_dir):
    return s.max_version(t.table(spark, sf_dir, "part"), "p_size")


@query("a9_batch_stats", f"""
    SELECT ms // 86400000 AS day, count(*) AS imported, count(*) FILTER (NOT avpublicerad) AS live
    FROM ({t.FEED_SQL}) GROUP BY 1
""")
def batch_stats(spark, sf_dir):
    feed = t.feed(spark, sf_dir).withColumn("removed", F.col("avpublicerad")).withColumn(
        "day", F.expr("uppdateradTid div 86400000"))
    return s.batch_stats(feed, "day")


@query("o1_top_by_timestamp", f"""
    SELECT ms AS timestamp, seq FROM ({t.FEED_SQL}) ORDER BY ms DESC, seq LIMIT 1
""")
def top_by_timestamp(spark, sf_dir):
    feed = t.feed(spark, sf_dir).withColumnRenamed("uppdateradTid", "timestamp")
    return s.top_by_timestamp(feed, "timestamp", "seq")


AS_OF = "1998-06-01 12:34:56"
ACTIVE_SQL = f"""
    SELECT * FROM ({t.ADS_SQL})
    WHERE NOT removed AND date_trunc('minute', TIMESTAMP '{AS_OF}')
          BETWEEN publication_date AND last_publication_date
"""


@query("p11_active_ads", f"SELECT id, timestamp FROM ({ACTIVE_SQL})")
def active_ads(spark, sf_dir):
    as_of = F.lit(AS_OF).cast("timestamp_ntz")
    return s.active_ads(t.ads(spark, sf_dir), as_of).select("id", "timestamp")


@query("p17_missing_description",
       f"SELECT id, timestamp FROM ({ACTIVE_SQL}) WHERE coalesce(headline, '') = ''")
def missing_description(spark, sf_dir):
    as_of = F.lit(AS_OF).cast("timestamp_ntz")
    return s.missing_description(t.ads(spark, sf_dir), as_of, "headline").select("id", "timestamp")


NEW_YEAR = 915148800000


@query("p12_by_timestamp", f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS id FROM orders
    WHERE epoch_ms(o_orderdate) = {NEW_YEAR}
""")
def by_timestamp(spark, sf_dir):
    return s.ids_with_timestamp(t.ads(spark, sf_dir), NEW_YEAR)


@query("p12_by_id", f"SELECT id, timestamp, removed FROM ({t.ADS_SQL}) WHERE id = '7'")
def by_id(spark, sf_dir):
    return s.by_id(t.ads(spark, sf_dir), "7").select("id", "timestamp", "removed")


@query("p13_sink_null_values", f"""
    WITH d AS ({t.DOCUMENTS_SQL})
    SELECT 'main' AS target, id, coalesce(country_code, '199') AS country_code,
           coalesce(country_id, 'i46j_HmG_v64') AS country_id,
           epoch_ms(publication_date) AS shown_from, epoch_ms(last_publication_date) AS shown_to
    FROM d
    UNION ALL
    SELECT 'deleted', id, NULL, coalesce(country_id, 'i46j_HmG_v64'),
           epoch_ms(TIMESTAMP '1970-01-01'), epoch_ms(TIMESTAMP '2100-12-31')
    FROM d WHERE removed
""")
def sink_null_values(spark, sf_dir):
    """What the published names make of open values, on ads and on removed ads."""
    documents = t.documents(spark, sf_dir)
    row = lambda target, code: [
        F.lit(target).alias("target"), "id", code.alias("country_code"),
        F.col("workplace_address.country_concept_id").alias("country_id"),
        t.millis("publication_date").alias("shown_from"),
        t.millis("last_publication_date").alias("shown_to")]
    main = documents.selectExpr(*snapshots.shown_sql(documents.schema)).select(
        *row("main", F.col("workplace_address.country_code")))
    gone = s.tombstones(documents)
    deleted = gone.selectExpr(*snapshots.shown_sql(gone.schema, removed=True)).select(
        *row("deleted", F.lit(None).cast("string")))
    return main.unionByName(deleted)


@query("u4_stream_view", f"""
    WITH d AS ({t.DOCUMENTS_SQL})
    SELECT id, removed, occupation_id FROM d
    UNION ALL SELECT id, removed, occupation_id FROM d WHERE removed
""")
def stream_view(spark, sf_dir):
    main, removed = s.route_tombstones(t.documents(spark, sf_dir))
    return s.stream_view(main, removed).select(
        "id", "removed", F.col("occupation")[0]["concept_id"].alias("occupation_id"))
