"""Lookup, replaced-by, occupation and requirement queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom.functions import requirements as r, text as x
from feedloom.lens import tables as t
from feedloom.lens.registry import query
from feedloom.plans import snapshots
from feedloom.operators import lookup as l, replacements as p

RESOLVED_SQL = f"""
    SELECT m.*, c.concept_id AS found_id, c.label, c.legacy_ams_taxonomy_id AS legacy_id
    FROM ({t.MENTIONS_SQL}) m LEFT JOIN ({t.SKILLS_SQL}) c USING (concept_id)
"""
KEYS = ["l_orderkey", "l_linenumber", "l_suppkey"]
KEYS_SQL = ", ".join(KEYS)


def _entry(c="concept"):
    return [F.col(f"{c}.concept_id").alias("found_id"), F.col(f"{c}.label").alias("label"),
            F.col(f"{c}.legacy_ams_taxonomy_id").alias("legacy_id")]


@query("j1_concept_lookup", f"SELECT {KEYS_SQL}, found_id, label, legacy_id FROM ({RESOLVED_SQL})")
def concept_lookup(spark, sf_dir):
    rows = l.concept_lookup(t.mentions(spark, sf_dir), t.skills(spark, sf_dir), "skill",
                            F.col("concept_id"))
    return rows.select(*KEYS, *_entry())


@query("j2_legacy_lookup", f"""
    SELECT {KEYS_SQL}, concept_id AS found_id, p_name AS label, legacy_ams_taxonomy_id AS legacy_id
    FROM lineitem LEFT JOIN (SELECT *, label AS p_name FROM ({t.SKILLS_SQL}))
      ON legacy_ams_taxonomy_id = CAST(l_partkey AS VARCHAR)
""")
def legacy_lookup(spark, sf_dir):
    rows = l.legacy_lookup(t.table(spark, sf_dir, "lineitem"), t.skills(spark, sf_dir), "skill",
                           t.text("l_partkey"))
    return rows.select(*KEYS, *_entry())


@query("j3_term_lookup", """
    SELECT o_orderkey, c_name AS term FROM orders LEFT JOIN customer ON o_custkey = c_custkey
""")
def term_lookup(spark, sf_dir):
    rows = l.term_lookup(t.table(spark, sf_dir, "orders"), t.occupations(spark, sf_dir),
                         "occupation-name", t.text("o_custkey"))
    return rows.select("o_orderkey", "term")


@query("j4_label_lookup", f"""
    WITH f AS (SELECT lower(label) AS label, min(concept_id) AS found_id
               FROM ({t.SKILLS_SQL}) GROUP BY 1)
    SELECT p_partkey, found_id FROM part LEFT JOIN f ON lower(p_name) = label
""")
def label_lookup(spark, sf_dir):
    rows = l.label_lookup(t.table(spark, sf_dir, "part"), t.skills(spark, sf_dir),
                          F.upper("p_name"), "skill")
    return rows.select("p_partkey", F.col("concept.concept_id").alias("found_id"))


@query("j4_label_lookup_any_type", """
    SELECT n_nationkey, CASE WHEN contains(n_name, '_1') THEN 'N' || n_nationkey END AS found_id
    FROM nation
""")
def label_lookup_any_type(spark, sf_dir):
    nations = t.table(spark, sf_dir, "nation")
    known = t._plain(nations.where("contains(n_name, '_1')"), "n_nationkey", "N", "n_name",
                     "municipality")
    rows = l.label_lookup(nations, known, F.lower("n_name"))
    return rows.select("n_nationkey", F.col("concept.concept_id").alias("found_id"))


@query("j5_weighted_concepts", f"""
    SELECT {KEYS_SQL}, found_id AS concept_id, label, legacy_id AS legacy_ams_taxonomy_id, weight
    FROM ({RESOLVED_SQL})
""")
def weighted_concepts(spark, sf_dir):
    return l.weighted_concepts(t.mentions(spark, sf_dir), t.skills(spark, sf_dir))


@query("j6_coded_value", """
    SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN c_name END AS label,
           CASE WHEN o_orderpriority <> '5-LOW' THEN 'C' || c_custkey END AS found_id
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey
""")
def coded_value(spark, sf_dir):
    code = F.when(F.col("o_orderpriority") == "5-LOW", "").otherwise(t.text("o_custkey", "C"))
    rows = l.coded_value(t.table(spark, sf_dir, "orders"), t.occupations(spark, sf_dir),
                         "occupation-name", code, "concept")
    return rows.select("o_orderkey", F.col("concept.label").alias("label"),
                       F.col("concept.concept_id").alias("found_id"))


@query("j7_driving_licences", f"""
    SELECT {KEYS_SQL}, found_id AS concept_id, label, legacy_id AS legacy_ams_taxonomy_id
    FROM ({RESOLVED_SQL}) WHERE found_id IS NOT NULL
""")
def driving_licences(spark, sf_dir):
    licences = t.skills(spark, sf_dir, "driving-licence")
    return l.known_concepts(t.mentions(spark, sf_dir).drop("weight"), licences)


EQUIVALENT_SQL = f"""
    SELECT concept_id AS for_id, list_pos, successor_id AS added_id, successor_label AS added_label,
           true AS new_version FROM ({t.SKILL_PAIRS_SQL})
    UNION ALL
    SELECT successor_id, list_pos, concept_id, preferred_label, false FROM ({t.SKILL_PAIRS_SQL})
    WHERE successor_id <> concept_id
"""


@query("j8_replaced_by_expand", f"""
    SELECT {KEYS_SQL}, concept_id, list_pos, added_id, added_label, new_version
    FROM ({t.MENTIONS_SQL}) JOIN ({EQUIVALENT_SQL}) ON concept_id = for_id
""")
def replaced_by_expand(spark, sf_dir):
    rows = p.replaced_by_expand(t.mentions(spark, sf_dir), t.skill_pairs(spark, sf_dir))
    return rows.select(*KEYS, "concept_id", "list_pos", "added_id", "added_label", "new_version")


@query("j9_occupation_hierarchy", f"""
    WITH names AS (
        SELECT 'C' || c_custkey AS concept_id, c_name AS label, c_custkey AS k,
               'N' || c_nationkey AS group_id, n_name AS group_label,
               'R' || r_regionkey AS field_id, r_name AS field_label
        FROM ({t.PLACES_SQL})),
    pairs AS ({t.OCCUPATION_PAIRS_SQL}),
    newer AS (SELECT p.concept_id, n.group_id, n.group_label, n.field_id, n.field_label
              FROM pairs p JOIN names n ON p.successor_id = n.concept_id),
    cards AS (SELECT n.concept_id, n.label, coalesce(w.group_id, n.group_id) AS group_id,
                     coalesce(w.group_label, n.group_label) AS group_label,
                     coalesce(w.field_id, n.field_id) AS field_id,
                     coalesce(w.field_label, n.field_label) AS field_label
              FROM names n LEFT JOIN newer w USING (concept_id)),
    listed AS (
        SELECT concept_id AS for_id, 'occupation' AS kind, 0 AS pos, concept_id, label FROM cards
        UNION ALL SELECT concept_id, 'occupation_group', 0, group_id, group_label FROM cards
        UNION ALL SELECT concept_id, 'occupation_field', 0, field_id, field_label FROM cards
        UNION ALL SELECT n.concept_id, 'occupation', list_pos + 1, successor_id, successor_label
                  FROM pairs p JOIN names n USING (concept_id)
        UNION ALL SELECT n.concept_id, 'occupation', list_pos + 1, p.concept_id, preferred_label
                  FROM pairs p JOIN names n ON n.concept_id = p.successor_id)
    SELECT o_orderkey, kind, pos, concept_id, label
    FROM orders JOIN listed ON for_id = 'C' || o_custkey
""")
def occupation_hierarchy(spark, sf_dir):
    ads = t.table(spark, sf_dir, "orders").select(
        "o_orderkey", t.text("o_custkey", "C").alias("concept_id"))
    rows = p.occupation_hierarchy(ads, t.occupations(spark, sf_dir),
                                  t.occupation_pairs(spark, sf_dir))
    return rows.select("o_orderkey", "kind", "pos", "concept_id", "label")


# --- Requirements ---

@query("p5_weight_split", f"""
    SELECT {KEYS_SQL}, concept_id, weight,
           CASE WHEN coalesce(weight, 0) >= 10 THEN 'must_have' ELSE 'nice_to_have' END AS side
    FROM ({t.MENTIONS_SQL})
""")
def weight_split(spark, sf_dir):
    side = F.when(r.is_must(F.col("weight")), "must_have").otherwise("nice_to_have")
    return t.mentions(spark, sf_dir).withColumn("side", side)


@query("requirements_per_ad", f"""
    SELECT l_orderkey AS ad_id,
           count(*) FILTER (coalesce(weight, 0) >= 10) AS must,
           count(*) FILTER (coalesce(weight, 0) < 10) AS nice,
           count(found_id) AS known, min(label) AS first_label
    FROM ({RESOLVED_SQL}) GROUP BY 1
""")
def requirements_per_ad(spark, sf_dir):
    """Lookup, split and count in one pass; counts are merged before they are shuffled."""
    found = l.weighted_concepts(t.mentions(spark, sf_dir), t.skills(spark, sf_dir))
    return found.groupBy(F.col("l_orderkey").alias("ad_id")).agg(
        F.count_if(r.is_must(F.col("weight"))).alias("must"),
        F.count_if(~r.is_must(F.col("weight"))).alias("nice"),
        F.count("concept_id").alias("known"),
        # A set per ad keeps this a hash aggregate; the least of strings alone would sort twice.
        F.array_min(F.collect_set("label")).alias("first_label"))


HOURS = {"1-URGENT": "6YE1_gAC_R2G", "2-HIGH": "947z_JGS_Uk2", "3-MEDIUM": "hGCt_6Ni_XPz"}


@query("p3_scope_defaults", """
    SELECT o_orderkey,
           CASE WHEN o_orderpriority = '1-URGENT' THEN 100.0::DOUBLE
                WHEN o_orderpriority IN ('2-HIGH', '3-MEDIUM') THEN 0.0::DOUBLE END AS scope_min,
           CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
                THEN 100.0::DOUBLE END AS scope_max
    FROM orders
""")
def scope_defaults(spark, sf_dir):
    hours = F.lit(None).cast("string")
    for priority, concept in HOURS.items():
        hours = F.when(F.col("o_orderpriority") == priority, concept).otherwise(hours)
    least, most = r.scope_default(hours)
    return t.table(spark, sf_dir, "orders").select(
        "o_orderkey", least.alias("scope_min"), most.alias("scope_max"))


@query("p7_contacts", """
    SELECT c_custkey,
           nullif(trim(coalesce(first_name, '') || ' ' || coalesce(last_name, '')), '') AS name,
           nullif(trim(coalesce(phone, '') || ', ' || coalesce(mobile, ''), ', '), '') AS telephone,
           CASE WHEN union_rep THEN 'Facklig representant' ELSE c_mktsegment END AS "contactType"
    FROM (SELECT *, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS first_name,
                 CASE WHEN c_acctbal > 3000 THEN c_name END AS last_name,
                 CASE WHEN c_acctbal < 5000 THEN CAST(c_nationkey AS VARCHAR) END AS phone,
                 CASE WHEN c_mktsegment = 'MACHINERY' THEN CAST(c_custkey AS VARCHAR) END AS mobile,
                 CASE WHEN c_nationkey < 12 THEN c_nationkey < 5 END AS union_rep
          FROM customer)
""")
def contacts(spark, sf_dir):
    person = F.expr("""named_struct(
        'fornamn', CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END,
        'efternamn', CASE WHEN c_acctbal > 3000 THEN c_name END,
        'befattning', c_mktsegment, 'beskrivning', CAST(NULL AS STRING),
        'epost', CAST(NULL AS STRING),
        'telefonnummer', CASE WHEN c_acctbal < 5000 THEN CAST(c_nationkey AS STRING) END,
        'mobilnummer', CASE WHEN c_mktsegment = 'MACHINERY' THEN CAST(c_custkey AS STRING) END,
        'fackligRepresentant', CASE WHEN c_nationkey < 12 THEN c_nationkey < 5 END)""")
    listed = t.table(spark, sf_dir, "customer").select(
        "c_custkey", r.contacts(F.array(person)).alias("contacts"))
    return listed.select("c_custkey", F.inline("contacts")).select(
        "c_custkey", "name", "telephone", "contactType")


@query("p14_geo_validity", """
    SELECT c_custkey,
           CASE WHEN lon BETWEEN -180 AND 180 AND lat BETWEEN -90 AND 90 THEN lon END AS lon,
           CASE WHEN lon BETWEEN -180 AND 180 AND lat BETWEEN -90 AND 90 THEN lat END AS lat
    FROM (SELECT c_custkey, c_acctbal / 25 AS lon, c_nationkey * 9.0::DOUBLE - 100 AS lat
          FROM customer)
""")
def geo_validity(spark, sf_dir):
    """Points as the published names show them."""
    point = F.array(F.col("c_acctbal") / 25, F.col("c_nationkey") * F.lit(9.0) - 100)
    ads = t.table(spark, sf_dir, "customer").select(
        "c_custkey", F.struct(point.alias("coordinates")).alias("workplace_address"))
    shown = ads.selectExpr(*snapshots.shown_sql(ads.schema))
    place = lambda i: F.get("workplace_address.coordinates", F.lit(i))
    return shown.select("c_custkey", place(0).alias("lon"), place(1).alias("lat"))


ORG_SQL = """CASE WHEN c_mktsegment = 'BUILDING' THEN '19' ELSE '' END ||
             reverse(substr(c_name, 10)) || CASE WHEN c_acctbal > 0 THEN '0' ELSE '' END"""


@query("p9_mask_org_number", f"""
    SELECT c_custkey,
           CASE WHEN length(trim(org)) <= 9 THEN org
                WHEN regexp_matches(substr(org, CASE WHEN length(org) = 12 THEN 5 ELSE 3 END, 1),
                                    '^[2-9]$') THEN org END AS org_number
    FROM (SELECT c_custkey, {ORG_SQL} AS org FROM customer)
""")
def mask_org_number(spark, sf_dir):
    return t.table(spark, sf_dir, "customer").select(
        "c_custkey", x.mask_org_number(F.expr(ORG_SQL)).alias("org_number"))


@query("k11_null_safe", f"SELECT id, coalesce(headline, 'none') AS headline FROM ({t.ADS_SQL})")
def null_safe(spark, sf_dir):
    return t.ads(spark, sf_dir).select("id", x.null_safe(F.col("headline"), "none").alias("headline"))
