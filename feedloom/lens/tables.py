"""The given tables seen as what the library works on: feed, ads, mentions, taxonomy, candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from feedloom import settings
from feedloom.operators.joins import lookup_join, planned_bytes, small_side
from feedloom.operators.snapshot import FILTER_TYPE
from feedloom.session import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str, *keys: str) -> DataFrame:
    """A table whose rows take long to process."""
    return spread(table(spark, sf_dir, name), *keys)


def slices(spark: SparkSession, sf_dir: str, name: str, *keys: str) -> DataFrame:
    """A table from whose rows a task counts far more: each gets about so many bytes of the files."""
    rows = table(spark, sf_dir, name)
    most = planned_bytes(rows) // settings.SLICE_BYTES + 1
    return rows.repartition(max(most, spark.sparkContext.defaultParallelism), *keys)


def text(c: str, prefix: str = "") -> Column:
    value = F.col(c).cast("string")
    return F.concat(F.lit(prefix), value) if prefix else value


def millis(c: str) -> Column:
    """Epoch milliseconds of a time without a zone, read as UTC."""
    return F.unix_millis(F.col(c).cast("timestamp"))


# --- events: the change feed. One row is one change of the ad ``user_id``. ---

def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("annonsId"), (F.col("event_type") == "error").alias("avpublicerad"),
        millis("ts").alias("uppdateradTid"), F.lit(None).cast("string").alias("avpubliceringsdatum"),
        F.col("event_id").alias("seq"), "event_type")


FEED_SQL = """
    SELECT user_id AS annonsId, event_type = 'error' AS avpublicerad, epoch_us(ts) // 1000 AS ms,
           event_id AS seq, event_type
    FROM events
"""


def latest_sql(where: str = "true", partition: str = "annonsId") -> str:
    return f"""
    SELECT * FROM ({FEED_SQL}) WHERE {where}
    QUALIFY row_number() OVER (PARTITION BY {partition} ORDER BY ms DESC, seq DESC) = 1
    """


# --- customer under nation under region: occupations under groups under fields ---

ENTRY = "struct<concept_id:string,label:string,legacy_ams_taxonomy_id:string"
PARENT_TYPE = f"{ENTRY},parent:{ENTRY}>>"


def occupations(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    groups = lookup_join(nation.withColumnRenamed("n_regionkey", "r_regionkey"), region,
                         "r_regionkey")
    entry = lambda i, p, label, *more: F.struct(
        text(i, p).alias("concept_id"), F.col(label).alias("label"),
        text(i).alias("legacy_ams_taxonomy_id"), *more)
    parents = groups.select(F.col("n_nationkey").alias("c_nationkey"), entry(
        "n_nationkey", "N", "n_name", entry("r_regionkey", "R", "r_name").alias("parent")
    ).cast(PARENT_TYPE).alias("parent"))
    return lookup_join(table(spark, sf_dir, "customer"), parents, "c_nationkey").select(
        text("c_custkey", "C").alias("concept_id"), F.lit("occupation-name").alias("type"),
        F.col("c_name").alias("label"), text("c_custkey").alias("legacy_ams_taxonomy_id"), "parent")


def _plain(df: DataFrame, key: str, prefix: str, label: str, type_: str) -> DataFrame:
    return df.select(
        text(key, prefix).alias("concept_id"), F.lit(type_).alias("type"),
        F.col(label).alias("label"), text(key).alias("legacy_ams_taxonomy_id"),
        F.lit(None).cast(PARENT_TYPE).alias("parent"))


def skills(spark: SparkSession, sf_dir: str, type_: str = "skill") -> DataFrame:
    """Parts as skills. Promotional parts are missing from the taxonomy, so some lookups fail."""
    known = table(spark, sf_dir, "part").where(F.col("p_type") != "PROMO")
    return _plain(known, "p_partkey", "P", "p_name", type_)


SKILLS_SQL = """
    SELECT 'P' || p_partkey AS concept_id, p_name AS label,
           CAST(p_partkey AS VARCHAR) AS legacy_ams_taxonomy_id
    FROM part WHERE p_type <> 'PROMO'
"""


def concepts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Occupations, skills, languages (region), municipalities (nation) and licences (supplier)."""
    of = lambda name: table(spark, sf_dir, name)
    return (
        occupations(spark, sf_dir)
        .unionByName(skills(spark, sf_dir))
        .unionByName(_plain(of("region"), "r_regionkey", "R", "r_name", "language"))
        .unionByName(_plain(of("nation"), "n_nationkey", "N", "n_name", "municipality"))
        .unionByName(_plain(of("nation"), "n_nationkey", "E", "n_name", "sun-education-field-3"))
        .unionByName(_plain(of("region"), "r_regionkey", "E", "r_name", "sun-education-field-1"))
        .unionByName(_plain(of("supplier"), "s_suppkey", "D", "s_name", "driving-licence")))


# --- replaced-by pairs ---

def skill_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every economy part is replaced by the part after it."""
    part = table(spark, sf_dir, "part").where(F.col("p_type") == "ECONOMY")
    return part.select(
        F.col("p_partkey").cast("int").alias("list_pos"), text("p_partkey", "P").alias("concept_id"),
        F.col("p_name").alias("preferred_label"),
        F.concat(F.lit("P"), (F.col("p_partkey") + 1).cast("string")).alias("successor_id"),
        F.concat(F.lit("after "), "p_name").alias("successor_label"))


SKILL_PAIRS_SQL = """
    SELECT CAST(p_partkey AS INTEGER) AS list_pos, 'P' || p_partkey AS concept_id,
           p_name AS preferred_label, 'P' || (p_partkey + 1) AS successor_id,
           'after ' || p_name AS successor_label
    FROM part WHERE p_type = 'ECONOMY'
"""


def occupation_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every machinery customer is replaced by the customer after it."""
    customer = table(spark, sf_dir, "customer").where(F.col("c_mktsegment") == "MACHINERY")
    return customer.select(
        F.col("c_custkey").cast("int").alias("list_pos"), text("c_custkey", "C").alias("concept_id"),
        F.col("c_name").alias("preferred_label"),
        F.concat(F.lit("C"), (F.col("c_custkey") + 1).cast("string")).alias("successor_id"),
        F.concat(F.lit("after "), "c_name").alias("successor_label"))


OCCUPATION_PAIRS_SQL = """
    SELECT CAST(c_custkey AS INTEGER) AS list_pos, 'C' || c_custkey AS concept_id,
           c_name AS preferred_label, 'C' || (c_custkey + 1) AS successor_id,
           'after ' || c_name AS successor_label
    FROM customer WHERE c_mktsegment = 'MACHINERY'
"""


# --- lineitem: weighted mentions of skills, and enrichment candidates ---

def mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", text("l_partkey", "P").alias("concept_id"),
        F.expr("nullif(l_quantity, 25D)").alias("weight"))


MENTIONS_SQL = """
    SELECT l_orderkey, l_linenumber, l_suppkey, 'P' || l_partkey AS concept_id,
           nullif(l_quantity, 25) AS weight
    FROM lineitem
"""


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = F.array(*[F.lit(k) for k in ("occupations", "competencies", "traits", "geos")])
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), "p_name", "p_type")
    return lookup_join(table(spark, sf_dir, "lineitem"), part, "l_partkey", "inner").select(
        text("l_orderkey").alias("doc_id"),
        F.get(kinds, (F.col("l_suppkey") % 4).cast("int")).alias("type"),
        F.initcap("p_name").alias("concept_label"), F.col("p_type").alias("term"),
        (F.col("l_linestatus") == "O").alias("term_misspelled"),
        (F.col("l_quantity") / 50).alias("prediction"),
        (F.col("l_linenumber") - 1).alias("sentence_index"))


CANDIDATES_SQL = """
    SELECT CAST(l_orderkey AS VARCHAR) AS doc_id,
           CASE l_suppkey % 4 WHEN 0 THEN 'occupations' WHEN 1 THEN 'competencies'
                WHEN 2 THEN 'traits' ELSE 'geos' END AS type,
           CASE l_suppkey % 4 WHEN 0 THEN 'occupation' WHEN 1 THEN 'skill'
                WHEN 2 THEN 'trait' ELSE 'location' END AS list,
           p_name AS concept_label, p_type AS term, l_linestatus = 'O' AS term_misspelled,
           l_quantity / 50 AS prediction, l_linenumber - 1 AS sentence_index
    FROM lineitem JOIN part ON l_partkey = p_partkey
"""
KEPT_CANDIDATES_SQL = f"""
    SELECT * FROM ({CANDIDATES_SQL})
    WHERE prediction >= CASE type WHEN 'occupations' THEN 0.8 WHEN 'competencies' THEN 0.5
                                  WHEN 'traits' THEN 0.5 ELSE 0.7 END
       OR (type IN ('occupations', 'geos') AND sentence_index = 0)
"""


# --- orders: ads. Status F is removed, O is live and P does not say. ---

REMOVED = "CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END"


def ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slim ads without lookups; a day short of 13 weeks on show."""
    return table(spark, sf_dir, "orders").select(
        text("o_orderkey").alias("id"), F.expr(REMOVED).alias("removed"),
        millis("o_orderdate").alias("timestamp"), F.col("o_orderdate").alias("publication_date"),
        (F.col("o_orderdate") + F.expr("INTERVAL '90' DAY")).alias("last_publication_date"),
        F.expr("CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN '' WHEN '5-LOW' THEN NULL "
               "ELSE o_orderpriority END").alias("headline"), "o_custkey", "o_orderpriority")


ADS_SQL = f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS id, {REMOVED} AS removed,
           epoch_ms(o_orderdate) AS timestamp, o_orderdate AS publication_date,
           o_orderdate + INTERVAL 90 DAY AS last_publication_date,
           CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN '' WHEN '5-LOW' THEN NULL
                ELSE o_orderpriority END AS headline,
           o_custkey, o_orderpriority
    FROM orders
"""


def places(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    """customer, or rows that hold its columns, with the names of nation and region."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    where = nation.join(small_side(region), F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("c_nationkey"), "n_name", "r_regionkey", "r_name")
    who = table(spark, sf_dir, "customer") if rows is None else rows
    return lookup_join(who, where, "c_nationkey", "inner")


PLACES_SQL = """
    SELECT c_custkey, c_name, c_nationkey, c_mktsegment, n_name, r_regionkey, r_name
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ads with an occupation and an address, in the shape snapshots hold."""
    who = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey")
    joined = places(spark, sf_dir, lookup_join(ads(spark, sf_dir), who, "o_custkey", "inner"))
    one = lambda c, p, label: F.array(F.struct(
        text(c, p).alias("concept_id"), F.col(label).alias("label"),
        F.lit(None).cast("string").alias("legacy_ams_taxonomy_id")))
    known_country = F.expr("o_orderpriority <> '1-URGENT'")
    return joined.select(
        "id", "headline", "removed", "timestamp", "publication_date", "last_publication_date",
        F.when(F.col("removed"), F.col("last_publication_date")).alias("removed_date"),
        one("o_custkey", "C", "c_name").alias("occupation"),
        one("c_nationkey", "N", "n_name").alias("occupation_group"),
        one("r_regionkey", "R", "r_name").alias("occupation_field"),
        F.struct(
            text("c_nationkey", "N").alias("municipality_concept_id"),
            F.col("n_name").alias("municipality"),
            text("r_regionkey", "R").alias("region_concept_id"), F.col("r_name").alias("region"),
            F.when(known_country, text("r_regionkey")).alias("country_code"),
            F.when(known_country, text("r_regionkey", "L")).alias("country_concept_id"),
            F.lit("Sverige").alias("country"), F.col("c_mktsegment").alias("city"),
        ).alias("workplace_address"),
        F.struct(F.concat(F.lit("<p>"), "o_orderpriority", F.lit("</p>")).alias("text_formatted"),
                 F.col("headline").alias("text")).alias("description"),
        F.struct(
            F.array(text("o_custkey", "C")).alias("occupation_concept_id"),
            F.array(text("r_regionkey", "R")).alias("occupation_field_concept_id"),
            F.array(text("c_nationkey", "N")).alias("occupation_group_concept_id"),
            text("c_nationkey", "N").alias("municipality_concept_id"),
            text("r_regionkey", "R").alias("region_concept_id"),
            F.when(known_country, text("r_regionkey", "L")).alias("country_concept_id"),
        ).cast(FILTER_TYPE).alias("removed_ad_filter"))


DOCUMENTS_SQL = f"""
    SELECT a.*, p.*, 'C' || o_custkey AS occupation_id, 'N' || c_nationkey AS group_id,
           'R' || r_regionkey AS field_id,
           CASE WHEN o_orderpriority <> '1-URGENT' THEN CAST(r_regionkey AS VARCHAR) END
               AS country_code,
           CASE WHEN o_orderpriority <> '1-URGENT' THEN 'L' || r_regionkey END AS country_id
    FROM ({ADS_SQL}) a JOIN ({PLACES_SQL}) p ON o_custkey = c_custkey
"""
