"""Taxonomy queries: the given tables stand for the landed category extracts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from feedloom.lens import tables as t
from feedloom.lens.registry import query
from feedloom.operators import taxonomy as x
from feedloom.plans import taxonomy_runs as runs
from feedloom.session import fresh_path
from feedloom.sources import landing

# Category -> (table, key expression, {extract column: expression}). Written so that both engines
# read it; the key is the natural key, "Term" the label.
REGION = ("region", "r_regionkey", "r_name")
NATION = ("nation", "n_nationkey", "n_name")
CUSTOMER = ("customer", "c_custkey", "c_name")
SUPPLIER = ("supplier", "s_suppkey", "s_name")
PART = ("part", "p_partkey", "p_name")
SOURCES = {
    "job_terms": CUSTOMER, "job_groups": NATION, "job_fields": REGION, "places": SUPPLIER,
    "municipalities": NATION, "regions": REGION, "countries": SUPPLIER, "languages": SUPPLIER,
    "work_time_extent": PART, "skills": PART, "employment_types": SUPPLIER,
    "driving_licences": PART, "wage_types": CUSTOMER, "old_education_levels": SUPPLIER,
    "old_education_fields": PART,
    "education_field_1": REGION, "education_field_2": NATION, "education_field_3": SUPPLIER,
    "education_level_1": REGION, "education_level_2": NATION, "education_level_3": CUSTOMER,
    "durations": PART, "experience_years": SUPPLIER,
}
# Column of the table that holds the parent's key.
PARENT_KEYS = {NATION: "n_regionkey", CUSTOMER: "c_nationkey", SUPPLIER: "s_nationkey"}


def extract_columns(name: str) -> dict[str, str]:
    """Extract column -> expression over the table."""
    spec, source = x.BY_NAME[name], SOURCES[name]
    _, key, label = source
    if name == "places":
        return {"kommunkod": "'' || s_nationkey", "label": "s_name",
                "type": "CASE WHEN s_acctbal > 5000 THEN 'spot' END",
                "legacy_ams_taxonomy_id": "CASE WHEN s_acctbal > 8000 THEN 'own-' || s_suppkey END",
                "concept_id": "CASE WHEN s_acctbal < 0 THEN 'own' || s_suppkey END"}
    out = {spec.key: f"'' || {key}", spec.label: label}
    if spec.legacy:  # a code that is not the ID
        out[spec.legacy] = f"'' || ({key} + 100)"
    if spec.description and spec.description != spec.label:
        out[spec.description] = f"'about ' || {label}"
    if spec.parent_key:
        out[spec.parent_key] = f"'' || {PARENT_KEYS[source]}"
    for extra in spec.extra:
        out[extra] = f"'{extra[0]}' || {key}"
    return out


def extract(spark, sf_dir, name: str) -> DataFrame:
    table, key, _ = SOURCES[name]
    return t.table(spark, sf_dir, table).select(
        F.col(key).cast("long").alias("pos"),
        *[F.expr(e).alias(c) for c, e in extract_columns(name).items()])


def with_ids(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn("uuid_id", F.concat(F.lit(f"{name}-"), F.col("pos").cast("string")))


FLAT = ["legacy_id", "type", "label", "concept_id", "description", "num_id", "country_code",
        "eures", "parent_id"]


def flat(concepts: DataFrame) -> DataFrame:
    return concepts.select(
        F.col("legacy_ams_taxonomy_id").alias("legacy_id"), "type", "label", "concept_id",
        "description", F.col("legacy_ams_taxonomy_num_id").alias("num_id"), "country_code",
        F.col("EURESCode").alias("eures"), F.col("parent.concept_id").alias("parent_id"))


def flat_sql(name: str, uuid: str | None = None, parent_uuid: str | None = None,
             source: str | None = None) -> str:
    spec, columns = x.BY_NAME[name], extract_columns(name)
    table, key, label = SOURCES[name]
    uuid = uuid or f"'{name}-' || {key}"
    of = lambda c: columns[c] if c in columns else "CAST(NULL AS VARCHAR)"
    legacy, type_ = columns[spec.legacy_column], f"'{spec.type}'"
    if name == "places":
        slug = "translate(lower(s_name), 'åäö ', 'aao_')"
        legacy = f"coalesce({columns['legacy_ams_taxonomy_id']}, s_nationkey || '-' || {slug})"
        type_ = f"coalesce({columns['type']}, 'place')"
        uuid = f"coalesce({columns['concept_id']}, {uuid})"
    number = f"CAST({columns[spec.number]} AS INTEGER)" if spec.number else "CAST(NULL AS INTEGER)"
    parent = "CAST(NULL AS VARCHAR)"
    if spec.parent:
        parent = parent_uuid or f"'{spec.parent}-' || {PARENT_KEYS[SOURCES[name]]}"
    return f"""
    SELECT {legacy} AS legacy_id, {type_} AS type, {label} AS label, {uuid} AS concept_id,
           {of(spec.description)} AS description, {number} AS num_id,
           {of('CountryCode')} AS country_code, {of('EURESCode')} AS eures, {parent} AS parent_id
    FROM {source or table}
    """


def built(spark, sf_dir, names) -> dict[str, DataFrame]:
    """The named categories and whatever they hang on."""
    needed = set(names)
    while True:
        more = {x.BY_NAME[n].parent for n in needed} - {None}
        if more <= needed:
            break
        needed |= more
    return x.build_categories({n: with_ids(extract(spark, sf_dir, n), n) for n in needed})


GROUPS = {
    "x1_jobs": ["job_terms", "job_groups", "job_fields"],
    "x2_geo": ["places", "municipalities", "regions", "countries"],
    "x4_skills": ["skills"],
    "x5_work_time_extent": ["work_time_extent"],
    "x6_languages": ["languages"],
    "x7_employment_types": ["employment_types"],
    "x8_driving_licences": ["driving_licences"],
    "x9_wage_types": ["wage_types"],
    "x10_education_fields": ["education_field_1", "education_field_2", "education_field_3"],
    "x11_education_levels": ["education_level_1", "education_level_2", "education_level_3"],
    "x12_old_education_levels": ["old_education_levels"],
    "x13_old_education_fields": ["old_education_fields"],
    "x14_durations": ["durations"],
    "x15_experience_years": ["experience_years"],
}


# Written out by hand, so that a wrong entry in the list of categories does not pass unseen.
NONE = "CAST(NULL AS VARCHAR)"
BY_HAND = {
    "x1_jobs": f"""
        SELECT '' || c_custkey AS legacy_id, 'occupation-name' AS type, c_name AS label,
               'job_terms-' || c_custkey AS concept_id, {NONE} AS description,
               CAST(c_custkey AS INTEGER) AS num_id, {NONE} AS country_code, {NONE} AS eures,
               'job_groups-' || c_nationkey AS parent_id FROM customer
        UNION ALL SELECT '' || n_nationkey, 'occupation-group', n_name, 'job_groups-' || n_nationkey,
               'about ' || n_name, n_nationkey, NULL, NULL, 'job_fields-' || n_regionkey FROM nation
        UNION ALL SELECT '' || r_regionkey, 'occupation-field', r_name, 'job_fields-' || r_regionkey,
               'about ' || r_name, r_regionkey, NULL, NULL, NULL FROM region
    """,
    "x2_geo": f"""
        SELECT CASE WHEN s_acctbal > 8000 THEN 'own-' || s_suppkey
                    ELSE s_nationkey || '-' || translate(lower(s_name), 'åäö ', 'aao_') END AS legacy_id,
               CASE WHEN s_acctbal > 5000 THEN 'spot' ELSE 'place' END AS type, s_name AS label,
               CASE WHEN s_acctbal < 0 THEN 'own' ELSE 'places-' END || s_suppkey AS concept_id,
               {NONE} AS description, CAST(NULL AS INTEGER) AS num_id, {NONE} AS country_code,
               {NONE} AS eures, 'municipalities-' || s_nationkey AS parent_id FROM supplier
        UNION ALL SELECT '' || n_nationkey, 'municipality', n_name, 'municipalities-' || n_nationkey,
               NULL, n_nationkey, NULL, NULL, 'regions-' || n_regionkey FROM nation
        UNION ALL SELECT '' || r_regionkey, 'region', r_name, 'regions-' || r_regionkey,
               NULL, r_regionkey, NULL, NULL, NULL FROM region
        UNION ALL SELECT '' || s_suppkey, 'country', s_name, 'countries-' || s_suppkey,
               NULL, CAST(s_suppkey AS INTEGER), 'C' || s_suppkey, NULL, NULL FROM supplier
    """,
    "x10_education_fields": f"""
        SELECT '' || (r_regionkey + 100) AS legacy_id, 'sun-education-field-1' AS type,
               r_name AS label, 'education_field_1-' || r_regionkey AS concept_id,
               {NONE} AS description, r_regionkey + 100 AS num_id, {NONE} AS country_code,
               {NONE} AS eures, {NONE} AS parent_id FROM region
        UNION ALL SELECT '' || (n_nationkey + 100), 'sun-education-field-2', n_name,
               'education_field_2-' || n_nationkey, NULL, n_nationkey + 100, NULL, NULL,
               'education_field_1-' || n_regionkey FROM nation
        UNION ALL SELECT '' || (s_suppkey + 100), 'sun-education-field-3', s_name,
               'education_field_3-' || s_suppkey, NULL, CAST(s_suppkey AS INTEGER), NULL, NULL,
               'education_field_2-' || s_nationkey FROM supplier
    """,
    "x11_education_levels": f"""
        SELECT '' || (r_regionkey + 100) AS legacy_id, 'sun-education-level-1' AS type,
               r_name AS label, 'education_level_1-' || r_regionkey AS concept_id,
               {NONE} AS description, r_regionkey + 100 AS num_id, {NONE} AS country_code,
               {NONE} AS eures, {NONE} AS parent_id FROM region
        UNION ALL SELECT '' || (n_nationkey + 100), 'sun-education-level-2', n_name,
               'education_level_2-' || n_nationkey, NULL, n_nationkey + 100, NULL, NULL,
               'education_level_1-' || n_regionkey FROM nation
        UNION ALL SELECT '' || (c_custkey + 100), 'sun-education-level-3', c_name,
               'education_level_3-' || c_custkey, NULL, CAST(c_custkey + 100 AS INTEGER), NULL, NULL,
               'education_level_2-' || c_nationkey FROM customer
    """,
}


def _register_group(name: str, categories: list[str]) -> None:
    @query(name, BY_HAND.get(name, " UNION ALL ".join(flat_sql(c) for c in categories)))
    def run(spark, sf_dir):
        concepts = built(spark, sf_dir, categories)
        return reduce(DataFrame.unionByName, [flat(concepts[c]) for c in categories])


for _name, _categories in GROUPS.items():
    _register_group(_name, _categories)


@query("u1_all_concepts", " UNION ALL ".join(
    f"SELECT {i} AS ordinal, * FROM ({flat_sql(c.name)})" for i, c in enumerate(x.CATEGORIES)))
def all_concepts(spark, sf_dir):
    rows = x.all_concepts(built(spark, sf_dir, [c.name for c in x.CATEGORIES]))
    return rows.select("ordinal", *[c.alias(n) for n, c in zip(FLAT, [
        F.col("legacy_ams_taxonomy_id"), F.col("type"), F.col("label"), F.col("concept_id"),
        F.col("description"), F.col("legacy_ams_taxonomy_num_id"), F.col("country_code"),
        F.col("EURESCode"), F.col("parent_concept_id")])])


@query("u2_dict_dedup", """
    SELECT p_name, p_partkey, p_brand FROM part
    QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY p_partkey DESC) = 1
""")
def dict_dedup(spark, sf_dir):
    part = t.table(spark, sf_dir, "part").select("p_name", "p_partkey", "p_brand")
    return x.last_per_key(part, "p_name", "p_partkey")


@query("j13_hierarchy_build", """
    SELECT c_name AS label, n_name AS parent_label, r_name AS grandparent_label
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    UNION ALL
    SELECT s_name, n_name, r_name
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")
def hierarchy_build(spark, sf_dir):
    concepts = built(spark, sf_dir, ["job_terms", "places"])
    rows = concepts["job_terms"].unionByName(concepts["places"])
    return rows.select("label", F.col("parent.label").alias("parent_label"),
                       F.col("parent.parent.label").alias("grandparent_label"))


NUMBERED_SQL = """
    SELECT 0 AS ordinal, r_regionkey * 3 AS pos FROM region
    UNION ALL SELECT 1, n_nationkey FROM nation UNION ALL SELECT 2, s_suppkey FROM supplier
"""


@query("j14_concept_id_assign", f"""
    SELECT n.ordinal, CAST(n.pos AS BIGINT) AS pos, 'id' || o_orderkey AS uuid_id
    FROM (SELECT *, row_number() OVER (ORDER BY ordinal, pos) - 1 AS line_no
          FROM ({NUMBERED_SQL})) n
    LEFT JOIN orders ON o_orderkey = line_no
""")
def concept_id_assign(spark, sf_dir):
    parts = [("region", "r_regionkey", 3), ("nation", "n_nationkey", 1), ("supplier", "s_suppkey", 1)]
    rows = reduce(DataFrame.unionByName, [
        t.table(spark, sf_dir, name).select(
            F.lit(i).alias("ordinal"), (F.col(key) * step).cast("long").alias("pos"))
        for i, (name, key, step) in enumerate(parts)])
    return x.concept_id_assign(rows, ids(spark, sf_dir)).select("ordinal", "pos", "uuid_id")


def ids(spark, sf_dir) -> DataFrame:
    return t.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("line_no"), t.text("o_orderkey", "id").alias("id"))


def repeated(spark, sf_dir) -> DataFrame:
    """Concepts with repeated ids and repeated legacy ids: customers named after their nation."""
    return t.table(spark, sf_dir, "customer").select(
        t.text("c_nationkey", "N").alias("concept_id"), F.col("c_mktsegment").alias("type"),
        F.col("c_name").alias("label"), t.text("c_nationkey").alias("legacy_ams_taxonomy_id"),
        F.col("c_custkey").alias("pos"))


TO_LEGACY = """
    SELECT 'N' || c_nationkey AS concept_id, '' || c_nationkey AS legacy_id, c_mktsegment AS type,
           c_name AS label
    FROM customer QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey DESC) = 1
"""
TO_CONCEPT = """
    SELECT 'N' || c_nationkey AS concept_id, '' || c_nationkey AS legacy_id, c_mktsegment AS type,
           c_name AS label
    FROM customer
    QUALIFY row_number() OVER (PARTITION BY c_mktsegment, c_nationkey ORDER BY c_custkey DESC) = 1
"""


def _to_legacy(df):
    return df.select("concept_id", F.col("legacyAmsTaxonomyId").alias("legacy_id"), "type", "label")


def _to_concept(df):
    return df.select(F.col("conceptId").alias("concept_id"),
                     F.col("legacyAmsTaxonomyId").alias("legacy_id"), "type",
                     F.col("preferredTerm").alias("label"))


@query("a6_concept_to_legacy", TO_LEGACY)
def concept_to_legacy(spark, sf_dir):
    return _to_legacy(x.concept_to_legacy(repeated(spark, sf_dir), ["pos"]))


@query("a7_legacy_to_concept", TO_CONCEPT)
def legacy_to_concept(spark, sf_dir):
    return _to_concept(x.legacy_to_concept(repeated(spark, sf_dir), ["pos"]))


@query("s11_lookup_dumps", f"""
    SELECT 'to_legacy' AS dump, * FROM ({TO_LEGACY})
    UNION ALL SELECT 'to_concept', * FROM ({TO_CONCEPT})
""")
def lookup_dumps(spark, sf_dir):
    root = fresh_path(spark, "dumps")
    landing.write_lookup_dumps(repeated(spark, sf_dir), ["pos"], root)
    there, back = landing.read_lookup_dumps(spark, root)
    tagged = lambda df, name: df.select(F.lit(name).alias("dump"), "*")
    return tagged(_to_legacy(there), "to_legacy").unionByName(tagged(_to_concept(back), "to_concept"))


@query("s9_taxonomy_values", f"{flat_sql('skills')} UNION ALL {flat_sql('job_terms')}")
def taxonomy_values(spark, sf_dir):
    concepts = built(spark, sf_dir, ["skills", "job_terms"])
    path = fresh_path(spark, "values")
    x.all_concepts({n: concepts[n] for n in ("skills", "job_terms")}).write.parquet(path)
    return flat(landing.taxonomy_values(spark, path))


def land(spark, sf_dir, names) -> str:
    root = fresh_path(spark, "landed")
    for name in names:
        landing.land_json(extract(spark, sf_dir, name), f"{root}/{name}")
    return root


@query("s10_taxonomy_sources", " UNION ALL ".join(
    f"SELECT '{c.name}' AS category, CAST({SOURCES[c.name][1]} AS BIGINT) AS pos, "
    f"{extract_columns(c.name)[c.label]} AS label FROM {SOURCES[c.name][0]}" for c in x.CATEGORIES))
def taxonomy_sources(spark, sf_dir):
    names = [c.name for c in x.CATEGORIES]
    extracts = landing.read_extracts(spark, land(spark, sf_dir, names))
    return reduce(DataFrame.unionByName, [
        extracts[n].select(F.lit(n).alias("category"), "pos",
                           F.col(x.BY_NAME[n].label).alias("label")) for n in names])


@query("s12_replacement_source", t.SKILL_PAIRS_SQL)
def replacement_source(spark, sf_dir):
    pairs = t.skill_pairs(spark, sf_dir)
    entry = lambda i, label: F.struct(i.alias("concept_id"), label.alias("preferred_label"))
    path = landing.land_json(pairs.select(
        "list_pos", "concept_id", "preferred_label", F.array(
            entry(F.col("successor_id"), F.col("successor_label")),
            entry(F.lit("later"), F.lit("not used"))).alias("replaced_by")),
        fresh_path(spark, "replaced"))
    return landing.read_replacements(spark, path)


def _given_ids_sql() -> str:
    """Every concept with the id its place over all extracts, in id order, gives it."""
    rows = " UNION ALL ".join(
        f"SELECT '{n}' AS cat, {i} AS ordinal, CAST({SOURCES[n][1]} AS BIGINT) AS pos "
        f"FROM {SOURCES[n][0]}" for i, n in enumerate(x.ID_ORDER))
    given = f"""given AS (
        SELECT cat, pos, 'id' || o_orderkey AS uuid FROM (
            SELECT *, row_number() OVER (ORDER BY ordinal, pos) - 1 AS line_no FROM ({rows}))
        LEFT JOIN orders ON o_orderkey = line_no)"""
    parts = []
    for spec in x.CATEGORIES:
        table, key, _ = SOURCES[spec.name]
        source = f"{table} JOIN given g ON g.cat = '{spec.name}' AND g.pos = {key}"
        if spec.parent:
            source += (f" JOIN given h ON h.cat = '{spec.parent}' AND h.pos = "
                       f"{PARENT_KEYS[SOURCES[spec.name]]}")
        parts.append(flat_sql(spec.name, "g.uuid", "h.uuid", source))
    return f"WITH {given} " + " UNION ALL ".join(parts)


@query("r6_taxonomy_build", _given_ids_sql())
def taxonomy_build(spark, sf_dir):
    landed = land(spark, sf_dir, [c.name for c in x.CATEGORIES])
    landing.land_json(ids(spark, sf_dir), f"{landed}/ids")
    return flat(runs.taxonomy_build(spark, landed, fresh_path(spark, "taxonomy")))


@query("r5_taxonomy_publish", """
    SELECT 'current' AS name, 'P' || p_partkey AS concept_id, p_brand AS label FROM part
    UNION ALL SELECT 'archive', 'P' || p_partkey, p_name FROM part
""")
def taxonomy_publish(spark, sf_dir):
    """Two versions in turn: the second becomes current and the first is archived."""
    part = t.table(spark, sf_dir, "part")
    root = fresh_path(spark, "versions")
    name = "taxonomy_" + root.rsplit("-", 1)[1]
    rows = lambda label: part.select(
        t.text("p_partkey", "P").alias("concept_id"), F.col(label).alias("label"),
        F.lit(0).alias("ordinal"), F.col("p_partkey").alias("pos"))
    for label, versions in (("p_name", part.where("p_size < 10")), ("p_brand", part)):
        runs.taxonomy_publish(spark, rows(label), versions.select(F.col("p_size").alias("version")),
                              root, name)
    shown = lambda tag, view: spark.table(view).select(
        F.lit(tag).alias("name"), "concept_id", "label")
    return shown("current", name).unionByName(shown("archive", f"{name}_archive"))
