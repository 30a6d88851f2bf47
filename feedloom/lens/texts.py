"""Text, date, keyword, candidate and token queries. All of them take whole texts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from feedloom.functions import dates, html, text as x, tokens as k
from feedloom.lens import tables as t
from feedloom.lens.registry import query
from feedloom.plans import snapshots
from feedloom.operators import candidates as c, keywords as w, tokens as o

# White space as the library sees it, for an engine whose \s is ASCII.
SPACE = (r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}"
         r"\x{205f}\x{3000}]")
WORD = r"[\p{L}\p{N}_]"


def strip_sql(c_: str) -> str:
    return f"regexp_replace(regexp_replace({c_}, '^{SPACE}+', ''), '{SPACE}+$', '')"


def words_sql(c_: str) -> str:
    return f"list_filter(regexp_split_to_array({c_}, '{SPACE}+'), lambda w: w <> '')"


PHRASES = ["license", "and the", ". src1", "remote work"]


@query("p2_remote_work", f"""
    SELECT doc_id, {" OR ".join(f"contains(lower(text || ' ' || source), '{p}')" for p in PHRASES)}
           AS remote
    FROM documents
""")
def remote_work(spark, sf_dir):
    flag = x.remote_work(F.col("text"), F.col("source"), PHRASES)
    return t.texts(spark, sf_dir, "documents", "doc_id").select("doc_id", flag.alias("remote"))


@query("p10_strip_nul", """
    SELECT doc_id, length(text) AS plain_length, md5(text) AS plain_md5, md5(text) AS json_md5
    FROM documents
""")
def strip_nul(spark, sf_dir):
    """NULs put behind every e, as they are and as JSON escapes, are removed again."""
    spoilt = F.replace("text", F.lit("e"), F.lit("e\0"))
    plain = x.strip_nul(spoilt)
    body = x.strip_nul_json(F.to_json(F.struct(spoilt.alias("text"))))
    parsed = F.from_json(body, "text string")["text"]
    return t.texts(spark, sf_dir, "documents", "doc_id").select(
        "doc_id", F.length(plain).cast("long").alias("plain_length"),
        F.md5(plain).alias("plain_md5"), F.md5(parsed).alias("json_md5"))


@query("p15_keyword_cap", """
    SELECT doc_id, CASE WHEN length(text) <= 256 THEN text END AS keyword FROM documents
""")
def keyword_cap(spark, sf_dir):
    """Keywords as the published names show them: over-long ones are left out."""
    ads = t.texts(spark, sf_dir, "documents", "doc_id").select(
        "doc_id", F.struct(F.array("text").alias("texts")).alias("keywords"))
    return ads.selectExpr(*snapshots.shown_sql(ads.schema)).select(
        "doc_id", F.get("keywords.texts", F.lit(0)).alias("keyword"))


@query("k1_clean_html")
def clean_html(spark, sf_dir):
    return t.texts(spark, sf_dir, "pages", "page_id").select(
        "page_id", html.clean_html(F.col("html")).alias("text"))


# How a page is put together from a name and a segment, and what its text then is.
COMPOSED = {
    "'<p>' || c_name || '</p><p>' || c_mktsegment || '</p>'": "c_name || nl || c_mktsegment",
    "'<div><p>' || c_name || '<p>' || c_mktsegment || '</p>end</div>'":
        "c_name || nl || c_mktsegment || nl || 'end'",
    "c_name || '<br>' || c_mktsegment || '<br/>end'":
        "c_name || nl || c_mktsegment || nl || 'end'",
    "'<ul><li>' || c_name || '</li><li>' || c_mktsegment || '</li></ul>end'":
        "c_name || nl || c_mktsegment || nl || 'end'",
    "'<script>var x = \"</p>\"</script>' || c_name || '<style>p {}</style>' || c_mktsegment":
        "c_name || c_mktsegment",
    "'<h4>' || c_name || '</h4>' || c_mktsegment || ' &amp; &lt;' || c_nationkey || '&gt; &#229;'":
        "c_name || nl || c_mktsegment || ' & <' || c_nationkey || '> å'",
    "'<b>' || c_name || '</b><!-- p --><p>' || c_mktsegment || '<i>x</i>'":
        "c_name || nl || c_mktsegment || 'x'",
    "'<div><div><h1>' || c_name || '</h3><pre>' || c_mktsegment || '</pre>'":
        "c_name || c_mktsegment",
    "'  ' || c_name || '  '": "c_name",
}


def _composed(values) -> str:
    cases = " ".join(f"WHEN {i} THEN {sql}" for i, sql in enumerate(values))
    return f"CASE c_custkey % {len(COMPOSED)} {cases} END"


@query("k1_clean_composed", f"""
    SELECT c_custkey, {_composed(COMPOSED.values())} AS text
    FROM (SELECT *, chr(10) AS nl FROM customer)
""")
def clean_composed(spark, sf_dir):
    """Pages made of blocks, nesting, open and wrongly closed elements, lists, breaks, scripts,
    styles, comments and entities, whose text SQL can state."""
    return t.texts(spark, sf_dir, "customer", "c_custkey").select(
        "c_custkey", html.clean_html(F.expr(_composed(COMPOSED))).alias("text"))


RUN_DATE = dt.date(2021, 5, 6)
DATE_TEXT_SQL = """
    CASE o_orderpriority
        WHEN '1-URGENT' THEN {f}(o_orderdate, '{iso}') WHEN '2-HIGH' THEN {f}(o_orderdate, '{us}')
        WHEN '3-MEDIUM' THEN {f}(o_orderdate, '{day}')
        WHEN '4-NOT SPECIFIED' THEN CASE WHEN o_orderstatus = 'F' THEN '' ELSE 'no date' END
        ELSE {f}(o_orderdate, '{odd}') END
"""
DATE_TEXT = DATE_TEXT_SQL.format(
    f="date_format", iso="yyyy-MM-dd HH:mm:ss", us="MMM d, yyyy h:mm:ss a", day="yyyy-MM-dd",
    odd="d MMMM yyyy")


@query("k2_lenient_date", """
    SELECT o_orderkey, CASE WHEN o_orderpriority <> '4-NOT SPECIFIED'
           THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') END AS iso
    FROM orders
""")
def lenient_date(spark, sf_dir):
    given = t.table(spark, sf_dir, "orders").select("o_orderkey", F.expr(DATE_TEXT).alias("given"))
    return given.select("o_orderkey", dates.lenient_date(F.col("given"), RUN_DATE).alias("iso"))


NOISE_SQL = rf"^([0-9\-]|.+,|{WORD}+-\p{{Nd}}|\(|.*\)|{WORD}*\p{{Nd}})"


@query("k3_trim_location", f"""
    SELECT doc_id, array_to_string(list_filter({words_sql('lower(text)')},
           lambda w: w <> 'box' AND NOT regexp_matches(w, '{NOISE_SQL}')), ' ') AS place
    FROM documents
""")
def trim_location(spark, sf_dir):
    return t.texts(spark, sf_dir, "documents", "doc_id").select(
        "doc_id", x.trim_location(F.col("text")).alias("place"))


@query("k3_trim_location_parts", f"""
    SELECT p_partkey, array_to_string(list_filter({words_sql('lower(place)')},
           lambda w: w <> 'box' AND NOT regexp_matches(w, '{NOISE_SQL}')), ' ') AS place
    FROM (SELECT p_partkey, p_name || ', Box ' || p_size || ' (' || p_type || ') se-' || p_size
                 || ' ' || p_brand || ' upplands-bro' AS place FROM part)
""")
def trim_location_parts(spark, sf_dir):
    place = F.expr("p_name || ', Box ' || p_size || ' (' || p_type || ') se-' || p_size || ' ' || "
                   "p_brand || ' upplands-bro'")
    return t.table(spark, sf_dir, "part").select(
        "p_partkey", x.trim_location(place).alias("place"))


NAMES = ("concat(c_name, ' AB')", "concat('AB ', c_name, ' ', c_mktsegment)",
         "concat('  ', c_mktsegment, ' ab gross AB ')")


def company_sql(c_: str) -> str:
    return (f"regexp_replace(regexp_replace({strip_sql(f'lower({c_})')}, '(?s)^(.*) ab', '\\1'), "
            f"'(?s)^(.*?)ab ', '\\1')")


@query("k4_employer_names", f"""
    WITH n AS (SELECT c_custkey, unnest([{", ".join(
        f"{{'at': {i}, 'name': {company_sql(n)}}}" for i, n in enumerate(NAMES))}]) AS n
        FROM customer),
    r AS (SELECT c_custkey, n.at AS at, n.name AS name, first_value(n.name) OVER (
              PARTITION BY c_custkey ORDER BY length(n.name), n.at) AS first_name,
              row_number() OVER (PARTITION BY c_custkey ORDER BY length(n.name), n.at) AS rank
          FROM n)
    SELECT c_custkey, name FROM r
    WHERE rank = 1 OR (name <> '' AND NOT starts_with(name, first_name))
""")
def employer_names(spark, sf_dir):
    names = F.array(*[F.expr(n) for n in NAMES])
    return t.table(spark, sf_dir, "customer").select(
        "c_custkey", F.explode(x.employer_names(names)).alias("name"))


@query("o2_shortest_first", """
    SELECT p_partkey, CAST(row_number() OVER (PARTITION BY p_partkey ORDER BY length(name), place)
                           - 1 AS INTEGER) AS rank, name
    FROM (SELECT p_partkey, 0 AS place, p_name AS name FROM part UNION ALL
          SELECT p_partkey, 1, p_brand FROM part UNION ALL SELECT p_partkey, 2, p_type FROM part)
""")
def shortest_first(spark, sf_dir):
    ranked = x.shortest_first(F.array("p_name", "p_brand", "p_type"))
    return t.table(spark, sf_dir, "part").select(
        "p_partkey", F.posexplode(ranked).alias("rank", "entry")).select(
            "p_partkey", "rank", F.col("entry.name").alias("name"))


LABEL_STRIPPED = strip_sql("replace(text, 'm.fl.', '')")


@query("k5_label_split", f"""
    SELECT doc_id, unnest(CASE WHEN contains(label, '-') THEN
               list_transform(string_split(label, '/'), lambda w: lower(w))
           ELSE list_transform(regexp_split_to_array(label, '/|, | och '),
                               lambda w: {strip_sql("lower(w)")}) END) AS keyword
    FROM (SELECT doc_id, {LABEL_STRIPPED} AS label FROM documents WHERE length(text) > 0)
""")
def label_split(spark, sf_dir):
    return t.texts(spark, sf_dir, "documents", "doc_id").select(
        "doc_id", F.explode(x.label_split(F.col("text"))).alias("keyword"))


@query("k6_nested_values", f"""
    SELECT id, unnest([c_name, n_name, r_name, c_mktsegment, 'Sverige']) AS value
    FROM ({t.DOCUMENTS_SQL})
""")
def nested_values(spark, sf_dir):
    documents = t.documents(spark, sf_dir)
    paths = ["occupation.label", "occupation_group.label", "occupation_field.label",
             "workplace_address.city", "workplace_address.country"]
    values = F.concat(*[w.nested_values(documents.schema, p) for p in paths])
    return documents.select("id", F.explode(values).alias("value"))


@query("k12_epoch_format", f"""
    SELECT seq, strftime(make_timestamp_ms(ms) + INTERVAL 1 HOUR, '%Y-%m-%dT%H:%M:%S') AS local
    FROM ({t.FEED_SQL})
""")
def epoch_format(spark, sf_dir):
    return t.feed(spark, sf_dir).select("seq", x.epoch_to_local(F.col("uppdateradTid")).alias("local"))


@query("x3_slugify", "SELECT doc_id, nullif(translate(lower(text), 'åäö ', 'aao_'), '') AS slug FROM documents")
def slugify(spark, sf_dir):
    return t.texts(spark, sf_dir, "documents", "doc_id").select("doc_id", x.slugify(F.col("text")).alias("slug"))


# --- Candidates ---

@query("k8_candidate_filter", f"""
    SELECT doc_id, type, concept_label, term, term_misspelled, prediction, sentence_index
    FROM (SELECT * REPLACE (upper(concept_label) AS concept_label) FROM ({t.KEPT_CANDIDATES_SQL}))
""")
def candidate_filter(spark, sf_dir):
    kept = c.candidate_filter(t.candidates(spark, sf_dir))
    return kept.withColumn("concept_label", F.upper("concept_label"))


TERMS_SQL = f"""
    SELECT DISTINCT doc_id, list, lower(concept_label) AS term FROM ({t.KEPT_CANDIDATES_SQL})
"""
TYPEAHEAD_SQL = f"""
    SELECT doc_id, list, lower(concept_label) AS term FROM ({t.KEPT_CANDIDATES_SQL})
    UNION
    SELECT doc_id, list, lower(term) FROM ({t.KEPT_CANDIDATES_SQL}) WHERE NOT term_misspelled
"""


@query("k9_enriched_terms", TERMS_SQL)
def enriched_terms(spark, sf_dir):
    return c.enriched_terms(t.candidates(spark, sf_dir))


@query("k10_typeahead_terms", TYPEAHEAD_SQL)
def typeahead_terms(spark, sf_dir):
    return c.typeahead_terms(t.candidates(spark, sf_dir))


@query("u5_compound_terms", f"SELECT * FROM ({TERMS_SQL}) WHERE list <> 'trait'")
def compound_terms(spark, sf_dir):
    return c.compound_terms(c.enriched_terms(t.candidates(spark, sf_dir)))


@query("t9_term_dictionary", f"""
    SELECT list, term, count(*) AS documents FROM ({TYPEAHEAD_SQL}) GROUP BY 1, 2
""")
def term_dictionary(spark, sf_dir):
    return o.term_dictionary(c.typeahead_terms(t.candidates(spark, sf_dir)))


@query("p16_headline_input", f"""
    SELECT id AS doc_id, c_mktsegment || ' | ' || n_name || ' | ' || r_name || ' | Sverige | '
           || c_name || ' | ' || coalesce(headline, '') AS doc_headline,
           '<p>' || o_orderpriority || '</p>' AS doc_text
    FROM ({t.DOCUMENTS_SQL})
""")
def headline_input(spark, sf_dir):
    return c.enrichment_input(t.documents(spark, sf_dir))


@query("j15_enrichment_attach", f"""
    WITH e AS ({TERMS_SQL}), y AS ({TYPEAHEAD_SQL}), d AS ({t.DOCUMENTS_SQL}),
    rows AS (
        SELECT doc_id, 'enriched' AS field, list, term FROM e
        UNION ALL SELECT doc_id, 'enriched', 'compound', term FROM e WHERE list <> 'trait'
        UNION ALL SELECT doc_id, 'typeahead', list, term FROM y
        UNION ALL SELECT doc_id, 'typeahead', 'compound', term FROM y WHERE list <> 'trait')
    SELECT id, field, list, term FROM d LEFT JOIN rows ON id = doc_id
""")
def enrichment_attach(spark, sf_dir):
    documents = t.documents(spark, sf_dir)
    plain = documents.withColumn("keywords", F.struct(F.struct(F.col("id").alias("x")).alias("extracted")))
    ads = c.enrichment_attach(plain, t.candidates(spark, sf_dir))
    lists = ["occupation", "skill", "trait", "location", "compound"]
    rows = F.flatten(F.array(*[
        F.transform(F.coalesce(F.col(f"keywords.{column}.{name}"), F.array().cast("array<string>")),
                    _row(field, name))
        for field, column in (("enriched", "enriched"), ("typeahead", "enriched_typeahead_terms"))
        for name in lists]))
    return ads.select("id", F.explode_outer(rows).alias("r")).select(
        "id", "r.field", "r.list", "r.term")


def _row(field, name):
    return lambda term: F.struct(F.lit(field).alias("field"), F.lit(name).alias("list"),
                                 term.alias("term"))


# --- Tokens ---

NORMALISED = "translate(replace(replace({0}, ',', ' '), chr(160), ' '), '.:!', '')"
# Without look-around: what may follow a letter, a digit or an underscore within one word.
STANDARD = (r"(?:(?:\p{L}\p{M}*)(?:[:·.''’]\p{L}\p{M}*)*|\p{N}\p{M}*(?:[,;.''’]\p{N}\p{M}*)*"
            r"|_\p{M}*)+")


def simple_sql(c_: str, source: str) -> str:
    return f"""
    SELECT *, unnest({words_sql(f"lower({NORMALISED.format(c_)})")}) AS word FROM {source}
    """


def standard_sql(c_: str) -> str:
    return (f"list_filter(regexp_extract_all(lower({c_}), '{STANDARD}'), "
            r"lambda w: regexp_matches(w, '[\p{L}\p{N}]'))")


def grams_sql(words: str, cut: str, least: int, most: int) -> str:
    return (f"SELECT *, unnest(list_transform(range({least}, least({most}, length(word)) + 1), "
            f"lambda k: {cut}(word, k))) AS term FROM ({words}) WHERE length(word) >= {least}")


DOCS_SIMPLE = simple_sql("text", "documents")
COUNT = "count(*) AS occurrences"


KEYS = {"documents": ["doc_id"], "conversations": ["conv_id", "turn"]}


def _docs(spark, sf_dir, name="documents"):
    return t.texts(spark, sf_dir, name, *KEYS[name]) if name in KEYS else t.table(spark, sf_dir, name)


@query("t1_char_normalise", f"SELECT doc_id, {NORMALISED.format('text')} AS text FROM documents")
def char_normalise(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", k.char_normalise(F.col("text")).alias("text"))


@query("t2_words", f"SELECT lang, word AS term, {COUNT} FROM ({DOCS_SIMPLE}) GROUP BY 1, 2")
def simple_words(spark, sf_dir):
    rows = o.word_tokens(_docs(spark, sf_dir), F.col("lang"), F.col("text"))
    return o.term_frequency(rows.withColumnRenamed("doc_id", "lang"), "lang")


@query("t3_prefix_grams", f"""
    SELECT lang, term, {COUNT} FROM ({grams_sql(DOCS_SIMPLE, 'left', 3, 30)}) GROUP BY 1, 2
""")
def prefix_grams(spark, sf_dir):
    return o.gram_frequency(_docs(spark, sf_dir), {"lang": F.col("lang")},
                            k.simple_words(F.col("text")), k.prefix_grams)


@query("t4_suffix_grams", f"""
    SELECT lang, term, {COUNT} FROM ({grams_sql(DOCS_SIMPLE, 'right', 3, 30)}) GROUP BY 1, 2
""")
def suffix_grams(spark, sf_dir):
    return o.gram_frequency(_docs(spark, sf_dir), {"lang": F.col("lang")},
                            k.simple_words(F.col("text")), k.suffix_grams)


STOP_SQL = ", ".join(f"'{s}'" for s in k.SWEDISH_STOPWORDS)
SHINGLES = f"""
    WITH w AS (SELECT turn, {standard_sql('text')} AS w FROM conversations),
    p AS (SELECT turn, w, unnest(range(1, len(w) + 1)) AS i FROM w),
    s AS (SELECT turn, w[i] AS term FROM p
          UNION ALL SELECT turn, w[i] || ' ' || w[i + 1] FROM p WHERE i + 1 <= len(w)
          UNION ALL SELECT turn, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FROM p
                    WHERE i + 2 <= len(w))
    SELECT turn, term, {COUNT} FROM s WHERE term NOT IN ({STOP_SQL}) GROUP BY 1, 2
"""


@query("t5_shingles", SHINGLES)
def shingles(spark, sf_dir):
    turns = t.slices(spark, sf_dir, "conversations", *KEYS["conversations"])
    rows = o.shingle_tokens(turns, F.col("turn"), F.col("text"))
    return o.term_frequency(rows.withColumnRenamed("doc_id", "turn"), "turn")


@query("t6_reversed_words", f"""
    SELECT lang, term, {COUNT} FROM (
        SELECT lang, reverse(unnest({standard_sql('text')})) AS term FROM documents)
    WHERE term NOT IN ({STOP_SQL}) GROUP BY 1, 2
""")
def reversed_words(spark, sf_dir):
    rows = o.reversed_tokens(_docs(spark, sf_dir), F.col("lang"), F.col("text"))
    return o.term_frequency(rows.withColumnRenamed("doc_id", "lang"), "lang")


LABEL_WORDS = r"""
    SELECT *, unnest(list_filter(regexp_split_to_array(lower(p_name || '-' || p_brand || '/' || p_type),
        '[^\p{L}\p{N}]+'), lambda w: w <> '')) AS word FROM part
"""


@query("t7_label_grams", f"""
    SELECT p_partkey, term, {COUNT} FROM ({grams_sql(LABEL_WORDS, 'left', 1, 10)}) GROUP BY 1, 2
""")
def label_grams(spark, sf_dir):
    label = F.expr("p_name || '-' || p_brand || '/' || p_type")
    parts = t.slices(spark, sf_dir, "part", "p_partkey")
    rows = o.label_tokens(parts, F.col("p_partkey"), label)
    return o.term_frequency(rows.withColumnRenamed("doc_id", "p_partkey"), "p_partkey")


KINDS = ["words", "prefix", "suffix", "shingles", "reversed"]


@query("t8_token_positions", f"""
    WITH s AS (SELECT item_id, {words_sql(f"lower({NORMALISED.format('text')})")} AS w FROM benchmark),
    sp AS (SELECT item_id, i - 1 AS pos, w[i] AS word
           FROM (SELECT *, unnest(range(1, len(w) + 1)) AS i FROM s)),
    d AS (SELECT item_id, {standard_sql('text')} AS w FROM benchmark),
    dp AS (SELECT item_id, w, i FROM (SELECT *, unnest(range(1, len(w) + 1)) AS i FROM d)),
    rows AS (
        SELECT item_id, 'words' AS kind, pos, word AS term FROM sp
        UNION ALL SELECT item_id, 'prefix', pos, term FROM ({grams_sql("SELECT * FROM sp", 'left', 3, 30)})
        UNION ALL SELECT item_id, 'suffix', pos, term FROM ({grams_sql("SELECT * FROM sp", 'right', 3, 30)})
        UNION ALL SELECT item_id, 'shingles', i - 1, array_to_string(w[i:i + n - 1], ' ')
            FROM dp, range(1, 4) AS lengths(n)
            WHERE i + n - 1 <= len(w) AND array_to_string(w[i:i + n - 1], ' ') NOT IN ({STOP_SQL})
        UNION ALL SELECT item_id, 'reversed', i - 1, reverse(w[i]) FROM dp
            WHERE reverse(w[i]) NOT IN ({STOP_SQL}))
    SELECT item_id, kind, CAST(pos AS INTEGER) AS pos, term FROM rows
""")
def token_positions(spark, sf_dir):
    """Every token with its document and position."""
    items = t.table(spark, sf_dir, "benchmark")
    return o.token_table(items, {"text": KINDS}, "item_id").select(
        F.col("doc_id").alias("item_id"), "kind", "pos", "term")


PLAN = {"headline": ["words", "prefix", "suffix"], "text": ["words", "prefix", "suffix"],
        "compound": ["shingles", "reversed"]}
HEAD_SIMPLE = simple_sql("headline", "f")


@query("t8_field_plan", f"""
    WITH f AS (SELECT item_id, text, replace(text, ',', '!') || '!' AS headline,
                      [replace(text, ' ', '_'), 'och ' || item_id, 'hco'] AS compound
               FROM benchmark),
    c AS (SELECT item_id, unnest(compound) AS compound FROM f),
    w AS (SELECT {standard_sql('compound')} AS w FROM c),
    p AS (SELECT w, unnest(range(1, len(w) + 1)) AS i FROM w),
    rows AS (
        SELECT 'headline' AS field, 'words' AS kind, word AS term FROM ({HEAD_SIMPLE})
        UNION ALL SELECT 'headline', 'prefix', term FROM ({grams_sql(HEAD_SIMPLE, 'left', 3, 30)})
        UNION ALL SELECT 'headline', 'suffix', term FROM ({grams_sql(HEAD_SIMPLE, 'right', 3, 30)})
        UNION ALL SELECT 'text', 'words', word FROM ({simple_sql('text', 'f')})
        UNION ALL SELECT 'text', 'prefix', term
                  FROM ({grams_sql(simple_sql('text', 'f'), 'left', 3, 30)})
        UNION ALL SELECT 'text', 'suffix', term
                  FROM ({grams_sql(simple_sql('text', 'f'), 'right', 3, 30)})
        UNION ALL SELECT 'compound', 'shingles', w[i] FROM p WHERE w[i] NOT IN ({STOP_SQL})
        UNION ALL SELECT 'compound', 'shingles', w[i] || ' ' || w[i + 1] FROM p
                  WHERE i + 1 <= len(w)
        UNION ALL SELECT 'compound', 'shingles', w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FROM p
                  WHERE i + 2 <= len(w)
        UNION ALL SELECT 'compound', 'reversed', reverse(w[i]) FROM p
                  WHERE reverse(w[i]) NOT IN ({STOP_SQL}))
    SELECT field, kind, term, {COUNT} FROM rows GROUP BY 1, 2, 3
""")
def field_plan(spark, sf_dir):
    docs = _docs(spark, sf_dir, "benchmark").select(
        "item_id", "text", F.expr("replace(text, ',', '!') || '!'").alias("headline"),
        F.expr("array(replace(text, ' ', '_'), 'och ' || item_id, 'hco')").alias("compound"))
    rows = o.token_table(docs, PLAN, "item_id")
    return o.term_frequency(rows, "field", "kind")
