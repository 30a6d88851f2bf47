"""The operators applied to the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom.llm.decontaminate import contamination
from feedloom.llm.katz import katz_scores
from feedloom.llm.language import identify, page_rows, train
from feedloom.llm.lattice import embedding_groups
from feedloom.llm.line_dedup import keep_bitmaps, kept_lines
from feedloom.llm.registry import ORACLE, QUERIES, query, table  # noqa: F401
from feedloom.llm.repeats import repeats
from feedloom.llm.sentence_pieces import piece_digests
from feedloom.llm.simhash import simhash_groups
from feedloom.llm.spelling import spelling_variants
from feedloom.llm.token_counts import token_counts
from feedloom.llm.token_files import read_token_digests, write_token_files
from feedloom.llm.tool_calls import REQUEST_TOOLS, linked_calls, request_messages
from feedloom.llm.whitening import whitened_rows
from feedloom.session import fresh_path, materialise


@query("op1_token_files")
def op1(spark, sf_dir):
    path = fresh_path(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path, "byte_bpe_50k.json", 0)
    return read_token_digests(spark, path)


@query("op3_token_counts")
def op3(spark, sf_dir):
    return token_counts(table(spark, sf_dir, "documents"), "word_bpe_49k.json", 2048)


@query("op7_simhash_groups")
def op7(spark, sf_dir):
    return simhash_groups(table(spark, sf_dir, "documents"))


OP8_SQL = """
WITH RECURSIVE
usable AS (
  SELECT row_number() OVER () AS n, vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([v FOR v IN embedding IF v IS NULL OR NOT isfinite(v)]) = 0
    AND len([v FOR v IN embedding IF v <> 0]) > 0),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM usable a JOIN usable b
  ON a.label = b.label AND a.n <> b.n AND len(a.e) = len(b.e)
  AND list_cosine_similarity(a.e, b.e) >= 0.93),
reach(x, y) AS (SELECT vec_id, vec_id FROM embeddings
  UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y),
lowest AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x),
counts AS (SELECT x, count(*) AS n_links FROM links GROUP BY x)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN lowest ON lowest.x = vec_id LEFT JOIN counts ON counts.x = vec_id
"""


@query("op8_embedding_groups", OP8_SQL)
def op8(spark, sf_dir):
    return embedding_groups(table(spark, sf_dir, "embeddings"))


OP5_SQL = r"""
WITH
lowered AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
d AS (SELECT doc_id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM lowered),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, len(s) AS k, array_to_string(s, ' ') AS s FROM (
    SELECT item_id, unnest([w[i:i + 9] FOR i IN range(1, greatest(len(w) - 9, 1) + 1)]) AS s
    FROM b WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT k FROM bw),
dw AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS s FROM (
    SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, lengths
    WHERE len(w) >= k)),
hits AS (SELECT doc_id, item_id, dw.k, i FROM dw JOIN bw ON dw.s = bw.s AND dw.k = bw.k),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (
    SELECT doc_id, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT doc_id, k, i FROM hits))
    GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids FROM (
    SELECT DISTINCT doc_id, item_id::VARCHAR AS x FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query("op5_contamination", OP5_SQL)
def op5(spark, sf_dir):
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


@query("op6_page_language")
def op6(spark, sf_dir):
    model = train(table(spark, sf_dir, "documents").select("text", "lang"))
    return identify(page_rows(table(spark, sf_dir, "pages")), model, "page_id")


OP9_SQL = """
WITH RECURSIVE
calls AS (
  SELECT conv_id, turn, 'c' || turn AS call_id, text,
    CASE WHEN length(text) > 200 THEN 'read' ELSE 'search' END AS name,
    row_number() OVER (PARTITION BY conv_id, turn ORDER BY
      CASE WHEN length(text) > 200 THEN 'read' ELSE 'search' END, length(text)::VARCHAR, text) AS nth
  FROM conversations WHERE role = 'user'),
results AS (
  SELECT conv_id, turn AS result_turn, 'c' || (turn - 1) AS call_id, text AS result,
    row_number() OVER (PARTITION BY conv_id, turn ORDER BY text) AS nth
  FROM conversations WHERE role = 'assistant'),
first AS (SELECT DISTINCT conv_id, turn FROM calls),
deep AS (
  SELECT conv_id, turn, 0 AS depth FROM first f WHERE NOT EXISTS (
    SELECT 1 FROM first g WHERE g.conv_id = f.conv_id AND g.turn = f.turn - 2)
  UNION ALL
  SELECT f.conv_id, f.turn, depth + 1 FROM deep d JOIN first f
  ON f.conv_id = d.conv_id AND f.turn = d.turn + 2),
joined AS (
  SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.call_id, r.call_id) AS call_id,
    coalesce(c.nth, r.nth) AS nth, c.conv_id IS NOT NULL AS called, r.conv_id IS NOT NULL AS replied,
    c.turn, result_turn, name, text, result
  FROM calls c FULL JOIN results r
  ON c.conv_id = r.conv_id AND c.call_id = r.call_id AND c.nth = r.nth)
SELECT j.conv_id, call_id, nth::INTEGER AS nth,
  CASE WHEN NOT called THEN 'orphan' WHEN NOT replied THEN 'unanswered' ELSE 'answered' END AS status,
  depth::BIGINT AS depth, coalesce(j.turn, result_turn) AS turn, name,
  (CASE WHEN NOT called THEN 0 WHEN text IS NULL THEN 2
    WHEN name = 'search' THEN (length(text) < 20)::INT + (length(text) < 1)::INT
    ELSE (length(text) > 1000)::INT END)::BIGINT AS n_errors,
  CASE WHEN called THEN '{"arguments":{' || CASE WHEN text IS NULL THEN '' ELSE
      '"length":' || length(text) || ',"query":' || to_json(text)::VARCHAR END || '},"id":"' || call_id
      || '","name":"' || name || '","result":' || coalesce(to_json(result)::VARCHAR, 'null') || '}'
    ELSE '{"id":"' || call_id || '","result":' || coalesce(to_json(result)::VARCHAR, 'null') || '}'
  END AS json
FROM joined j LEFT JOIN deep ON deep.conv_id = j.conv_id AND 'c' || deep.turn = call_id
"""


@query("op9_tool_calls", OP9_SQL)
def op9(spark, sf_dir):
    return linked_calls(request_messages(table(spark, sf_dir, "conversations")), REQUEST_TOOLS)


@query("op10_sentence_pieces")
def op10(spark, sf_dir):
    return piece_digests(table(spark, sf_dir, "documents"), "piece_bpe_32k.model")


OP4_SQL = r"""
WITH
d AS (SELECT row_number() OVER () AS n, doc_id,
  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT n, doc_id, i, hash(array_to_string(w[i:i + 49], ' ')) AS h,
  md5(array_to_string(w[i:i + 49], ' ')) AS m FROM (
    SELECT n, doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
first AS (SELECT h, m, min(doc_id) AS smallest FROM s GROUP BY h, m),
gone AS (SELECT DISTINCT n, unnest(range(i, i + 50)) AS p FROM s JOIN first USING (h, m)
  WHERE doc_id > smallest),
lists AS (SELECT n, list(p) AS ps, count(*) AS k FROM gone GROUP BY n)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(k, 0)::BIGINT AS n_removed,
  sha256(CASE WHEN k IS NULL THEN array_to_string(w, ' ') ELSE
    array_to_string([w[i] FOR i IN range(1, len(w) + 1) IF NOT list_contains(ps, i)], ' ') END)
    AS kept_sha256
FROM d LEFT JOIN lists USING (n)
"""


@query("op4_repeats", OP4_SQL)
def op4(spark, sf_dir):
    return repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op2_katz_scores")
def op2(spark, sf_dir):
    return katz_scores(table(spark, sf_dir, "documents"), order=3)


@query("op11_whitened_embeddings")
def op11(spark, sf_dir):
    return whitened_rows(table(spark, sf_dir, "embeddings"))


OP12_SQL = """
WITH
d AS (SELECT row_number() OVER () AS n, doc_id,
  string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT n, doc_id, i, lines[i] AS line, translate(
    trim(lines[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT n, doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM d)),
first AS (SELECT k, min(doc_id) AS smallest FROM l WHERE length(k) >= 10 GROUP BY k),
marked AS (SELECT n, l.doc_id, i, line, coalesce(l.doc_id > smallest, false) AS gone
  FROM l LEFT JOIN first ON l.k = first.k)
SELECT any_value(doc_id) AS doc_id, count(*)::BIGINT AS n_lines,
  count(*) FILTER (gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY n
"""


@query("op12_line_dedup", OP12_SQL)
def op12(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return kept_lines(docs, materialise(keep_bitmaps(docs), "bitmaps")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@query("op13_spelling_variants")
def op13(spark, sf_dir):
    return spelling_variants(table(spark, sf_dir, "documents"))
