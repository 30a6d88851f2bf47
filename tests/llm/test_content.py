"""Contamination, languages, tool calls and the pipeline."""

import json
from collections import Counter

import pytest
from feedloom.llm import decontaminate, language, tool_calls
from feedloom.llm.decontaminate import contamination, drop_contaminated
from llm import odd
from pyspark.sql import functions as F

ITEM = "item_id long, text string"


def _items():
    shared = odd.prose(1, 130).split()
    return [(1, " ".join(shared[20:45])), (2, "One, SHORT line!"), (3, None), (4, ""), (5, "..."),
            (None, " ".join(shared[60:75])), (6, " ".join(shared[20:45])), (7, "the"),
            (8, odd.prose(99, 30)), (10, " ".join(odd.prose(3, 9000).split()[5000:5011])),
            (11, "the the the the the the the the the the the"), (12, "日本語 日本語")]


def test_contamination_equals_brute_force(spark):
    docs = odd.documents(spark)
    items = spark.createDataFrame(_items(), ITEM).withColumn("terms", F.lit(1))
    got = Counter((r.doc_id, r.n_words, r.n_hit, tuple(r.item_ids))
                  for r in contamination(docs, items).collect())
    want = odd.contamination([row[:2] for row in odd.odd_rows()], _items())
    assert got == Counter((i, n, h, tuple(by)) for i, n, h, by in want)


def test_no_documents_or_items(spark):
    items = spark.createDataFrame(_items(), ITEM)
    assert contamination(odd.documents(spark, []), items).collect() == []
    rows = contamination(odd.documents(spark), spark.createDataFrame([], ITEM)).collect()
    assert len(rows) == len(odd.odd_rows()) and not any(r.n_hit for r in rows)


def test_contaminated_documents_go_and_the_others_stay(spark):
    docs = odd.documents(spark)
    items = spark.createDataFrame(_items(), ITEM)
    want = Counter(i for (i, _, hit, _) in odd.contamination(
        [row[:2] for row in odd.odd_rows()], _items()) if not hit)
    out = drop_contaminated(docs, items)
    assert out.columns == docs.columns
    assert Counter(r.doc_id for r in out.collect()) == want


def test_proximity_matches_allow_words_out_of_place(spark):
    docs = spark.createDataFrame([(1, "a b x c d"), (2, "a b c d"), (3, "d c b a"), (4, "a x y z b c d")],
                                 "doc_id long, text string")
    terms = spark.createDataFrame([(t, n) for n, t in enumerate("abcd")],
                                  "term string, term_id long")
    index = decontaminate.postings(docs, terms)
    wanted = spark.createDataFrame([(0, n, n) for n in range(4)],
                                   "window long, offset int, term_id long")
    keys = {r.key: r.doc_id for r in index.select("doc_id", "key").distinct().collect()}

    def found(slop):
        return {keys[r.key] for r in decontaminate.matches(index, wanted, slop).collect()}

    assert found(0) == {2}
    assert found(1) == {1, 2}
    assert found(3) == {1, 2, 4}
    assert found(6) == {1, 2, 3, 4}


def test_contamination_runs_no_python(spark):
    docs = odd.documents(spark).select("doc_id", "text")
    plan = contamination(docs, spark.createDataFrame(_items(), ITEM))._jdf.queryExecution() \
        .toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def _labelled(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return docs, docs.where("doc_id % 2 = 0"), docs.where("doc_id % 2 = 1")


def test_held_out_documents_are_identified_by_their_text(spark):
    _, learn, rest = _labelled(spark)
    model = language.train(learn.select("text", "lang"))
    rows = language.document_rows(rest).withColumn("declared", F.lit(None).cast("string")) \
        .withColumn("host", F.lit(""))
    got = {r.doc_id: r for r in language.identify(rows, model, "doc_id").collect()}
    truth = {r.doc_id: r.lang for r in rest.collect()}
    assert sum(got[i].text_lang == truth[i] for i in truth) / len(truth) > 0.98


def test_evidence_decides_where_the_text_does_not(spark):
    _, learn, _ = _labelled(spark)
    model = language.train(learn.select("text", "lang"))
    german = learn.where("lang = 'de'").limit(30).collect()
    kind = "id long, text string, declared string, suffix string, domain string, host string"
    rows = [(n, r.text, "de", "de", "x.de", "www.x.de") for n, r in enumerate(german)]
    rows += [(100, None, None, "de", "x.de", "www.x.de"), (101, "", "fr-CA", None, None, None),
             (102, "", "", "de", "y.de", "y.de"), (103, "Ω" * 400, "xx", "org", "z.org", "z.org"),
             (103, "Ω" * 400, "xx", "org", "z.org", "z.org"), (None, None, None, None, None, None)]
    found = language.identify(spark.createDataFrame(rows, kind), model, "id").collect()
    assert len(found) == len(rows)
    by_id = {r.id: r for r in found}
    assert by_id[100].lang == "de" and by_id[102].lang == "de"
    assert by_id[101].lang == "fr" and by_id[101].declared == "fr"
    assert by_id[103].text_lang == language.UNKNOWN
    assert all(0 < r.probability <= 1 for r in found)
    assert language.identify(spark.createDataFrame([], kind), model, "id").collect() == []


def test_pages_give_host_domain_and_declaration(spark):
    pages = spark.createDataFrame([
        (1, "https://u:p@www.Shop.example.co.uk:80/x?y", "<html LANG='de-AT'><p>ab<b>c</b></p>"),
        (2, "http://a.b.org/", "<script>var x='<html lang=fr>'</script>t"), (3, None, None),
        (4, "nonsense", "")], "page_id long, url string, html string")
    got = {r.page_id: r for r in language.page_rows(pages).collect()}
    assert (got[1].host, got[1].domain, got[1].suffix, got[1].declared) == (
        "www.shop.example.co.uk", "example.co.uk", "uk", "de")
    assert got[1].text.split() == ["ab", "c"]
    assert (got[2].domain, got[2].suffix, got[2].text.strip()) == ("b.org", "org", "t")
    assert got[4].host == ""


def test_clean_documents_are_kept_by_the_language_stage(spark):
    docs, _, _ = _labelled(spark)
    junk = spark.createDataFrame([(10 ** 9, "Ω Ψ " * 200, "zz", "junk", 800)], docs.schema)
    out = language.keep_identified(docs.unionByName(junk), docs.select("text", "lang"))
    kept = {r.doc_id for r in out.select("doc_id").collect()}
    assert kept == {r.doc_id for r in docs.select("doc_id").collect()}
    odd_docs = odd.documents(spark)
    assert language.keep_identified(odd_docs, docs.select("text", "lang")).columns == \
        odd_docs.columns
    none = odd.documents(spark, [])
    assert language.keep_identified(none, none.select("text", "lang")).collect() == []


TOOLS = {"add": {"type": "object", "required": ["x"], "additionalProperties": False, "properties": {
    "x": {"type": "integer", "minimum": 0}, "tags": {"type": "array", "items": {"enum": ["a"]}}}}}


@pytest.mark.parametrize(("arguments", "wrong"), [
    ('{"x": 1}', 0), ('{"x": 1.0}', 0), ('{"x": -1}', 1), ('{"x": "1"}', 1), ("{}", 1),
    ('{"x": 1, "y": 2}', 1), ('{"x": 1, "x": 2}', 1), ('{"x": NaN}', 1), ("", 1), (None, 1),
    ('{"x": 1, "tags": ["a", "b"]}', 1), ("[1]", 1), ('{"x": true}', 1)])
def test_arguments_are_held_against_the_schema(arguments, wrong):
    assert len(tool_calls.judged("add", arguments, TOOLS)[1]) == wrong
    assert tool_calls.judged("other", '{"x": 1}', TOOLS)[1] == ["unknown tool"]


def test_canonical_json():
    assert tool_calls.canonical(tool_calls.parsed('{"b": [1.0, 2.5, "é\\n"], "a": {"d": null, "c": true}}')) \
        == '{"a":{"c":true,"d":null},"b":[1,2.5,"é\\n"]}'


def test_calls_are_linked_and_ordered(spark):
    def call(name, after=None, arguments='{"x": 1}'):
        return {"id": name, "name": "add", "arguments": arguments, "after": after}

    rows = [
        (1, 0, "assistant", None, [call("a"), call("b", "a"), call("c", "b")], None),
        (1, 1, "tool", "one", None, "a"), (1, 2, "tool", None, None, "b"),
        (1, 3, "tool", "lost", None, "z"), (1, 3, "tool", "lost", None, "z"),
        (1, 4, "assistant", "", [call("p", "q"), call("q", "p"), call("r", "q")], None),
        (1, 5, "assistant", None, [call("a"), call(None), call("s", "none")], None),
        (1, 6, "tool", "two", None, "a"), (2, 0, "tool", "early", None, "e"),
        (2, 1, "assistant", None, [call("e", None, "no json")], None),
        (None, 0, "assistant", None, [call("a")], None), (3, 0, "user", "hi", None, None),
        (3, 1, None, None, [], None)]
    messages = spark.createDataFrame(rows, tool_calls.MESSAGE).withColumn("depth", F.lit(9))
    got = {(r.conv_id, r.call_id, r.nth): r for r in tool_calls.linked_calls(
        messages, TOOLS).collect()}
    state = {k: (r.status, r.depth) for k, r in got.items()}
    assert state == {
        (1, "a", 1): ("answered", 0), (1, "a", 2): ("answered", 0), (1, "b", 1): ("answered", 1),
        (1, "c", 1): ("unanswered", 2), (1, "z", 1): ("orphan", None), (1, "z", 2): ("orphan", None),
        (1, "p", 1): ("unanswered", None), (1, "q", 1): ("unanswered", None),
        (1, "r", 1): ("unanswered", None), (1, None, 1): ("unanswered", None),
        (1, "s", 1): ("unanswered", 0), (2, "e", 1): ("early", 0),
        (None, "a", 1): ("unanswered", None)}
    assert got[1, "a", 2].json == '{"arguments":{"x":1},"id":"a","name":"add","result":"two"}'
    assert got[2, "e", 1].n_errors == 1
    assert got[2, "e", 1].json == '{"arguments":"no json","id":"e","name":"add","result":"early"}'
    assert got[1, "z", 1].json == '{"id":"z","result":"lost"}'
    none = spark.createDataFrame([], tool_calls.MESSAGE)
    assert tool_calls.linked_calls(none, TOOLS).collect() == []


DEEP = "[" * 3000 + "]" * 3000


@pytest.mark.parametrize("arguments", [
    DEEP, "[" * 200_000, f'{{"x": {DEEP}}}', f'{{"x": 1, "tags": {"[" * 70 + "]" * 70}}}',
    '{"x": 1e400}', '{"x": -1e400}', '{"x": "\\ud800"}', '{"\\udfff": 1}', f'{{"x": {"9" * 5000}}}',
    '{"x": Infinity}', "{" * 9000])
def test_arguments_that_cannot_be_written_stay_text(spark, arguments):
    rows = [(1, 0, "assistant", None, [{"id": "a", "name": "add", "arguments": arguments,
                                        "after": None}], None)]
    (row,) = tool_calls.linked_calls(spark.createDataFrame(rows, tool_calls.MESSAGE), TOOLS).collect()
    said = json.loads(row.json)
    assert row.n_errors == 1 and said["arguments"] == arguments
    json.dumps(said, ensure_ascii=False, allow_nan=False).encode()


@pytest.mark.parametrize(("arguments", "wrong"), [
    (f'{{"x": {"9" * 400}}}', 0), ('{"x": 1e300}', 0), ('{"x": 1.5}', 1), (f'{{"x": -{"9" * 400}}}', 1),
    ('{"x": 1, "tags": ["\\ud83d\\ude00"]}', 1)])
def test_great_numbers_and_whole_pairs_are_judged(arguments, wrong):
    value, errors = tool_calls.judged("add", arguments, TOOLS)
    assert len(errors) == wrong and json.loads(tool_calls.canonical(value)) == json.loads(arguments)


def test_calls_and_results_meet_in_a_hash_join(spark):
    found = tool_calls.linked_calls(spark.createDataFrame([], tool_calls.MESSAGE), TOOLS)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "FullOuter" in plan and "SortMergeJoin" not in plan


def test_long_chains_of_calls(spark):
    rows = [(1, f"k{n}", f"k{n - 1}" if n else None) for n in range(100)]
    frame = spark.createDataFrame(rows, "conv_id long, call_id string, after string")
    got = {r.call_id: r.depth for r in tool_calls.depths(frame).collect()}
    assert got == {f"k{n}": n for n in range(100)}
