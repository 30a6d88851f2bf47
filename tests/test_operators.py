"""Rules that tables alone do not show: skew, replays, missing against null, order, failures."""

import datetime as dt
import json
import re

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from feedloom import settings
from feedloom.lens import QUERIES
from feedloom.operators import candidates as c, joins, lookup as l, replacements as p
from feedloom.operators import snapshot as s, taxonomy as x
from feedloom.plans import imports, normalise as n, snapshots
from feedloom.session import fresh_path
from feedloom.sources import feed as f
from feedloom.streaming import feed_stream as stream

RUN_DATE = dt.date(2021, 5, 6)
ENTRY = "struct<concept_id:string,label:string,legacy_ams_taxonomy_id:string"
CONCEPTS = (f"concept_id string, type string, label string, legacy_ams_taxonomy_id string, "
            f"parent {ENTRY},parent:{ENTRY}>>")
PAIRS = ("list_pos int, concept_id string, preferred_label string, successor_id string, "
         "successor_label string")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- Joins ---

@pytest.mark.parametrize("how", ["left", "inner", "left_anti", "left_semi"])
def test_hot_keys_change_the_plan_and_not_the_rows(spark, how):
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, None)
        .otherwise(F.col("id")).cast("long").alias("k"), "id")
    right = spark.range(0, 2000, 2).select(
        F.when(F.col("id") == 0, 7).otherwise(F.col("id") + 1000).cast("int").alias("k"),
        F.col("id").alias("v")).where("k != 1007")
    split = joins.lookup_join(left, right, "k", how, limit=0)
    plain = left.join(right.select(F.col("k").cast("long").alias("k"), *right.columns[1:]), "k", how)
    assert rows(split) == rows(plain)


def test_hot_keys_are_found_and_few(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
    hot = joins.hot_keys(df, F.xxhash64("k"))
    want = spark.range(1).select(F.xxhash64(F.lit(-1).cast("long"))).first()[0]
    assert want in hot and len(hot) <= 200


def test_broadcast_needs_a_size_within_the_bound(spark, tmp_path):
    spark.range(10_000).write.parquet(str(tmp_path / "r"))
    right = spark.read.parquet(str(tmp_path / "r"))
    assert joins.fits_broadcast(right)
    assert not joins.fits_broadcast(right, 10)
    assert not joins.fits_broadcast(right.join(right.withColumnRenamed("id", "o"), F.lit(True)))


def test_a_broadcast_side_is_measured_as_rows_in_memory_and_not_as_a_file(spark, tmp_path):
    spark.range(1_000_000, numPartitions=2).write.parquet(str(tmp_path / "ids"))
    ids = spark.read.parquet(str(tmp_path / "ids"))
    assert joins.planned_bytes(ids) < settings.BROADCAST_BYTES < joins.held_bytes(ids)
    found = joins.lookup_join(ids.limit(9), ids, "id", unique=False)
    for df in (found, ids.limit(9).join(joins.small_side(ids), "id", "left_semi")):
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
        assert df.count() == 9


@pytest.mark.parametrize("name", ["t3_prefix_grams", "t4_suffix_grams"])
def test_words_are_counted_before_they_are_cut_into_grams(spark, name):
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan()
    assert "Aggregate" in plan.toString().split("Generate", 1)[1]


@pytest.mark.parametrize("name", ["t5_shingles", "t7_label_grams"])
def test_a_task_that_counts_gets_a_slice_of_the_input(spark, name, monkeypatch):
    monkeypatch.setattr(settings, "SLICE_BYTES", 500)
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan()
    dealt = re.search(r"RepartitionByExpression .*, (\d+)", plan.toString())
    assert dealt and int(dealt.group(1)) > 8


def test_ads_that_are_read_more_than_once_are_parsed_once(spark, monkeypatch):
    monkeypatch.setattr(settings, "IN_PLACE_BYTES", 0)
    found = QUERIES["p8_workplace_address"](spark, "/root/testdata/sf0.001")
    assert "arse_json" not in found._jdf.queryExecution().analyzed().toString().lower()


# --- Snapshots ---

def test_upsert_is_idempotent_and_last_write_wins(spark):
    old = spark.createDataFrame([("a", 1), ("b", 5)], "id string, timestamp bigint")
    new = spark.createDataFrame([("b", 2), ("c", 3)], "id string, timestamp bigint")
    once = s.upsert(old, new)
    assert rows(once) == [("a", 1), ("b", 2), ("c", 3)]
    assert rows(s.upsert(once, new)) == rows(once)
    assert rows(s.upsert(old, new, newer_by="timestamp")) == [("a", 1), ("b", 5), ("c", 3)]
    assert rows(s.upsert(old, old, newer_by="timestamp")) == rows(old)


def test_document_without_a_key_fails(spark):
    df = spark.createDataFrame([(None, "t", None)], "concept_id string, type string, k string")
    with pytest.raises(SparkRuntimeException, match="document without k"):
        df.select(s.document_key(["type", "k"])).collect()


def test_size_gate(spark):
    ads = lambda n, removed: spark.range(n).select(F.lit(removed).alias("removed"))
    gate = lambda new, cur: s.size_gate(new, cur).first()["passed"]
    assert gate(ads(8, None), ads(10, False)) and not gate(ads(7, False), ads(10, False))
    assert gate(ads(0, False), ads(10, None)) and gate(ads(0, False), None)


def test_a_shrunken_rebuild_is_not_published(spark):
    root = fresh_path(spark, "gate")
    ads = lambda n: spark.range(n).select(F.col("id").cast("string").alias("id"),
                                          F.lit(False).alias("removed"))
    for name, size in (("old", 10), ("small", 7), ("new", 8)):
        snapshots.write_base(ads(size), f"{root}/{name}")
    assert imports.gate(spark, f"{root}/small", "gated")
    assert not imports.gate(spark, f"{root}/small", "gated", needed=True)
    snapshots.show(spark, "gated", f"{root}/old", f"{root}/old")
    for prefix in ("gated", None):
        assert not imports.gate(spark, f"{root}/small", prefix)
        assert imports.gate(spark, f"{root}/new", prefix)


def test_reconciling_ends_when_the_number_of_missing_ads_no_longer_falls(spark):
    feed = spark.createDataFrame([(i, False, 1, None) for i in range(25)], f.FEED_SCHEMA)
    held: list[int] = []

    def load(pending):
        held.extend([r["annonsId"] for r in pending.collect() if r["annonsId"] < 20][:1])

    def snapshot():
        return spark.createDataFrame([(str(i),) for i in held], "id string")

    assert imports.reconcile(load, feed, snapshot) == 5 and len(held) == 20


def test_keys_of_different_types_join_alike_by_any_plan(spark):
    left = spark.createDataFrame([(1, "x")] * 300 + [(2, "y")], "k int, v string")
    right = spark.createDataFrame([(1, "one"), (5_000_000_000, "far")], "k bigint, w string")
    small, large = (rows(joins.lookup_join(left, right, "k", "left", limit)) for limit in (None, 0))
    assert small == large and sum(r[2] == "one" for r in small) == 300


def test_the_last_body_of_an_ad_counts(spark):
    feed = spark.createDataFrame([(1, False, 10, None), (2, True, 10, None)], f.FEED_SCHEMA)
    raw = spark.createDataFrame([(1, "new", 2), (1, "old", 1), (2, "gone", 1), (3, "other", 1)],
                                "annonsId bigint, body string, version int")
    assert rows(f.attach_raw(feed, raw).select("annonsId", "body")) == [(1, "new")]


def test_what_the_sink_shows(spark):
    ads = spark.createDataFrame(
        [("1", ((None, "c", [200.0, 1.0])), (["a" * 300, "b"],), None),
         ("2", (("1", None, [20.0, 1.0])), None, None)],
        "id string, workplace_address struct<country_code:string,country_concept_id:string,"
        "coordinates:array<double>>, keywords struct<skill:array<string>>, "
        "publication_date timestamp_ntz")
    live = ads.selectExpr(*snapshots.shown_sql(ads.schema)).orderBy("id").collect()
    assert live[0]["workplace_address"].asDict() == {
        "country_code": "199", "country_concept_id": "c", "coordinates": None}
    assert live[1]["workplace_address"]["country_concept_id"] == "i46j_HmG_v64"
    assert live[1]["workplace_address"]["coordinates"] == [20.0, 1.0]
    assert live[0]["keywords"]["skill"] == ["b"] and live[1]["keywords"] is None
    assert live[0]["publication_date"] is None
    gone = ads.selectExpr(*snapshots.shown_sql(ads.schema, removed=True)).first()
    assert gone["publication_date"].year == 1970


def test_publishing_a_missing_snapshot_moves_no_name(spark):
    with pytest.raises(FileNotFoundError):
        snapshots.publish_snapshot(spark, "nowhere", "/tmp/no-such", "/tmp/no-such")
    assert not spark.catalog.tableExists("nowhere_read")


def test_feed_cursor(spark):
    feed = spark.createDataFrame([(1, False, 10, None), (2, None, 20, None), (3, True, 20, None)],
                                 f.FEED_SCHEMA)
    ids = lambda df: [r[0] for r in rows(df)]
    assert ids(f.feed_changes(feed)) == [1, 2]
    assert ids(f.feed_changes(feed, 10)) == [2, 3]
    assert ids(f.feed_changes(feed, 20)) == [] and ids(f.feed_changes(feed, 20, True)) == [2, 3]


# --- Taxonomy ---

def test_positions_are_dense_over_gaps_and_partitions(spark):
    df = spark.range(100).repartition(5).select((F.col("id") % 3).cast("int").alias("o"), (F.col("id") * 5).alias("p"))
    got = [r["n"] for r in x.global_positions(df, "o", "p").orderBy("o", "p").collect()]
    assert got == list(range(100))


def test_a_missing_parent_fails_and_the_last_row_wins(spark):
    region = spark.createDataFrame([(0, "1", "Old", "r1"), (1, "1", "New", "r2")],
                                   "pos long, NationalNUTSLevel3Code string, Term string, uuid_id string")
    town = lambda code: spark.createDataFrame(
        [(0, "5", "Town", "m1", code)], "pos long, NationalNUTSLAU2Code string, Term string, "
        "uuid_id string, NationalNUTSLevel3Code string")
    built = x.build_categories({"regions": region, "municipalities": town("1")})
    assert built["municipalities"].first()["parent"]["label"] == "New"
    with pytest.raises(SparkRuntimeException, match="municipalities without a parent: 9"):
        x.build_categories({"regions": region, "municipalities": town("9")})["municipalities"].collect()


def test_every_category_has_an_id_place_and_a_type():
    assert sorted(x.ID_ORDER) == sorted(x.BY_NAME) and len(x.BY_NAME) == 23
    assert x.CATEGORIES.index(x.BY_NAME["job_terms"]) == 0
    assert x.BY_NAME["education_field_3"].number == "SUNField3ID"
    assert x.BY_NAME["education_level_3"].number == "SUNLevel3Code"


@pytest.fixture(scope="module")
def concepts(spark):
    job = lambda k, g, fl: (k, f"job {k}", "1", (g, f"group {g}", "2", (fl, f"field {fl}", "3")))
    named = [(i, "occupation-name", *r) for i, *r in (
        job("o1", "g1", "f1"), job("o2", "g2", "f2"), job("o3", "g3", "f3"))]
    plain = lambda i, t: (i, t, f"label {i}", f"leg {i}", None)
    return spark.createDataFrame([
        *named, plain("o4", "occupation-name"), plain("s1", "skill"), plain("s2", "skill"),
        plain("k1", "municipality"), plain("b", "driving-licence"), plain("se", "country"),
        plain("e", "sun-education-field-2"), plain("e", "sun-education-field-3"),
        plain("l", "sun-education-level-1"), plain("6YE1_gAC_R2G", "worktime-extent")], CONCEPTS)


@pytest.fixture(scope="module")
def pairs(spark):
    return spark.createDataFrame([
        (0, "o1", "old o1", "o2", "new o2"), (1, "o1", "old o1", "o3", "new o3"),
        (2, "s1", "old s1", "s1", "same"), (3, "s0", "gone", "s2", "kept")], PAIRS)


def test_the_last_newer_version_gives_group_and_field(spark, concepts, pairs):
    cards = {r["for_id"]: r for r in p.occupation_cards(concepts, pairs).collect()}
    assert sorted(cards) == ["o1", "o2", "o3"]  # o4 has no parent
    assert [e["concept_id"] for e in cards["o1"]["occupation"]] == ["o1", "o2", "o3"]
    assert cards["o1"]["occupation_group"][0]["concept_id"] == "g3"
    assert [e["label"] for e in cards["o2"]["occupation"]] == ["job o2", "old o1"]
    assert cards["o2"]["occupation_field"][0]["concept_id"] == "f2"


def test_a_concept_replaced_by_itself_is_added_once(spark, pairs):
    got = rows(p.equivalents(pairs).where("for_id = 's1'").select("concept_id", "new_version"))
    assert got == [("s1", True)]


def test_families_answer_with_the_lowest_level(spark, concepts):
    table = l.lookup_table(concepts).where("lookup_type = 'sun-education-field'")
    assert [r["entry"]["label"] for r in table.collect()] == ["label e"]


# --- Whole ads ---

def ads_from(spark, concepts, pairs, *messages):
    raw = spark.createDataFrame([(m["annonsId"], json.dumps(m)) for m in messages],
                                "annonsId bigint, body string")
    feed = spark.createDataFrame(
        [(m["annonsId"], False, 1000, None) for m in messages], f.FEED_SCHEMA)
    given = imports.Inputs(raw, n.prepare_taxonomy(concepts, pairs), run_date=RUN_DATE)
    found = imports.live_documents(feed, given, store=False).collect()
    return {int(r["id"]): r for r in found}


def test_missing_keys_and_nulls(spark, concepts, pairs):
    hours = {"arbetstidTyp": {"varde": "6YE1_gAC_R2G"}}
    ads = ads_from(
        spark, concepts, pairs, {"annonsId": 1, **hours},
        {"annonsId": 2, **hours, "arbetstidOmfattningFran": None, "arbetstidOmfattningTill": 50,
         "tillgangTillEgenBil": None, "arbetsplatsadress": {"gatuadress": None, "land": {"varde": "se"}},
         "kompetenser": None, "korkort": None, "kontaktpersoner": None, "yrkesroll": None,
         "utbildningsinriktning": None, "organisationsnummer": None, "antalPlatser": "many",
         "ingenErfarenhetKravs": None},
        {"annonsId": 3, "tillgangTillEgenBil": True, "ingenErfarenhetKravs": True,
         "annonstextFormaterad": "Jobba", "annonsrubrik": "hemifrån"})
    one, two, three = ads[1], ads[2], ads[3]
    assert tuple(one["scope_of_work"]) == (100.0, 100.0)
    assert tuple(two["scope_of_work"]) == (None, 50.0)
    assert tuple(three["scope_of_work"]) == (None, None)
    assert [one["access_to_own_car"], two["access_to_own_car"], three["access_to_own_car"]] == [
        False, None, True]
    assert one["workplace_address"]["street_address"] == ""
    assert two["workplace_address"]["street_address"] is None
    assert two["workplace_address"]["country_code"] == "leg se"
    assert two["workplace_address"]["country"] == "Sverige"
    assert one["workplace_address"]["country_concept_id"] == "i46j_HmG_v64"
    assert one["must_have"]["skills"] == [] and two["nice_to_have"]["skills"] == []
    assert two["application_contact"] == [] and two["number_of_vacancies"] is None
    assert [one["experience_required"], two["experience_required"], three["experience_required"]] == [
        True, True, False]
    assert one["remote_work"] is False and three["remote_work"] is True
    assert one["occupation"] is None and one["driving_license"] is None
    assert not one["driving_license_required"]


def test_a_full_ad(spark, concepts, pairs):
    ad = ads_from(spark, concepts, pairs, {
        "annonsId": 1, "yrkesroll": {"varde": "o1"}, "korkort": [{"varde": "b"}, {"varde": "x"}],
        "kompetenser": [{"varde": "s2", "vikt": 10}, {"varde": "zz", "vikt": 10},
                        {"varde": "s2", "vikt": 9}, {"varde": "s1"}],
        "utbildningsinriktning": {"varde": "e", "vikt": 3}, "utbildningsniva": {"varde": "l", "vikt": 10},
        "arbetsplatsadress": {"kommun": {"varde": "k1", "namn": "By"}, "longitud": "17.5",
                              "latitud": "norr", "postort": "123 By"},
        "organisationsnummer": "5501234567", "arbetsgivareNamn": "By AB", "arbetsplatsNamn": "By Norr AB",
        "publiceringsdatum": "2020-01-02 03:04:05"})[1]
    must, nice = ad["must_have"], ad["nice_to_have"]
    assert [(v["concept_id"], v["weight"]) for v in must["skills"]] == [
        ("s2", 10), (None, 10), ("s0", None)]
    assert [(v["concept_id"], v["weight"]) for v in nice["skills"]] == [
        ("s2", 9), ("s1", None), ("s0", None), ("s1", None)]
    assert [v["label"] for v in nice["education"]] == ["label e"]
    assert [(v["label"], v["weight"]) for v in nice["education_level"]] == [("label l", 10)]
    assert must["education"] == [] and [v["concept_id"] for v in ad["driving_license"]] == ["b"]
    assert ad["driving_license_required"] and ad["employer"]["organization_number"] is None
    assert ad["workplace_address"]["coordinates"] == [17.5, None]
    assert ad["workplace_address"]["municipality_code"] == "leg k1"
    assert ad["publication_date"] == dt.datetime(2020, 1, 2, 3, 4, 5)
    words = ad["keywords"]["extracted"]
    assert words["location"] == ["by", "sverige"] and words["employer"] == ["by"]
    assert words["skill"] == ["gone", "label s1", "label s2", "same"]
    assert words["occupation"] == ["field f3", "group g3", "job o1", "new o2", "new o3"]


def test_codes_beyond_the_bound_are_joined_with_the_same_result(spark, concepts, pairs):
    bodies = [{"annonsId": i, "arbetstidTyp": {"varde": "6YE1_gAC_R2G" if i % 2 else "unknown"},
               "kompetenser": [{"varde": v, "vikt": 10 * (i % 3)} for v in ("s2", "zz", "s1", None)[i % 4:]],
               "korkort": [{"varde": "b"}, {"varde": None}] if i % 3 else None,
               "utbildningsinriktning": {"varde": "e", "vikt": 3}, "utbildningsniva": {"varde": None},
               "arbetsplatsadress": {"kommun": {"varde": "k1"}, "land": {"varde": "se"}} if i % 2 else None}
              for i in range(24)] + [{"annonsId": 99}]
    raw = spark.createDataFrame([(str(m["annonsId"]), json.dumps(m)) for m in bodies],
                                "id string, body string")
    typed = f.parse_raw(raw)
    in_place, joined = (n.prepare_taxonomy(concepts, pairs, limit) for limit in (None, 0))
    assert in_place.in_place is not None and joined.in_place is None
    found = [[json.dumps(r.asDict(True), default=str) for r in n.normalise_ads(typed, taxonomy, RUN_DATE)
              .orderBy("id").collect()] for taxonomy in (in_place, joined)]
    assert found[0] == found[1] and len(found[0]) == 25
    empty = n.prepare_taxonomy(concepts.limit(0), pairs.limit(0))
    assert n.normalise_ads(typed, empty, RUN_DATE).count() == 25


# --- Enrichment ---

def test_candidates_by_threshold_or_headline(spark):
    kinds = ["occupations", "competencies", "traits", "geos"]
    df = spark.createDataFrame(
        [("d", t, f"L{p}", "T", i == 0, p, i) for t in kinds for p in (0.4, 0.5, 0.7, 0.8) for i in (0, 1)],
        "doc_id string, type string, concept_label string, term string, term_misspelled boolean, "
        "prediction double, sentence_index int")
    got = c.candidate_filter(df).groupBy("type").count()
    assert dict(rows(got)) == {"occupations": 5, "competencies": 6, "traits": 6, "geos": 6}
    lists = c.answered_lists(df.unionByName(df.limit(1).withColumn("doc_id", F.lit("e")).withColumn(
        "sentence_index", F.lit(3)))).orderBy("doc_id").collect()
    assert [len(v) for v in lists[1]["enriched"]] == [0, 0, 0, 0, 0]
    assert lists[0]["enriched"]["trait"] == ["l0.5", "l0.7", "l0.8"]
    terms = lists[0]["enriched_typeahead_terms"]
    assert terms["trait"] == ["l0.5", "l0.7", "l0.8", "t"]
    assert len(terms["compound"]) == len(terms["occupation"]) + len(terms["skill"]) + len(terms["location"])


def test_enrichment_needs_an_id_only_where_there_is_a_text(spark):
    schema = ("id string, headline string, description struct<text_formatted:string>, "
              "occupation array<struct<label:string>>, "
              "workplace_address struct<city:string,municipality:string,region:string,country:string>")
    ok = spark.createDataFrame([("1", None, ("t",), [("a",), ("b",)], ("c", None, None, "d")),
                                (None, "h", ("",), None, None)], schema)
    assert rows(c.enrichment_input(ok)) == [("1", "c |  |  | d | a b | ", "t")]
    bad = spark.createDataFrame([("", "h", ("t",), None, None)], schema)
    with pytest.raises(SparkRuntimeException, match="no id"):
        c.enrichment_input(bad).collect()


# --- Streaming ---

def test_stream_equals_batches_and_a_finished_stream_adds_nothing(spark, concepts, pairs, tmp_path):
    feeds = [[(1, False, 10, None), (2, False, 11, None)], [(1, True, 20, None), (3, False, 21, None)],
             [(3, False, 30, None), (2, False, 5, None)]]
    raw = spark.createDataFrame([(i, json.dumps({
        "annonsId": i, "annonsrubrik": f"ad {i}", "yrkesroll": {"varde": "o2"}})) for i in (1, 2, 3)],
        "annonsId bigint, body string")
    given = imports.Inputs(raw, n.prepare_taxonomy(concepts, pairs.where("false")), run_date=RUN_DATE)
    landing = tmp_path / "feed"
    landing.mkdir()
    root = fresh_path(spark, "s")
    main, deleted = f"{root}/ads", f"{root}/deleted"
    keys = f.FEED_SCHEMA.replace(" bigint", "").replace(" boolean", "").replace(" string", "").split(", ")
    for i, changes in enumerate(feeds):
        (landing / f"{i}.json").write_text("\n".join(json.dumps(dict(zip(keys, r))) for r in changes))
        source = stream.feed_stream(spark, str(landing))
        stream.stream_import(spark, source, main, deleted, lambda: given, f"{root}/cp"
                             ).awaitTermination()
    shown = ["id", "removed", "timestamp", "headline"]
    got = rows(snapshots.read_current(spark, main).select(*shown))
    assert got == [("1", True, 20, None), ("2", None, 5, "ad 2"), ("3", None, 30, "ad 3")]
    gone = snapshots.read_current(spark, deleted).first()
    assert gone["id"] == "1" and gone["occupation"]["concept_id"] == ["o2"]
    batch = f"{root}/batch"
    for table in (f"{batch}/ads", f"{batch}/deleted"):
        schemas = imports.document_schemas(spark.createDataFrame([], f.FEED_SCHEMA), given)
        snapshots.ensure_table(spark, table, schemas[table.endswith("deleted")])
    for changes in feeds:
        imports.load_batch(spark, spark.createDataFrame(changes, f.FEED_SCHEMA), f"{batch}/ads",
                           f"{batch}/deleted", given)
    assert rows(snapshots.read_current(spark, f"{batch}/ads").select(*shown)) == got
    again = stream.stream_import(spark, stream.feed_stream(spark, str(landing)), main, deleted, given,
                                 f"{root}/cp")
    again.awaitTermination()
    assert rows(snapshots.read_current(spark, main).select(*shown)) == got


def test_hot_keys_that_repeat_on_the_right_are_not_broadcast(spark):
    left = spark.createDataFrame([(1,)] * 300 + [(2,)], "k int")
    right = spark.createDataFrame([(1, n) for n in range(9)] + [(2, 0)], "k int, w int")
    found = joins.lookup_join(left, right, "k", "inner", 0)
    assert found.count() == 2701
    assert "Union" not in found._jdf.queryExecution().executedPlan().toString()
