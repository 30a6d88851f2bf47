"""Snapshots as commits: whole or not at all, folded, counted, published in one step."""

import json

import pytest

from feedloom import settings
from feedloom.operators import joins
from feedloom.plans import commits, imports, normalise as n, snapshots
from feedloom.plans.commits import Conflict
from feedloom.session import fresh_path
from feedloom.sources import feed as f
from pyspark.sql import functions as F
from test_operators import RUN_DATE, concepts, pairs, rows  # noqa: F401

ROW = "id string, removed boolean, timestamp bigint, v int"


@pytest.fixture
def table(spark):
    path = fresh_path(spark, "t") + "/ads"
    snapshots.ensure_table(spark, path, spark.createDataFrame([], ROW).schema)
    return path


def part(spark, *data):
    return spark.createDataFrame([(i, gone, time, v) for i, gone, time, v in data], ROW)


def held(spark, path):
    return rows(snapshots.read_current(spark, path).select("id", "v"))


def known(spark, path):
    table = snapshots.table_state(spark, path)
    return table.documents, table.live, table.newest


def true_counts(spark, path):
    return tuple(snapshots.read_current(spark, path).agg(
        F.count("*"), F.count_if(F.col("removed") == F.lit(False))).first())


def test_batches_replace_by_key_and_counts_follow(spark, table):
    assert held(spark, table) == [] and known(spark, table) == (0, 0, 0)
    for data in ([("a", False, 5, 1), ("b", False, 4, 1)], [("b", True, 9, 2), ("c", None, 3, 2)],
                 [("a", False, 1, 3)], [], [("b", False, 2, 4), ("z", True, 2, 4)]):
        snapshots.write_batch(part(spark, *data), table)
        assert known(spark, table)[:2] == true_counts(spark, table)
    assert held(spark, table) == [("a", 3), ("b", 4), ("c", 2), ("z", 4)]
    assert known(spark, table)[2] == 9
    assert len(snapshots.table_state(spark, table).parts) == 4


def test_a_named_writers_batch_counts_once(spark, table):
    for writer, number, v in (("s", 0, 1), ("s", 0, 2), ("s", 1, 3), ("s", 0, 4), ("r", 0, 5), (None, 0, 6)):
        snapshots.write_batch(part(spark, (f"{writer}{number}", False, v, v)), table, writer, number)
    assert held(spark, table) == [("None0", 6), ("r0", 5), ("s0", 1), ("s1", 3)]
    assert snapshots.holds(spark, table, "s", 1) and not snapshots.holds(spark, table, "s", 2)


def test_a_base_is_written_once(spark, table):
    snapshots.write_base(part(spark, ("a", False, 1, 1)), table)
    assert known(spark, table) == (1, 1, 1)
    with pytest.raises(FileExistsError):
        snapshots.write_base(part(spark, ("b", False, 1, 1)), table)
    with pytest.raises(FileNotFoundError):
        snapshots.read_current(spark, f"{table}-other")
    snapshots.ensure_table(spark, table, spark.createDataFrame([], "x int").schema)
    assert held(spark, table) == [("a", 1)]


def test_folding_changes_no_row_and_keeps_what_is_written_meanwhile(spark, table, monkeypatch):
    snapshots.write_base(part(spark, *[(f"{i:03}", False, i, 0) for i in range(50)]), table)
    snapshots.write_batch(part(spark, ("007", True, 90, 1), ("new", False, 91, 1)), table)
    snapshots.write_batch(part(spark, ("007", False, 92, 2)), table)
    before, counts = held(spark, table), known(spark, table)
    state = commits.read_state(spark, snapshots.located(table)[0])
    assert not snapshots.fold(spark, table, least=3)
    written = snapshots.write_part

    def interrupted(df, path, table_, *more, **others):
        found = written(df, path, table_, *more, **others)
        monkeypatch.setattr(snapshots, "write_part", written)
        snapshots.write_batch(part(spark, ("001", False, 93, 9)), table)
        return found

    monkeypatch.setattr(snapshots, "write_part", interrupted)
    assert snapshots.fold(spark, table)
    kinds = [p.kind for p in snapshots.table_state(spark, table).parts]
    assert kinds == ["base", "batch"]
    assert held(spark, table) == sorted([r for r in before if r[0] != "001"] + [("001", 9)])
    assert known(spark, table) == (*counts[:2], 93)
    # Who read the old parts goes on reading them.
    assert rows(snapshots.read_current(spark, table, state=state).select("id", "v")) == before


def test_of_two_folds_one_counts(spark, table, monkeypatch):
    snapshots.write_batch(part(spark, ("a", False, 1, 1)), table)
    written = snapshots.write_part

    def overtaken(*given, **others):
        monkeypatch.setattr(snapshots, "write_part", written)
        assert snapshots.fold(spark, table)
        return written(*given, **others)

    monkeypatch.setattr(snapshots, "write_part", overtaken)
    assert not snapshots.fold(spark, table)
    assert held(spark, table) == [("a", 1)] and len(snapshots.table_state(spark, table).parts) == 1


def test_unused_parts_go_when_no_kept_state_names_them(spark, table, monkeypatch):
    root, _ = snapshots.located(table)
    snapshots.write_batch(part(spark, ("a", False, 1, 1)), table)
    old = snapshots.table_state(spark, table).parts[0].name
    lost = snapshots.write_part(part(spark, ("x", False, 1, 1)), table,
                                snapshots.table_state(spark, table)).part
    snapshots.fold(spark, table)
    assert snapshots.remove_unused(spark, root) == []
    assert snapshots.remove_unused(spark, root, older_than=0) == [lost]
    monkeypatch.setattr(commits, "KEPT", 1)
    snapshots.write_batch(part(spark, ("b", False, 1, 1)), table)
    assert snapshots.remove_unused(spark, root, older_than=0) == [old]
    assert held(spark, table) == [("a", 1), ("b", 1)]


def test_two_writers_get_a_number_each(spark, table, monkeypatch):
    root, name = snapshots.located(table)
    created, turns = commits._created, []

    def slower(spark_, root_, state):
        if not turns:
            turns.append(1)
            commits.commit(spark, root, lambda s: s.tables[name].writers.update(other=1))
        return created(spark_, root_, state)

    monkeypatch.setattr(commits, "_created", slower)
    before = commits.read_state(spark, root).version
    snapshots.write_batch(part(spark, ("a", False, 1, 1)), table, "mine", 4)
    state = commits.read_state(spark, root)
    assert state.version == before + 2 and state.tables[name].writers == {"other": 1, "mine": 4}
    assert not created(spark, root, state)


def test_what_was_changed_meanwhile_is_a_conflict(spark, table):
    root, _ = snapshots.located(table)
    state = commits.read_state(spark, root)
    one = snapshots.write_part(part(spark, ("a", False, 1, 1)), table, state.tables["ads"])
    snapshots.write_batch(part(spark, ("a", False, 2, 2)), table)
    with pytest.raises(Conflict):
        snapshots.append(spark, [one], seen=state)
    assert held(spark, table) == [("a", 2)]


def test_a_probe_reads_the_range_of_the_batch_only(spark, table):
    snapshots.write_base(part(spark, ("a", False, 1, 1)), table)
    current = snapshots.read_current(spark, table).where(F.col("id").between("b", "c"))
    text = current.select("id")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(id,b)" in text and "ReadSchema: struct<id:string>" in text


# --- Whole imports ---

def ads_and_feeds(spark, concepts, pairs, **more):
    raw = spark.createDataFrame([(i, json.dumps({
        "annonsId": i, "annonsrubrik": f"ad {i}", "yrkesroll": {"varde": "o2"},
        "annonstextFormaterad": "text", "arbetsplatsId": str(i)})) for i in (1, 2, 3, 4)],
        "annonsId bigint, body string")
    given = imports.Inputs(raw, n.prepare_taxonomy(concepts, pairs.where("false")),
                           run_date=RUN_DATE, **more)
    feeds = [spark.createDataFrame(data, f.FEED_SCHEMA) for data in (
        [(1, False, 10, None), (2, False, 11, None)],
        [(1, True, 20, None), (3, False, 21, None), (2, False, 22, None)])]
    return given, feeds


class Stopped(RuntimeError):
    pass


def stop(*_, **__):
    raise Stopped


def both(spark, root):
    return [rows(snapshots.read_current(spark, f"{root}/{name}").select("id", "timestamp"))
            for name in ("ads", "deleted")]


@pytest.mark.parametrize("step", ["write_part", "append"])
def test_an_import_that_stops_anywhere_leaves_both_tables_as_they_were(
        spark, concepts, pairs, monkeypatch, step):  # noqa: F811
    given, (first, second) = ads_and_feeds(spark, concepts, pairs)
    root = fresh_path(spark, "stopped")
    main, deleted = f"{root}/ads", f"{root}/deleted"
    imports.incremental_import(spark, first, main, deleted, given)
    before = both(spark, root)
    work, calls = getattr(imports, step), []

    def once(*args, **named):
        calls.append(1)
        # The second part is that of removed ads: the ads are written by then.
        if step == "append" or len(calls) == 2:
            raise Stopped
        return work(*args, **named)

    monkeypatch.setattr(imports, step, once)
    with pytest.raises(Stopped):
        imports.load_batch(spark, second, main, deleted, given, "w", 7)
    assert both(spark, root) == before
    monkeypatch.setattr(imports, step, work)
    assert imports.load_batch(spark, second, main, deleted, given, "w", 7) == {
        "imported": 3, "live": 2}
    done = both(spark, root)
    assert done == [[("1", 20), ("2", 22), ("3", 21)], [("1", 20)]]
    assert imports.load_batch(spark, second, main, deleted, given, "w", 7)["imported"] == 0
    assert both(spark, root) == done


def test_columns_are_found_without_rows_and_a_batch_is_stored(
        spark, concepts, pairs, monkeypatch):  # noqa: F811
    given, (first, second) = ads_and_feeds(spark, concepts, pairs)
    given.taxonomy.in_place = None
    looked, search = [], joins.hot_keys
    monkeypatch.setattr(joins, "hot_keys", lambda *of: looked.append(1) or search(*of))
    # As with sides and feeds of any size.
    monkeypatch.setattr(settings, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(settings, "SKEW_CHECK_BYTES", 1)
    imports.documents(first, None, given, store=False)
    assert looked
    looked.clear()
    main, deleted = imports.document_schemas(first, given)
    assert not looked
    rows_of = imports.documents(second, None, given)
    assert [one.schema for one in rows_of] == [main, deleted]
    assert rows_of[1].inputFiles() and all("batch-rows" in name for name in rows_of[1].inputFiles())
    assert [rows(one.select("id", "timestamp")) for one in rows_of] == [
        [("1", 20), ("2", 22), ("3", 21)], [("1", 20)]]


def test_cursor_and_gate_read_no_rows(spark, concepts, pairs, monkeypatch):  # noqa: F811
    given, (first, _) = ads_and_feeds(spark, concepts, pairs)
    root = fresh_path(spark, "counts")
    imports.incremental_import(spark, first, f"{root}/ads", f"{root}/deleted", given)
    snapshots.show(spark, "cheap", f"{root}/ads", f"{root}/deleted")
    monkeypatch.setattr(imports, "read_current", stop)
    monkeypatch.setattr(snapshots, "_parts", stop)
    assert imports.cursor(spark, f"{root}/ads") == 11
    assert imports.cursor(spark, f"{root}/ads", 3) == 3 and imports.cursor(spark, f"{root}/no") == 0
    assert imports.gate(spark, f"{root}/ads", "cheap", needed=True)


def shown(spark, prefix):
    return {name: rows(spark.table(f"{prefix}_{name}").select("id"))
            for name in ("read", "write", "stream", "deleted")}


@pytest.mark.parametrize("step", [("commits", "_created"), ("snapshots", "show"),
                                  ("snapshots", "point_view")])
def test_publishing_that_stops_leaves_all_names_on_one_snapshot(
        spark, concepts, pairs, monkeypatch, step):  # noqa: F811
    given, (first, second) = ads_and_feeds(spark, concepts, pairs)
    root = fresh_path(spark, "names")
    prefix = "p" + root.rsplit("-", 1)[1]
    main, deleted = f"{root}/ads", f"{root}/deleted"
    imports.incremental_import(spark, first, main, deleted, given)
    snapshots.publish_snapshot(spark, prefix, main, deleted)
    old = shown(spark, prefix)
    assert old["read"] == [("1",), ("2",)] and old["deleted"] == []
    live, _ = imports.documents(second.where("annonsId = 3"), None, given)
    snapshots.write_base(live, f"{root}/next")
    owner = {"commits": commits, "snapshots": snapshots}[step[0]]
    work = getattr(owner, step[1])
    monkeypatch.setattr(owner, step[1], stop)
    if step[1] == "point_view":
        # The names are queries over the log: there is nothing to be pointed anew.
        snapshots.publish_snapshot(spark, prefix, f"{root}/next", deleted)
    else:
        with pytest.raises(Stopped):
            snapshots.publish_snapshot(spark, prefix, f"{root}/next", deleted)
        assert shown(spark, prefix) == old
        monkeypatch.setattr(owner, step[1], work)
        snapshots.publish_snapshot(spark, prefix, f"{root}/next", deleted)
    assert shown(spark, prefix) == {name: [("3",)] if name != "deleted" else [] for name in old}
    monkeypatch.setattr(owner, step[1], work)
    # What is imported into a published snapshot shows without publishing again.
    imports.load_batch(spark, second, f"{root}/next", deleted, given)
    assert shown(spark, prefix)["deleted"] == [("1",)]
    assert shown(spark, prefix)["read"] == [("1",), ("2",), ("3",)]
    with pytest.raises(Conflict):
        snapshots.drop_table(spark, f"{root}/next")
    snapshots.fold(spark, f"{root}/next")
    assert shown(spark, prefix)["read"] == [("1",), ("2",), ("3",)]


def test_a_published_name_reads_the_parts_of_its_table_only(spark, concepts, pairs):  # noqa: F811
    given, (first, second) = ads_and_feeds(spark, concepts, pairs)
    root = fresh_path(spark, "pruned")
    prefix = "p" + root.rsplit("-", 1)[1]
    main, deleted = f"{root}/ads", f"{root}/deleted"
    for feed in (first, second):
        imports.incremental_import(spark, feed, main, deleted, given)
    snapshots.publish_snapshot(spark, prefix, main, deleted)
    plan = spark.table(f"{prefix}_read")._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()


def test_columns_that_change_keep_the_old_names_whole(spark):
    root = fresh_path(spark, "columns")
    prefix = "p" + root.rsplit("-", 1)[1]
    one = spark.createDataFrame([("a", False, 1)], "id string, removed boolean, v int")
    gone = spark.createDataFrame([], """id string, removed boolean, occupation struct<concept_id:
        array<string>>, workplace_address struct<region_concept_id:string>""")
    snapshots.ensure_table(spark, f"{root}/gone", gone.schema)
    snapshots.write_base(one, f"{root}/one")
    snapshots.write_base(one.withColumn("w", F.lit(2)).withColumn("id", F.lit("b")), f"{root}/two")
    snapshots.publish_snapshot(spark, prefix, f"{root}/one", f"{root}/gone")
    snapshots.show(spark, prefix, f"{root}/two", f"{root}/gone")
    # Stopped before the names of the new columns were made.
    assert shown(spark, prefix)["read"] == shown(spark, prefix)["write"] == [("a",)]
    snapshots.publish_snapshot(spark, prefix, f"{root}/two", f"{root}/gone")
    assert rows(spark.table(f"{prefix}_read").select("id", "w")) == [("b", 2)]


# --- Late answers ---

CANDIDATE = ("doc_id string, type string, concept_label string, term string, "
             "term_misspelled boolean, prediction double, sentence_index int")


def answers(spark, *ids):
    return spark.createDataFrame([(str(i), "competencies", f"Skill {i}", "t", False, 0.9, 1)
                                  for i in ids], CANDIDATE)


def enriched(spark, main):
    return dict(rows(snapshots.read_current(spark, main).select(
        "id", F.array_join("keywords.enriched.skill", ",").alias("s"))))


def waiting(spark, main):
    return [r[0] for r in rows(snapshots.read_current(spark, imports.ledger_path(main))
                               .where("open").select("id"))]


def test_answers_that_land_late_are_patched_in(spark, concepts, pairs):  # noqa: F811
    logos = spark.createDataFrame([("workplace", "2", "logo 2")], "kind string, key string, url string")
    given, (first, second) = ads_and_feeds(spark, concepts, pairs, logos=logos,
                                           candidates=answers(spark, 1))
    root = fresh_path(spark, "late")
    main, deleted = f"{root}/ads", f"{root}/deleted"
    imports.incremental_import(spark, first, main, deleted, given)
    assert enriched(spark, main) == {"1": "skill 1", "2": None} and waiting(spark, main) == ["2"]
    assert imports.attach_late_answers(spark, main, answers(spark, 1, 9)) == 0
    state = snapshots.table_state(spark, main)
    assert imports.attach_late_answers(spark, main, answers(spark, 2)) == 1
    assert enriched(spark, main) == {"1": "skill 1", "2": "skill 2"} and waiting(spark, main) == []
    now = snapshots.table_state(spark, main)
    assert (now.documents, now.live, now.newest) == (state.documents, state.live, state.newest)
    assert rows(snapshots.read_current(spark, main).select("id", "logo_url", "headline")) == [
        ("1", None, "ad 1"), ("2", "logo 2", "ad 2")]
    # A change of 2 asks again, 3 is new, and 1 is removed.
    imports.incremental_import(spark, second, main, deleted, given)
    assert enriched(spark, main) == {"1": None, "2": None, "3": None}
    assert waiting(spark, main) == ["2", "3"]


def test_a_removed_ad_no_longer_waits(spark, concepts, pairs):  # noqa: F811
    given, (first, second) = ads_and_feeds(spark, concepts, pairs, candidates=answers(spark))
    root = fresh_path(spark, "gone")
    for feed in (first, second):
        imports.incremental_import(spark, feed, f"{root}/ads", f"{root}/deleted", given)
    assert waiting(spark, f"{root}/ads") == ["2", "3"]


def test_a_patch_never_brings_back_an_older_ad(spark, concepts, pairs, monkeypatch):  # noqa: F811
    given, (first, second) = ads_and_feeds(spark, concepts, pairs, candidates=answers(spark))
    root = fresh_path(spark, "race")
    main, deleted = f"{root}/ads", f"{root}/deleted"
    imports.incremental_import(spark, first, main, deleted, given)
    append, turns = imports.append, []

    def overtaken(*args, **named):
        if named.get("seen") is not None and not turns:
            turns.append(1)
            imports.load_batch(spark, second, main, deleted, given)
        return append(*args, **named)

    monkeypatch.setattr(imports, "append", overtaken)
    assert imports.attach_late_answers(spark, main, answers(spark, 1, 2)) == 1
    assert enriched(spark, main) == {"1": None, "2": "skill 2", "3": None}
    assert rows(snapshots.read_current(spark, main).select("id", "timestamp")) == [
        ("1", 20), ("2", 22), ("3", 21)]
    assert waiting(spark, main) == ["3"]


def test_differences_are_summed_and_folded(spark):
    path = fresh_path(spark, "sums") + "/terms"
    counts = lambda *data: spark.createDataFrame(data, imports.DICTIONARY)
    snapshots.ensure_table(spark, path, counts().schema, ("documents",))
    for data in ([("a", "x", 2), ("a", "y", 1)], [("a", "x", 3), ("a", "y", -1)], [("b", None, 5)]):
        snapshots.write_batch(counts(*data), path)
    want = [("a", "x", 5), ("b", None, 5)]
    assert rows(snapshots.read_current(spark, path)) == want
    assert snapshots.fold(spark, path) and rows(snapshots.read_current(spark, path)) == want
    snapshots.write_batch(counts(("a", "x", -5)), path)
    assert rows(snapshots.read_current(spark, path)) == want[1:]
    assert len(snapshots.table_state(spark, path).parts) == 2


def dictionary(spark, main):
    return rows(snapshots.read_current(spark, imports.dictionary_path(main)))


def counted(spark, main):
    return rows(imports.ad_terms(snapshots.read_current(spark, main)).groupBy("list", "term").count())


def test_the_dictionary_follows_every_batch(spark, concepts, pairs):  # noqa: F811
    given, (first, second) = ads_and_feeds(spark, concepts, pairs, candidates=answers(spark, 1, 2))
    root = fresh_path(spark, "terms")
    main, deleted = f"{root}/ads", f"{root}/deleted"
    imports.incremental_import(spark, first, main, deleted, given)
    assert dictionary(spark, main) == counted(spark, main) == [
        ("skill", "skill 1", 1), ("skill", "skill 2", 1), ("skill", "t", 2)]
    imports.incremental_import(spark, second, main, deleted, given, fold_after=1)
    assert dictionary(spark, main) == counted(spark, main) == [
        ("skill", "skill 2", 1), ("skill", "t", 1)]
    imports.attach_late_answers(spark, main, answers(spark, 3))
    assert dictionary(spark, main) == counted(spark, main) == [
        ("skill", "skill 2", 1), ("skill", "skill 3", 1), ("skill", "t", 2)]


def test_the_dictionary_holds_whichever_of_two_writers_is_faster(
        spark, concepts, pairs, monkeypatch):  # noqa: F811
    given, (first, second) = ads_and_feeds(spark, concepts, pairs, candidates=answers(spark, 1, 2, 3))
    root = fresh_path(spark, "terms")
    main, deleted = f"{root}/ads", f"{root}/deleted"
    imports.incremental_import(spark, first, main, deleted, given)
    append, turns = imports.append, []

    def overtaken(*args, **named):
        if not turns:
            turns.append(1)
            imports.load_batch(spark, second.where("annonsId = 2"), main, deleted, given)
        return append(*args, **named)

    monkeypatch.setattr(imports, "append", overtaken)
    imports.load_batch(spark, second, main, deleted, given)
    assert dictionary(spark, main) == counted(spark, main)
    assert [r for r in dictionary(spark, main) if r[1] == "t"] == [("skill", "t", 2)]


def test_saved_ads_become_a_snapshot(spark, concepts, pairs):  # noqa: F811
    given, (first, second) = ads_and_feeds(spark, concepts, pairs)
    root = fresh_path(spark, "saved")
    ads = [imports.documents(feed, None, given)[0].where("NOT coalesce(removed, false)")
           for feed in (first, second)]
    for one in ads:
        one.write.mode("append").parquet(f"{root}/saved")
    imports.rebuild_from_saved(spark, f"{root}/saved", f"{root}/ads")
    assert rows(snapshots.read_current(spark, f"{root}/ads").select("id", "timestamp")) == [
        ("1", 10), ("2", 22), ("3", 21)]
    assert snapshots.table_state(spark, f"{root}/ads").parts[0].kind == "base"


# --- Landed bodies ---

def test_only_the_days_and_buckets_of_a_batch_are_read(spark):
    path, day = fresh_path(spark, "bodies"), 24 * 3600 * 1000
    for n, when in enumerate(("2024-01-01", "2024-01-10", "2024-01-11")):
        bodies = spark.range(200).selectExpr("id AS annonsId", f"'{n} of ' || id AS body", f"{n} AS version")
        f.land_bodies(bodies, path, 16, F.lit(when))
    raw = f.landed_bodies(spark, path, "annonsId bigint, body string, version int")
    start = 1704844800000  # 2024-01-10
    feed = spark.createDataFrame([(7, False, start + day, None), (9, False, start + day, None),
                                  (11, True, 0, None), (999, False, start + day, None),
                                  (None, False, start + day, None)], f.FEED_SCHEMA)
    found = f.attach_raw(feed, raw, buckets=16)
    assert rows(found.select("annonsId", "body")) == [(7, "2 of 7"), (9, "2 of 9")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(landed" in plan and "bucket#" in plan
    wanted = feed.where("annonsId IN (7, 9)").selectExpr("annonsId", "uppdateradTid AS updatedAt")
    named = raw.withColumn("file", F.input_file_name())
    files = [r[0] for r in f.of_batch(named, wanted, 16).select("file").distinct().collect()]
    read = f.of_batch(raw, wanted, 16)._jdf.queryExecution().executedPlan().toString()
    assert len(files) <= 4 and "2024-01-10" in read
    days = {name.split("landed=")[1][:10] for name in files}
    assert days == {"2024-01-10", "2024-01-11"}
    assert f.attach_raw(feed.limit(0), raw, buckets=16).collect() == []


def test_bodies_without_folders_are_found_as_before(spark):
    feed = spark.createDataFrame([(1, False, 10, None), (2, True, 10, None)], f.FEED_SCHEMA)
    raw = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1)],
                                "annonsId bigint, body string, version int")
    assert rows(f.attach_raw(feed, raw).select("annonsId", "body")) == [(1, "b")]
