"""What the plans look like: small sides are broadcast, and Python stays out of all but two jobs."""

import pytest

from feedloom.lens import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def plan(spark, name):
    return QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [
    "requirements_per_ad", "k3_trim_location", "k4_employer_names", "k5_label_split", "t3_prefix_grams",
    "t5_shingles", "k9_enriched_terms", "s4_upsert_index", "j9_occupation_hierarchy", "p6_education_split"])
def test_no_python_in_the_plan(spark, name):
    text = plan(spark, name)
    assert "Python" not in text and "Pandas" not in text


@pytest.mark.parametrize("name", ["requirements_per_ad", "j1_concept_lookup", "k9_enriched_terms"])
def test_the_looked_up_side_is_broadcast(spark, name):
    assert "BroadcastHashJoin" in plan(spark, name)


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(spark, "requirements_per_ad")
    assert "PushedFilters: [IsNotNull(p_type), Not(EqualTo(p_type,PROMO))" in text
    assert "l_extendedprice" not in text and "l_shipdate" not in text


def test_counts_are_merged_before_the_shuffle(spark):
    assert "partial_count" in plan(spark, "requirements_per_ad")


@pytest.mark.parametrize("name", ["s3_batch_dedup", "s4_upsert_index", "u2_dict_dedup", "a7_legacy_to_concept"])
def test_last_row_per_key_needs_no_window(spark, name):
    text = plan(spark, name)
    assert "Window" not in text and "partial_max_by" in text


def test_the_flagship_never_sorts_to_aggregate(spark):
    assert "SortAggregate" not in plan(spark, "requirements_per_ad")


def test_occupations_are_joined_without_moving_the_ads(spark):
    assert "SortMergeJoin" not in plan(spark, "j9_occupation_hierarchy")


def test_ads_are_resolved_where_they_stand(spark):
    text = plan(spark, "p1_normalise_ad")
    # One exchange spreads the given orders over the cores; no ad is moved after that.
    assert text.count("Exchange hashpartitioning") <= 1 and "SortMergeJoin" not in text
    assert "Aggregate" not in text and "Generate" not in text


def test_keywords_need_no_text_and_no_dates(spark):
    assert "Python" not in plan(spark, "k7_extracted_keywords")


def test_numbering_needs_no_window_over_the_rows(spark):
    assert "row_number" not in plan(spark, "j14_concept_id_assign")


def test_removed_ads_are_routed_in_one_pass(spark):
    from feedloom.lens import tables as t
    from feedloom.operators.snapshot import route_tombstones

    main, _ = route_tombstones(t.documents(spark, SF_DIR))
    assert "Union" not in main._jdf.queryExecution().executedPlan().toString()
