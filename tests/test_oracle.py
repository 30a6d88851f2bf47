"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest

from compare import connect, differences
from feedloom.lens import ORACLE, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_gives_the_rows_of_its_sql_without_a_cross_join(spark, con, name):
    found = QUERIES[name](spark, SF_DIR)
    assert differences(found, con, ORACLE[name]) == []
    assert "CartesianProduct" not in found._jdf.queryExecution().executedPlan().toString()


def test_only_html_cleaning_has_no_sql():
    assert set(QUERIES) - set(ORACLE) == {"k1_clean_html"}


def test_cleaned_pages_hold_text_and_no_markup_or_scripts(spark):
    from pyspark.sql import functions as F

    rows = QUERIES["k1_clean_html"](spark, SF_DIR)
    assert rows.count() == spark.read.parquet(f"{SF_DIR}/pages.parquet").count()
    assert rows.where((F.length("text") == 0) | F.col("text").contains("<script")).count() == 0
