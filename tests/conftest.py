import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from feedloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", **{
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """Values a column function gives for a list of inputs."""
    from pyspark.sql import functions as F

    def run(function, inputs, ddl="string"):
        rows = spark.createDataFrame(list(enumerate(inputs)), f"i int, v {ddl}")
        found = rows.select("i", function(F.col("v")).alias("r")).orderBy("i").collect()
        return [row["r"] for row in found]

    return run
