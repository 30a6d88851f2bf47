"""The queries of this subpackage, each with the SQL that states its result, where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feedloom.session import tune

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run):
        def tuned(spark: SparkSession, sf_dir: str) -> DataFrame:
            return run(tune(spark), sf_dir)

        QUERIES[name] = tuned
        if sql is not None:
            ORACLE[name] = sql.strip()
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
