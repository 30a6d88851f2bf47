"""The incremental import as a stream over landed feed files.

Files are read once each, in the order they land, and every micro-batch becomes one batch of the
snapshot. Writer and batch number are the stream's own, so a batch repeated after a failure
replaces what it wrote before, and nothing else. Run with ``availableNow`` from a scheduler, or leave it running.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from feedloom.plans.imports import Inputs, ensure_tables, load_batch
from feedloom.sources.feed import FEED_SCHEMA


def feed_stream(spark: SparkSession, path: str, schema: str = FEED_SCHEMA, fmt: str = "json",
                max_files: int = 100) -> DataFrame:
    return (spark.readStream.format(fmt).schema(schema)
            .option("maxFilesPerTrigger", max_files).load(path))


def run_stream(stream: DataFrame, each_batch: Callable[[DataFrame, int], None], checkpoint: str,
               available_now: bool = True) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def stream_import(spark: SparkSession, stream: DataFrame, main: str, deleted: str,
                  inputs: Inputs | Callable[[], Inputs], checkpoint: str,
                  available_now: bool = True) -> StreamingQuery:
    """Upsert feed batches into a snapshot. A later batch wins over an earlier one.

    A stream that stays up should get ``inputs`` as a function: it is called for every batch and so
    sees bodies that landed meanwhile. An ad whose body has not landed is left to ``reconcile``.
    """
    given = inputs if callable(inputs) else lambda: inputs
    empty = spark.createDataFrame([], stream.schema)
    ensure_tables(spark, empty, main, deleted, given())

    def load(rows: DataFrame, number: int) -> None:
        load_batch(spark, rows, main, deleted, given(), stream_id(spark, checkpoint), number)

    return run_stream(stream, load, checkpoint, available_now)


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark keeps in a checkpoint: it outlives restarts, and a new checkpoint has another."""
    noted = spark.read.text(f"{checkpoint}/metadata", wholetext=True).first()[0]
    return "stream-" + json.loads(noted)["id"]
