"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# SQL settings the jobs rely on; all can be set on a running session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot key is cut into several tasks, even where that costs one more exchange.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128m",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app: str = "feedloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor sees. Only a local session that names none gets one of its own."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.getCheckpointDir():
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="feedloom-"))
    return spark.sparkContext.getCheckpointDir()


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path nothing has been written to yet."""
    return os.path.join(shared_dir(spark), "feedloom", f"{name}-{uuid.uuid4().hex}")


@contextmanager
def dropping_shuffles(spark: SparkSession):
    """Writes within remove their own shuffle files when they end: later steps read what is written.

    Spark else keeps them until the driver happens to collect its garbage.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def materialise(df, name: str):
    """Write ``df`` to the shared folder and read it back: the lineage ends at durable files."""
    path = fresh_path(df.sparkSession, name)
    with dropping_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df) -> None:
    """Delete the files of a table that ``materialise`` wrote and nothing will read any more."""
    jvm = df.sparkSession._jvm
    home = os.path.join(shared_dir(df.sparkSession), "feedloom").split(":", 1)[-1].lstrip("/")
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
        if home not in path.toString():
            raise ValueError(f"{folder} is not a table of this library's own")
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def spread(df, *keys: str):
    """Give costly per-row work one task per core where the scan has fewer splits than that.

    A scan of many files comes back as it is; only input too small to split is shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, *keys)
