"""Session settings and the shared folder used for staged tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter for correctness or for plans at scale. Everything else
# is left to the cluster.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # GBK / GB18030 review files can only be read with the JVM's own charsets.
    "spark.sql.legacy.javaCharsets": "true",
}


def build_session(app: str = "quillspark", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: there the driver
    and the executors are the same machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    fallback = os.path.join(tempfile.gettempdir(), f"quillspark-{os.getpid()}")
    os.makedirs(fallback, exist_ok=True)
    spark.conf.set("spark.checkpoint.dir", fallback)
    return fallback


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a table that is written once and read back."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df, name: str):
    """Write a table that several later jobs read, and return the read-back.

    Used before iterative fits: the input is computed once, survives the loss
    of executors, and its lineage is cut.
    """
    path = staging_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df, *cols):
    """Rows of an input with fewer partitions than cores, spread by ``cols``.

    For work that is heavy per row on a table of one or a few files. Only the
    plan is looked at; a table with enough partitions is returned as it is, so
    nothing is shuffled at scale.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *cols) if df.rdd.getNumPartitions() < cores else df
