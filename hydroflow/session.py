"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_SCRATCH = "hydroflow.scratch.dir"


def build_session(master: str | None = None, app: str = "hydroflow", **conf: str) -> SparkSession:
    """A session with the settings the operators rely on.

    UTC, ANSI mode (bad casts raise), adaptive plans with skew splitting, and Kryo for the RDDs of MLlib's
    tree training, whose node statistics are shuffled once per level.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session that names none gets a folder of its own; a cluster session without one is
    refused, because a machine-local folder would be lost with its machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("Set spark.checkpoint.dir to a folder that all executors share.")
    own = spark.conf.get(_LOCAL_SCRATCH, None)
    if not own:
        own = tempfile.mkdtemp(prefix="hydroflow-")
        spark.conf.set(_LOCAL_SCRATCH, own)
    return own


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A new path below the shared folder, grouped by application so that it can be dropped as a whole."""
    return f"{shared_dir(spark)}/hydroflow/{spark.sparkContext.applicationId}/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The same rows as a table in the shared folder: computed once, lineage cut, column-pruned when read."""
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
