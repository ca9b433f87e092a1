"""Session construction and the shared scratch location.

Intermediate files (written tables used to cut lineage, round-trip tests of
sources and sinks) go under the cluster's shared checkpoint folder,
``spark.checkpoint.dir``. It is read from the session; only when it is unset
(a local test run) a fresh local folder is made and registered.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # Python call-site capture for error messages costs several py4j round
    # trips per DataFrame/Column call while a plan is built; batch jobs skip it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_session(master: str | None = None, *, app: str = "feedlens", shuffle_partitions: int | None = None,
                conf: dict | None = None) -> SparkSession:
    """A session with adaptive execution on; ``master`` only for local runs."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (conf or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The session's checkpoint folder; a fresh local one only when none is configured on a local master.

    On a cluster a folder of one machine would lose what other machines write: that is refused.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError(f"set spark.checkpoint.dir to a folder that all machines of {master} share")
    local = tempfile.mkdtemp(prefix="feedlens-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused path under the checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/feedlens-scratch/{label}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the scratch folder and read back: for a result that several later steps read."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


__all__ = ["checkpoint_root", "get_session", "scratch_path", "stored"]
