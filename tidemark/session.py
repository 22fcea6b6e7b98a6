"""Session-level settings every job shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_utc(spark: SparkSession) -> SparkSession:
    """Windows are epoch-aligned, so wall-clock casts must happen in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def use_rocksdb_state(spark: SparkSession) -> SparkSession:
    """Keep streaming state off the executor heap, with incremental (changelog) checkpoints."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    return spark


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder below the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster the executors
    would not see it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="tidemark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/tidemark/{purpose}-{uuid.uuid4().hex}"


def written_to(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to a new folder all executors can reach and read it back.

    This cuts the lineage, survives executor loss, and gives the planner the true size of an
    aggregate, so whether it is broadcast follows from a measured size.
    """
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
