"""Folders of micro-batch output, one sub-folder per batch id.

Writing a batch replaces its own folder only, so a batch that is run again after a failure
leaves the same content behind.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH = "batch_id"


def batch_path(folder: str, batch_id: int) -> str:
    return f"{folder}/{BATCH}={batch_id}"


def write_batch(df: DataFrame, folder: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(batch_path(folder, batch_id))


def read_batch(spark: SparkSession, folder: str, batch_id: int, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(batch_path(folder, batch_id))


def remove_batch(spark: SparkSession, folder: str, batch_id: int, part: str = "") -> None:
    path, files = _hadoop(spark, f"{batch_path(folder, batch_id)}/{part}")
    files.delete(path, True)


def batch_ids(spark: SparkSession, folder: str) -> list[int]:
    path, files = _hadoop(spark, folder)
    names = [status.getPath().getName() for status in files.listStatus(path)]
    return sorted(int(name.partition("=")[2]) for name in names if name.startswith(f"{BATCH}="))


def _hadoop(spark: SparkSession, location: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def read_changelog(spark: SparkSession, folder: str, schema) -> DataFrame:
    """Every update written so far, with its batch id."""
    with_batch = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
    return spark.read.schema(with_batch).option("basePath", folder).parquet(folder)


def last_wins(changelog: DataFrame, key: Sequence[str], version: str = BATCH) -> DataFrame:
    """What a reader of an update stream holds: the newest row per key.

    Values are taken column by column; a batch has at most one update per key, so they all come
    from the same update. Only the newest value per key and map task is exchanged.
    """
    values = [c for c in changelog.columns if c not in (*key, version)]
    return (
        changelog.groupBy(*key)
        .agg(*(F.max_by(c, version).alias(c) for c in values))
        .select(*[c for c in changelog.columns if c != version])
    )


def upsert_batches(folder: str, files: int | None = None):
    """A ``foreachBatch`` function collecting updates for ``last_wins``.

    A stateful batch has one task, and so one file, per state partition. ``files`` shuffles the
    (already aggregated) updates into fewer.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch if files is None else batch.repartition(files), folder, batch_id)

    return write


def compact(spark: SparkSession, folder: str, schema, key: Sequence[str], part: str = "") -> None:
    """Fold all but the two newest batches into one, keeping what ``last_wins`` gives.

    The two newest may still be run again or read by the next batch. The folded rows are added
    to the newest of the older batches before the others go: a stop in between only leaves rows
    that lose, or repeat the winner. ``part`` names the sub-folder of a batch that holds updates.
    """
    older = batch_ids(spark, folder)[:-2]
    if len(older) < 2:
        return
    changelog = read_changelog(spark, folder, schema).where(F.col(BATCH) <= older[-1])
    if part:
        name, _, value = part.partition("=")
        changelog = changelog.where(F.col(name) == value).drop(name)
    last_wins(changelog, key).write.mode("append").parquet(f"{batch_path(folder, older[-1])}/{part}")
    for batch_id in older[:-1]:
        remove_batch(spark, folder, batch_id)
