"""What a summary job's window store holds, read from its checkpoint.

A store keeps the totals of windows that have not ended; the watermark of the last batch evicts the others. Reading it needs
no running job: the checkpoint is a table like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars
from ..operators.summary import summary_record

TOTALS = "struct<total_quantity: bigint, total_cents: bigint>"


def stores(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Operators of a job that keep state, with their partitions and the batches that can be read."""
    return spark.read.format("state-metadata").load(checkpoint)


def open_windows(spark: SparkSession, checkpoint: str, window_minutes: int, batch_id: int | None = None) -> DataFrame:
    """The summary records of the windows in the store after the last batch, or after ``batch_id``."""
    reader = spark.read.format("statestore")
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    rows = reader.load(checkpoint)
    # the store names its aggregates by their function alone, so they are taken by place
    started = rows.select(
        F.col("key.key").alias("category"),
        scalars.epoch_ms("key.window.start").alias("window_start"),
        F.col("value").cast(TOTALS).alias("t"),
    ).select("category", "window_start", "t.*")
    return summary_record(started, window_minutes)
