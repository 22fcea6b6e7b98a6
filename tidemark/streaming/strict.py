"""Exact zero-grace summary of a stream.

Every micro-batch is judged by the same rule as a table (``operators.lateness``), starting from
the record time each partition had reached before. What is carried between batches is small and
kept per batch id, so a repeated batch starts from the same state:

* ``expiry``  - when the windows of the batch expired, and with it the time its partitions reached;
* ``windows`` - running totals: those the batch changed (``changed=1``, kept as the update
  changelog) and those it left alone but which are still open in some partition (``changed=0``, dropped later). They hold
  whatever any partition has of an open window, so publishing does not look at closed ones.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars
from ..operators import lateness
from ..operators.summary import summary_record, totals, with_key_and_value
from . import batches

EXPIRY = T.StructType(
    [
        T.StructField("partition", T.IntegerType()),
        T.StructField(lateness.WINDOW_NO, T.IntegerType()),
        T.StructField("last_time", T.TimestampType()),
        T.StructField(lateness.EXPIRES_AT, T.LongType()),
    ]
)
TOTALS = T.StructType(
    [
        T.StructField("partition", T.IntegerType()),
        T.StructField("category", T.StringType()),
        T.StructField(lateness.WINDOW_NO, T.IntegerType()),
        T.StructField("total_quantity", T.LongType()),
        T.StructField("total_cents", T.LongType()),
    ]
)
WINDOWS = T.StructType([*TOTALS.fields, T.StructField("changed", T.IntegerType())])
GROUP = ("partition", "category", lateness.WINDOW_NO)


@dataclass(frozen=True)
class StrictSummary:
    """``foreachBatch`` target writing the update changelog below ``folder``.

    Offsets must rise from batch to batch within a partition, as a topic delivers them. As in
    the original, totals belong to a partition; ``result`` and what is published add up whatever
    several partitions hold of a key. ``publish`` receives the summary records every batch has
    changed; a repeated batch publishes them again. ``report`` receives the batch id and the numbers of records kept and late,
    counted in the pass that sums them. Every ``compact_every`` batches the changelog
    is folded, so neither its folders nor a reader's work grow with the number of batches.
    """

    folder: str
    window_minutes: int = 1
    key: str = "key"
    time_col: str = "timestamp"
    publish: Callable[[DataFrame], None] | None = None
    report: Callable[[int, int, int], None] | None = None
    compact_every: int = 100

    def _window_start(self) -> Column:
        return F.col(lateness.WINDOW_NO) * F.lit(self.window_minutes * 60_000).cast("bigint")

    def _path(self, part: str) -> str:
        return f"{self.folder}/{part}"

    def _at(self, spark: SparkSession, part: str, batch_id: int, schema: T.StructType) -> DataFrame:
        return batches.read_batch(spark, self._path(part), batch_id, schema)

    def _before(self, spark: SparkSession, part: str, batch_id: int, schema: T.StructType) -> DataFrame:
        return spark.createDataFrame([], schema) if batch_id == 0 else self._at(spark, part, batch_id - 1, schema)

    def _horizon(self, time_before: DataFrame) -> int | None:
        """The earliest window that is open in some partition seen so far; None before any record."""
        seen = F.min(scalars.window_index("seen_until", self.window_minutes))
        return time_before.agg(seen).first()[0]

    def _open(self, spark: SparkSession, batch_id: int, horizon: int | None) -> DataFrame:
        """Totals of the windows the previous batch left open in some partition."""
        windows = self._before(spark, "windows", batch_id, WINDOWS).select(*TOTALS.names)
        return windows if horizon is None else windows.where(F.col(lateness.WINDOW_NO) >= horizon)

    def _changed(self, spark: SparkSession, batch_id: int, horizon: int | None) -> DataFrame:
        """The summary records of the windows a batch changed, over all partitions.

        Only a partition that was never seen before can change a window behind the horizon; then, and only then, totals come
        from the whole changelog.
        """
        windows = self._at(spark, "windows", batch_id, WINDOWS)
        changed = windows.where("changed = 1").select("category", lateness.WINDOW_NO).distinct()
        behind = F.lit(False) if horizon is None else F.col(lateness.WINDOW_NO) < horizon
        totals_now = windows if changed.where(behind).isEmpty() else self._latest(spark)
        return self._summed(totals_now.select(*TOTALS.names).join(changed, ["category", lateness.WINDOW_NO]))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        expiry_before = self._before(spark, "expiry", batch_id, EXPIRY)
        time_before = expiry_before.groupBy("partition").agg(F.max("last_time").alias("seen_until"))
        records = with_key_and_value(batch, self.key).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            expiry = lateness.expiry_offsets(
                records, self.window_minutes, time_col=self.time_col, stream_time=time_before
            )
            # Written so that its real size is known before it is joined.
            batches.write_batch(expiry, self._path("expiry"), batch_id)
            expiry = self._at(spark, "expiry", batch_id, EXPIRY)

            kept = lateness.mark_late(records, self.window_minutes, time_col=self.time_col, expiry=expiry)
            kept, counts = lateness.counted(kept)
            added = (
                lateness.with_window_number(kept, self.window_minutes, self.time_col)
                .groupBy("partition", F.col(self.key).alias("category"), lateness.WINDOW_NO)
                .agg(*totals())
            )
            horizon = self._horizon(time_before)
            before = self._open(spark, batch_id, horizon)
            windows = (
                added.withColumn("changed", F.lit(1))
                .unionByName(before.withColumn("changed", F.lit(0)))
                .groupBy(*GROUP)
                .agg(*(F.sum(c).alias(c) for c in ("total_quantity", "total_cents")), F.max("changed").alias("changed"))
            )
            windows.write.mode("overwrite").partitionBy("changed").parquet(
                batches.batch_path(self._path("windows"), batch_id)
            )
            if self.report:
                self.report(batch_id, counts.get["kept"], counts.get["late"])
            if self.publish:
                self.publish(self._changed(spark, batch_id, horizon))
        finally:
            records.unpersist()
        if batch_id and batch_id % self.compact_every == 0:
            self.compact(spark)
        batches.remove_batch(spark, self._path("expiry"), batch_id - 2)
        batches.remove_batch(spark, self._path("windows"), batch_id - 2, "changed=0")

    def updates(self, spark: SparkSession) -> DataFrame:
        """Every update so far, with its batch id."""
        return batches.read_changelog(spark, self._path("windows"), WINDOWS).where("changed = 1").drop("changed")

    def compact(self, spark: SparkSession) -> None:
        """Fold old updates into one batch; may run between micro-batches at any time."""
        batches.compact(spark, self._path("windows"), WINDOWS, GROUP, "changed=1")

    def result(self, spark: SparkSession) -> DataFrame:
        """The summary table the changelog describes."""
        return self._summed(self._latest(spark))

    def _latest(self, spark: SparkSession) -> DataFrame:
        return batches.last_wins(self.updates(spark), GROUP)

    def _summed(self, latest: DataFrame) -> DataFrame:
        """Over all partitions that hold a window."""
        summed = latest.groupBy("category", self._window_start().alias("window_start")).agg(
            F.sum("total_quantity").alias("total_quantity"), F.sum("total_cents").alias("total_cents")
        )
        return summary_record(summed, self.window_minutes)
