"""The streaming forms of the jobs. Each takes a streaming frame, so any source will do."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

from ..operators import rules, summary
from ..operators.shape import unpack
from ..params import AlertParams, JobParams, SummaryParams
from ..schemas import ALERT, SUMMARY_WIRE, TELEMETRY, TRANSACTION
from ..session import use_rocksdb_state, use_utc
from ..sources import topics
from .batches import upsert_batches
from .keyed import KeyedTable
from .strict import StrictSummary

COMMIT_INTERVAL = "30 seconds"
STRICT_INPUT = ("key", "quantity", "price", "kafka_timestamp", "partition", "offset")


def summary_updates(
    sales: DataFrame, window_minutes: int = 1, *, time_col: str = "timestamp", **columns
) -> DataFrame:
    """Windowed totals of a stream, with state dropped as soon as a window has ended.

    The watermark lags one micro-batch and spans all partitions, so it accepts rows that exact
    zero grace would drop; ``streaming.strict`` is the exact form.
    """
    watermarked = sales.withWatermark(time_col, "0 seconds")
    return summary.summarize(watermarked, window_minutes, time_col=time_col, **columns)


def late_rows(query: StreamingQuery) -> list[dict]:
    """Per batch still in the query's progress: rows read, and groups of late rows the watermark has dropped.

    Spark drops after partial sums, so a dropped number counts (window, key) pairs of a task rather than records;
    ``strict.StrictSummary`` reports records.
    """
    return [
        {
            "batch_id": one["batchId"],
            "rows": one["numInputRows"],
            "dropped": sum(state["numRowsDroppedByWatermark"] for state in one["stateOperators"]),
        }
        for one in map(dict, query.recentProgress)
    ]


def writer(
    frame: DataFrame, checkpoint: str, mode: str, *, name: str | None = None, once: bool = False
) -> DataStreamWriter:
    """Checkpointed writer; ``once`` drains what is there now, else one batch per commit interval."""
    out = frame.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if name:
        out = out.queryName(name)
    return out.trigger(availableNow=True) if once else out.trigger(processingTime=COMMIT_INTERVAL)


def summary_to_table(
    summaries: DataFrame, folder: str, checkpoint: str, *, once: bool = False, files: int | None = None
) -> StreamingQuery:
    """Update-mode changelog into ``folder``; read it with ``batches.last_wins``."""
    write = upsert_batches(folder, files)
    return writer(summaries, checkpoint, "update", once=once).foreachBatch(write).start()


def summary_to_keyed_table(
    summaries: DataFrame, table: KeyedTable, checkpoint: str, *, once: bool = False
) -> StreamingQuery:
    """Update-mode summaries into a table that can be read at any time."""
    write = lambda batch, batch_id: table.upsert(batch, batch_id)
    return writer(summaries, checkpoint, "update", once=once).foreachBatch(write).start()


def closed_windows(summaries: DataFrame, folder: str, checkpoint: str, *, once: bool = False) -> StreamingQuery:
    """One final row per window, written when the window ends."""
    return writer(summaries, checkpoint, "append", once=once).format("parquet").option("path", folder).start()


def alerts_to_files(telemetry: DataFrame, folder: str, checkpoint: str, *, once: bool = False) -> StreamingQuery:
    alerts = rules.raise_alerts(telemetry)
    return writer(alerts, checkpoint, "append", once=once).format("parquet").option("path", folder).start()


@dataclass(frozen=True)
class Intake:
    """How a job reads its topic.

    ``schema_ids`` are those the topic's messages may carry, or a map of them to the schemas they were written with. A message with another one, or damaged, stops the job, or
    is kept in ``foreign_folder`` if that is given. ``max_rows`` bounds a micro-batch, ``min_partitions`` splits hot topic
    partitions over more tasks; neither changes a result.
    """

    schema_ids: Collection[int] | Mapping[int, StructType]
    max_rows: int | None = None
    min_partitions: int | None = None
    foreign_folder: str | None = None

    def messages(self, spark: SparkSession, params: JobParams, schema, checkpoint: str) -> DataFrame:
        raw = topics.read_topic(spark, params, max_rows=self.max_rows, min_partitions=self.min_partitions)
        return self.decoded(raw, schema, checkpoint)

    def decoded(self, raw: DataFrame, schema, checkpoint: str) -> DataFrame:
        """The records, foreign messages going to their folder by a query of its own over the same offsets."""
        if self.foreign_folder is None:
            return unpack(topics.decode_topic(raw, schema, self.schema_ids))
        aside = topics.foreign_to_files(raw, self.schema_ids, self.foreign_folder, checkpoint)
        aside.trigger(processingTime=COMMIT_INTERVAL).start()
        return unpack(topics.decode_topic(raw, schema, self.schema_ids, on_foreign="leave"))


def supervise(spark: SparkSession, timeout: int | None = None) -> None:
    """Wait until any query of the session stops, then stop the others.

    A job that keeps foreign messages aside runs two queries over one topic: neither may go on without the other, or
    messages would be lost. An error of the query that stopped is raised. Queries that stopped earlier in the session count,
    unless ``spark.streams.resetTerminated()`` was called before the job's were started.
    """
    try:
        spark.streams.awaitAnyTermination(timeout) if timeout else spark.streams.awaitAnyTermination()
    finally:
        for query in spark.streams.active:
            query.stop()


def run_alerts(
    spark: SparkSession, params: AlertParams, checkpoint: str, schema_id: int, intake: Intake
) -> StreamingQuery:
    """Telemetry topic to alert topic: stateless, no exchange."""
    telemetry = intake.messages(use_utc(spark), params, TELEMETRY, checkpoint)
    alerts = rules.keyed_alerts(rules.raise_alerts(telemetry, rules.default_rules(params)))
    encoded = topics.encode_topic(alerts, schema_id, ALERT, "SensorAlerts")
    return topics.topic_writer(encoded, params, checkpoint, "append").start()


def _summary_messages(summaries: DataFrame, schema_id: int) -> DataFrame:
    return topics.encode_topic(summary.keyed_summary(summaries), schema_id, SUMMARY_WIRE, "sales_summary")


def run_summary(
    spark: SparkSession, params: SummaryParams, checkpoint: str, schema_id: int, intake: Intake
) -> StreamingQuery:
    """Sales topic to summary topic, one update per changed window and commit interval."""
    sales = intake.messages(use_rocksdb_state(use_utc(spark)), params, TRANSACTION, checkpoint)
    updates = summary_updates(sales, params.window_minutes, time_col="kafka_timestamp")
    out = topics.topic_writer(_summary_messages(updates, schema_id), params, checkpoint, "update")
    return out.trigger(processingTime=COMMIT_INTERVAL).start()


def run_strict_summary(
    spark: SparkSession, params: SummaryParams, checkpoint: str, schema_id: int, intake: Intake
) -> StreamingQuery:
    """As ``run_summary``, but judging every record by exact zero grace. A micro-batch is kept on the executors while it
    is judged, so ``intake.max_rows`` must bound it.
    """
    if intake.max_rows is None:
        raise ValueError("the strict summary needs intake.max_rows")
    sales = intake.messages(use_utc(spark), params, TRANSACTION, checkpoint).select(*STRICT_INPUT)
    job = StrictSummary(
        f"{checkpoint}/strict",
        params.window_minutes,
        time_col="kafka_timestamp",
        publish=lambda updates: topics.write_topic(_summary_messages(updates, schema_id), params),
    )
    return writer(sales, checkpoint, "append", name=params.app_id).foreachBatch(job).start()
