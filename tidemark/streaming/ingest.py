"""The ingest chain as jobs: generated rows to a topic, a topic into the table, new table rows
to the sales topic."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from ..functions import wire
from ..operators import shape
from ..schemas import GENERATED_TRANSACTION, TELEMETRY, TRANSACTION
from ..sources import database, synthetic, topics
from . import batches
from .jobs import Intake

OFFSET = T.StructType([T.StructField("last", T.TimestampNTZType())])

# The session and the offset reached so far, to the rows newer than that (none: None) and the offset they reach.
Read = Callable[[SparkSession, datetime | None], tuple[DataFrame | None, datetime | None]]
Send = Callable[[DataFrame], None]


@dataclass(frozen=True)
class TablePoll:
    """``foreachBatch`` target polling a table on every tick of a clock stream.

    The offset reached is stored per tick after the rows are sent: a tick that fails is polled
    again from where it started, so rows are sent at least once.
    """

    read: Read
    send: Send
    folder: str

    def last_offset(self, spark: SparkSession, batch_id: int) -> datetime | None:
        if batch_id == 0:
            return None
        row = batches.read_batch(spark, self.folder, batch_id - 1, OFFSET).first()
        return row["last"]

    def __call__(self, tick: DataFrame, batch_id: int) -> None:
        spark = tick.sparkSession
        last = self.last_offset(spark, batch_id)
        rows, newest = self.read(spark, last)
        if rows is not None and newest != last:
            self.send(rows)
        batches.write_batch(spark.createDataFrame([(newest,)], OFFSET).coalesce(1), self.folder, batch_id)
        batches.remove_batch(spark, self.folder, batch_id - 2)


@dataclass(frozen=True)
class OverlappingPoll:
    """As ``TablePoll`` for a table whose rows may become visible after later ones: polls reach ``overlap`` back.

    ``read`` takes the session and a time and gives the rows behind it and the latest time among them. Keys sent within the
    overlap are kept in a ledger per tick, written with the offset after the rows are sent: a tick that fails is polled
    again, so rows are sent at least once, and exactly once without failures.
    """

    read: Read
    send: Send
    folder: str
    key: tuple[str, ...]
    overlap: timedelta
    ts_col: str = "timestamp"

    def _part(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def __call__(self, tick: DataFrame, batch_id: int) -> None:
        spark = tick.sparkSession
        last = ledger = None
        if batch_id:
            last = batches.read_batch(spark, self._part("offsets"), batch_id - 1, OFFSET).first()["last"]
            ledger = spark.read.parquet(batches.batch_path(self._part("ledger"), batch_id - 1))
        rows, newest = self.read(spark, None if last is None else last - self.overlap)
        if rows is None:
            newest = last
        else:
            newest = newest if last is None else max(newest, last)
            rows = database.unsent(rows, self.ts_col, self.key, ledger).persist()
        try:
            if rows is not None:
                self.send(rows)
                kept = database.next_ledger(rows, self.ts_col, self.key, newest, self.overlap, ledger)
                batches.write_batch(kept, self._part("ledger"), batch_id)
            else:
                empty = spark.createDataFrame([], "none string") if ledger is None else ledger
                batches.write_batch(empty, self._part("ledger"), batch_id)
        finally:
            if rows is not None:
                rows.unpersist()
        batches.write_batch(spark.createDataFrame([(newest,)], OFFSET).coalesce(1), self._part("offsets"), batch_id)
        for part in ("offsets", "ledger"):
            batches.remove_batch(spark, self._part(part), batch_id - 2)


def clock_stream(spark: SparkSession) -> DataFrame:
    """One row per second; only its micro-batches matter."""
    return spark.readStream.format("rate").option("rowsPerSecond", 1).load()


def poll_table(poll: TablePoll, clock: DataFrame, checkpoint: str, interval: str = "1 second") -> DataStreamWriter:
    return (
        clock.writeStream.foreachBatch(poll)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=interval)
    )


def read_table(table: database.JdbcTable, ts_col: str = "timestamp", **slicing) -> Read:
    """Polls over JDBC, each up to the database's own time, whatever zone it runs in; the time column comes back as an
    instant."""

    def read(spark: SparkSession, last: datetime | None):
        rows, newest = table.increment(spark, ts_col, last, **slicing)
        return rows if rows is None else rows.withColumn(ts_col, rows[ts_col].cast("timestamp")), newest

    return read


def sales_messages(rows: DataFrame, full_name: str = "sales.sales_transactions") -> DataFrame:
    """Table rows through the transform chain: (key, value, topic)."""
    return shape.sales_chain(full_name)(shape.envelope("sales_transactions", TRANSACTION.names)(rows))


def send_sales(bootstrap_servers: str, schema_id: int) -> Send:
    """Write table rows to the topic the chain names."""

    def send(rows: DataFrame) -> None:
        messages = sales_messages(rows)
        body = wire.encode_record(messages["value"], TRANSACTION, shape.record_name(messages))
        messages.select(
            messages["key"].cast("binary").alias("key"), wire.framed(body, schema_id).alias("value"), "topic"
        ).write.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers).save()

    return send


def store_transactions(
    raw: DataFrame, table: database.JdbcTable, checkpoint: str, intake: Intake, clash_folder: str | None = None
) -> DataStreamWriter:
    """Generated transactions from their topic into the table. A row's time is its message's, in whole seconds."""
    messages = intake.decoded(raw, GENERATED_TRANSACTION, checkpoint)
    timed = messages.withColumn("timestamp", F.date_trunc("second", "kafka_timestamp"))
    rows = timed.select(*GENERATED_TRANSACTION.names, "timestamp")
    write = database.append_batches(table, clash_folder=clash_folder)
    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


# Per kind of generated record: its maker, schema, record name and key field.
GENERATED = {
    "telemetry": (synthetic.telemetry, TELEMETRY, "SensorTelemetry", "sensor_id"),
    "transactions": (synthetic.transactions, GENERATED_TRANSACTION, "SalesTransaction", "transaction_id"),
}


def generated_messages(kind: str, rows: DataFrame, schema_id: int) -> DataFrame:
    """Synthetic rows as topic messages, keyed by the field their generator names."""
    make, schema, name, key = GENERATED[kind]
    keyed = shape.key_from(key)(shape.envelope("", schema.names)(make(rows)))
    return topics.encode_topic(keyed, schema_id, schema, name)
