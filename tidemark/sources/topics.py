"""Topic sources and sinks over Spark's Kafka connector.

The connector ships as a separate Spark package; the option maps are plain functions so the
wiring can be checked without it.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..functions import evolution, wire
from ..operators.shape import record_name
from ..params import JobParams


def reader_options(params: JobParams, max_rows: int | None = None, min_partitions: int | None = None) -> dict:
    """Start at the earliest record, as a new consumer group of the original jobs does."""
    options = {
        "kafka.bootstrap.servers": params.bootstrap_servers,
        "subscribe": params.input_topic,
        "startingOffsets": "earliest",
        "groupIdPrefix": params.app_id,
    }
    if max_rows is not None:
        options["maxOffsetsPerTrigger"] = str(max_rows)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def writer_options(params: JobParams) -> dict:
    return {"kafka.bootstrap.servers": params.bootstrap_servers, "topic": params.output_topic}


def read_topic(spark: SparkSession, params: JobParams, streaming: bool = True, **limits) -> DataFrame:
    reader = spark.readStream if streaming else spark.read
    return reader.format("kafka").options(**reader_options(params, **limits)).load()


def route(schema_ids: Collection[int], value: str = "value") -> Column:
    """Where a message belongs: ``good``, ``empty`` (a null value) or ``foreign`` (no header, or another schema)."""
    good = F.coalesce(wire.is_framed(value, schema_ids), F.lit(False))
    return F.when(F.col(value).isNull(), "empty").when(good, "good").otherwise("foreign")


def decode_topic(raw: DataFrame, schema, schema_ids: Collection[int], on_foreign: str = "fail") -> DataFrame:
    """Raw Kafka columns to an envelope: string key, decoded value. An empty message has a null value.

    A foreign message stops the job, naming its place; ``on_foreign="leave"`` gives it a null value instead, for jobs
    that keep ``foreign_messages`` elsewhere. If ``schema_ids`` maps ids to the schemas their messages were written with,
    each message is decoded by its own and resolved to ``schema`` (a record schema, or an ``evolution.Reader`` with defaults).
    """
    if on_foreign not in ("fail", "leave"):
        raise ValueError("on_foreign must be 'fail' or 'leave'")
    if isinstance(schema_ids, Mapping):
        reader = schema if isinstance(schema, evolution.Reader) else evolution.Reader(schema)
        message = F.col("value")
        decode = lambda bytes_: evolution.decode_versions(bytes_, schema_ids, reader)
    else:
        message = wire.payload_if_framed("value", schema_ids)
        decode = lambda bytes_: wire.decode_record(bytes_, schema)
    if on_foreign == "fail":
        at = F.format_string("foreign message in %s, partition %d, offset %d", "topic", "partition", "offset")
        message = F.when(route(schema_ids) == "foreign", F.raise_error(at).cast("binary")).otherwise(message)
    return raw.select(
        F.col("key").cast("string").alias("key"),
        decode(message).alias("value"),
        "topic",
        "partition",
        "offset",
        "timestamp",
    )


def foreign_messages(raw: DataFrame, schema_ids: Collection[int]) -> DataFrame:
    """The messages that are neither empty nor of the expected schemas, to be kept elsewhere."""
    return raw.where(route(schema_ids) == "foreign")


def foreign_to_files(raw: DataFrame, schema_ids: Collection[int], folder: str, checkpoint: str) -> DataStreamWriter:
    """Foreign messages of a stream as they came, with topic, partition and offset, into ``folder``."""
    return (
        foreign_messages(raw, schema_ids)
        .writeStream.format("parquet")
        .option("path", folder)
        .option("checkpointLocation", f"{checkpoint}/foreign")
    )


def encode_topic(keyed: DataFrame, schema_id: int, schema, name: str | None = None) -> DataFrame:
    """(key, value record) to the two binary columns of the Kafka sink.

    The record name only matters to Spark's own Avro writer; see ``wire.encode_record``.
    """
    body = wire.encode_record(F.col("value"), schema, name or record_name(keyed))
    return keyed.select(
        F.col("key").cast("binary").alias("key"),
        wire.framed(body, schema_id).alias("value"),
    )


def write_topic(encoded: DataFrame, params: JobParams) -> None:
    encoded.write.format("kafka").options(**writer_options(params)).save()


def topic_writer(encoded: DataFrame, params: JobParams, checkpoint: str, mode: str) -> DataStreamWriter:
    return (
        encoded.writeStream.format("kafka")
        .options(**writer_options(params))
        .option("checkpointLocation", checkpoint)
        .queryName(params.app_id)
        .outputMode(mode)
    )
