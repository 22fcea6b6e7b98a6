"""The jobs' inputs replayed from the ``events`` table, as tables and as streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars
from ..session import use_utc


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/events.parquet")


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as a stream; the glob makes a single file and a folder of files look alike."""
    schema = events(spark, sf_dir).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")


def _extra() -> Column:
    """The integer in ``props``, which always reads ``{"k": n}``; any other text fails the cast.

    Cutting it out costs a third of a JSON parse per row, and every replayed query pays it.
    """
    return F.rtrim(F.substring_index("props", '"k":', -1), F.lit("}")).cast("int")


def transactions(rows: DataFrame) -> DataFrame:
    """Events as sales messages: record columns plus key, partition, offset and record time.

    Arrival is simulated: every record is delayed by up to 199 places, and the partition follows
    the key. Offsets order the records of a partition but have gaps, as on a compacted topic;
    being a plain expression they need no global numbering.
    """
    extra = _extra()
    delay = (F.col("event_id") * 7919) % 200
    return rows.select(
        F.concat(F.lit("tx"), F.col("event_id").cast("string")).alias("transaction_id"),
        F.concat(F.lit("prod_"), F.col("user_id").cast("string")).alias("product_id"),
        F.col("event_type").alias("category"),
        (1 + extra % 10).cast("int").alias("quantity"),
        (scalars.cents("value") / F.lit(100.0)).alias("price"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("event_type").alias("key"),
        (F.length("event_type") % 3).cast("int").alias("partition"),
        ((F.col("event_id") + delay) * 200 + (199 - delay)).alias("offset"),
    )


def telemetry(rows: DataFrame) -> DataFrame:
    """Events as sensor readings; ``timestamp`` stays a raw count of epoch seconds."""
    extra = _extra()
    steps = scalars.cents("value") % 3501
    return rows.select(
        F.concat(F.lit("sensor_"), F.col("user_id").cast("string")).alias("sensor_id"),
        (F.lit(15.0) + steps / F.lit(100.0)).alias("temperature"),
        ((5 + extra % 66) / F.lit(100.0)).alias("humidity"),
        (40 + F.col("user_id") % 51).cast("double").alias("soil_fertility"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("timestamp"),
    )
