"""Synthetic telemetry and transactions, at any size and as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import generators as g

# The domains of the generated records.
CATEGORIES = ("fertilizers", "seeds", "pesticides", "equipment", "supplies", "soil")
TEMPERATURE = (15.0, 50.0)
HUMIDITY = (0.05, 0.70)
SOIL_FERTILITY = (40.0, 90.0)
TELEMETRY_START = 1741421258
QUANTITY = (1, 10)
PRICE = (10.0, 200.0)
DEFAULT_ROWS = 10_000_000


def telemetry(rows: DataFrame, row: str = "id", seed: int = 1) -> DataFrame:
    """One telemetry record per input row; ``row`` numbers them from 0. ``key`` is the sensor."""
    n = F.col(row)
    return rows.select(
        g.digits("sensor_", 3, n, seed, 0).alias("sensor_id"),
        g.uniform(*TEMPERATURE, n, seed, 1).alias("temperature"),
        g.uniform(*HUMIDITY, n, seed, 2).alias("humidity"),
        g.uniform(*SOIL_FERTILITY, n, seed, 3).alias("soil_fertility"),
        g.iteration(TELEMETRY_START, 1, n).alias("timestamp"),
    ).select(F.col("sensor_id").alias("key"), "*")


def transactions(rows: DataFrame, row: str = "id", seed: int = 2) -> DataFrame:
    """One transaction per input row, without a timestamp: the table fills it in."""
    n = F.col(row)
    return rows.select(
        g.digits("tx", 5, n, seed, 0).alias("transaction_id"),
        g.digits("prod_", 3, n, seed, 1).alias("product_id"),
        g.option(CATEGORIES, n, seed, 2).alias("category"),
        g.uniform_int(*QUANTITY, n, seed, 3).alias("quantity"),
        g.uniform(*PRICE, n, seed, 4).cast("float").alias("price"),
    ).select(F.col("transaction_id").alias("key"), "*")


def row_numbers(spark: SparkSession, count: int = DEFAULT_ROWS, partitions: int | None = None) -> DataFrame:
    return spark.range(0, count, 1, partitions)


def row_stream(spark: SparkSession, rows_per_second: int = 1, partitions: int = 1) -> DataFrame:
    """Row numbers as an endless stream."""
    rate = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second)
    return rate.option("numPartitions", partitions).load().select(F.col("value").alias("id"))
