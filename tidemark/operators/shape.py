"""Record-at-a-time message transforms, as projections to be chained with ``DataFrame.transform``.

They work on an envelope with a struct column ``value`` and the columns ``key`` and ``topic``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars

Step = Callable[[DataFrame], DataFrame]


def envelope(topic: str, fields: Sequence[str] | None = None) -> Step:
    """Wrap rows into (key = null, value = struct, topic), as a source connector emits them."""

    def step(df: DataFrame) -> DataFrame:
        return df.select(
            F.lit(None).cast("string").alias("key"),
            F.struct(*(fields or df.columns)).alias("value"),
            F.lit(topic).alias("topic"),
        )

    return step


def unpack(df: DataFrame) -> DataFrame:
    """Flatten an envelope; the record time of the message becomes ``kafka_timestamp``."""
    renamed = {"timestamp": "kafka_timestamp"}
    outer = [F.col(c).alias(renamed.get(c, c)) for c in df.columns if c != "value"]
    return df.where("value IS NOT NULL").select(*outer, "value.*")


def cast_field(field: str, to: str) -> Step:
    """Cast one field of the value record."""

    def step(df: DataFrame) -> DataFrame:
        return df.withColumn("value", F.col("value").withField(field, F.col(f"value.{field}").cast(to)))

    return step


def route_topic(regex: str, replacement: str) -> Step:
    """Rename the topic where ``regex`` matches the whole name. Group references are ``$1``, ``$2``."""

    def step(df: DataFrame) -> DataFrame:
        whole = f"^(?:{regex})$"
        routed = F.regexp_replace("topic", whole, replacement)
        return df.withColumn("topic", F.when(F.col("topic").rlike(whole), routed).otherwise(F.col("topic")))

    return step


def name_record(full_name: str) -> Step:
    """Attach the record schema's full name to the value column; the encoder reads it back."""

    def step(df: DataFrame) -> DataFrame:
        return df.withMetadata("value", {"record_name": full_name})

    return step


def record_name(df: DataFrame) -> str | None:
    return df.schema["value"].metadata.get("record_name")


def value_to_key(*fields: str) -> Step:
    """Copy value fields into a struct key."""

    def step(df: DataFrame) -> DataFrame:
        return df.withColumn("key", F.struct(*(F.col(f"value.{f}").alias(f) for f in fields)))

    return step


def extract_key_field(field: str) -> Step:
    """Reduce a struct key to one of its fields."""

    def step(df: DataFrame) -> DataFrame:
        return df.withColumn("key", F.col(f"key.{field}"))

    return step


def key_from(field: str) -> Step:
    """Use a value field as the message key directly."""

    def step(df: DataFrame) -> DataFrame:
        return df.withColumn("key", F.col(f"value.{field}"))

    return step


def chain(*steps: Step) -> Step:
    return lambda df: reduce(lambda frame, step: frame.transform(step), steps, df)


def sales_chain(full_name: str = "sales.sales_transactions") -> Step:
    """The transforms between the transactions table and the sales topic, in their order."""
    return chain(
        cast_field("price", "double"),
        route_topic("sales_transactions", "sales-transactions"),
        name_record(full_name),
        value_to_key("category"),
        extract_key_field("category"),
    )


def round_price(df: DataFrame, column: str = "price") -> DataFrame:
    """What storing a price in the transactions table does to it."""
    return df.withColumn(column, scalars.money(column))
