"""Sales totals per record key over tumbling event-time windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exact, scalars
from .scan import running, total

SUMMARY_COLUMNS = ("category", "total_quantity", "total_revenue", "window_start", "window_end")


def with_key_and_value(df: DataFrame, key: str = "key", value: str | None = None) -> DataFrame:
    """Drop records without a key (or without a value): they never reach an aggregate."""
    present = F.col(key).isNotNull()
    if value is not None:
        present &= F.col(value).isNotNull()
    return df.where(present)


def totals(quantity: str = "quantity", price: str = "price") -> list[Column]:
    """Sum of units and sum of prices in cents.

    Both are 64-bit integer sums: independent of row order, and an overflow (9.2e18) raises
    instead of wrapping.
    """
    return [
        F.sum(F.col(quantity).cast("bigint")).alias("total_quantity"),
        F.sum(scalars.cents(price)).alias("total_cents"),
    ]


def window_aggregate(
    records: DataFrame,
    window_minutes: int,
    aggregates: Sequence[Column],
    *,
    key: str = "key",
    time_col: str = "timestamp",
) -> DataFrame:
    """Any aggregates per (key, tumbling window): columns category, window_start (ms), aggregates.

    Partial results are built before the only exchange, so a hot key ships one row per window
    and map task. Works on a table or on a watermarked stream.
    """
    keyed = with_key_and_value(records, key).where(F.col(time_col).isNotNull())
    category = F.col(key).alias("category")
    if records.isStreaming:
        # Spark only drops the state of ended windows when it knows the group as a window.
        window = F.window(time_col, scalars.minutes(window_minutes)).alias("__window")
        grouped = keyed.groupBy(category, window).agg(*aggregates)
        start = scalars.epoch_ms("__window.start")
    else:
        # A single number groups and travels at half the cost of the (start, end) pair.
        window = scalars.window_start(time_col, window_minutes).alias("__window")
        grouped = keyed.groupBy(category, window).agg(*aggregates)
        start = F.col("__window")
    kept = [c for c in grouped.columns if c not in ("category", "__window")]
    return grouped.select("category", start.alias("window_start"), *kept)


def summarize(
    sales: DataFrame,
    window_minutes: int = 1,
    *,
    key: str = "key",
    quantity: str = "quantity",
    price: str = "price",
    time_col: str = "timestamp",
) -> DataFrame:
    """Units and revenue, one row per (key, window), on a table or on a watermarked stream."""
    sums = totals(quantity, price)
    return summary_record(window_aggregate(sales, window_minutes, sums, key=key, time_col=time_col), window_minutes)


def summarize_exact(
    sales: DataFrame,
    window_minutes: int = 1,
    *,
    key: str = "key",
    quantity: str = "quantity",
    price: str = "price",
    time_col: str = "timestamp",
) -> DataFrame:
    """As ``summarize`` for prices that are no whole cents: the exact sum of the doubles, rounded once."""
    sums = [F.sum(F.col(quantity).cast("bigint")).alias("total_quantity"), *exact.sums(price, "__price")]
    started = window_aggregate(sales, window_minutes, sums, key=key, time_col=time_col)
    return started.select(
        "category",
        "total_quantity",
        exact.total("__price").alias("total_revenue"),
        "window_start",
        (F.col("window_start") + F.lit(window_minutes * 60_000)).alias("window_end"),
    )


def summary_record(started: DataFrame, window_minutes: int, *keep: str) -> DataFrame:
    """(category, window_start in ms, totals) to the flat summary record, behind ``keep``."""
    return started.select(
        *keep,
        "category",
        "total_quantity",
        scalars.from_cents("total_cents").alias("total_revenue"),
        "window_start",
        (F.col("window_start") + F.lit(window_minutes * 60_000)).alias("window_end"),
    )


def update_stream(
    accepted: DataFrame,
    window_minutes: int = 1,
    *,
    key: str = "key",
    quantity: str = "quantity",
    price: str = "price",
    time_col: str = "timestamp",
    partition: str = "partition",
    offset: str = "offset",
    block: int = 1 << 20,
) -> DataFrame:
    """Every single update of the windowed totals: one row per accepted record, unthinned.

    This is what the changelog holds when nothing merges updates before they are forwarded. The
    totals of a record cover the records of its window up to its own offset.
    """
    started = with_key_and_value(accepted, key).select(
        partition,
        offset,
        F.col(key).alias("category"),
        scalars.window_start(time_col, window_minutes).alias("window_start"),
        F.col(quantity).cast("bigint").alias("__units"),
        scalars.cents(price).alias("__cents"),
    )
    updates = running(
        started,
        [partition, "category", "window_start"],
        offset,
        {"total_quantity": total("__units"), "total_cents": total("__cents")},
        block=block,
    )
    return summary_record(updates, window_minutes, partition, offset)


def update_ticks(
    accepted: DataFrame,
    tick: Column,
    window_minutes: int = 1,
    *,
    key: str = "key",
    quantity: str = "quantity",
    price: str = "price",
    time_col: str = "timestamp",
    partition: str = "partition",
    block: int = 1 << 20,
) -> DataFrame:
    """The changelog when updates are merged until the next commit: the last update of each window in each tick.

    ``tick`` numbers the commits of a partition and must not fall with its offsets. Records are first added up by (window,
    tick), before the exchange, so what is shuffled and scanned follows the number of ticks, not of records.
    """
    deltas = (
        with_key_and_value(accepted, key)
        .select(
            partition,
            F.col(key).alias("category"),
            scalars.window_start(time_col, window_minutes).alias("window_start"),
            tick.cast("bigint").alias("tick"),
            F.col(quantity).cast("bigint").alias("__units"),
            scalars.cents(price).alias("__cents"),
        )
        .groupBy(partition, "category", "window_start", "tick")
        .agg(F.sum("__units").alias("__units"), F.sum("__cents").alias("__cents"))
    )
    updates = running(
        deltas,
        [partition, "category", "window_start"],
        "tick",
        {"total_quantity": total("__units"), "total_cents": total("__cents")},
        block=block,
    )
    return summary_record(updates, window_minutes, partition, "tick")


def keyed_summary(summary: DataFrame) -> DataFrame:
    """Re-key summaries by category for a topic: (key, value)."""
    return summary.select(F.col("category").alias("key"), F.struct(*SUMMARY_COLUMNS).alias("value"))
