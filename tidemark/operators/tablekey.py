"""What the transactions table does on insert: default timestamp and unique key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import TRANSACTION_TABLE_KEY


def default_timestamp(df: DataFrame, column: str = "timestamp") -> DataFrame:
    """Fill a missing column with the current time in whole seconds; a given one is left alone."""
    if column in df.columns:
        return df
    return df.withColumn(column, F.date_trunc("second", F.current_timestamp()))


def first_per_key(
    df: DataFrame, key: Sequence[str] = TRANSACTION_TABLE_KEY, order: str | None = None
) -> DataFrame:
    """Keep one row per table key: the one with the lowest ``order`` (any one when not given).

    Both forms combine on the map side, so copies of one key shrink before the exchange; with an ``order`` or text
    columns Spark combines by sorting each map task's rows, which costs about four times a hashed sum.
    On a watermarked stream use ``first_per_key_stream``.
    """
    if order is None:
        return df.dropDuplicates(list(key))
    rest = [c for c in df.columns if c not in key]
    kept = df.groupBy(*key).agg(F.min_by(F.struct(*rest), order).alias("first"))
    return kept.select(*key, "first.*").select(*df.columns)


def first_per_key_stream(df: DataFrame, key: Sequence[str] = TRANSACTION_TABLE_KEY) -> DataFrame:
    """Streaming guard; its state is dropped behind the watermark."""
    return df.dropDuplicatesWithinWatermark(list(key))


def split_clashes(
    df: DataFrame, key: Sequence[str] = TRANSACTION_TABLE_KEY
) -> tuple[DataFrame, DataFrame]:
    """The rows that are alone with their key, and all rows of keys that several rows share.

    Together they are every row of ``df``. Clashing keys are counted with a map-side combine and only they are joined
    back; a hot key is one row on that side, so the other side can be split.
    """
    # a renamed copy of the keys, compared null-safely: a missing key part clashes like any other value
    clashing = duplicate_keys(df, key).select(*[F.col(name).alias(f"__{name}") for name in key])
    same = [F.col(name).eqNullSafe(F.col(f"__{name}")) for name in key]
    return df.join(clashing, same, "left_anti"), df.join(clashing, same, "left_semi")


def duplicate_keys(df: DataFrame, key: Sequence[str] = TRANSACTION_TABLE_KEY) -> DataFrame:
    """Keys a plain insert would fail on, with their number of rows."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
