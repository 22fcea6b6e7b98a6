"""Exact zero-grace lateness, per topic partition.

A record is late when the highest record time already seen in its partition (in offset order)
has reached the end of its window. Evaluating that literally needs each partition sorted by
offset in one task. Two equivalent forms avoid this:

* ``expiry_offsets``: a window expires at the lowest offset among the records of later windows.
  One map-side-combined aggregate gives the lowest offset per (partition, window); a suffix
  minimum over windows turns it into expiry offsets. Records are then only compared with a
  number - they are neither sorted nor, while the expiry table is small, shuffled.
* ``with_stream_time``: the running maximum itself, as a blocked scan (see ``scan``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions import scalars
from ..session import written_to
from .scan import highest, running
from .summary import with_key_and_value

WINDOW_NO = "window_no"
EXPIRES_AT = "expires_at"


def with_window_number(df: DataFrame, window_minutes: int, time_col: str = "timestamp") -> DataFrame:
    return df.withColumn(WINDOW_NO, scalars.window_index(time_col, window_minutes))


def expiry_offsets(
    records: DataFrame,
    window_minutes: int,
    *,
    time_col: str = "timestamp",
    partition: str = "partition",
    offset: str = "offset",
    stream_time: DataFrame | None = None,
) -> DataFrame:
    """Per (partition, window): ``expires_at`` (null: still open) and ``last_time``.

    ``stream_time`` carries (partition, seen_until) over from earlier batches. It enters as a
    record ahead of all others, at offset -1, so that windows it has ended admit nothing.

    The suffix minimum runs per partition over one row per distinct window, a number bounded by
    time span / window width and not by the number of records.
    """
    arrivals = records.select(partition, offset, time_col)
    if stream_time is not None:
        ahead = F.lit(-1).cast("bigint")
        arrivals = arrivals.union(stream_time.select(partition, ahead, "seen_until"))
    firsts = (
        with_window_number(arrivals, window_minutes, time_col)
        .groupBy(partition, WINDOW_NO)
        .agg(F.min(offset).alias("first_offset"), F.max(time_col).alias("last_time"))
    )
    later_windows = (
        Window.partitionBy(partition).orderBy(F.col(WINDOW_NO).desc()).rowsBetween(Window.unboundedPreceding, -1)
    )
    expires_at = F.min("first_offset").over(later_windows)
    return firsts.select(partition, WINDOW_NO, "last_time", expires_at.alias(EXPIRES_AT))


def mark_late(
    records: DataFrame,
    window_minutes: int,
    *,
    time_col: str = "timestamp",
    partition: str = "partition",
    offset: str = "offset",
    expiry: DataFrame | None = None,
    work_dir: str | None = None,
) -> DataFrame:
    """Add ``late``. No job runs until the result is used, unless there is a ``work_dir``.

    With a ``work_dir``, a new folder all executors can reach, the expiry table is written there first: its real size
    picks the join, a broadcast when small, else a sort-merge join whose skewed partitions are split at run time, and the
    records need no exchange while it is small. The caller removes the folder once the result has been used.
    """
    if expiry is None:
        expiry = expiry_offsets(records, window_minutes, time_col=time_col, partition=partition, offset=offset)
        if work_dir is not None:
            expiry = written_to(expiry, work_dir)
    late = F.coalesce(F.col(offset) >= F.col(EXPIRES_AT), F.lit(False))
    return (
        with_window_number(records, window_minutes, time_col)
        .join(expiry.select(partition, WINDOW_NO, EXPIRES_AT), [partition, WINDOW_NO], "left")
        .withColumn("late", late)
        .select(*records.columns, "late")
    )


def drop_late(records: DataFrame, window_minutes: int, *, key: str = "key", **columns) -> DataFrame:
    """Records a zero-grace window accepts. Keyless records go first: they do not advance time."""
    keyed = with_key_and_value(records, key)
    return mark_late(keyed, window_minutes, **columns).where(~F.col("late")).drop("late")


def late_only(records: DataFrame, window_minutes: int, *, key: str = "key", **columns) -> DataFrame:
    """The complement of ``drop_late`` among keyed records."""
    keyed = with_key_and_value(records, key)
    return mark_late(keyed, window_minutes, **columns).where("late").drop("late")


def counted(marked: DataFrame, name: str = "lateness") -> tuple[DataFrame, Observation]:
    """The kept ones of records with a ``late`` mark, and what counts both kinds while they pass.

    The counts are those of the first job that runs the frame; they cost no job of their own.
    """
    seen = Observation(name)
    late = F.col("late").cast("bigint")
    observed = marked.observe(
        seen, F.coalesce(F.sum(1 - late), F.lit(0)).alias("kept"), F.coalesce(F.sum(late), F.lit(0)).alias("late")
    )
    return observed.where(~F.col("late")).drop("late"), seen


def with_stream_time(
    records: DataFrame,
    *,
    time_col: str = "timestamp",
    partition: str = "partition",
    offset: str = "offset",
    block: int = 1 << 20,
) -> DataFrame:
    """Add ``stream_time``: the highest record time seen so far in the partition, in offset order."""
    return running(records, [partition], offset, {"stream_time": highest(time_col)}, block=block)
