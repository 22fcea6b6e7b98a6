"""Exact zero-grace summary by a stateful processor, one instance of state per topic partition.

The same rule as ``strict.StrictSummary``: a record is late when the time already seen in its partition has reached the end
of its window. Here the time seen is a value state and the totals of open windows are a map state, which expire as time
passes them. Each partition's share of a micro-batch is put in offset order in one Python worker, so a batch must be
bounded; ``StrictSummary`` spreads a hot partition over all tasks and is the form for large topics.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions import scalars
from ..operators.lateness import WINDOW_NO
from ..operators.summary import summary_record, with_key_and_value
from . import batches

UPDATES = T.StructType(
    [
        T.StructField("partition", T.IntegerType()),
        T.StructField("category", T.StringType()),
        T.StructField(WINDOW_NO, T.LongType()),
        T.StructField("total_quantity", T.LongType()),
        T.StructField("total_cents", T.LongType()),
    ]
)
GROUP = ("partition", "category", WINDOW_NO)


class StrictProcessor(StatefulProcessor):
    def __init__(self, window_minutes: int):
        self.width = window_minutes * 60_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "seen_until long")
        self.open = handle.getMapState("open", "category string, window_no long", "quantity long, cents long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows)).sort_values("offset", kind="stable")
        times = batch["time_us"].to_numpy()
        before = self.seen.get()[0] if self.seen.exists() else np.iinfo(np.int64).min
        reached = np.maximum(np.maximum.accumulate(times), before)
        window_no = times // self.width
        kept = batch.assign(window_no=window_no)[(window_no + 1) * self.width > reached]
        changed = []
        for (category, number), some in kept.groupby(["category", "window_no"], sort=False):
            at = (category, int(number))
            quantity, cents = self.open.getValue(at) if self.open.containsKey(at) else (0, 0)
            totals = (quantity + int(some["quantity"].sum()), cents + int(some["cents"].sum()))
            self.open.updateValue(at, totals)
            changed.append((key[0], *at, *totals))
        now = int(reached[-1])
        self.seen.update((now,))
        for at in [tuple(at) for at in self.open.keys()]:
            if (at[1] + 1) * self.width <= now:
                self.open.removeKey(at)
        yield pd.DataFrame(changed, columns=UPDATES.names)

    def close(self) -> None:
        pass


def strict_updates(sales: DataFrame, window_minutes: int = 1, *, key: str = "key", time_col: str = "timestamp") -> DataFrame:
    """The update stream of a stream of records with partition and offset: totals of every window a batch changed."""
    records = with_key_and_value(sales, key).select(
        "partition",
        "offset",
        F.col(key).alias("category"),
        F.unix_micros(time_col).alias("time_us"),
        F.col("quantity").cast("long").alias("quantity"),
        scalars.cents("price").alias("cents"),
    )
    return records.groupBy("partition").transformWithStateInPandas(
        StrictProcessor(window_minutes), UPDATES, outputMode="Update", timeMode="None"
    )


def result(changelog: DataFrame, window_minutes: int) -> DataFrame:
    """The summary table that the updates describe, over all partitions that hold a window."""
    latest = batches.last_wins(changelog, GROUP)
    start = F.col(WINDOW_NO) * F.lit(window_minutes * 60_000)
    summed = latest.groupBy("category", start.alias("window_start")).agg(
        F.sum("total_quantity").alias("total_quantity"), F.sum("total_cents").alias("total_cents")
    )
    return summary_record(summed, window_minutes)
