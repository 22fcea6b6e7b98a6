"""What the strict summary publishes batch by batch, and jobs of two queries."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tidemark.operators import lateness, summary
from tidemark.streaming import jobs
from tidemark.streaming.strict import StrictSummary

BASE = datetime(2024, 1, 1, tzinfo=timezone.utc)
SALES = "key string, quantity int, price double, timestamp timestamp, partition int, offset long"


def row(partition, offset, minute, key="a", quantity=1):
    return (key, quantity, 1.25, BASE + timedelta(minutes=minute), partition, offset)


# Two partitions far apart in time, a window that one of them has closed, and one partition that comes late with old times.
BATCHES = [
    [row(0, 0, 5), row(1, 0, 5, quantity=2), row(0, 1, 70)],
    [row(0, 2, 130), row(1, 1, 20, quantity=4), row(1, 2, 30, "b")],
    [row(0, 3, 10), row(1, 3, 75, quantity=8), row(0, 4, 140, "b")],
    [row(2, 0, 8, quantity=16), row(1, 4, 80)],
    [row(2, 1, 72, quantity=32), row(0, 5, 400)],
]


def run(spark, folder, batches, look=None):
    published = {}

    def publish(updates):
        rows = updates.collect()
        published.update({(r.category, r.window_start): tuple(r) for r in rows})
        if look:
            look(rows)

    job = StrictSummary(f"{folder}/state", 60, publish=publish)
    for number, rows in enumerate(batches):
        job(spark.createDataFrame(rows, SALES), number)
    return job, published


def test_published_totals_are_the_table(spark, folder):
    job, published = run(spark, folder, BATCHES)
    every = spark.createDataFrame([r for rows in BATCHES for r in rows], SALES)
    expected = summary.summarize(lateness.drop_late(every, 60), 60)
    assert sorted(published.values()) == sorted(map(tuple, expected.collect())) == sorted(map(tuple, job.result(spark).collect()))


def test_publishing_reads_open_windows_only(spark, folder, monkeypatch):
    """The changelog is folded only for the partition that was never seen before and starts behind the horizon."""
    folds = []
    latest = StrictSummary._latest
    monkeypatch.setattr(StrictSummary, "_latest", lambda self, s: folds.append(1) or latest(self, s))
    run(spark, folder, BATCHES[:3])
    assert not folds
    run(spark, f"{folder}/again", [*BATCHES[:3], [row(0, 6, 200), row(1, 6, 200)], *BATCHES[3:]])
    assert folds


def test_closed_windows_leave_the_state(spark, folder):
    rows = [[row(p, 10 * n + p, 60 * n + 5) for p in (0, 1)] for n in range(6)]
    run(spark, folder, rows)
    held = spark.read.parquet(f"{folder}/state/windows/batch_id=5")
    assert held.select(F.countDistinct("window_no")).first()[0] <= 2


def test_when_one_query_fails_the_other_stops(spark, folder):
    spark.streams.resetTerminated()  # queries of other tests
    rates = [spark.readStream.format("rate").load() for _ in range(2)]

    def fail(batch, number):
        raise OSError("disk full")

    good = rates[0].writeStream.format("noop").option("checkpointLocation", f"{folder}/a").start()
    rates[1].writeStream.foreachBatch(fail).option("checkpointLocation", f"{folder}/b").start()
    with pytest.raises(Exception, match="disk full"):
        jobs.supervise(spark, 60)
    assert not good.isActive
    spark.streams.resetTerminated()
