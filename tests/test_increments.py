"""Exact sums, thinned changelogs, overlapping polls, counted drops and table functions."""

from __future__ import annotations

import math
import random
from datetime import datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import exact
from tidemark.operators import lateness, summary
from tidemark.plans import inspect, tables
from tidemark.sources import database
from tidemark.streaming import ingest

T0 = datetime(2024, 1, 1)


def summed(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    return df.agg(*exact.sums("v", "s")).select(exact.total("s").alias("t")).first().t


fine = st.integers(-(2**89), 2**89).map(lambda n: float(n) * 2.0**-50).filter(lambda x: abs(x) < 2.0**40)


@settings(max_examples=25, deadline=None)
@given(st.lists(fine, min_size=1, max_size=40))
def test_sum_is_the_nearest_double_in_any_order(spark, values):
    expected = math.fsum(values)
    assert summed(spark, values) == expected
    assert summed(spark, values[::-1]) == expected


def test_sum_where_a_plain_one_loses(spark):
    values = [2.0**39, 2.0**-50, -(2.0**39), 2.0**-50] * 50
    assert summed(spark, values) == 100 * 2.0**-50 == math.fsum(values)
    assert summed(spark, [None, 1.5, None]) == 1.5 and summed(spark, [None]) is None and summed(spark, [-0.0]) == 0


@pytest.mark.parametrize("bad", [2.0**40, -(2.0**41), 2.0**-51, 0.1, float("nan"), float("inf")])
def test_what_does_not_fit_raises(spark, bad):
    with pytest.raises(Exception, match="no multiple of 2\\^-50"):
        summed(spark, [1.0, bad])


def accepted(spark, n, seed=3):
    rng = random.Random(seed)
    rows = [(rng.choice("ab"), rng.randint(1, 9), rng.randint(0, 999) / 100, T0 + timedelta(seconds=rng.randrange(7200)), i % 2, i) for i in range(n)]
    return spark.createDataFrame(rows, "key string, quantity int, price double, timestamp timestamp, partition int, offset long")


def test_ticks_are_the_last_updates(spark):
    rows = accepted(spark, 400)
    every = summary.update_stream(rows, 60).collect()
    last = {}
    for r in sorted(every, key=lambda r: r.offset):
        last[r.partition, r.offset // 25, r.category, r.window_start] = (r.total_quantity, r.total_revenue)
    found = summary.update_ticks(rows, F.call_function("div", F.col("offset"), F.lit(25)), 60, block=4)
    assert {(r.partition, r.tick, r.category, r.window_start): (r.total_quantity, r.total_revenue) for r in found.collect()} == last


def test_ticks_are_added_up_before_the_exchange(spark):
    plan = inspect.physical(summary.update_ticks(accepted(spark, 400), F.col("offset") * 0, 60))
    scan = plan.rindex("Scan ")
    assert "HashAggregate" in plan[:scan] and plan[:scan].rindex("Exchange hashpartitioning") < plan[:scan].rindex("partial_sum")


def test_counts_come_with_the_pass(spark, folder):
    rows = accepted(spark, 300).withColumn("partition", F.lit(0))
    marked = lateness.mark_late(rows, 10, work_dir=f"{folder}/expiry")
    kept, seen = lateness.counted(marked)
    n = kept.count()
    assert seen.get == {"kept": n, "late": 300 - n} and 0 < n < 300
    nothing, seen = lateness.counted(marked.limit(0))
    assert nothing.count() == 0 and seen.get == {"kept": 0, "late": 0}


def polls(spark, folder, rows, overlap, hours):
    """Rows (id, time, visible from), polled at the given hours: ids sent at each poll."""
    schema = "id long, timestamp timestamp_ntz, visible timestamp_ntz"
    table = spark.createDataFrame([(i, T0 + timedelta(hours=t), T0 + timedelta(hours=v)) for i, t, v in rows], schema)
    upper, sent = [None], []

    def read(session, last):
        now = table.where(F.col("visible") <= F.lit(upper[0].isoformat(sep=" ")).cast("timestamp_ntz")).drop("visible")
        found, newest = database.read_increment(now, "timestamp", last, upper[0])
        return (None, last) if newest == last else (found, newest)

    job = ingest.OverlappingPoll(read, lambda found: sent.append(sorted(r.id for r in found.collect())), folder, ("id",), timedelta(hours=overlap))
    for number, hour in enumerate(hours):
        upper[0] = T0 + timedelta(hours=hour)
        before = len(sent)
        job(spark.range(1), number)
        if len(sent) == before:
            sent.append([])
    return sent, job


def test_late_commits_arrive_once(spark, folder):
    rows = [(1, 1, 1), (2, 2, 7), (3, 3, 3), (4, 6, 6), (5, 5, 9), (6, 11, 11)]
    sent, _ = polls(spark, folder, rows, 6, [4, 7.5, 8, 10, 12, 13])
    assert sent == [[1, 3], [2, 4], [], [5], [6], []]
    plain = database.replay(spark.createDataFrame([(2, T0)], "id long, timestamp timestamp_ntz"), "timestamp", [T0])
    assert plain[0][0].count() == 0


def test_the_ledger_expires(spark, folder):
    rows = [(i, i, i) for i in range(1, 20)]
    sent, job = polls(spark, folder, rows, 3, [5.5, 10.5, 15.5, 19.5])
    assert sent == [[1, 2, 3, 4, 5], [6, 7, 8, 9, 10], [11, 12, 13, 14, 15], [16, 17, 18, 19]]
    held = spark.read.parquet(f"{folder}/ledger/batch_id=3")
    assert sorted(r.id for r in held.collect()) == [17, 18, 19]


def test_an_empty_table_and_a_first_row_later(spark, folder):
    sent, _ = polls(spark, folder, [(1, 5, 5)], 3, [1, 2, 6, 7])
    assert sent == [[], [], [1], []]


def test_a_failed_send_is_polled_again(spark, folder):
    rows = spark.createDataFrame([(1, T0)], "id long, timestamp timestamp_ntz")
    calls = []

    def send(found):
        calls.append(found.count())
        if len(calls) == 1:
            raise OSError("broker away")

    job = ingest.OverlappingPoll(lambda *_: (rows, T0), send, folder, ("id",), timedelta(hours=1))
    with pytest.raises(OSError):
        job(spark.range(1), 0)
    job(spark.range(1), 0)
    job(spark.range(1), 1)
    assert calls == [1, 1, 0]


def test_table_functions_take_their_arguments(spark, small):
    tables.register_replayed(spark, small, 60)
    tables.register_functions(spark)
    hour = spark.sql("SELECT category, total_quantity, window_start, window_end FROM sales_windows(60)")
    expected = spark.table("summary").select("category", "total_quantity", "window_start", "window_end")
    assert sorted(map(tuple, hour.collect())) == sorted(map(tuple, expected.collect()))
    hot = spark.sql("SELECT count(*) FROM threshold_alerts(1000D, -1D)").first()[0]
    documented = spark.sql("SELECT count(*) FROM threshold_alerts(35D, 0.2D)").first()[0]
    assert hot == 0 and documented == spark.table("alerts").count()
    late = spark.sql("SELECT transaction_id FROM late_sales(60)").count()
    assert late == lateness.late_only(spark.table("transactions"), 60).count()
