"""Row counts and totals known for the replayed inputs."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import lateness, rules, summary
from tidemark.plans.catalog import QUERIES
from tidemark.sources import replayed


@pytest.mark.parametrize(
    ("name", "rows"),
    [
        ("alerts_documented", 6442),
        ("alerts_as_coded", 10306),
        ("alert_temperature", 3478),
        ("alert_humidity_below", 2964),
        ("alert_humidity_above", 6828),
        ("alerts_stream", 6442),
        ("summary_1min", 9788),
        ("summary_7min", 8564),
        ("summary_60min", 3385),
        ("summary_1day", 150),
        ("summary_strict_60min", 2012),
        ("summary_stream_update", 9788),
        ("incremental_read", 3351),
        ("incremental_replay", 10000),
    ],
)
def test_rows(spark, medium, name, rows):
    assert QUERIES[name](spark, medium).count() == rows


@pytest.mark.parametrize("name", ["summary_1min", "summary_7min", "summary_60min", "summary_1day"])
def test_totals_do_not_depend_on_the_window(spark, medium, name):
    sums = QUERIES[name](spark, medium).agg(
        F.sum("total_quantity"), F.round(F.sum("total_revenue"), 2)
    )
    assert tuple(sums.first()) == (55333, 496306.57)


def test_strict_keeps_and_drops_everything_once(spark, medium):
    sales = replayed.transactions(replayed.events(spark, medium))
    kept = lateness.drop_late(sales, 60)
    assert kept.count() == 2961
    assert lateness.late_only(sales, 60).count() == 10000 - 2961
    assert summary.summarize(kept, 60).agg(F.sum("total_quantity")).first()[0] == 16429


def test_both_alerts_and_boundary(spark, medium):
    telemetry = replayed.telemetry(replayed.events(spark, medium))
    per_row = rules.raise_alerts(telemetry.withColumn("sensor_id", F.monotonically_increasing_id().cast("string")))
    both = per_row.groupBy("sensor_id").count().where("count = 2").count()
    assert both == 1025
    assert telemetry.where("humidity = 0.2D").count() == 208
    assert telemetry.where("temperature = 35D").count() == 1
