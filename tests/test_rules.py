import math

import pytest
from pyspark.sql import functions as F

from tidemark.operators import rules
from tidemark.params import AlertParams
from tidemark.plans import inspect
from tidemark.schemas import ALERT, TELEMETRY
from tidemark.sources import replayed


def readings(spark, *rows):
    return spark.createDataFrame([(f"s{i}", t, h, 50.0, 1741421301) for i, (t, h) in enumerate(rows)], TELEMETRY)


def raised(df):
    return sorted((r.sensor_id, r.alert_type) for r in df.collect())


def test_documented_sample(spark):
    one = spark.createDataFrame([("sensor_991", 20.0, 0.1, 50.0, 1741421301)], TELEMETRY)
    (alert,) = rules.raise_alerts(one).collect()
    assert tuple(alert) == ("sensor_991", "LOW_HUMIDITY", 1741421301, "Humidity is below 20.0%")


def test_temperature_text_and_both_rules(spark):
    alerts = rules.raise_alerts(readings(spark, (36.0, 0.10))).collect()
    assert {a.details for a in alerts} == {"Temperature exceeded 35.0°C", "Humidity is below 20.0%"}


def test_text_prints_doubles_as_the_jvm_does(spark):
    params = AlertParams(humidity_threshold=0.29, temperature_threshold=1e7)
    dry = rules.raise_alerts(readings(spark, (2e7, 0.1)), rules.default_rules(params)).collect()
    assert {a.details for a in dry} == {"Temperature exceeded 1.0E7°C", "Humidity is below 28.999999999999996%"}


def test_thresholds_are_strict_and_nan_is_silent(spark):
    rows = readings(spark, (35.0, 0.2), (math.nan, math.nan), (math.nextafter(35.0, 99), 0.2), (35.0, math.nextafter(0.2, 0)))
    assert raised(rules.raise_alerts(rows)) == [("s2", "HIGH_TEMPERATURE"), ("s3", "LOW_HUMIDITY")]


def test_inverted_rule_keeps_label_and_text(spark):
    params = AlertParams(humidity_rule="above")
    rows = readings(spark, (20.0, 0.3), (20.0, 0.2), (20.0, math.nan), (20.0, 0.1))
    (alert,) = rules.raise_alerts(rows, rules.default_rules(params)).collect()
    assert (alert.sensor_id, alert.alert_type, alert.details) == ("s0", "LOW_HUMIDITY", "Humidity is below 20.0%")


def test_null_readings_raise_nothing(spark):
    rows = spark.createDataFrame([("a", None, None, 1.0, 1)], "sensor_id string, temperature double, humidity double, soil_fertility double, timestamp bigint")
    assert rules.raise_alerts(rows).count() == 0


def test_a_further_rule_is_only_data(spark):
    barren = rules.Rule("LOW_FERTILITY", lambda: F.col("soil_fertility") < 55, lambda: F.lit("Soil is poor"))
    rows = readings(spark, (36.0, 0.1))
    alerts = rules.raise_alerts(rows, [*rules.default_rules(), barren])
    assert raised(alerts) == [("s0", "HIGH_TEMPERATURE"), ("s0", "LOW_FERTILITY"), ("s0", "LOW_HUMIDITY")]


def test_names_and_types(spark):
    alerts = rules.raise_alerts(readings(spark, (36.0, 0.1)))
    assert [(f.name, f.dataType) for f in alerts.schema] == [(f.name, f.dataType) for f in ALERT]


def test_one_scan_no_exchange_no_python(spark, small):
    alerts = rules.raise_alerts(replayed.telemetry(replayed.events(spark, small)))
    assert inspect.exchanges(alerts) == 0
    assert inspect.python_nodes(alerts) == []
    (columns,) = inspect.scanned_columns(alerts)
    assert set(columns) == {"ts", "user_id", "value", "props"}


def test_rules_reach_the_scan_of_a_stored_table(spark, folder):
    readings(spark, (36.0, 0.1), (20.0, 0.5)).write.parquet(f"{folder}/telemetry")
    alerts = rules.raise_alerts(spark.read.parquet(f"{folder}/telemetry"))
    plan = inspect.physical(alerts)
    assert "GreaterThan(temperature,35.0)" in plan and "LessThan(humidity,0.2)" in plan
    assert inspect.scanned_columns(alerts) == [["sensor_id", "temperature", "humidity", "timestamp"]]


@pytest.mark.parametrize("mode", ["below", "above"])
def test_union_twin(spark, small, mode):
    telemetry = replayed.telemetry(replayed.events(spark, small))
    hot, dry = rules.high_temperature(), rules.low_humidity(mode=mode)
    single = rules.raise_alerts(telemetry, [hot, dry])
    twin = rules.raise_alerts(telemetry, [hot]).unionByName(rules.raise_alerts(telemetry, [dry]))
    assert single.exceptAll(twin).count() == 0 and twin.exceptAll(single).count() == 0
