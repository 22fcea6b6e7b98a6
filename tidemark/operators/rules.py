"""Threshold alerts: one telemetry row raises zero, one or two alerts, in one narrow pass."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars
from ..params import AlertParams

ALERT_COLUMNS = ("sensor_id", "alert_type", "timestamp", "details")


@dataclass(frozen=True)
class Rule:
    """An alert rule as data; a new rule needs no new operator.

    ``prescreen`` is a plain comparison that holds wherever the rule fires (and maybe elsewhere);
    unlike a NaN test it can be handed to the scan. By default it is the rule itself.
    """

    alert_type: str
    fires: Callable[[], Column]
    details: Callable[[], Column]
    prescreen: Callable[[], Column] | None = None


def high_temperature(threshold: float = 35.0) -> Rule:
    return Rule(
        "HIGH_TEMPERATURE",
        lambda: scalars.greater_than("temperature", threshold),
        lambda: scalars.temperature_text(threshold),
        lambda: F.col("temperature") > F.lit(float(threshold)),
    )


def low_humidity(threshold: float = 0.2, mode: str = "below") -> Rule:
    """``below`` is the documented contract; ``above`` keeps the inverted rule under the same label."""
    compare = {"below": scalars.less_than, "above": scalars.greater_than}[mode]
    return Rule(
        "LOW_HUMIDITY",
        lambda: compare("humidity", threshold),
        lambda: scalars.humidity_text(threshold),
        lambda: F.col("humidity") < F.lit(float(threshold))
        if mode == "below"
        else F.col("humidity") > F.lit(float(threshold)),
    )


def default_rules(params: AlertParams | None = None) -> list[Rule]:
    params = params or AlertParams()
    return [
        high_temperature(params.temperature_threshold),
        low_humidity(params.humidity_threshold, params.humidity_rule),
    ]


def raise_alerts(telemetry: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """Fan every row out to one alert per rule that fires.

    The leading filter lets a table scan skip row groups in which no rule can fire. No exchange,
    and the source is read once.
    """
    rules = default_rules() if rules is None else rules
    if not rules:
        raise ValueError("at least one rule is needed")
    fired = [
        F.when(
            rule.fires(),
            F.struct(F.lit(rule.alert_type).alias("alert_type"), rule.details().alias("details")),
        )
        for rule in rules
    ]
    any_rule = reduce(lambda a, b: a | b, ((rule.prescreen or rule.fires)() for rule in rules))
    return (
        telemetry.where(any_rule)
        .select("sensor_id", "timestamp", F.inline(F.array(*fired)))
        .where(F.col("alert_type").isNotNull())
        .select(*ALERT_COLUMNS)
    )


def keyed_alerts(alerts: DataFrame) -> DataFrame:
    """Re-key alerts by sensor for a topic: (key, value)."""
    return alerts.select(F.col("sensor_id").cast("string").alias("key"), F.struct(*ALERT_COLUMNS).alias("value"))
