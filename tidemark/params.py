"""Job parameters: defaults, environment overrides and range checks.

A set but unusable value raises; it never falls back to the default silently.
"""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields, replace
from typing import Any, Self


class ParameterError(ValueError):
    """A job parameter is missing, unreadable or out of its documented range."""


# Environment variable names shared by both jobs.
ENVIRONMENT = {
    "app_id": "APP_ID_CONFIG",
    "bootstrap_servers": "BOOTSTRAP_SERVERS_CONFIG",
    "schema_registry_url": "SCHEMA_REGISTRY_URL",
    "input_topic": "INPUT_TOPIC",
    "output_topic": "OUTPUT_TOPIC",
    "window_minutes": "WINDOW_SIZE_MINUTES",
    "temperature_threshold": "TEMPERATURE_THRESHOLD",
    "humidity_threshold": "HUMIDITY_THRESHOLD",
    "humidity_rule": "HUMIDITY_RULE",
}

# Default endpoints.
BOOTSTRAP_SERVERS = "broker-1:29092,broker-2:29093,broker-3:29094"
SCHEMA_REGISTRY_URL = "http://schema-registry:8081"


@dataclass(frozen=True)
class JobParams:
    app_id: str
    input_topic: str
    output_topic: str
    bootstrap_servers: str = BOOTSTRAP_SERVERS
    schema_registry_url: str = SCHEMA_REGISTRY_URL

    def __post_init__(self) -> None:
        for name in ("app_id", "input_topic", "output_topic", "bootstrap_servers"):
            if not getattr(self, name).strip():
                raise ParameterError(f"{name} must not be empty")

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> Self:
        env = os.environ if env is None else env
        base = cls()
        found: dict[str, Any] = {}
        for field in fields(cls):
            text = env.get(ENVIRONMENT[field.name], "").strip()
            if not text:
                continue
            try:
                found[field.name] = type(getattr(base, field.name))(text)
            except ValueError as error:
                raise ParameterError(f"{ENVIRONMENT[field.name]}={text!r} is not valid") from error
        return replace(base, **found)


@dataclass(frozen=True)
class SummaryParams(JobParams):
    app_id: str = "sales-transactions-summary"
    input_topic: str = "sales-transactions"
    output_topic: str = "sales-summary"
    window_minutes: int = 1

    def __post_init__(self) -> None:
        super().__post_init__()
        if self.window_minutes <= 0:
            raise ParameterError("window_minutes must be greater than 0")


@dataclass(frozen=True)
class AlertParams(JobParams):
    app_id: str = "sensors-alerts-app"
    input_topic: str = "sensor-telemetry"
    output_topic: str = "sensor-alerts"
    temperature_threshold: float = 35.0
    humidity_threshold: float = 0.2
    humidity_rule: str = "below"

    def __post_init__(self) -> None:
        super().__post_init__()
        if not self.temperature_threshold > 0:
            raise ParameterError("temperature_threshold must be greater than 0")
        if not 0 <= self.humidity_threshold <= 1:
            raise ParameterError("humidity_threshold must be between 0 and 1")
        if self.humidity_rule not in ("below", "above"):
            raise ParameterError("humidity_rule must be 'below' or 'above'")
