"""Plan checks: what a query exchanges, broadcasts and reads."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def physical(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df: DataFrame) -> int:
    """Shuffles in the plan, leaving out broadcasts and reused exchanges."""
    return len(re.findall(r"(?<!Broadcast)(?<!Reused)Exchange (?:hash|range|single|round)", physical(df), re.I))


def broadcasts(df: DataFrame) -> int:
    return len(re.findall(r"BroadcastExchange", physical(df)))


def scanned_columns(df: DataFrame) -> list[list[str]]:
    """Columns every file scan reads."""
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", physical(df))
    return [[part.split(":")[0] for part in schema.split(",") if part] for schema in schemas]


def python_nodes(df: DataFrame) -> list[str]:
    """Operators that leave the JVM."""
    return re.findall(r"\b(?:ArrowEvalPython|BatchEvalPython|MapInPandas|MapInArrow|FlatMapGroupsInPandas)\b", physical(df))
