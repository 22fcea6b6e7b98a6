"""Named tables for ad-hoc SQL over the jobs' inputs and results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import rules, summary
from ..sources import replayed


def register(frames: dict[str, DataFrame]) -> None:
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)


# Parameterised tables over the views above; the arguments are plain numbers, which the optimizer folds into the scan.
TABLE_FUNCTIONS = {
    "sales_windows": """
        (minutes BIGINT) RETURNS TABLE(category STRING, sales BIGINT, total_quantity BIGINT, window_start BIGINT, window_end BIGINT)
        RETURN SELECT category, count(*), sum(quantity), w, w + sales_windows.minutes * 60000
               FROM (SELECT *, unix_millis(timestamp) - pmod(unix_millis(timestamp), sales_windows.minutes * 60000) AS w
                     FROM transactions WHERE key IS NOT NULL)
               GROUP BY category, w""",
    "threshold_alerts": """
        (hot DOUBLE, dry DOUBLE) RETURNS TABLE(sensor_id STRING, alert_type STRING, timestamp BIGINT)
        RETURN SELECT sensor_id, a, timestamp
               FROM (SELECT sensor_id, timestamp, explode(filter(array(
                       if(temperature > threshold_alerts.hot AND NOT isnan(temperature), 'HIGH_TEMPERATURE', NULL),
                       if(humidity < threshold_alerts.dry, 'LOW_HUMIDITY', NULL)), x -> x IS NOT NULL)) AS a
                     FROM telemetry WHERE temperature > threshold_alerts.hot OR humidity < threshold_alerts.dry)""",
    "late_sales": """
        (minutes BIGINT) RETURNS TABLE(transaction_id STRING, partition INT, offset BIGINT)
        RETURN WITH numbered AS (
                 SELECT *, unix_millis(timestamp) div (late_sales.minutes * 60000) AS n FROM transactions WHERE key IS NOT NULL),
               expiry AS (
                 SELECT partition, n, min(first) OVER (PARTITION BY partition ORDER BY n DESC
                                                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS expires_at
                 FROM (SELECT partition, n, min(offset) AS first FROM numbered GROUP BY partition, n))
               SELECT transaction_id, r.partition, r.offset FROM numbered r JOIN expiry e ON r.partition = e.partition AND r.n = e.n
               WHERE r.offset >= e.expires_at""",
}


def register_functions(spark: SparkSession) -> None:
    """``sales_windows(minutes)``, ``threshold_alerts(hot, dry)`` and ``late_sales(minutes)`` over the registered views."""
    for name, body in TABLE_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")


def register_replayed(spark: SparkSession, sf_dir: str, window_minutes: int = 1) -> None:
    """``telemetry``, ``transactions``, ``alerts`` and ``summary`` over the replayed events."""
    rows = replayed.events(spark, sf_dir)
    telemetry, transactions = replayed.telemetry(rows), replayed.transactions(rows)
    register(
        {
            "telemetry": telemetry,
            "transactions": transactions,
            "alerts": rules.raise_alerts(telemetry),
            "summary": summary.summarize(transactions, window_minutes),
        }
    )
