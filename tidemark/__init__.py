"""Spark-native analytics for sales-transaction and sensor-telemetry streams."""
