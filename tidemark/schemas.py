"""Record schemas. Field names and types are the wire contract and must not change."""

from __future__ import annotations

from pyspark.sql import types as T


def _record(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, False) for name, kind in fields.items()])


TRANSACTION = _record(
    transaction_id=T.StringType(),
    product_id=T.StringType(),
    category=T.StringType(),
    quantity=T.IntegerType(),
    price=T.DoubleType(),
    timestamp=T.TimestampType(),
)

TRANSACTION_TABLE = _record(
    transaction_id=T.StringType(),
    product_id=T.StringType(),
    category=T.StringType(),
    quantity=T.IntegerType(),
    price=T.DecimalType(10, 2),
    timestamp=T.TimestampType(),
)
TRANSACTION_TABLE_KEY = ("transaction_id", "timestamp")

GENERATED_TRANSACTION = _record(
    transaction_id=T.StringType(),
    product_id=T.StringType(),
    category=T.StringType(),
    quantity=T.IntegerType(),
    price=T.FloatType(),
)

# total_quantity is a 32-bit int on the wire; tables keep the wide sum (see functions.wire).
SUMMARY = _record(
    category=T.StringType(),
    total_quantity=T.LongType(),
    total_revenue=T.DoubleType(),
    window_start=T.LongType(),
    window_end=T.LongType(),
)

SUMMARY_WIRE = _record(
    category=T.StringType(),
    total_quantity=T.IntegerType(),
    total_revenue=T.DoubleType(),
    window_start=T.LongType(),
    window_end=T.LongType(),
)

# timestamp counts epoch seconds and is passed through untouched.
TELEMETRY = _record(
    sensor_id=T.StringType(),
    temperature=T.DoubleType(),
    humidity=T.DoubleType(),
    soil_fertility=T.DoubleType(),
    timestamp=T.LongType(),
)

ALERT = _record(
    sensor_id=T.StringType(),
    alert_type=T.StringType(),
    timestamp=T.LongType(),
    details=T.StringType(),
)

# The columns of Spark's Kafka source; value is raw bytes there and a record once decoded.
ENVELOPE = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)
