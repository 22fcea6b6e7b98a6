"""Message bytes: string keys, the 5-byte schema header, and flat Avro record bodies."""

from __future__ import annotations

import json
from collections.abc import Collection

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import avroflat

# A framed message is one zero byte, a 4-byte big-endian schema id, then the body.
MAGIC = b"\x00"
HEADER_BYTES = 5

CODEC_SETTING = "spark.tidemark.codec"
ARROW, SPARK_AVRO = "arrow", "spark-avro"

_AVRO_TYPES = {
    T.StringType(): "string",
    T.IntegerType(): "int",
    T.LongType(): "long",
    T.FloatType(): "float",
    T.DoubleType(): "double",
    T.TimestampType(): {"type": "long", "logicalType": "timestamp-millis"},
}


def _col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def header(value: str | Column) -> Column:
    """(magic, schema_id, payload, framed): what routes foreign or damaged messages away."""
    value = _col(value)
    long_enough = F.length(value) >= HEADER_BYTES
    schema_id = F.conv(F.hex(F.substring(value, 2, 4)), 16, 10).cast("bigint")
    return F.struct(
        F.hex(F.substring(value, 1, 1)).alias("magic"),
        F.when(long_enough, schema_id).alias("schema_id"),
        F.when(long_enough, _tail(value)).alias("payload"),
        F.coalesce(is_framed(value), F.lit(False)).alias("framed"),
    )


def _tail(value: Column) -> Column:
    return F.substring(value, HEADER_BYTES + 1, 2**31 - 1)


def is_framed(value: str | Column, schema_ids: Collection[int] | None = None) -> Column:
    """Whether a message carries a header and, if given, one of these schema ids."""
    value = _col(value)
    carries = (F.length(value) >= HEADER_BYTES) & (F.substring(value, 1, 1) == F.lit(MAGIC))
    if schema_ids is None:
        return carries
    return carries & F.substring(value, 2, 4).isin([number.to_bytes(4, "big") for number in schema_ids])


def payload_if_framed(value: str | Column, schema_ids: Collection[int] | None = None) -> Column:
    """The body behind the header, or null for anything ``is_framed`` does not accept."""
    value = _col(value)
    return F.when(is_framed(value, schema_ids), _tail(value))


def framed(body: Column, schema_id: int | Column) -> Column:
    """Put the header in front of a body."""
    number = schema_id if isinstance(schema_id, Column) else F.lit(schema_id)
    return F.concat(F.lit(MAGIC), F.unhex(F.lpad(F.hex(number.cast("bigint")), 8, "0")), body)


def avro_schema(schema: T.StructType, full_name: str) -> str:
    """The Avro schema of a flat record."""
    namespace, _, name = full_name.rpartition(".")
    fields = [{"name": f.name, "type": _AVRO_TYPES[f.dataType]} for f in schema.fields]
    record = {"type": "record", "name": name, "fields": fields}
    return json.dumps(record | ({"namespace": namespace} if namespace else {}))


def spark_avro_loaded(spark: SparkSession) -> bool:
    """Whether the separate spark-avro package is on the class path."""
    loader = spark._jvm.java.lang.Thread.currentThread().getContextClassLoader()
    try:
        loader.loadClass("org.apache.spark.sql.avro.AvroDataToCatalyst")
    except Exception:
        return False
    return True


def codec(chosen: str | None = None) -> str:
    """Which codec reads and writes record bodies: ``chosen``, else the session's ``CODEC_SETTING``, else ``arrow``.

    ``arrow`` is this package's codec for flat records. ``spark-avro`` is Spark's separate package, which must be on the
    class path; it does not look at what follows a record, so it cannot tell a body of a longer schema. What lies on the
    class path never chooses by itself.
    """
    spark = SparkSession.active()
    name = chosen or spark.conf.get(CODEC_SETTING, None) or ARROW
    if name not in (ARROW, SPARK_AVRO):
        raise ValueError(f"the codec must be {ARROW!r} or {SPARK_AVRO!r}, not {name!r}")
    if name == SPARK_AVRO and not spark_avro_loaded(spark):
        raise ValueError("the codec 'spark-avro' needs Spark's Avro package on the class path")
    return name


def decode_record(
    body: Column, schema: T.StructType, fail_fast: bool = True, with_codec: str | None = None
) -> Column:
    """Avro bytes to a struct. Null stays null; damaged bytes raise, or give null if not fail_fast."""
    if codec(with_codec) == SPARK_AVRO:
        from pyspark.sql.avro.functions import from_avro

        mode = {"mode": "FAILFAST" if fail_fast else "PERMISSIVE"}
        return from_avro(body, avro_schema(schema, "record"), mode)
    nullable = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
    return F.arrow_udf(avroflat.decoder(_kinds(schema), fail_fast), nullable)(body)


def encode_record(
    record: Column, schema: T.StructType, full_name: str | None = None, with_codec: str | None = None
) -> Column:
    """A struct to Avro bytes, its fields cast to the wire types (out-of-range values raise)."""
    fields = [record.getField(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
    if codec(with_codec) == SPARK_AVRO:
        from pyspark.sql.avro.functions import to_avro

        return to_avro(F.when(record.isNotNull(), F.struct(*fields)), avro_schema(schema, full_name or "record"))
    # Single fields cross to Python at half the cost of a struct.
    body = F.arrow_udf(avroflat.encoder(_kinds(schema)), T.BinaryType())(*fields)
    return F.when(record.isNotNull(), F.coalesce(body, F.raise_error(F.lit("a record has no values"))))


def _kinds(schema: T.StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.typeName()) for f in schema.fields]
