from datetime import datetime, timezone

import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import avroflat, wire
from tidemark.schemas import ALERT, SUMMARY_WIRE, TELEMETRY, TRANSACTION

KINDS = [("s", "string"), ("i", "integer"), ("l", "long"), ("f", "float"), ("d", "double")]
TYPES = pa.struct([("s", pa.string()), ("i", pa.int32()), ("l", pa.int64()), ("f", pa.float32()), ("d", pa.float64())])


def encode(records, kinds=KINDS, types=TYPES):
    """Bodies of a struct array, field by field."""
    array = records if isinstance(records, pa.Array) else pa.array(records, types)
    return avroflat.encoder(kinds)(*array.flatten())


def bodies(records):
    return encode(records)


def test_bytes_follow_the_public_format():
    (body,) = bodies([{"s": "foo", "i": -1, "l": 64, "f": 1.0, "d": -2.0}]).to_pylist()
    assert body.hex() == "06666f6f" + "01" + "8001" + "0000803f" + "00000000000000c0"


@pytest.mark.parametrize(
    ("number", "hexed"),
    [(0, "00"), (-1, "01"), (1, "02"), (-64, "7f"), (64, "8001"), (-65, "8101"),
     (2**63 - 1, "feffffffffffffffff01"), (-(2**63), "ffffffffffffffffff01")],
)
def test_zigzag_varints(number, hexed):
    body = encode([{"l": number}], [("l", "long")], pa.struct([("l", pa.int64())]))
    assert body.to_pylist()[0].hex() == hexed
    assert avroflat.decoder([("l", "long")], True)(body).to_pylist() == [{"l": number}]


record = st.fixed_dictionaries(
    {
        "s": st.text(max_size=200),
        "i": st.integers(-(2**31), 2**31 - 1),
        "l": st.integers(-(2**63), 2**63 - 1),
        "f": st.floats(width=32, allow_nan=False),
        "d": st.floats(allow_nan=False),
    }
)


@given(st.lists(st.one_of(st.none(), record), max_size=20), st.integers(0, 5))
def test_round_trip_with_nulls_and_slices(records, skip):
    body = bodies(records)
    assert avroflat.decoder(KINDS, True)(body).to_pylist() == records
    assert avroflat.decoder(KINDS, True)(body.slice(skip)).to_pylist() == records[skip:]
    sliced = pa.array(records, TYPES).slice(skip)
    assert encode(sliced).to_pylist() == body.to_pylist()[skip:]


def test_damaged_bodies():
    good = bodies([{"s": "foo", "i": 1, "l": 2, "f": 1.0, "d": 2.0}]).to_pylist()[0]
    broken = [good[:-1], b"", b"\x7f", b"\xff" * 12, good]
    lenient = avroflat.decoder(KINDS, False)(pa.array(broken, pa.binary())).to_pylist()
    assert lenient[:4] == [None] * 4 and lenient[4]["s"] == "foo"
    with pytest.raises(ValueError, match="4 damaged"):
        avroflat.decoder(KINDS, True)(pa.array(broken, pa.binary()))


def test_missing_field_value_is_refused():
    with pytest.raises(ValueError, match="value for s"):
        bodies([{"s": None, "i": 1, "l": 2, "f": 1.0, "d": 2.0}])


def test_header(spark):
    rows = [bytes.fromhex("000000002A") + b"hi", b"\x01\x00\x00\x00\x2ahi", b"\x00\x00", b"", None, b"\x00\xff\xff\xff\xff"]
    df = spark.createDataFrame([(r,) for r in rows], "value binary")
    got = [tuple(r) for r in df.select(wire.header("value").alias("h")).select("h.*").collect()]
    assert got[0] == ("00", 42, bytearray(b"hi"), True)
    assert got[1] == ("01", 42, bytearray(b"hi"), False)
    assert got[2] == ("00", None, None, False)
    assert got[3] == ("", None, None, False)
    assert got[4] == (None, None, None, False)
    assert got[5] == ("00", 4294967295, bytearray(b""), True)
    payloads = [r[0] for r in df.select(wire.payload_if_framed("value")).collect()]
    assert payloads == [bytearray(b"hi"), None, None, None, None, bytearray(b"")]


@pytest.fixture(params=[wire.ARROW, wire.SPARK_AVRO])
def codec(request, spark):
    if request.param == wire.SPARK_AVRO and not wire.spark_avro_loaded(spark):
        pytest.skip("Spark's Avro package is not on the class path")
    return request.param


def test_the_codec_is_chosen_and_not_found(spark):
    assert wire.codec() == wire.ARROW
    spark.conf.set(wire.CODEC_SETTING, "xml")
    try:
        with pytest.raises(ValueError, match="xml"):
            wire.codec()
        assert wire.codec(wire.ARROW) == wire.ARROW
    finally:
        spark.conf.unset(wire.CODEC_SETTING)
    if not wire.spark_avro_loaded(spark):
        with pytest.raises(ValueError, match="class path"):
            wire.codec(wire.SPARK_AVRO)


def test_records_through_spark(spark, codec):
    rows = [("tx1", "prod_1", "säeds", 3, 12.5, datetime(2024, 1, 1, 0, 0, 0, 123000)), None]
    df = spark.createDataFrame([(r,) for r in rows], T.StructType([T.StructField("value", TRANSACTION)]))
    message = wire.framed(wire.encode_record(F.col("value"), TRANSACTION, with_codec=codec), 9)
    record = wire.decode_record(wire.payload_if_framed("m"), TRANSACTION, with_codec=codec)
    back = df.select(message.alias("m")).select(record.alias("r"))
    assert [r.r if r.r is None else tuple(r.r) for r in back.collect()] == rows


def test_a_record_of_nulls_is_refused(spark):
    df = spark.sql("SELECT struct(cast(null AS string) AS sensor_id, cast(null AS string) AS alert_type, cast(null AS bigint) AS timestamp, cast(null AS string) AS details) AS v")
    with pytest.raises(Exception, match="no values"):
        df.select(wire.encode_record(F.col("v"), ALERT)).collect()


def test_wide_totals_must_fit_the_wire_int(spark, codec):
    df = spark.sql("SELECT struct('a' AS category, 2147483648L AS total_quantity, 1D AS total_revenue, 0L AS window_start, 1L AS window_end) AS v")
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        df.select(wire.encode_record(F.col("v"), SUMMARY_WIRE, with_codec=codec)).collect()


def test_avro_schema_text():
    text = wire.avro_schema(TELEMETRY, "iot.SensorTelemetry")
    assert '"namespace": "iot"' in text and '"name": "SensorTelemetry"' in text
    assert '{"name": "timestamp", "type": "long"}' in text
    assert "timestamp-millis" in wire.avro_schema(TRANSACTION, "sales_transactions")
    assert "namespace" not in wire.avro_schema(ALERT, "SensorAlerts")


def test_record_times_are_floored_to_milliseconds():
    kinds = [("t", "timestamp")]
    early = datetime(1969, 12, 31, 23, 59, 59, 999_999, tzinfo=timezone.utc)
    body = encode([{"t": early}], kinds, pa.struct([("t", pa.timestamp("us", "UTC"))]))
    assert body.to_pylist() == [b"\x01"]
