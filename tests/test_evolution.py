"""Messages of several writer schemas resolved to one reader schema."""

from __future__ import annotations

import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import evolution, wire
from tidemark.schemas import TRANSACTION
from tidemark.sources import topics


def struct(**kinds):
    return T.StructType([T.StructField(name, kind, False) for name, kind in kinds.items()])


READER = struct(a=T.StringType(), n=T.LongType(), x=T.DoubleType())


def messages(spark, parts):
    """One framed message a part: (schema id, writer schema, values)."""
    frames = []
    for place, (number, schema, values) in enumerate(parts):
        df = spark.createDataFrame([values], schema)
        value = wire.framed(wire.encode_record(F.struct(*schema.names), schema), number)
        frames.append(df.select(F.lit(place).alias("offset"), value.alias("value")))
    out = frames[0]
    for more in frames[1:]:
        out = out.union(more)
    return out


def test_each_message_is_read_by_its_own_schema(spark):
    old = struct(x=T.FloatType(), n=T.IntegerType(), gone=T.StringType(), a=T.StringType())
    renamed = struct(label=T.StringType(), n=T.LongType())
    reader = evolution.Reader(READER, {"x": -1.5}, {"a": ("label",)})
    raw = messages(spark, [(1, old, (0.1, -7, "old", "é")), (2, renamed, ("two", 2**40)), (3, READER, ("three", 3, 0.3)), (9, READER, ("no", 0, 0.0))])
    found = raw.select("offset", evolution.decode_versions("value", {1: old, 2: renamed, 3: READER}, reader).alias("r"))
    rows = {row.offset: row.r and tuple(row.r) for row in found.collect()}
    single = spark.sql("SELECT cast(cast(0.1 AS float) AS double) AS x").first().x
    assert rows == {0: ("é", -7, single), 1: ("two", 2**40, -1.5), 2: ("three", 3, 0.3), 3: None}


@pytest.mark.parametrize(
    ("writer", "said"),
    [
        (struct(a=T.StringType(), n=T.DoubleType(), x=T.DoubleType()), "n: double cannot be read as long"),
        (struct(a=T.LongType(), n=T.LongType(), x=T.DoubleType()), "a: long cannot be read as string"),
        (struct(a=T.StringType(), n=T.LongType()), "x: the writer has no such field"),
    ],
)
def test_schemas_that_do_not_resolve_fail_before_a_message_is_read(spark, writer, said):
    frame = spark.createDataFrame([], "value binary")
    with pytest.raises(evolution.SchemaMismatch, match=said):
        frame.select(evolution.decode_versions("value", {1: writer}, evolution.Reader(READER)))


def test_defaults_must_name_fields():
    with pytest.raises(evolution.SchemaMismatch, match="no such fields: y"):
        evolution.Reader(READER, {"y": 1})


def test_damaged_message_raises_or_gives_null(spark):
    raw = spark.createDataFrame([(bytes([0, 0, 0, 0, 1, 255]),), (None,), (b"\x00\x00",)], "value binary")
    reader = evolution.Reader(READER)
    lenient = raw.select(evolution.decode_versions("value", {1: READER}, reader, fail_fast=False).alias("r"))
    assert [row.r for row in lenient.collect()] == [None, None, None]
    with pytest.raises(Exception, match="damaged"):
        raw.select(evolution.decode_versions("value", {1: READER}, reader).alias("r")).collect()


def test_topic_of_several_writers(spark):
    """A map of ids to schemas in place of a set of ids; foreign ids still stop the job or are left aside."""
    early = struct(**{f.name: f.dataType for f in TRANSACTION.fields if f.name != "product_id"})
    at = datetime(2024, 1, 1, tzinfo=timezone.utc)
    raw = messages(spark, [(1, early, ("t1", "c", 2, 1.5, at)), (2, TRANSACTION, ("t2", "p", "c", 3, 2.5, at)), (3, READER, ("x", 1, 1.0))])
    raw = raw.select(
        F.lit(b"k").alias("key"), "value", F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("offset").cast("long").alias("offset"),
        F.current_timestamp().alias("timestamp"),
    )
    reader, writers = evolution.Reader(TRANSACTION, {"product_id": "?"}), {1: early, 2: TRANSACTION}
    left = topics.decode_topic(raw, reader, writers, on_foreign="leave").orderBy("offset").collect()
    assert [row.value and (row.value.transaction_id, row.value.product_id, row.value.quantity) for row in left] == [("t1", "?", 2), ("t2", "p", 3), None]
    with pytest.raises(Exception, match="foreign message in t, partition 0, offset 2"):
        topics.decode_topic(raw, reader, writers).collect()
    assert topics.foreign_messages(raw, writers).count() == 1


def test_schemas_are_read_from_json():
    text = wire.avro_schema(TRANSACTION, "sales.tx")
    assert evolution.parse_schema(text) == (TRANSACTION, {})
    with_default = json.loads(text)
    with_default["fields"][1]["default"] = "none"
    assert evolution.parse_schema(with_default)[1] == {"product_id": "none"}
    assert evolution.read_registry(json.dumps({"7": json.loads(text)})) == {7: TRANSACTION}
    with pytest.raises(evolution.SchemaMismatch, match="only flat records"):
        evolution.parse_schema({"type": "record", "name": "r", "fields": [{"name": "u", "type": ["null", "int"]}]})
