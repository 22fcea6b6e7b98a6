"""Messages of several writer schemas in one topic, read as records of one reader schema.

The id in a message's header chooses the schema it was written with. Each known schema decodes the messages of its own id;
what follows is column selection by field name: order does not matter, fields the reader does not know go, fields the
writer did not have take their default, and numbers widen (int to long, float or double; long to float or double; float to
double). Whether two schemas resolve is decided when the frame is defined, before any message is read.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import wire

# The promotions that schema resolution allows.
WIDENS = {
    T.IntegerType(): (T.LongType(), T.FloatType(), T.DoubleType()),
    T.LongType(): (T.FloatType(), T.DoubleType()),
    T.FloatType(): (T.DoubleType(),),
}
_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "long": T.LongType(), "float": T.FloatType(), "double": T.DoubleType()}


class SchemaMismatch(ValueError):
    """A writer schema cannot be read as the reader schema."""


@dataclass(frozen=True)
class Reader:
    """The schema a job works with. ``defaults`` fill fields a writer lacks; ``former`` lists earlier names of a field."""

    schema: T.StructType
    defaults: Mapping[str, object] = field(default_factory=dict)
    former: Mapping[str, tuple[str, ...]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        unknown = {*self.defaults, *self.former} - set(self.schema.names)
        if unknown:
            raise SchemaMismatch(f"no such fields: {', '.join(sorted(unknown))}")

    def source(self, wanted: T.StructField, writer: T.StructType) -> T.StructField | None:
        """The writer's field that a reader's field takes, or None where its default applies."""
        for name in (wanted.name, *self.former.get(wanted.name, ())):
            if name in writer.names:
                found = writer[name]
                if found.dataType != wanted.dataType and wanted.dataType not in WIDENS.get(found.dataType, ()):
                    raise SchemaMismatch(
                        f"{wanted.name}: {found.dataType.typeName()} cannot be read as {wanted.dataType.typeName()}"
                    )
                return found
        if wanted.name not in self.defaults:
            raise SchemaMismatch(f"{wanted.name}: the writer has no such field and the reader no default")
        return None

    def resolve(self, record: Column, writer: T.StructType) -> Column:
        """A writer's record as a reader's; null stays null."""
        columns = []
        for wanted in self.schema.fields:
            found = self.source(wanted, writer)
            value = F.lit(self.defaults[wanted.name]) if found is None else record.getField(found.name)
            columns.append(value.cast(wanted.dataType).alias(wanted.name))
        return F.when(record.isNotNull(), F.struct(*columns))


def decode_versions(
    value: str | Column, writers: Mapping[int, T.StructType], reader: Reader, fail_fast: bool = True
) -> Column:
    """Framed messages to the reader's records, each by the writer schema of its id; null for any other message."""
    records = [
        reader.resolve(wire.decode_record(wire.payload_if_framed(value, {number}), writer, fail_fast), writer)
        for number, writer in sorted(writers.items())
    ]
    if not records:
        raise SchemaMismatch("no writer schemas")
    return F.coalesce(*records)


def parse_schema(text: str | Mapping) -> tuple[T.StructType, dict[str, object]]:
    """A flat Avro record schema as a struct and the defaults of its fields."""
    record = json.loads(text) if isinstance(text, str) else text
    if record.get("type") != "record":
        raise SchemaMismatch("not a record schema")
    fields, defaults = [], {}
    for one in record["fields"]:
        kind = one["type"]
        if isinstance(kind, Mapping):
            stamp = kind.get("logicalType") == "timestamp-millis" and kind.get("type") == "long"
            found = T.TimestampType() if stamp else _TYPES.get(kind.get("type"))
        else:
            found = _TYPES.get(kind) if isinstance(kind, str) else None
        if found is None:
            raise SchemaMismatch(f"{one['name']}: only flat records of strings and numbers can be read, not {kind!r}")
        fields.append(T.StructField(one["name"], found, False))
        if "default" in one:
            defaults[one["name"]] = one["default"]
    return T.StructType(fields), defaults


def read_registry(text: str) -> dict[int, T.StructType]:
    """Writer schemas by id, from a JSON object of id and Avro schema."""
    return {int(number): parse_schema(schema)[0] for number, schema in json.loads(text).items()}
