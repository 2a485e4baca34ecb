"""Serialized publish requests to batches of messages and back.

Bytes are parsed by the protobuf runtime inside Arrow batches, one request per
row; Spark partitions the work. Only the shape is translated here. Whether a
message is valid is decided afterwards, by column expressions (``batches``).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

import tracelake
from tracelake.functions.identifiers import uuid_to_bytes
from tracelake.model import (
    ALL_KINDS,
    BATCH_DDL,
    EVENT,
    EVENT_SCHEMA,
    NAMED_VALUES,
    SEGMENT_END,
    SEGMENT_START,
    VALUE_TYPES,
)

# The functions below travel to the executors with their code, so these need
# protobuf but not this package.
cloudpickle.register_pickle_by_value(tracelake)

UNDECODABLE = "undecodable"
# Decoded messages that a worker holds as rows, besides those of one batch.
STEP_MESSAGES = 2000

# The wire layout. (field, number, type); a type that names a
# layout is a nested message, "+" marks repeated, "?" optional; fields of a
# layout listed in ONE_OF form one oneof.
LAYOUTS = {
    "Value": (
        ("int8", 1, "int64"), ("int16", 2, "int64"), ("int32", 3, "int64"), ("int64", 4, "int64"),
        ("uint8", 5, "uint64"), ("uint16", 6, "uint64"), ("uint32", 7, "uint64"),
        ("uint64", 8, "uint64"), ("float32", 9, "float"), ("float64", 10, "double"),
        ("timestamp_ns", 11, "sfixed64"), ("binary", 12, "bytes"), ("string", 13, "string"),
        ("bool", 14, "bool"),
    ),
    "Field": (("name", 1, "string"), ("data_type", 2, "int32"), ("unit", 3, "string?")),
    "Start": (("time_ns", 1, "sfixed64"), ("source_name", 2, "string")),
    "End": (("time_ns", 1, "sfixed64"),),
    "Schema": (("name", 1, "string"), ("fields", 2, "Field+")),
    "Entry": (("name", 1, "string"), ("value", 2, "Value")),
    "NamedValues": (
        ("event_name", 1, "string"), ("field_name", 2, "string"), ("values", 3, "Entry+"),
    ),
    "Event": (("time_ns", 1, "sfixed64"), ("name", 2, "string"), ("fields", 3, "Entry+")),
    "Message": (
        ("segment_id", 1, "bytes"), ("source_name", 7, "string"), ("segment_start", 2, "Start"),
        ("segment_end", 3, "End"), ("event_schema", 4, "Schema"),
        ("named_values", 5, "NamedValues"), ("event", 6, "Event"),
    ),
    "Batch": (("messages", 1, "Message+"),),
}
ONE_OF = {
    "Value": [t.name for t in VALUE_TYPES] + ["timestamp_ns"],
    "Message": list(ALL_KINDS),
}


def batch_class():
    """Protobuf class of one batch, from a descriptor built at run time.

    The type number of a schema field is declared as a plain integer: enums and
    integers are the same on the wire, and unknown numbers survive.
    """
    # imported here: the codec is optional, everything else works without it
    from google.protobuf import descriptor_pb2, descriptor_pool, message_factory

    kinds = descriptor_pb2.FieldDescriptorProto
    file = descriptor_pb2.FileDescriptorProto(
        name="tracelake.proto", package="tracelake", syntax="proto3"
    )
    for name, fields in LAYOUTS.items():
        message = file.message_type.add(name=name)
        if name in ONE_OF:
            message.oneof_decl.add(name="content")
        for field, number, kind in fields:
            base = kind.rstrip("+?")
            out = message.field.add(name=field, number=number)
            out.label = kinds.LABEL_REPEATED if kind.endswith("+") else kinds.LABEL_OPTIONAL
            if base in LAYOUTS:
                out.type, out.type_name = kinds.TYPE_MESSAGE, f".tracelake.{base}"
            else:
                out.type = getattr(kinds, f"TYPE_{base.upper()}")
            if field in ONE_OF.get(name, ()):
                out.oneof_index = 0
            elif kind.endswith("?"):
                out.proto3_optional = True
                out.oneof_index = len(message.oneof_decl)
                message.oneof_decl.add(name=f"_{field}")
    pool = descriptor_pool.DescriptorPool()
    pool.Add(file)
    return message_factory.GetMessageClass(pool.FindMessageTypeByName("tracelake.Batch"))


_WIRE_NAMES = {"timestamp[ns]": "timestamp_ns"}
_TYPES = {_WIRE_NAMES.get(t.name, t.name): t for t in VALUE_TYPES}


def _value_row(value):
    tag = value.WhichOneof("content")
    if tag is None:
        return None
    kind, content = _TYPES[tag], getattr(value, tag)
    # unsigned carriers stay in the decimal slot until validated
    slot = "u" if kind.is_unsigned else kind.slot
    return {"tag": kind.name, slot: content}


def _entries(entries, key):
    return [
        {key: e.name, "value": _value_row(e.value) if e.HasField("value") else None}
        for e in entries
    ]


def _message_row(message):
    kind = message.WhichOneof("content")
    row = {"segment_id": message.segment_id, "source_name": message.source_name, "kind": kind}
    if kind is None:
        return row
    body = getattr(message, kind)
    if kind == SEGMENT_START:
        row[kind] = {"time_ns": body.time_ns, "source_name": body.source_name}
    elif kind == SEGMENT_END:
        row[kind] = {"time_ns": body.time_ns}
    elif kind == EVENT_SCHEMA:
        fields = [
            {
                "name": f.name,
                "data_type": VALUE_TYPES[f.data_type - 1].name
                if 1 <= f.data_type <= len(VALUE_TYPES)
                else None,
                "unit": f.unit if f.HasField("unit") else None,
            }
            for f in body.fields
        ]
        row[kind] = {"name": body.name, "fields": fields}
    elif kind == NAMED_VALUES:
        row[kind] = {
            "event_name": body.event_name,
            "field_name": body.field_name,
            "values": _entries(body.values, "label"),
        }
    else:
        row[kind] = {
            "time_ns": body.time_ns, "name": body.name, "fields": _entries(body.fields, "name")
        }
    return row


def _arrow_schema(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(T.StructType.fromDDL(ddl))


def decode_batches(payloads: DataFrame) -> DataFrame:
    """(stream_id, batch_no, payload) to batches, plus ``decode_error``.

    Bytes that are no batch at all give a row without messages and an error.
    """
    ddl = BATCH_DDL + ", decode_error STRING"
    schema = _arrow_schema(ddl)

    def decode(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from google.protobuf.message import DecodeError

        cls = batch_class()
        for part in parts:
            rows, held = [], 0
            # a payload holds a whole batch: rows go on as soon as their messages are many
            for at in range(part.num_rows):
                [row] = part.slice(at, 1).to_pylist()
                try:
                    batch = cls.FromString(row.pop("payload") or b"")
                    row["trace_messages"] = [_message_row(m) for m in batch.messages]
                    held += len(batch.messages)
                except DecodeError:
                    row["decode_error"] = UNDECODABLE
                rows.append(row)
                if held >= STEP_MESSAGES or len(rows) >= STEP_MESSAGES:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return payloads.select("stream_id", "batch_no", "payload").mapInArrow(decode, ddl)


def _fill_value(target, value) -> None:
    kind = _TYPES[_WIRE_NAMES.get(value["tag"], value["tag"])]
    content = value[kind.slot]
    setattr(
        target, _WIRE_NAMES.get(kind.name, kind.name), int(content) if kind.is_integer else content
    )


def _fill(message, row) -> None:
    message.segment_id = row["segment_id"]
    message.source_name = row["source_name"]
    kind = row["kind"]
    body, data = getattr(message, kind), row[kind]
    body.SetInParent()
    for name in ("time_ns", "source_name", "name", "event_name", "field_name"):
        if data.get(name) is not None:
            setattr(body, name, data[name])
    if kind == EVENT_SCHEMA:
        numbers = {t.name: n for n, t in enumerate(VALUE_TYPES, 1)}
        for f in data["fields"]:
            out = body.fields.add(name=f["name"], data_type=numbers[f["data_type"]])
            if f["unit"] is not None:
                out.unit = f["unit"]
    elif kind == NAMED_VALUES:
        for e in data["values"]:
            _fill_value(body.values.add(name=e["label"]).value, e["value"])
    elif kind == EVENT:
        for f in data["fields"]:
            _fill_value(body.fields.add(name=f["name"]).value, f["value"])


def encode_batches(batches: DataFrame, column: str = "messages") -> DataFrame:
    """Batches of log messages (see ``gather_batches``) with their ``payload``.

    Columns other than the messages are kept.
    """
    rest = [c for c in batches.columns if c != column]
    raw = F.transform(
        column, lambda m: m.withField("segment_id", uuid_to_bytes(m["segment_id"]))
    )
    shaped = batches.select(*rest, raw.alias("_messages"))
    out = T.StructType(
        [f for f in batches.schema.fields if f.name != column]
        + [T.StructField("payload", T.BinaryType())]
    )

    def encode(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cls = batch_class()
        for part in parts:
            payloads = []
            # one batch at a time: its messages are many
            for messages in part.column("_messages"):
                batch = cls()
                for row in messages.as_py():
                    _fill(batch.messages.add(), row)
                payloads.append(batch.SerializeToString())
            kept = [part.column(name) for name in rest]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(payloads, pa.binary())], [*rest, "payload"]
            )

    return shaped.mapInArrow(encode, out)


def encode_messages(numbered: DataFrame, stream_keys: Sequence[str]) -> DataFrame:
    """Numbered messages (see ``number_batches``) as ``payload`` of their batch.

    The same bytes as :func:`encode_batches` of the gathered batches. A batch on the
    wire is its messages' bytes one after the other, so each message is encoded by
    itself and only bytes are gathered, never a batch of rows.
    """
    keys = [*stream_keys, "batch_no", "batch_pos"]
    message = F.struct("segment_id", "source_name", "kind", *ALL_KINDS)
    single = encode_batches(numbered.select(*keys, F.array(message).alias("messages")))
    return single.groupBy(*stream_keys, "batch_no").agg(
        F.expr("listagg(payload, X'') WITHIN GROUP (ORDER BY batch_pos)").alias("payload")
    )

