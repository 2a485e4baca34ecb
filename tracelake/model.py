"""Row shapes of the message log and the table of value types.

A *log* is a DataFrame (batch or stream) with one message per row. ``seq`` is
the arrival order: unique, never derived from event time. ``kind`` says which
of the nullable payload structs is set.
"""

from __future__ import annotations

from dataclasses import dataclass

SEGMENT_START = "segment_start"
SEGMENT_END = "segment_end"
EVENT_SCHEMA = "event_schema"
NAMED_VALUES = "named_values"
EVENT = "event"

CONTROL_KINDS = (SEGMENT_START, SEGMENT_END, EVENT_SCHEMA, NAMED_VALUES)
ALL_KINDS = CONTROL_KINDS + (EVENT,)


@dataclass(frozen=True)
class ValueType:
    """One primitive type: its names in each system and the slot it lives in."""

    name: str
    duckdb: str
    arrow: str
    spark: str
    slot: str
    numeric: bool
    low: int | None = None
    high: int | None = None

    @property
    def is_integer(self) -> bool:
        return self.low is not None

    @property
    def is_unsigned(self) -> bool:
        return self.low == 0


# The fourteen primitive types, in wire-tag order (1..14).
VALUE_TYPES = (
    ValueType("int8", "TINYINT", "Int8", "TINYINT", "i", True, -(2**7), 2**7 - 1),
    ValueType("int16", "SMALLINT", "Int16", "SMALLINT", "i", True, -(2**15), 2**15 - 1),
    ValueType("int32", "INTEGER", "Int32", "INT", "i", True, -(2**31), 2**31 - 1),
    ValueType("int64", "BIGINT", "Int64", "BIGINT", "i", True, -(2**63), 2**63 - 1),
    ValueType("uint8", "UTINYINT", "UInt8", "SMALLINT", "i", True, 0, 2**8 - 1),
    ValueType("uint16", "USMALLINT", "UInt16", "INT", "i", True, 0, 2**16 - 1),
    ValueType("uint32", "UINTEGER", "UInt32", "BIGINT", "i", True, 0, 2**32 - 1),
    ValueType("uint64", "UBIGINT", "UInt64", "DECIMAL(20,0)", "u", True, 0, 2**64 - 1),
    ValueType("float32", "FLOAT", "Float32", "FLOAT", "f", True),
    ValueType("float64", "DOUBLE", "Float64", "DOUBLE", "f", True),
    ValueType("timestamp[ns]", "TIMESTAMP_NS", "Timestamp(ns, UTC)", "BIGINT", "ts", False),
    ValueType("binary", "BLOB", "Binary", "BINARY", "bin", False),
    ValueType("string", "VARCHAR", "Utf8", "STRING", "s", False),
    ValueType("bool", "BOOLEAN", "Boolean", "BOOLEAN", "b", True),
)

TYPE_BY_NAME = {t.name: t for t in VALUE_TYPES}

# Other accepted spellings of the canonical names. ``float`` and
# ``double`` are aliases; the last two are what the Go publisher prints.
TYPE_ALIASES = {
    "float": "float32",
    "double": "float64",
    "timestamp_ns": "timestamp[ns]",
    "boolean": "bool",
}

INTEGER_TYPES = tuple(t.name for t in VALUE_TYPES if t.is_integer)

# A typed value: the tag decides the type, one slot per family carries it.
# Integers that fit a BIGINT use ``i``; only uint64 needs the decimal slot.
# float32 is carried widened in ``f`` and cast back when read.
VALUE_DDL = (
    "STRUCT<tag: STRING, i: BIGINT, u: DECIMAL(20,0), f: DOUBLE, "
    "ts: BIGINT, bin: BINARY, s: STRING, b: BOOLEAN>"
)
START_DDL = "STRUCT<time_ns: BIGINT, source_name: STRING>"
END_DDL = "STRUCT<time_ns: BIGINT>"
FIELD_DDL = "STRUCT<name: STRING, data_type: STRING, unit: STRING>"
SCHEMA_DDL = f"STRUCT<name: STRING, fields: ARRAY<{FIELD_DDL}>>"
NAMED_VALUES_DDL = (
    "STRUCT<event_name: STRING, field_name: STRING, "
    f"`values`: ARRAY<STRUCT<value: {VALUE_DDL}, label: STRING>>>"
)
EVENT_DDL = (
    "STRUCT<time_ns: BIGINT, name: STRING, "
    f"fields: ARRAY<STRUCT<name: STRING, value: {VALUE_DDL}>>>"
)

PAYLOAD_DDL = {
    SEGMENT_START: START_DDL,
    SEGMENT_END: END_DDL,
    EVENT_SCHEMA: SCHEMA_DDL,
    NAMED_VALUES: NAMED_VALUES_DDL,
    EVENT: EVENT_DDL,
}

LOG_DDL = "seq BIGINT, segment_id STRING, source_name STRING, kind STRING, " + ", ".join(
    f"{kind} {PAYLOAD_DDL[kind]}" for kind in ALL_KINDS
)
LOG_COLUMNS = ("seq", "segment_id", "source_name", "kind", *ALL_KINDS)

# Before validation a message looks the same, but the segment id is still the
# raw bytes and unsigned carriers may hold any uint64 in slot ``u``.
BATCH_DDL = (
    "stream_id STRING, batch_no BIGINT, trace_messages ARRAY<STRUCT<"
    "segment_id: BINARY, source_name: STRING, kind: STRING, "
    + ", ".join(f"{kind}: {PAYLOAD_DDL[kind]}" for kind in ALL_KINDS)
    + ">>"
)
