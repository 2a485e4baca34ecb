"""A message log derived from a plain ``events`` table.

The table (event_id, ts, user_id, event_type, value, props) is reshaped into
all five kinds of message, with the irregular cases on purpose: repeated starts
and ends, schemas redefined, value tables before their schema, fields outside
the schema, and wrong tags. ``user_id % 16`` makes the segments.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from tracelake.functions.values import value_sql
from tracelake.sources.emit import (
    emit_end,
    emit_events,
    emit_schemas,
    emit_start,
    emit_value_tables,
    union_log,
)

SEGMENT = "'00000000-0000-7000-8000-' || lpad(CAST(k AS STRING), 12, '0') AS segment_id"
SOURCE = "'src' || CAST(k % 4 AS STRING) AS source_name"
STATES = ((0, "IDLE"), (1, "INIT"), (2, "RUNNING"), (3, "ERROR"))


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events with segment, source and nanosecond time."""
    return (
        spark.read.parquet(f"{sf_dir}/events.parquet")
        .selectExpr(
            "*",
            "user_id % 16 AS k",
            "timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts) * 1000 AS time_ns",
        )
        .selectExpr("*", SEGMENT, SOURCE)
    )


def _cases(rows: DataFrame, *cases: str) -> DataFrame:
    """One output row per non-null struct among ``cases``."""
    return rows.selectExpr("k", f"inline(filter(array({', '.join(cases)}), x -> x IS NOT NULL))")


def start_messages(events: DataFrame) -> DataFrame:
    def start(holds: str, seq: str, time_ns: str, source: str) -> str:
        return (
            f"CASE WHEN {holds} THEN named_struct('seq', {seq}, 'time_ns', {time_ns}, "
            f"'source_name', 'src' || {source}) END"
        )

    first = events.groupBy("k").agg({"time_ns": "min"}).toDF("k", "lo")
    own = "CAST(k % 4 AS STRING)"
    rows = _cases(
        first,
        start("k % 8 <> 5", "k", "lo", own),
        start("k % 4 = 0", "k + 100", "lo - 1000000000", f"{own} || 'b'"),
        start("k = 8", "k + 200", "lo + 7", "'0c'"),
    )
    return emit_start(rows.selectExpr("*", SEGMENT))


def end_messages(events: DataFrame) -> DataFrame:
    def end(holds: str, seq: str, time_ns: str) -> str:
        return f"CASE WHEN {holds} THEN named_struct('seq', {seq}, 'time_ns', {time_ns}) END"

    last = events.groupBy("k").agg({"time_ns": "max"}).toDF("k", "hi")
    rows = _cases(
        last,
        end("k % 8 <> 7", "k + 1000000000", "hi"),
        end("k % 5 = 0", "k + 1000000100", "hi - 5000000000"),
    )
    return emit_end(rows.selectExpr("*", SEGMENT, SOURCE))


def _definition(name: str, data_type: str, unit: str = "NULL") -> str:
    return (
        f"named_struct('name', '{name}', 'data_type', '{data_type}', 'unit', "
        f"CAST({unit} AS STRING))"
    )


def schema_messages(events: DataFrame) -> DataFrame:
    names = "array('click', 'error', 'purchase', 'signup', 'view')"
    fields = ", ".join(
        (
            _definition("value", "float64", "'USD'"),
            _definition("user_id", "int64"),
            _definition("state", "uint8"),
        )
    )
    first = (
        events.select("k", "event_type")
        .distinct()
        .where("k <> 13 OR event_type <> 'signup'")
        .selectExpr(
            "k",
            "event_type AS event_name",
            f"299 + k * 5 + array_position({names}, event_type) AS seq",
            f"array({fields}) AS fields",
        )
    )
    again = (
        events.select("k")
        .distinct()
        .where("k % 2 = 0")
        .selectExpr(
            "k",
            "'view' AS event_name",
            "k + 400 AS seq",
            f"array({_definition('value', 'float32', repr('EUR'))}) AS fields",
        )
    )
    return emit_schemas(first.unionByName(again).selectExpr("*", SEGMENT, SOURCE))


def _table(*entries: tuple[str, object, str]) -> str:
    return ", ".join(
        f"named_struct('value', {value_sql(kind, repr(key))}, 'label', '{label}')"
        for kind, key, label in entries
    )


def value_table_messages(events: DataFrame) -> DataFrame:
    def message(holds: str, seq: str, event: str, name: str, entries: str) -> str:
        return (
            f"CASE WHEN {holds} THEN named_struct('seq', {seq}, 'event_name', '{event}', "
            f"'field_name', '{name}', 'values', array({entries})) END"
        )

    states = _table(*[("uint8", key, label) for key, label in STATES])
    failed = _table(("uint8", 3, "FAULT"), ("uint8", 3, "FAILED"))
    rows = _cases(
        events.select("k").distinct(),
        message("true", "k + 250", "error", "state", _table(("uint8", 9, "LOST"))),
        message("true", "k + 500", "error", "state", states),
        message("true", "k + 520", "view", "state", states),
        message("k % 3 = 0", "k + 600", "error", "state", failed),
        message("k = 4", "k + 616", "view", "state", _table(("string", "x", "TEXT"))),
        message("k = 2", "k + 638", "view", "nope", _table(("uint8", 0, "Z"))),
        message("k = 6", "k + 654", "click", "value", _table(("string", "a", "A"))),
    )
    return emit_value_tables(rows.selectExpr("*", SEGMENT, SOURCE))


def event_messages(events: DataFrame) -> DataFrame:
    def entry(name: str, value: str) -> str:
        return f"named_struct('name', '{name}', 'value', {value})"

    odd = "event_type = 'error' AND event_id % 10 = 0"
    state = value_sql("uint8", "event_id % 4").replace(
        "'tag', 'uint8'", f"'tag', CASE WHEN {odd} THEN 'int16' ELSE 'uint8' END"
    )
    always = ", ".join(
        (
            entry("value", value_sql("float64", "value")),
            entry("user_id", value_sql("int64", "user_id")),
            entry("state", state),
        )
    )
    extra = entry("k", value_sql("int64", "get_json_object(props, '$.k')"))
    rows = events.selectExpr(
        "event_id * 10 + 10000 AS seq",
        "segment_id",
        "source_name",
        "time_ns",
        "event_type AS event_name",
        f"IF(event_type = 'purchase', array({always}, {extra}), array({always})) AS fields",
    )
    return emit_events(rows)


@lru_cache(maxsize=4)
def sample_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole log. Each kind is a branch of its own, so a filter on ``kind``
    removes the branches it does not need from the plan.

    Only the plan is remembered between calls, no data.
    """
    events = read_events(spark, sf_dir)
    return union_log(
        start_messages(events),
        schema_messages(events),
        value_table_messages(events),
        event_messages(events),
        end_messages(events),
    )
