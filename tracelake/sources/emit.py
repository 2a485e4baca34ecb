"""Raw records to log rows: the publishing interface as append jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.model import (
    EVENT,
    EVENT_SCHEMA,
    LOG_COLUMNS,
    NAMED_VALUES,
    PAYLOAD_DDL,
    SEGMENT_END,
    SEGMENT_START,
)
from tracelake.operators.conformance import dedupe_schema_fields


def _message(rows: DataFrame, kind: str, payload: str) -> DataFrame:
    """Rows in the log's layout; ``payload`` is the SQL of the kind's struct."""
    slots = [
        f"CAST({payload if k == kind else 'NULL'} AS {ddl}) AS {k}"
        for k, ddl in PAYLOAD_DDL.items()
    ]
    return rows.selectExpr(
        "CAST(seq AS BIGINT) AS seq", "segment_id", "source_name", f"'{kind}' AS kind", *slots
    )


def _time(rows: DataFrame) -> str:
    now = "unix_micros(current_timestamp()) * 1000"
    return f"coalesce(time_ns, {now})" if "time_ns" in rows.columns else now


def emit_start(rows: DataFrame) -> DataFrame:
    """Start messages from (seq, segment_id, source_name[, time_ns])."""
    body = f"named_struct('time_ns', {_time(rows)}, 'source_name', source_name)"
    return _message(rows, SEGMENT_START, body)


def emit_end(rows: DataFrame) -> DataFrame:
    """End messages from (seq, segment_id, source_name[, time_ns])."""
    return _message(rows, SEGMENT_END, f"named_struct('time_ns', {_time(rows)})")


def emit_schemas(rows: DataFrame) -> DataFrame:
    """Schema messages from (seq, segment_id, source_name, event_name, fields).

    A field defined twice keeps its last definition, as in the schema builder.
    """
    rows = rows.withColumn("fields", dedupe_schema_fields(F.col("fields")))
    return _message(rows, EVENT_SCHEMA, "named_struct('name', event_name, 'fields', fields)")


def emit_value_tables(rows: DataFrame) -> DataFrame:
    """Value tables from (seq, segment_id, source_name, event_name, field_name, values)."""
    body = "named_struct('event_name', event_name, 'field_name', field_name, 'values', `values`)"
    return _message(rows, NAMED_VALUES, body)


def emit_events(rows: DataFrame) -> DataFrame:
    """Events from (seq, segment_id, source_name, event_name, fields[, time_ns]).

    A missing time is the time of the job.
    """
    body = f"named_struct('time_ns', {_time(rows)}, 'name', event_name, 'fields', fields)"
    return _message(rows, EVENT, body)


def union_log(*parts: DataFrame) -> DataFrame:
    """Message tables of several kinds as one log."""
    rows = parts[0].select(*LOG_COLUMNS)
    for part in parts[1:]:
        rows = rows.unionByName(part.select(*LOG_COLUMNS))
    return rows
