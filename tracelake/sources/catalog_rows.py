"""Signals read back from stored catalog rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.functions.identifiers import UUID_PATTERN, normalize_uuid
from tracelake.functions.types import type_from_duckdb


def signals_from_rows(rows: DataFrame) -> DataFrame:
    """Rows of (data_segment_id, source, message, signal, unit, data_type) as signals.

    ``data_type`` holds a DuckDB type name. A bad id or type gives ``error``.
    """
    bad_id = ~F.coalesce(F.col("data_segment_id").rlike(UUID_PATTERN), F.lit(False))
    data_type = type_from_duckdb(F.col("data_type"))
    error = F.when(bad_id, F.lit("invalid_uuid")).when(data_type.isNull(), F.lit("unknown_type"))
    return rows.withColumns(
        {
            "data_segment_id": normalize_uuid(F.col("data_segment_id")),
            "data_type": data_type,
            "error": error,
        }
    )
