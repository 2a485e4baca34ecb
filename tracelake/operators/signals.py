"""Signal keys, their resolution, and the signal catalog as text (K1-K3, K5, K6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelake.functions.identifiers import (
    UUID_PATTERN,
    key_string,
    normalize_uuid,
    table_key,
    table_name,
)
from tracelake.operators.catalog import Catalog, signal_values, signals
from tracelake.plans.joins import lookup_join, settle

# The text form of a signal key, segment-or-* / source / message . signal
KEY_PATTERN = r"\A([*\w-]+)/([^/.]+)/([^.]+)\.([^\n]+)\z"


def parse_keys(texts: DataFrame, column: str = "signal_key") -> DataFrame:
    """Add segment_id, source, message, signal and ``error`` of key texts (K1).

    Only the segment can be a wildcard (null). The pattern is tested once; in
    a text that fits, plain cuts at the first separators find the same parts.
    """
    text = F.col(column)
    segment = F.substring_index(text, "/", 1)
    error = F.when(~F.coalesce(text.rlike(KEY_PATTERN), F.lit(False)), F.lit("not_a_key")).when(
        (segment != "*") & ~segment.rlike(UUID_PATTERN), F.lit("invalid_uuid")
    )
    pieces = F.split(text, "/", 3)
    tail = F.try_element_at(pieces, F.lit(3))
    message = F.substring_index(tail, ".", 1)
    good = F.col("error").isNull()
    parts = {
        "segment_id": F.when(segment != "*", normalize_uuid(segment)),
        "source": F.try_element_at(pieces, F.lit(2)),
        "message": message,
        "signal": F.substring(tail, F.length(message) + 2, F.length(tail)),
    }
    return texts.withColumn("error", error).select(
        *texts.columns, *[F.when(good, c).alias(name) for name, c in parts.items()], "error"
    )


def with_names(signal_rows: DataFrame) -> DataFrame:
    """Add the text keys of each signal (K5)."""
    where = (F.col("data_segment_id"), F.col("source"), F.col("message"))
    return signal_rows.withColumns(
        {
            "key_string": key_string(*where, F.col("signal")),
            "table_name": table_name(*where),
            "table_key": table_key(*where),
        }
    )


def resolve(signal_rows: DataFrame, keys: DataFrame) -> DataFrame:
    """Signals selected by parsed keys (K2, K3).

    One row per (key row, matching signal): a key listed twice counts twice,
    and columns of ``keys`` beyond the parts are carried along.
    """
    wanted = keys.where(F.col("error").isNull()).select(
        *[c for c in keys.columns if c not in ("segment_id", "error")],
        F.col("segment_id").alias("_key_segment"),
    )
    parts = ["source", "message", "signal"]
    found = signal_rows.where("is_first")

    def same_segment(left: DataFrame, right: DataFrame) -> Column:
        by_key, by_signal = (
            (left, right) if "_key_segment" in left.columns else (right, left)
        )
        return by_key["_key_segment"].isNull() | (
            by_key["_key_segment"] == by_signal["data_segment_id"]
        )

    side = settle(wanted)
    if side.broadcastable:
        joined = lookup_join(
            found, side, parts, spread_by="data_segment_id", residual=same_segment
        )
    else:
        # more keys than fit: then the catalog is the side worth measuring
        spread = side.df.withColumn("_spread", F.monotonically_increasing_id())
        joined = lookup_join(
            spread, found, parts, spread_by="_spread", residual=same_segment
        ).drop("_spread")
    return joined.drop("_key_segment")


def signal_json(catalog: Catalog) -> DataFrame:
    """The signal catalog with one JSON text per signal (K6).

    A missing unit or value table is left out of the text. The value table of
    one signal is one JSON object, hence the collected entries.
    """
    keys = ["segment_id", "event_name", "field_pos"]
    entries = (
        signal_values(catalog)
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_list(F.struct("number", "label"))).alias("entries"))
        .select(
            F.col("segment_id").alias("data_segment_id"),
            F.col("event_name").alias("message"),
            "field_pos",
            F.map_from_entries(
                F.transform(
                    "entries",
                    lambda e: F.struct(e["number"].cast("string").alias("k"), e["label"].alias("v")),
                )
            ).alias("entries"),
        )
    )
    joined = signals(catalog).join(entries, ["data_segment_id", "message", "field_pos"], "left")
    empty = F.create_map().cast("map<string,string>")
    table = F.when(F.col("has_value_table"), F.coalesce("entries", empty))
    doc = F.struct(
        "data_segment_id", "source", "message", "signal", "data_type", "unit",
        table.alias("value_table"),
    )
    return joined.select(
        "data_segment_id", "source", "message", "signal", "field_pos", F.to_json(doc).alias("json")
    )
