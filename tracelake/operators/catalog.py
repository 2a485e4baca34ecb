"""The metadata catalog folded out of the log (M1-M9) and its flat views (K4).

Every rule is a minimum, maximum or arg-min/max by ``seq``. That makes the fold
order-free over rows and mergeable: a :class:`FoldState` of one part of the log
merged with that of another is the state of both, which is all the streaming
job needs. Control messages are few next to events; every aggregate here has a
map-side part, so a segment that owns most of the log is no hot spot.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelake.functions.values import as_number, canonical_key
from tracelake.model import (
    CONTROL_KINDS,
    EVENT,
    EVENT_SCHEMA,
    LOG_COLUMNS,
    NAMED_VALUES,
    PAYLOAD_DDL,
    SEGMENT_END,
    SEGMENT_START,
)
from tracelake.plans.joins import lookup_join


@dataclass(frozen=True)
class FoldState:
    """Mergeable partial results of the fold, one table per kind of key."""

    segments: DataFrame
    schemas: DataFrame
    values: DataFrame


@dataclass(frozen=True)
class Catalog:
    """The folded catalog.

    ``segments``: segment_id, source, start_time_ns, end_time_ns (+ the seqs
    that decided); ``event_schemas``: segment_id, event_name, schema_seq,
    fields; ``event_fields``: one row per field; ``value_tables``: one row per
    kept key of a field's value table.
    """

    segments: DataFrame
    event_schemas: DataFrame
    event_fields: DataFrame
    value_tables: DataFrame


SEGMENT_STATE_DDL = (
    "segment_id STRING, start_time_ns BIGINT, start_seq BIGINT, start_source STRING, "
    "first_seq BIGINT, first_source STRING, end_seq BIGINT, end_time_ns BIGINT, last_seq BIGINT"
)
SCHEMA_STATE_DDL = (
    "segment_id STRING, event_name STRING, schema_seq BIGINT, "
    "fields ARRAY<STRUCT<name: STRING, data_type: STRING, unit: STRING>>"
)


def _best_by(order: str, *columns: str, latest: bool) -> list[Column]:
    """``order`` and ``columns`` of the row where ``order`` is extreme."""
    pick = F.max_by if latest else F.min_by
    edge = F.max if latest else F.min
    return [edge(order).alias(order)] + [pick(c, order).alias(c) for c in columns]


def _merge_segments(rows: DataFrame) -> DataFrame:
    return rows.groupBy("segment_id").agg(
        F.min("start_time_ns").alias("start_time_ns"),
        *_best_by("start_seq", "start_source", latest=True),
        *_best_by("first_seq", "first_source", latest=False),
        *_best_by("end_seq", "end_time_ns", latest=True),
        F.max("last_seq").alias("last_seq"),
    )


def _merge_schemas(rows: DataFrame) -> DataFrame:
    return rows.groupBy("segment_id", "event_name").agg(
        *_best_by("schema_seq", "fields", latest=False)
    )


def _merge_values(rows: DataFrame) -> DataFrame:
    order = F.struct("seq", "pos")
    return (
        rows.groupBy("segment_id", "event_name", "field_name", "tag", "key")
        .agg(F.max_by(F.struct("seq", "pos", "value", "label"), order).alias("w"))
        .select("segment_id", "event_name", "field_name", "tag", "key", "w.*")
    )


def fold_state(log: DataFrame, mode: str = "update") -> FoldState:
    """Partial fold of any part of a log.

    ``mode="update"``: only control messages create segments. ``mode="from"``:
    any message does (M6).
    """
    if mode not in ("update", "from"):
        raise ValueError(f"mode must be 'update' or 'from', not {mode!r}")
    control = log.where(F.col("kind").isin(*CONTROL_KINDS))
    is_start = F.col("kind") == SEGMENT_START
    is_end = F.col("kind") == SEGMENT_END
    rows = control.select(
        "segment_id",
        F.when(is_start, F.col("segment_start.time_ns")).alias("start_time_ns"),
        F.when(is_start, F.col("seq")).alias("start_seq"),
        F.when(is_start, F.col("segment_start.source_name")).alias("start_source"),
        F.col("seq").alias("first_seq"),
        F.col("source_name").alias("first_source"),
        F.when(is_end, F.col("seq")).alias("end_seq"),
        F.when(is_end, F.col("segment_end.time_ns")).alias("end_time_ns"),
        F.col("seq").alias("last_seq"),
    )
    if mode == "from":
        # Events matter only by the first envelope of their segment. Reducing
        # them on (segment, source) first keeps this a hash aggregate on longs.
        seen = (
            log.where(F.col("kind") == EVENT)
            .groupBy("segment_id", "source_name")
            .agg(F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"))
        )
        rows = rows.unionByName(
            seen.withColumnRenamed("source_name", "first_source"), allowMissingColumns=True
        )

    schemas = log.where(F.col("kind") == EVENT_SCHEMA).select(
        "segment_id",
        F.col("event_schema.name").alias("event_name"),
        F.col("seq").alias("schema_seq"),
        F.col("event_schema.fields").alias("fields"),
    )
    values = (
        log.where(F.col("kind") == NAMED_VALUES)
        .select(
            "segment_id",
            F.col("named_values.event_name").alias("event_name"),
            F.col("named_values.field_name").alias("field_name"),
            "seq",
            F.posexplode("named_values.values").alias("pos", "entry"),
        )
        .select(
            "segment_id",
            "event_name",
            "field_name",
            F.col("entry.value.tag").alias("tag"),
            canonical_key(F.col("entry.value")).alias("key"),
            "seq",
            "pos",
            F.col("entry.value").alias("value"),
            F.col("entry.label").alias("label"),
        )
    )
    return FoldState(_merge_segments(rows), _merge_schemas(schemas), _merge_values(values))


def merge_states(first: FoldState, second: FoldState) -> FoldState:
    """State of two disjoint parts of a log together; order does not matter."""
    return FoldState(
        _merge_segments(first.segments.unionByName(second.segments)),
        _merge_schemas(first.schemas.unionByName(second.schemas)),
        _merge_values(first.values.unionByName(second.values)),
    )


def merge_rows(state: FoldState) -> FoldState:
    """Collapse state tables that hold several partial rows per key."""
    return FoldState(
        _merge_segments(state.segments), _merge_schemas(state.schemas), _merge_values(state.values)
    )


def explode_fields(event_schemas: DataFrame) -> DataFrame:
    """One row per schema field; ``is_first`` marks the one a lookup by name finds."""
    names = F.transform("fields", lambda x: x["name"])
    return event_schemas.select(
        "segment_id",
        "event_name",
        "schema_seq",
        names.alias("_names"),
        F.posexplode("fields").alias("field_pos", "f"),
    ).select(
        "segment_id",
        "event_name",
        "schema_seq",
        F.col("field_pos").cast("bigint").alias("field_pos"),
        F.col("f.name").alias("field_name"),
        F.col("f.data_type").alias("data_type"),
        F.col("f.unit").alias("unit"),
        (F.array_position("_names", F.col("f.name")) == F.col("field_pos") + 1).alias("is_first"),
    )


def state_to_catalog(state: FoldState) -> Catalog:
    segments = state.segments.select(
        "segment_id",
        F.coalesce("start_source", "first_source").alias("source"),
        "start_time_ns",
        "end_time_ns",
        "start_seq",
        "end_seq",
        "first_seq",
    )
    # A key survives if its schema had arrived before. The last write of a key
    # decides: if even that came before the schema, all of them did.
    fields = explode_fields(state.schemas)
    owner = fields.where("is_first").select(
        "segment_id", "event_name", "field_name", "schema_seq", "field_pos"
    )
    value_tables = (
        state.values.join(owner, ["segment_id", "event_name", "field_name"])
        .where(F.col("seq") > F.col("schema_seq"))
        .drop("schema_seq")
    )
    return Catalog(segments, state.schemas, fields, value_tables)


def fold(log: DataFrame, mode: str = "update", tombstones: DataFrame | None = None) -> Catalog:
    """Fold a log into its catalog (M1-M6, M9); with removals, M7."""
    if tombstones is not None:
        log = drop_removed(log, tombstones)
    return state_to_catalog(fold_state(log, mode))


def drop_removed(log: DataFrame, tombstones: DataFrame) -> DataFrame:
    """Messages that arrived after the last removal of their segment (M7).

    ``tombstones`` has (segment_id, seq).
    """
    last = tombstones.groupBy("segment_id").agg(F.max("seq").alias("removed_seq"))
    return (
        lookup_join(log, last, ["segment_id"], "left")
        .where(F.col("removed_seq").isNull() | (F.col("seq") > F.col("removed_seq")))
        .drop("removed_seq")
    )


def snapshot(catalog: Catalog, table_entries: int | None = None) -> DataFrame:
    """The minimal control log that rebuilds the catalog (M8).

    Rows keep the ``seq`` of the message that decided them, so a snapshot up to
    ``s`` and the live log after ``s`` never clash. The delivery order inside a
    segment is (``phase``, ``event_name``, ``field_pos``): start, then each
    schema followed by its value tables, then end.

    A value table is one message, gathered in one task as its shape demands: all
    entries that one field has. With ``table_entries`` a larger table is spread
    over several messages that fold back to it; ``part_no`` tells them apart, as
    they may share the ``seq`` of one message, and comes last in the order.
    """
    source = catalog.segments.select("segment_id", F.col("source").alias("source_name"))
    start = catalog.segments.where(F.col("start_time_ns").isNotNull()).select(
        F.col("start_seq").alias("seq"),
        "segment_id",
        F.col("source").alias("source_name"),
        F.lit(SEGMENT_START).alias("kind"),
        F.struct(
            F.col("start_time_ns").alias("time_ns"), F.col("source").alias("source_name")
        ).alias(SEGMENT_START),
        F.lit(0).alias("phase"),
        F.lit("").alias("event_name"),
        F.lit(-1).cast("bigint").alias("field_pos"),
    )
    end = catalog.segments.where(F.col("end_time_ns").isNotNull()).select(
        F.col("end_seq").alias("seq"),
        "segment_id",
        F.col("source").alias("source_name"),
        F.lit(SEGMENT_END).alias("kind"),
        F.struct(F.col("end_time_ns").alias("time_ns")).alias(SEGMENT_END),
        F.lit(2).alias("phase"),
        F.lit("").alias("event_name"),
        F.lit(-1).cast("bigint").alias("field_pos"),
    )
    schema = catalog.event_schemas.join(source, "segment_id").select(
        F.col("schema_seq").alias("seq"),
        "segment_id",
        "source_name",
        F.lit(EVENT_SCHEMA).alias("kind"),
        F.struct(F.col("event_name").alias("name"), "fields").alias(EVENT_SCHEMA),
        F.lit(1).alias("phase"),
        "event_name",
        F.lit(-1).cast("bigint").alias("field_pos"),
    )
    entry = F.struct("seq", "pos", "value", "label")
    owner = ["segment_id", "event_name", "field_name", "field_pos"]
    tables = catalog.value_tables.withColumn("part_no", F.lit(0).cast("bigint"))
    if table_entries is not None:
        sizes = catalog.value_tables.groupBy(*owner).agg(
            F.ceil(F.count(F.lit(1)) / table_entries).alias("_messages")
        )
        tables = catalog.value_tables.join(sizes, owner).withColumn(
            "part_no", F.pmod(F.xxhash64("tag", "key"), F.col("_messages"))
        )
    named = (
        tables.groupBy(*owner, "part_no")
        .agg(F.max("seq").alias("seq"), F.sort_array(F.collect_list(entry)).alias("entries"))
        .join(source, "segment_id")
        .select(
            "seq",
            "segment_id",
            "source_name",
            F.lit(NAMED_VALUES).alias("kind"),
            F.struct(
                "event_name",
                "field_name",
                F.transform(
                    "entries",
                    lambda e: F.struct(e["value"].alias("value"), e["label"].alias("label")),
                ).alias("values"),
            ).alias(NAMED_VALUES),
            F.lit(1).alias("phase"),
            "event_name",
            "field_pos",
            "part_no",
        )
    )
    rows = None
    for part in (start, schema, named, end):
        missing = {
            k: F.lit(None).cast(PAYLOAD_DDL[k]) for k in PAYLOAD_DDL if k not in part.columns
        }
        order = ["phase", "event_name", "field_pos"]
        if table_entries is not None:
            order.append("part_no")
            missing.setdefault("part_no", F.lit(0).cast("bigint"))
            missing = {k: v for k, v in missing.items() if k not in part.columns}
        part = part.withColumns(missing).select(*LOG_COLUMNS, *order)
        rows = part if rows is None else rows.unionByName(part)
    return rows


def signals(catalog: Catalog) -> DataFrame:
    """Every field of every event as a flat signal (K4).

    ``has_value_table`` is false when the field has no named values at all;
    a table whose keys are all non-integers is present with zero entries. The
    entries are in :func:`signal_values`.
    """
    keys = ["segment_id", "event_name", "field_pos"]
    tables = catalog.value_tables.groupBy(*keys).agg(
        F.countDistinct(as_number(F.col("value"))).alias("n_values")
    )
    source = catalog.segments.select("segment_id", "source")
    return (
        catalog.event_fields.join(tables, keys, "left")
        .join(source, "segment_id")
        .select(
            F.col("segment_id").alias("data_segment_id"),
            "source",
            F.col("event_name").alias("message"),
            F.col("field_name").alias("signal"),
            "data_type",
            "unit",
            F.col("n_values").isNotNull().alias("has_value_table"),
            F.coalesce("n_values", F.lit(0)).alias("n_values"),
            "field_pos",
            "is_first",
        )
    )


def signal_values(catalog: Catalog) -> DataFrame:
    """Integer-keyed entries of the signals' value tables, one per number.

    Two keys of different integer types with one number: the last write stays.
    """
    return (
        catalog.value_tables.withColumn("number", as_number(F.col("value")))
        .where(F.col("number").isNotNull())
        .groupBy("segment_id", "event_name", "field_pos", "field_name", "number")
        .agg(F.max_by("label", F.struct("seq", "pos")).alias("label"))
    )
