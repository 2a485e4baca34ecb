"""Values of signals over time.

Events are never shuffled to meet the catalog: the catalog side is measured and
broadcast when it is small, salted otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.functions.identifiers import key_string
from tracelake.functions.values import as_type, canonical_key, last_per_name, render, value_of
from tracelake.model import EVENT
from tracelake.operators.catalog import Catalog
from tracelake.plans.joins import lookup_join, settle


def explode_events(log: DataFrame, field_names: Sequence[str] | None = None) -> DataFrame:
    """One row per field of every event; the last entry of a repeated name counts."""
    fields = F.col("event.fields")
    if field_names is not None:
        fields = F.filter(fields, lambda x: x["name"].isin(*field_names))
    return (
        log.where(F.col("kind") == EVENT)
        .select(
            "seq",
            "segment_id",
            F.col("source_name").alias("source"),
            F.col("event.time_ns").alias("time_ns"),
            F.col("event.name").alias("message"),
            F.explode(last_per_name(fields)).alias("f"),
        )
        .select(
            "seq", "segment_id", "source", "time_ns", "message",
            F.col("f.name").alias("signal"), F.col("f.value").alias("value"),
        )
    )


SIGNAL = ["segment_id", "source", "message", "signal"]


def latest_samples(log: DataFrame) -> DataFrame:
    """The sample of each signal that is last by (time_ns, seq); no time is the lowest.

    First the winning (time, seq) per signal, from names and times only and
    with a hash aggregate on one number; then the values of just the winning
    events. Taking the arg-max of the values directly would sort every sample.
    """
    # (time_ns, seq) as one number: seq is below 10**19, and 38 digits hold both
    wide = "decimal(38,0)"
    shift = F.lit(str(10**19)).cast("decimal(20,0)")
    time = F.coalesce("time_ns", F.lit(-(2**63)))
    rank = (time.cast("decimal(19,0)") * shift).cast(wide) + F.col("seq").cast(wide)
    signal = F.struct(*SIGNAL).alias("_signal")
    events = log.where(F.col("kind") == EVENT)
    names = events.select(
        "seq",
        "segment_id",
        F.col("source_name").alias("source"),
        F.col("event.time_ns").alias("time_ns"),
        F.col("event.name").alias("message"),
        F.explode(F.array_distinct(F.col("event.fields.name"))).alias("signal"),
    )
    winners = (
        names.groupBy(*SIGNAL)
        .agg(F.max(rank.cast(wide)).alias("rank"))
        # one column, in which null names are names like others
        .select(signal, F.pmod("rank", shift.cast(wide)).cast("bigint").alias("seq"))
    )
    side = settle(winners)
    picked = lookup_join(events, side.df.select("seq").distinct(), ["seq"], "left_semi", unique=True)
    return lookup_join(explode_events(picked).select("*", signal), side, ["_signal", "seq"]).drop("_signal")


def latest_values(log: DataFrame) -> DataFrame:
    """Latest value of each signal as text, by (time_ns, seq)."""
    return latest_samples(log).select(
        *SIGNAL,
        "time_ns",
        key_string(*[F.col(k) for k in SIGNAL]).alias("full_name"),
        render(F.col("value")).alias("value"),
    )


def decode_values(
    log: DataFrame, catalog: Catalog, field_names: Sequence[str] | None = None
) -> DataFrame:
    """Field values with their label from the value tables, where there is one."""
    samples = explode_events(log, field_names).withColumns(
        {"tag": F.col("value.tag"), "key": canonical_key(F.col("value"))}
    )
    labels = catalog.value_tables.select(
        "segment_id",
        F.col("event_name").alias("message"),
        F.col("field_name").alias("signal"),
        "tag",
        "key",
        "label",
    )
    return lookup_join(samples, labels, ["segment_id", "message", "signal", "tag", "key"], "left")


def message_columns(catalog: Catalog, message: str, segment_id: str | None = None):
    """``[(field, data_type)]`` of a message, in field order, for :func:`wide_events`.

    The result has one entry per column of the wide table. Without a segment,
    a field declared with different types in different segments is refused.
    """
    fields = catalog.event_fields.where((F.col("event_name") == message) & F.col("is_first"))
    if segment_id is not None:
        fields = fields.where(F.col("segment_id") == segment_id)
    found = (
        fields.groupBy("field_name")
        .agg(
            F.min("field_pos").alias("pos"),
            F.min("data_type").alias("low"),
            F.max("data_type").alias("high"),
        )
        .orderBy("pos", "field_name")
        .collect()
    )
    mixed = [r["field_name"] for r in found if r["low"] != r["high"]]
    if mixed:
        raise ValueError(f"fields with several types, pass a segment_id: {mixed}")
    return [(r["field_name"], r["low"]) for r in found]


def wide_events(log: DataFrame, message: str, columns: Sequence[tuple[str, str]]) -> DataFrame:
    """The stored table of a message: one typed column per signal.

    A missing field, or one whose tag is not the declared type, is null.
    """
    events = log.where((F.col("kind") == EVENT) & (F.col("event.name") == message))
    return events.select(
        "seq",
        "segment_id",
        F.col("source_name").alias("source"),
        F.col("event.time_ns").alias("time_ns"),
        *[
            as_type(value_of(F.col("event.fields"), F.lit(name)), data_type).alias(name)
            for name, data_type in columns
        ],
    )


WIDE_KEYS = ("segment_id", "source", "message")


def wide_columns(catalog: Catalog) -> list[tuple[str, str, str]]:
    """``[(column, field, data_type)]`` of all messages, for :func:`wide_tables`.

    A column for each field and type declared anywhere, so their number is bounded by
    the declarations and not by the events. It is named after the field; where another
    type, a key or a name that differs in case has that name, the type follows.
    """
    found = (
        catalog.event_fields.where("is_first")
        .select("field_name", "data_type").distinct()
        .orderBy("field_name", "data_type").collect()
    )
    plain = [r["field_name"].lower() for r in found] + ["seq", "time_ns", *WIDE_KEYS]
    taken = {name for name in plain if plain.count(name) > 1 or name in ("seq", "time_ns", *WIDE_KEYS)}
    columns = []
    for field, data_type in found:
        column = field
        while column.lower() in taken:
            column += f":{data_type}"
        taken.add(column.lower())
        columns.append((column, field, data_type))
    return columns


def wide_tables(
    log: DataFrame, catalog: Catalog, columns: Sequence[tuple[str, str, str]] | None = None
) -> DataFrame:
    """The stored tables of all messages in one pass over the events.

    ``seq, time_ns``, the keys of the table, and the columns of :func:`wide_columns`. A
    row fills those its own segment declares for its message, with a value whose tag is
    the declared type; the others are null. Fields with several types in several
    segments are kept apart. A message without a schema has no table.
    """
    if columns is None:
        columns = wide_columns(catalog)
    declared = (
        catalog.event_fields.where("is_first")
        .groupBy("segment_id", F.col("event_name").alias("message"))
        .agg(F.map_from_entries(F.collect_list(F.struct("field_name", "data_type"))).alias("_types"))
    )
    events = log.where(F.col("kind") == EVENT).select(
        "seq", "segment_id",
        F.col("source_name").alias("source"),
        F.col("event.time_ns").alias("time_ns"),
        F.col("event.name").alias("message"),
        F.col("event.fields").alias("_fields"),
    )
    return lookup_join(events, declared, ["segment_id", "message"]).select(
        "seq", "time_ns", *WIDE_KEYS,
        *[
            F.when(
                F.try_element_at("_types", F.lit(field)) == data_type,
                as_type(value_of(F.col("_fields"), F.lit(field)), data_type),
            ).alias(column)
            for column, field, data_type in columns
        ],
    )


def write_wide_tables(wide: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Store :func:`wide_tables` partitioned by segment, source and message.

    The rows of a table are brought together before; a table too large for one task is
    split and small ones share a task, by the sizes seen at run time. An empty name is
    read back as null.
    """
    together = wide.hint("rebalance", *[F.col(key) for key in WIDE_KEYS])
    together.write.partitionBy(*WIDE_KEYS).parquet(path, mode=mode)


def signal_samples(log: DataFrame, resolved: DataFrame) -> DataFrame:
    """Samples of resolved signals: (key_string, time_ns, value) (C4).

    The join is per event, so only the wanted fields are ever unpacked.
    """
    wanted = resolved.select(
        F.col("data_segment_id").alias("segment_id"),
        "source",
        F.col("message").alias("_message"),
        "signal",
        "data_type",
    )
    events = log.where(F.col("kind") == EVENT).select(
        "seq",
        "segment_id",
        F.col("event.time_ns").alias("time_ns"),
        F.col("event.name").alias("_message"),
        F.col("event.fields").alias("_fields"),
    )
    joined = lookup_join(events, wanted, ["segment_id", "_message"])
    return (
        joined.withColumn("value", value_of(F.col("_fields"), F.col("signal")))
        .where(F.col("value").isNotNull())
        .select(
            "seq",
            "time_ns",
            "segment_id",
            "source",
            F.col("_message").alias("message"),
            "signal",
            "data_type",
            key_string(
                F.col("segment_id"), F.col("source"), F.col("_message"), F.col("signal")
            ).alias("key_string"),
            "value",
        )
    )
