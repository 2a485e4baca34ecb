"""The registered queries: each operator over the log derived from ``events``.

Every query reads whole tables. Inputs an operator needs besides the log
(filters, commands, keys, batches) are derived from the same events where their
number should grow, and are short fixed lists where the log is what grows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.functions import json_values as J
from tracelake.functions.times import ns_remainder, ns_to_micros
from tracelake.functions.types import arrow_type, duckdb_type, is_numeric, spark_type
from tracelake.functions.values import (
    as_number,
    as_type,
    canonical_key,
    field,
    render,
    typed,
    value_struct,
)
from tracelake.model import (
    ALL_KINDS,
    EVENT,
    LOG_COLUMNS,
    LOG_DDL,
    PAYLOAD_DDL,
    VALUE_TYPES,
)
from tracelake.operators import batching, catalog, conformance, filters, samples, signals
from tracelake.operators import subscriptions as subs
from tracelake.operators.timed_batches import number_timed_batches
from tracelake.plans.joins import written
from tracelake.plans.sample_log import read_events, sample_log
from tracelake.sources import batches, wire
from tracelake.session import new_folder
from tracelake.sources.catalog_rows import signals_from_rows
from tracelake.streaming.catalog_stream import compact, read_catalog, start_catalog_stream
from tracelake.streaming.latest_stream import latest_now, start_latest
from tracelake.streaming.routing_stream import (
    delivered,
    late_delivered,
    start_late_subscriber,
    start_routing,
    start_subscriptions,
)
from tracelake.streaming.store import (
    start_ingest,
    start_store,
    stored_catalog,
    stored_log,
    stored_status,
)

# Fixed values of the query set.
LATE_AT = 60_000
REPLAY_FROM_NS = 1_705_276_800_000_000_000
REMOVED_AT = 450
BATCH_OF = 100
# Events of one file of a stream, about.
FILE_EVENTS = 250_000


def _big(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("bigint")


def _time_of_message() -> Column:
    return F.coalesce("segment_start.time_ns", "segment_end.time_ns", "event.time_ns")


def _name_of_message() -> Column:
    return F.coalesce("event_schema.name", "named_values.event_name", "event.name")


# --- catalog ---------------------------------------------------------------


def segments_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    folded = catalog.fold(sample_log(spark, sf_dir))
    return folded.segments.select("segment_id", "source", "start_time_ns", "end_time_ns")


def segments_fold_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fold in which any message makes a segment."""
    folded = catalog.fold(sample_log(spark, sf_dir), mode="from")
    return folded.segments.select(
        "segment_id", "source", "start_time_ns", "end_time_ns", "first_seq"
    )


def _removals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        read_events(spark, sf_dir)
        .where(F.col("k") % 3 == 0)
        .select("segment_id", F.lit(REMOVED_AT).cast("bigint").alias("seq"))
        .distinct()
    )


def remove_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    removals = _removals(spark, sf_dir)
    return _segments_with_schemas(catalog.fold(sample_log(spark, sf_dir), tombstones=removals))


def _segments_with_schemas(folded: catalog.Catalog) -> DataFrame:
    schemas = folded.event_schemas.groupBy("segment_id").agg(F.count("*").alias("n_schemas"))
    return folded.segments.join(schemas, "segment_id", "left").select(
        "segment_id", "source", "start_time_ns", "end_time_ns",
        F.coalesce("n_schemas", F.lit(0)).cast("bigint").alias("n_schemas"),
    )


def schemas_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    folded = catalog.fold(sample_log(spark, sf_dir))
    return folded.event_fields.select(
        "segment_id", "event_name", "schema_seq", "field_pos", "field_name", "data_type", "unit"
    )


def duplicate_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = sample_log(spark, sf_dir)
    return conformance.duplicate_schemas(log, catalog.fold(log)).select(
        "seq", "segment_id", "event_name", "schema_seq"
    )


def value_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    folded = catalog.fold(sample_log(spark, sf_dir))
    return folded.value_tables.select(
        "segment_id", "event_name", "field_name", "tag", "key", "label"
    )


def _signal_columns(folded: catalog.Catalog) -> DataFrame:
    return signals.with_names(catalog.signals(folded)).select(
        "key_string", "table_name", "table_key", "source", "message", "signal", "data_type",
        "unit", _big("has_value_table").alias("has_value_table"), "n_values",
    )


def signal_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _signal_columns(catalog.fold(sample_log(spark, sf_dir)))


def snapshot_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = catalog.snapshot(catalog.fold(sample_log(spark, sf_dir)))
    fields = F.transform(
        "event_schema.fields",
        lambda f: F.concat_ws(":", f["name"], f["data_type"], f["unit"]),
    )
    labels = F.transform(
        "named_values.values",
        lambda e: F.concat_ws(":", e["value"]["tag"], canonical_key(e["value"]), e["label"]),
    )
    return rows.select(
        "seq", "segment_id", "source_name", "kind", _big("phase").alias("phase"), "event_name",
        "field_pos", _time_of_message().alias("time_ns"),
        F.array_join(F.coalesce(fields, F.sort_array(labels)), ",").alias("content"),
    )


def snapshot_refold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signals of the catalog rebuilt from its own snapshot."""
    rows = catalog.snapshot(catalog.fold(sample_log(spark, sf_dir)))
    return _signal_columns(catalog.fold(rows.select(*LOG_COLUMNS)))


# --- signal keys -----------------------------------------------------------


def _key_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_events(spark, sf_dir)
    n = F.col("event_id")
    segment = (
        F.when(n % 3 == 0, F.lit("*"))
        .when(n % 3 == 1, F.col("segment_id"))
        .otherwise(F.upper(F.replace("segment_id", F.lit("-"), F.lit(""))))
    )
    wanted = F.element_at(
        F.array(*[F.lit(x) for x in ("value", "user_id", "state", "no.such")]),
        (n % 4 + 1).cast("int"),
    )
    text = F.concat(
        segment, F.lit("/"), F.col("source_name"), F.lit("/"), F.col("event_type"), F.lit("."),
        wanted,
    )
    broken = (
        F.when(n % 11 == 0, F.replace(text, F.lit("."), F.lit("/")))
        .when(n % 13 == 0, F.concat(F.lit("not-an-id"), F.substring_index(text, "/", -2)))
        .when(n % 17 == 0, F.concat(text, F.lit("\n")))
        .when(n % 19 == 0, F.concat(F.lit("zz/"), F.substring_index(text, "/", -2)))
        .otherwise(text)
    )
    return events.select("event_id", broken.alias("signal_key"))


def signal_key_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals.parse_keys(_key_texts(spark, sf_dir)).select(
        "event_id", "segment_id", "source", "message", "signal", "error"
    )


def signal_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = catalog.signals(catalog.fold(sample_log(spark, sf_dir)))
    keys = signals.parse_keys(_key_texts(spark, sf_dir)).drop("signal_key")
    return signals.with_names(signals.resolve(known, keys)).select(
        "event_id", "key_string", "data_type", "unit"
    )


def signal_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals.signal_json(catalog.fold(sample_log(spark, sf_dir))).drop("field_pos")


# --- filters and routing ---------------------------------------------------


def filter_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("event_id")
    segment = (
        F.when(n % 5 == 0, F.lit("*"))
        .when(n % 5 == 1, F.col("segment_id"))
        .when(n % 5 == 2, F.concat(F.lit("{"), F.col("segment_id"), F.lit("}")))
        .when(n % 5 == 3, F.concat(F.lit("urn:uuid:"), F.upper("segment_id")))
        .otherwise(F.replace("segment_id", F.lit("-"), F.lit("")))
    )
    source = F.when(n % 3 == 0, F.lit("*")).when(n % 3 == 1, F.col("source_name")).otherwise("")
    event = (
        F.when(n % 4 == 0, F.lit("*"))
        .when(n % 4 == 1, F.concat(F.col("event_type"), F.lit("/x")))
        .otherwise(F.col("event_type"))
    )
    text = (
        F.when(n % 7 == 0, F.concat_ws("/", segment, source))
        .when(n % 11 == 0, F.concat_ws("/", F.col("user_id").cast("string"), source, event))
        .when(n % 13 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat_ws("/", segment, source, event))
    )
    texts = read_events(spark, sf_dir).select("event_id", text.alias("filter"))
    return filters.parse_filters(texts).select(
        "event_id", "segment_id", "source_name", "event_name", "error"
    )


def _route_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filters of all eight shapes; most are derived from the data."""
    seen = read_events(spark, sf_dir).select("segment_id", "source_name", "event_type").distinct()
    none = F.lit(None).cast("string")
    shapes = {
        "all": (none, none, none),
        "source": (none, F.col("source_name"), none),
        "segment": (F.col("segment_id"), none, none),
        "segment_source": (F.col("segment_id"), F.col("source_name"), none),
        "event": (none, none, F.col("event_type")),
        "source_event": (none, F.col("source_name"), F.col("event_type")),
        "segment_event": (F.col("segment_id"), none, F.col("event_type")),
        "exact": (F.col("segment_id"), F.col("source_name"), F.col("event_type")),
    }
    rows = None
    for subscriber, parts in shapes.items():
        part = seen.select(
            F.lit(subscriber).alias("subscriber_id"),
            *[c.alias(n) for c, n in zip(parts, ("segment_id", "source_name", "event_name"))],
        ).distinct()
        if subscriber == "event":
            part = part.unionByName(part)  # each listed twice: delivered twice
        rows = part if rows is None else rows.unionByName(part)
    return rows


def filter_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = filters.route(sample_log(spark, sf_dir), _route_filters(spark, sf_dir))
    return routed.groupBy("subscriber_id", "segment_id", "kind").agg(
        F.count("*").alias("copies"), F.sum("seq").alias("sum_seq")
    )


def subscription_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a command of its user."""
    n = F.col("event_id")
    text = (
        F.when(n % 6 == 0, F.lit("*/*/*"))
        .when(n % 6 == 1, F.lit(None).cast("string"))
        .when(n % 6 == 2, F.lit("*/src1/*"))
        .when(n % 6 == 3, F.concat(F.lit("*/*/"), F.col("event_type")))
        .when(n % 6 == 4, F.concat(F.upper("segment_id"), F.lit("/src1/click")))
        .otherwise(F.lit("src1/click"))
    )
    commands = read_events(spark, sf_dir).select(
        F.col("user_id").cast("string").alias("subscriber_id"),
        (n * 10 + 10_000).alias("seq"),
        F.when(F.col("event_type").isin("error", "purchase"), F.lit("unsubscribe"))
        .otherwise(F.lit("subscribe"))
        .alias("action"),
        text.alias("filter"),
    )
    return subs.subscription_intervals(commands)


# Subscribe and unsubscribe commands of three subscribers.
COMMANDS = (
    ("A", 20_000, "subscribe", "*/src1/click"),
    ("B", 30_000, "subscribe", "*/src1/*"),
    ("B", 60_000, "unsubscribe", "*/src1/*"),
    ("C", 50_000, "subscribe", "*/*/*"),
)


COMMANDS_DDL = "subscriber_id string, seq bigint, action string, filter string"


def subscription_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    commands = spark.createDataFrame(COMMANDS, COMMANDS_DDL)
    return _per_subscriber(subs.route_subscriptions(sample_log(spark, sf_dir), commands))


def subscription_bursts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event is a moment's interest of its user in events like it, and one comes late."""
    n = F.col("event_id") * 10 + 10_000
    filter_text = F.concat(F.upper("segment_id"), F.lit("/*/"), F.col("event_type"))
    who = F.col("user_id").cast("string").alias("subscriber_id")
    events = read_events(spark, sf_dir)
    ons = events.select(who, (n + 1).alias("seq"), F.lit("subscribe").alias("action"), filter_text.alias("filter"))
    offs = events.select(who, (n + 705).alias("seq"), F.lit("unsubscribe").alias("action"), filter_text.alias("filter"))
    late = spark.createDataFrame([("late", 1_000_000_000, "subscribe", "*/*/*")], COMMANDS_DDL)
    commands = ons.unionByName(offs).unionByName(late)
    return _per_subscriber(subs.route_subscriptions(sample_log(spark, sf_dir), commands))


def _per_subscriber(routed: DataFrame) -> DataFrame:
    return routed.groupBy("subscriber_id", "segment_id", "kind").agg(
        F.count("*").alias("copies"), F.sum("seq").alias("sum_seq")
    )


def replay_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        subs.replay_from(sample_log(spark, sf_dir), REPLAY_FROM_NS)
        .groupBy("segment_id", "kind")
        .agg(F.count("*").alias("messages"), F.sum("seq").alias("sum_seq"))
    )


def _late_filters(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [("late", None, None, "error")],
        "subscriber_id string, segment_id string, source_name string, event_name string",
    )


def late_subscriber(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = _late_filters(spark)
    return _late_columns(subs.late_subscriber(sample_log(spark, sf_dir), LATE_AT, wanted))


def _late_columns(rows: DataFrame) -> DataFrame:
    return rows.select(
        _big("part").alias("part"), "seq", "segment_id", "source_name", "kind",
        _name_of_message().alias("name"), _time_of_message().alias("time_ns"),
    )


# --- samples ---------------------------------------------------------------


def latest_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples.latest_values(sample_log(spark, sf_dir)).select(
        "full_name", "message", "signal", "time_ns", "value"
    )


def decoded_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = sample_log(spark, sf_dir)
    return samples.decode_values(log, catalog.fold(log), ["state"]).select(
        "seq", "segment_id", "message", "tag", "key", "label"
    )


def wide_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = sample_log(spark, sf_dir)
    columns = samples.message_columns(catalog.fold(log), "error")
    return samples.wide_events(log, "error", columns).withColumn("state", _big("state"))


def wide_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = sample_log(spark, sf_dir)
    return samples.wide_tables(log, catalog.fold(log)).withColumn("state", _big("state"))


def signal_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = sample_log(spark, sf_dir)
    texts = spark.createDataFrame(
        [
            ("*/src1/click.value",),
            ("*/src2/error.state",),
            ("00000000-0000-7000-8000-000000000003/src3/view.user_id",),
            ("*/src1/click.value",),
            ("*/src0b/purchase.value",),
        ],
        "signal_key string",
    )
    keys = signals.parse_keys(texts).drop("signal_key")
    found = signals.resolve(catalog.signals(catalog.fold(log)), keys)
    return samples.signal_samples(log, found).select(
        "seq", "key_string", "time_ns", "data_type", render(F.col("value")).alias("value")
    )


# --- conformance -----------------------------------------------------------


def conformance_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = sample_log(spark, sf_dir)
    problems = conformance.rejected(conformance.check_events(log, catalog.fold(log)))
    return problems.groupBy("event_name", "field", "code", "expected", "found").agg(
        F.count("*").alias("n"), F.sum("seq").alias("sum_seq")
    )


def conforming_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = sample_log(spark, sf_dir)
    good = conformance.conforming(conformance.check_events(log, catalog.fold(log)))
    return good.select("seq", "segment_id", F.col("event.name").alias("event_name"))


def unregistered_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = sample_log(spark, sf_dir)
    return conformance.unregistered_events(log, catalog.fold(log)).select(
        "seq", "segment_id", F.col("event.name").alias("event_name")
    )


def schema_field_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    def definition(name: Column, data_type: str, unit: Column) -> Column:
        return F.struct(
            name.alias("name"), F.lit(data_type).alias("data_type"), unit.alias("unit")
        )

    defined = F.array(
        definition(F.lit("value"), "float64", F.lit("USD")),
        definition(F.col("event_type"), "int64", F.lit(None).cast("string")),
        definition(F.lit("click"), "uint8", F.col("source_name")),
        definition(
            F.when(F.col("event_id") % 3 == 0, F.lit("value")).otherwise(F.lit("other")),
            "float32",
            F.col("source_name"),
        ),
    )
    fields = conformance.dedupe_schema_fields(F.col("fields"))
    return (
        read_events(spark, sf_dir)
        .select("event_id", defined.alias("fields"))
        .select("event_id", F.posexplode(fields).alias("pos", "f"))
        .select("event_id", _big("pos").alias("pos"), "f.name", "f.data_type", "f.unit")
    )


# --- batches ---------------------------------------------------------------


def _wire_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of a hundred events per stream, some messages damaged."""
    n = F.col("event_id")
    state = (
        F.when(n % 29 == 0, value_struct(F.lit("int8"), i=F.lit(300)))
        .when(n % 31 == 0, value_struct(F.lit("uint8")))
        .when(n % 37 == 0, value_struct(F.lit(None)))
        .when(n % 41 == 0, value_struct(F.lit("uint16"), u=F.lit(65_535)))
        .when(n % 43 == 0, value_struct(F.lit("uint32"), u=F.lit(2**32)))
        .otherwise(value_struct(F.lit("uint8"), u=n % 4))
    )
    fields = F.array(field("state", state), field("value", typed("float64", F.col("value"))))
    event = F.struct("time_ns", F.col("event_type").alias("name"), fields.alias("fields"))
    schema = F.struct(
        F.col("event_type").alias("name"),
        F.array(
            F.struct(
                F.lit("state").alias("name"),
                F.when(n % 2 == 0, F.lit("uint8")).otherwise(F.lit("unspecified")).alias("data_type"),
                F.lit(None).cast("string").alias("unit"),
            )
        ).alias("fields"),
    )
    raw_id = F.unhex(F.replace("segment_id", F.lit("-"), F.lit("")))
    is_schema = n % 23 == 0
    kind = F.when(is_schema, F.lit("event_schema")).otherwise(F.lit(EVENT))
    columns = {
        "segment_id": F.when(n % 47 == 0, F.substring(raw_id, 1, 15)).otherwise(raw_id),
        "source_name": F.col("source_name"),
        "kind": F.when(n % 53 != 0, kind),
    }
    payload = {k: F.lit(None).cast(PAYLOAD_DDL[k]) for k in ALL_KINDS}
    payload["event"] = F.when(~is_schema, event).cast(PAYLOAD_DDL["event"])
    payload["event_schema"] = F.when(is_schema, schema).cast(PAYLOAD_DDL["event_schema"])
    message = F.struct(
        n.alias("at"), *[c.alias(k) for k, c in {**columns, **payload}.items()]
    )
    # arrival number of a batch: its block of events, then its stream
    block = F.call_function("div", n, F.lit(BATCH_OF).cast("bigint"))
    return (
        read_events(spark, sf_dir)
        .select(
            F.col("source_name").alias("stream_id"),
            (block * 4 + F.col("k") % 4).alias("batch_no"),
            message.alias("message"),
        )
        .groupBy("stream_id", "batch_no")
        .agg(F.sort_array(F.collect_list("message")).alias("messages"))
        .select(
            "stream_id",
            "batch_no",
            F.transform("messages", lambda m: m.dropFields("at")).alias("trace_messages"),
        )
    )


def _checked_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches.check_messages(batches.flatten_batches(_wire_batches(spark, sf_dir)))


def wire_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked_batches(spark, sf_dir).select(
        "stream_id", "batch_no", _big("pos").alias("pos"), "seq", "kind", "error"
    )


def ingest_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = batches.accepted(_checked_batches(spark, sf_dir))
    state = F.try_element_at("event.fields", F.lit(1))["value"]
    return log.select(
        "seq", "segment_id", "source_name", "kind", _time_of_message().alias("time_ns"),
        _name_of_message().alias("name"), state["tag"].alias("state_tag"),
        render(state).alias("state"),
    )


def publish_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = batches.publish_status(_checked_batches(spark, sf_dir))
    return status.select(
        "stream_id",
        *[_big(f"{c}_messages").alias(f"{c}_messages") for c in ("total", "successful", "failed")],
        "last_error",
    )


def undecodable_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status when every seventh batch cannot be decoded."""
    raw = _wire_batches(spark, sf_dir).withColumn(
        "decode_error", F.when(F.col("batch_no") % 7 == 3, F.lit("undecodable"))
    )
    status = batches.publish_status(batches.check_messages(batches.flatten_batches(raw)))
    return status.select(
        "stream_id",
        *[_big(f"{c}_messages").alias(f"{c}_messages") for c in ("total", "successful", "failed")],
        "last_error",
    )


def strict_publish_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches.strict_publish_status(_checked_batches(spark, sf_dir))


def publish_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbered = batching.number_batches(sample_log(spark, sf_dir), ["source_name"])
    return numbered.groupBy("source_name", "batch_no").agg(
        F.count("*").alias("messages"),
        F.min("seq").alias("first_seq"),
        F.max("seq").alias("last_seq"),
        F.sum(F.col("batch_pos") * F.col("seq")).alias("order_check"),
    )


def timed_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches per source that close after 50 messages or half a day."""
    numbered = number_timed_batches(
        sample_log(spark, sf_dir), ["source_name"], batch_size=50, timeout_ns=43_200_000_000_000
    )
    return numbered.groupBy("source_name", "batch_no").agg(
        F.count("*").alias("messages"),
        F.min("seq").alias("first_seq"),
        F.max("seq").alias("last_seq"),
        F.sum(F.col("batch_pos") * F.col("seq")).alias("order_check"),
    )


def subscriber_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = spark.createDataFrame(
        [
            ("clicks", 0, None, None, "click"),
            ("clicks", 1, None, "src1", None),
            ("everything", 0, None, None, None),
        ],
        "subscriber_id string, filter_no bigint, segment_id string, source_name string, "
        "event_name string",
    )
    packed = batching.responses(filters.route(sample_log(spark, sf_dir), wanted))
    unpacked = batching.unpack(packed)
    return unpacked.groupBy("subscriber_id", "batch_no").agg(
        F.count("*").alias("messages"),
        F.count(F.when(F.col("kind") == EVENT, 1)).alias("events"),
        F.sum(F.col("pos") * F.coalesce(F.col("event.time_ns") % 1000003, F.lit(0))).alias(
            "order_check"
        ),
    )


def wire_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as serialized batches and back, in the layout of ``emit_rows``."""
    numbered = batching.number_batches(sample_log(spark, sf_dir), ["source_name"])
    payloads = wire.encode_messages(numbered, ["source_name"]).select(
        F.col("source_name").alias("stream_id"), "batch_no", "payload"
    )
    checked = batches.check_messages(batches.flatten_batches(wire.decode_batches(payloads)))
    log = batches.accepted(checked)
    return log.select(
        "segment_id", "source_name", "kind", _time_of_message().alias("time_ns"),
        _name_of_message().alias("name"), _items().alias("items"),
        F.array_join(
            F.transform(
                "event.fields",
                lambda f: F.concat_ws(":", f["name"], f["value"]["tag"], render(f["value"])),
            ),
            ",",
        ).alias("content"),
    )


def _items() -> Column:
    return _big(
        F.coalesce(
            F.when(F.col("kind") == "event_schema", F.size("event_schema.fields")),
            F.when(F.col("kind") == "named_values", F.size("named_values.values")),
            F.when(F.col("kind") == EVENT, F.size("event.fields")),
        )
    )


def emit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_log(spark, sf_dir).select(
        "seq", "segment_id", "source_name", "kind", _time_of_message().alias("time_ns"),
        _name_of_message().alias("name"), _items().alias("items"),
    )


def catalog_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("event_id")
    names = [t.duckdb for t in VALUE_TYPES] + ["HUGEINT", "tinyint"]
    rows = read_events(spark, sf_dir).select(
        "event_id",
        F.when(n % 9 == 0, F.lit("not-an-id"))
        .when(n % 9 == 1, F.upper("segment_id"))
        .otherwise(F.col("segment_id"))
        .alias("data_segment_id"),
        F.col("source_name").alias("source"),
        F.col("event_type").alias("message"),
        F.lit("value").alias("signal"),
        F.when(n % 2 == 0, F.lit("USD")).alias("unit"),
        F.element_at(
            F.array(*[F.lit(x) for x in names]), (n % len(names) + 1).cast("int")
        ).alias("data_type"),
    )
    return signals_from_rows(rows)


# --- typed values ----------------------------------------------------------


# JSON lexemes by event_id, next to the event's own numbers.
JSON_LEXEMES = (
    "300", "-1", "1.5", "1e300", "true", "null", '"AQID"', '"text"', '"1"', "[1,2]",
    "18446744073709551615", "1.0",
)


def _json_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("event_id")
    cases = [F.lit(x) for x in JSON_LEXEMES] + [
        F.col("value").cast("string"),
        F.col("user_id").cast("string"),
        F.get_json_object("props", "$.k"),
    ]
    lexeme = F.element_at(F.array(*cases), (n % len(cases) + 1).cast("int"))
    names = F.array(*[F.lit(t.name) for t in VALUE_TYPES])
    docs = read_events(spark, sf_dir).select(
        "event_id",
        F.element_at(names, (n % 14 + 1).cast("int")).alias("data_type"),
        F.concat(F.lit('{"v": '), lexeme, F.lit("}")).alias("doc"),
    )
    return docs.select(
        "event_id",
        "data_type",
        J.json_kind(
            F.try_variant_get(F.try_parse_json("doc"), "$.v", "variant")
        ).alias("kind"),
        F.try_element_at(F.from_json("doc", "map<string,string>"), F.lit("v")).alias("text"),
    )


def json_to_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = J.typed_from_json(F.col("kind"), F.col("text"), F.col("data_type"))
    rows = _json_values(spark, sf_dir).select("event_id", "data_type", read.alias("r"))
    return rows.select(
        "event_id", "data_type", render(F.col("r.value")).alias("value"),
        F.col("r.error").alias("error"),
    )


def json_to_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = J.sql_columns(F.col("kind"), F.col("text"), F.col("data_type"))
    return (
        _json_values(spark, sf_dir)
        .select("event_id", "data_type", columns.alias("c"))
        .select(
            "event_id", "data_type", F.col("c.text").alias("text"),
            F.hex("c.bytes").alias("bytes"), F.col("c.time_ns").alias("time_ns"),
            F.col("c.error").alias("error"),
        )
    )


def log_to_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON of every sample; one value in fifty is made NaN first."""
    long = samples.explode_events(sample_log(spark, sf_dir))
    spoiled = (F.col("signal") == "value") & (F.col("seq") % 500 == 0)
    value = F.when(
        spoiled, typed("float64", F.lit(float("nan")))
    ).otherwise(F.col("value"))
    return long.withColumn("value", value).select(
        "seq", "signal", J.json_text(F.col("value")).alias("json"),
        F.when(J.not_json(F.col("value")), F.lit("not_a_json_number")).alias("error"),
    )


def rendered_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.col("value")
    shown = {
        "plain": typed("float64", value),
        "large": typed("float64", value * 1_000_000),
        "small": typed("float64", value / 4096),
        "single": typed("float32", value),
        "raw": typed("binary", F.col("event_type").cast("binary")),
        "flag": typed("bool", F.col("event_id") % 2 == 0),
        "time": typed("timestamp[ns]", F.col("time_ns")),
        "wide": typed("uint64", F.col("user_id") + F.lit(str(2**63)).cast("decimal(20,0)")),
    }
    return read_events(spark, sf_dir).select(
        "event_id", *[render(v).alias(name) for name, v in shown.items()]
    )


def numeric_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = samples.explode_events(sample_log(spark, sf_dir))
    value = F.col("value")
    return long.select(
        "seq",
        "signal",
        as_number(value).cast("bigint").alias("number"),
        as_type(value, "float64").alias("as_float64"),
        _big(as_type(value, "uint8")).alias("as_uint8"),
        as_type(value, "int64").alias("as_int64"),
    )


def distinct_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = samples.explode_events(sample_log(spark, sf_dir))
    return (
        long.select(
            "segment_id", "message", "signal", F.col("value.tag").alias("tag"),
            canonical_key(F.col("value")).alias("key"),
        )
        .groupBy("segment_id", "message", "signal", "tag", "key")
        .agg(F.count("*").alias("n"))
    )


def catalog_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = signals.with_names(catalog.signals(catalog.fold(sample_log(spark, sf_dir))))
    name = F.col("data_type")
    return found.select(
        "key_string", "data_type", duckdb_type(name).alias("duckdb_type"),
        arrow_type(name).alias("arrow_type"), spark_type(name).alias("spark_type"),
        _big(is_numeric(name)).alias("is_numeric"),
    )


def time_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times moved to either side of the epoch, with nanoseconds."""
    ns = F.col("time_ns") + F.col("event_id") % 1000 - F.when(
        F.col("event_id") % 2 == 0, F.lit(3_400_000_000_000_000_000)
    ).otherwise(F.lit(0))
    moved = read_events(spark, sf_dir).select("event_id", ns.alias("ns"))
    return moved.select(
        "event_id", "ns", ns_to_micros(F.col("ns")).alias("micros"),
        ns_remainder(F.col("ns")).alias("remainder"),
    )


# --- streams ---------------------------------------------------------------


def _files(spark: SparkSession, sf_dir: str, least: int) -> int:
    """Into how many files a stream of the events is written: none grows with the table."""
    return max(least, -(-read_events(spark, sf_dir).count() // FILE_EVENTS))


def _log_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived log as a stream of files in order, three eighths of them per micro-batch."""
    path, files = new_folder(spark, "log-stream"), _files(spark, sf_dir, 8)
    sample_log(spark, sf_dir).repartitionByRange(files, "seq").write.parquet(path)
    return spark.readStream.schema(LOG_DDL).option("maxFilesPerTrigger", -(-files * 3 // 8)).parquet(path)


def stream_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_folder(spark, "catalog")
    stream = start_catalog_stream(
        _log_stream(spark, sf_dir), root, new_folder(spark, "catalog-offsets")
    )
    stream.awaitTermination()
    return _signal_columns(read_catalog(spark, root))


def stream_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_folder(spark, "latest")
    start_latest(
        _log_stream(spark, sf_dir), root, new_folder(spark, "latest-offsets")
    ).awaitTermination()
    return latest_now(spark, root).select("full_name", "message", "signal", "time_ns", "value")


def stream_remove_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog after removals, kept by a stream, compacted, and read."""
    root, smaller = new_folder(spark, "catalog"), new_folder(spark, "compacted")
    removals = written(_removals(spark, sf_dir))
    stream = start_catalog_stream(
        _log_stream(spark, sf_dir), root, new_folder(spark, "catalog-offsets"), tombstones=removals
    )
    stream.awaitTermination()
    compact(spark, root, smaller, 0, removals)
    return _segments_with_schemas(read_catalog(spark, smaller, removals))


def stream_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_folder(spark, "store")
    stream = start_store(_log_stream(spark, sf_dir), root, new_folder(spark, "store-offsets"))
    stream.awaitTermination()
    per_kind = stored_log(spark, root).groupBy("segment_id").agg(
        F.count("*").alias("messages"), F.sum("seq").alias("sum_seq")
    )
    return (
        stored_catalog(spark, root)
        .segments.select("segment_id", "source", "start_time_ns", "end_time_ns")
        .join(per_kind, "segment_id")
    )


def stream_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_folder(spark, "routed")
    stream = start_routing(
        _log_stream(spark, sf_dir),
        _route_filters(spark, sf_dir),
        root,
        new_folder(spark, "routed-offsets"),
    )
    stream.awaitTermination()
    return delivered(spark, root).groupBy("subscriber_id", "segment_id", "kind").agg(
        F.count("*").alias("copies"), F.sum("seq").alias("sum_seq")
    )


def stream_subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changing subscriptions on a stream; the commands lie in several files."""
    root, folder = new_folder(spark, "routed"), new_folder(spark, "commands")
    commands = spark.createDataFrame(COMMANDS, COMMANDS_DDL)
    commands.repartitionByRange(3, "seq").write.parquet(folder)
    stream = start_subscriptions(
        _log_stream(spark, sf_dir),
        lambda: spark.read.schema(COMMANDS_DDL).parquet(folder),
        root,
        new_folder(spark, "routed-offsets"),
    )
    stream.awaitTermination()
    return _per_subscriber(delivered(spark, root))


def stream_late_subscriber(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot, then live messages of a stream that also delivers older ones."""
    root = new_folder(spark, "late")
    stream = start_late_subscriber(
        _log_stream(spark, sf_dir),
        sample_log(spark, sf_dir),
        LATE_AT,
        _late_filters(spark),
        root,
        new_folder(spark, "late-offsets"),
    )
    stream.awaitTermination()
    return _late_columns(late_delivered(spark, root))


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status per stream after ingesting the wire batches from files."""
    path, root = new_folder(spark, "wire-batches"), new_folder(spark, "lake")
    files = _files(spark, sf_dir, 4)
    _wire_batches(spark, sf_dir).repartition(files).write.parquet(path)
    stream = start_ingest(
        batches.stream_batches(spark, path, maxFilesPerTrigger=-(-files // 2)),
        root,
        new_folder(spark, "lake-offsets"),
    )
    stream.awaitTermination()
    return stored_status(spark, root)


QUERIES = {
    "segments_fold": segments_fold,
    "segments_fold_from": segments_fold_from,
    "remove_segment": remove_segment,
    "schemas_first_wins": schemas_first_wins,
    "duplicate_schemas": duplicate_schemas,
    "value_tables": value_tables,
    "signals": signal_list,
    "snapshot_rows": snapshot_rows,
    "snapshot_refold": snapshot_refold,
    "signal_key_parse": signal_key_parse,
    "signal_lookup": signal_lookup,
    "signal_json": signal_json,
    "filter_parse": filter_parse,
    "filter_route": filter_route,
    "subscription_intervals": subscription_intervals,
    "subscription_route": subscription_route,
    "subscription_bursts": subscription_bursts,
    "replay_from": replay_from,
    "late_subscriber": late_subscriber,
    "latest_values": latest_values,
    "decoded_states": decoded_states,
    "wide_event": wide_event,
    "wide_tables": wide_tables,
    "signal_samples": signal_samples,
    "conformance": conformance_counts,
    "conforming_events": conforming_events,
    "unregistered_events": unregistered_events,
    "schema_field_dedupe": schema_field_dedupe,
    "wire_validity": wire_validity,
    "ingest_batches": ingest_batches,
    "publish_status": publish_status,
    "undecodable_status": undecodable_status,
    "strict_publish_status": strict_publish_status,
    "publish_batches": publish_batches,
    "timed_batches": timed_batches,
    "subscriber_responses": subscriber_responses,
    "wire_round_trip": wire_round_trip,
    "emit_rows": emit_rows,
    "catalog_rows": catalog_rows,
    "json_to_log": json_to_log,
    "json_to_columns": json_to_columns,
    "log_to_json": log_to_json,
    "rendered_values": rendered_values,
    "numeric_samples": numeric_samples,
    "distinct_values": distinct_values,
    "catalog_types": catalog_types,
    "time_columns": time_columns,
    "stream_catalog": stream_catalog,
    "stream_latest": stream_latest,
    "stream_remove_segment": stream_remove_segment,
    "stream_store": stream_store,
    "stream_route": stream_route,
    "stream_subscriptions": stream_subscriptions,
    "stream_late_subscriber": stream_late_subscriber,
    "stream_ingest": stream_ingest,
}
