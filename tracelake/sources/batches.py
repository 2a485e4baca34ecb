"""Incoming batches of messages: flatten, validate, account."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.functions.identifiers import uuid_from_bytes
from tracelake.functions.values import has_content, in_range, settle_slots
from tracelake.model import (
    ALL_KINDS,
    BATCH_DDL,
    EVENT,
    EVENT_SCHEMA,
    LOG_COLUMNS,
    NAMED_VALUES,
    TYPE_BY_NAME,
)
from tracelake.plans.joins import lookup_join, settle, written
from tracelake.plans.ordered import running_number

INVALID_UUID = "invalid_uuid"
MISSING_MESSAGE = "missing_message"
MISSING_DATA_TYPE = "missing_data_type"
MISSING_VALUE = "missing_value"
TRUNCATION = "truncation"
MISSING_BATCH_NO = "missing_batch_no"


def read_batches(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    return spark.read.format(file_format).schema(BATCH_DDL).load(path)


def stream_batches(
    spark: SparkSession, path: str, file_format: str = "parquet", **options
) -> DataFrame:
    return spark.readStream.format(file_format).schema(BATCH_DDL).options(**options).load(path)


# Batches without a number come after all that have one.
_UNNUMBERED = (1 << 63) - 1


def flatten_batches(batches: DataFrame, first_seq: int = 0) -> DataFrame:
    """One row per message of each batch, in order.

    ``batch_no`` is the arrival number of a batch over all streams. ``seq``
    numbers messages on from ``first_seq`` by (batch_no, stream_id, position): a
    batch begins where the sizes of all earlier ones end, so batches and numbers
    of any size fit. Rows of one stream and number follow each other as they were
    read. A batch that could not be decoded (``decode_error``) or has no number is
    one message without content, so that it is quarantined and counted.

    Messages are stored once, each a row, so that decoding is not repeated and no
    reader holds many batches; batches are numbered by narrow rows, those of their
    first messages, with an id of their own.
    """
    if "decode_error" not in batches.columns:
        batches = batches.withColumn("decode_error", F.lit(None).cast("string"))
    messages = batches.schema["trace_messages"].dataType
    nothing = F.array(F.lit(None).cast(messages.elementType))
    error = F.coalesce("decode_error", F.when(F.col("batch_no").isNull(), F.lit(MISSING_BATCH_NO)))
    held = written(
        batches.select("stream_id", "batch_no", error.alias("decode_error"), "trace_messages")
        .withColumn(
            "trace_messages",
            F.when(F.col("decode_error").isNotNull(), nothing).otherwise(F.col("trace_messages")),
        )
        .withColumns({
            "_size": F.size("trace_messages").cast("bigint"),
            "_row": F.monotonically_increasing_id(),
        })
        .select(
            "stream_id", "batch_no", "decode_error", "_size", "_row",
            F.posexplode("trace_messages").alias("pos", "message"),
        )
    )
    narrow = held.where("pos = 0").select(
        "_row", "_size", F.coalesce("batch_no", F.lit(_UNNUMBERED)).alias("_order"),
        F.struct("stream_id", "_row").alias("_tie"),
    )
    begins = running_number(
        narrow, [], "_begin", seq="_order", tie="_tie", weight=F.col("_size")
    ).select("_row", "_begin")
    numbered = lookup_join(held, begins, ["_row"], spread_by="pos")
    return numbered.withColumn("seq", F.col("_begin") + F.col("pos") + F.lit(first_seq)).select(
        "seq", "stream_id", "batch_no", "pos", "decode_error", "message.*"
    )


def _value_error(value: Column) -> Column:
    return F.when(~has_content(value), F.lit(MISSING_VALUE)).when(
        ~in_range(value), F.lit(TRUNCATION)
    )


def _first_error(items: Column, check) -> Column:
    found = F.filter(F.transform(items, check), lambda e: e.isNotNull())
    return F.try_element_at(found, F.lit(1))


def message_error(row_kind: Column | None = None) -> Column:
    """Error code of a wire message, null for a valid one (V5).

    Any bad nested value rejects the whole message; the first problem in
    message order is the one reported.
    """
    kind = F.col("kind") if row_kind is None else row_kind
    payload = F.coalesce(
        *[F.when(kind == k, F.col(k).isNotNull()) for k in ALL_KINDS], F.lit(False)
    )
    data_types = list(TYPE_BY_NAME)
    return (
        F.when(F.coalesce(F.octet_length("segment_id"), F.lit(0)) != 16, F.lit(INVALID_UUID))
        .when(~payload, F.lit(MISSING_MESSAGE))
        .when(
            kind == EVENT_SCHEMA,
            _first_error(
                F.col("event_schema.fields"),
                lambda f: F.when(
                    f["data_type"].isNull() | ~f["data_type"].isin(*data_types),
                    F.lit(MISSING_DATA_TYPE),
                ),
            ),
        )
        .when(
            kind == NAMED_VALUES,
            _first_error(F.col("named_values.values"), lambda e: _value_error(e["value"])),
        )
        .when(
            kind == EVENT,
            _first_error(F.col("event.fields"), lambda f: _value_error(f["value"])),
        )
    )


def check_messages(flat: DataFrame) -> DataFrame:
    """Flattened wire messages with their ``error`` code."""
    if "decode_error" not in flat.columns:
        return flat.withColumn("error", message_error())
    return flat.withColumn("error", F.coalesce("decode_error", message_error())).drop("decode_error")


def accepted(checked: DataFrame, *, strict: bool = False) -> DataFrame:
    """Valid messages in the log's layout.

    Default: bad messages are left out (quarantine). ``strict``: a stream ends
    at its first bad message, as on the wire; what came before is kept.
    """
    good = checked.where(F.col("error").isNull())
    if strict:
        bad = (
            checked.where(F.col("error").isNotNull())
            .groupBy("stream_id")
            .agg(F.min("seq").alias("_bad_seq"))
        )
        good = lookup_join(good, bad, ["stream_id"], "left").where(
            F.col("_bad_seq").isNull() | (F.col("seq") < F.col("_bad_seq"))
        )
    return good.withColumns(
        {
            "segment_id": uuid_from_bytes(F.col("segment_id")),
            "named_values": F.when(
                F.col("named_values").isNotNull(),
                F.col("named_values").withField(
                    "values",
                    F.transform(
                        "named_values.values",
                        lambda e: F.struct(
                            settle_slots(e["value"]).alias("value"), e["label"].alias("label")
                        ),
                    ),
                ),
            ),
            "event": F.when(
                F.col("event").isNotNull(),
                F.col("event").withField(
                    "fields",
                    F.transform(
                        "event.fields",
                        lambda f: F.struct(
                            f["name"].alias("name"), settle_slots(f["value"]).alias("value")
                        ),
                    ),
                ),
            ),
        }
    ).select(*LOG_COLUMNS)


def quarantined(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("error").isNotNull())


def publish_status(checked: DataFrame) -> DataFrame:
    """Counts per stream and the last error by arrival (S6), bad messages quarantined.

    Counting per (stream, error) first keeps the pass over all messages a hash
    aggregate on numbers.
    """
    at = F.struct("batch_no", "seq")
    per_error = checked.groupBy("stream_id", "error").agg(
        F.count(F.lit(1)).alias("n"), F.max(at).alias("last_at")
    )
    bad = F.col("error").isNotNull()
    return per_error.groupBy("stream_id").agg(
        F.sum("n").alias("total_messages"),
        F.sum(F.when(bad, F.lit(0)).otherwise(F.col("n"))).alias("successful_messages"),
        F.sum(F.when(bad, F.col("n")).otherwise(F.lit(0))).alias("failed_messages"),
        F.coalesce(F.max_by("error", F.when(bad, F.col("last_at"))), F.lit("")).alias("last_error"),
        F.max(F.when(bad, F.col("last_at"))).alias("last_error_at"),
    )


def strict_publish_status(checked: DataFrame) -> DataFrame:
    """Counts per stream when the first bad message ends the stream.

    ``forwarded_messages`` went on; ``total_messages`` counts only whole
    batches before the one that failed, and equals ``successful_messages``.
    """
    bad = (
        checked.where(F.col("error").isNotNull())
        .groupBy("stream_id", "error")
        .agg(F.min("seq").alias("seq"), F.min("batch_no").alias("batch_no"))
        .groupBy("stream_id")
        .agg(
            F.min("seq").alias("_bad_seq"),
            F.min("batch_no").alias("_bad_batch"),
            F.min_by("error", "seq").alias("stream_error"),
        )
    )
    joined = lookup_join(checked, settle(bad), ["stream_id"], "left")
    fine = F.col("_bad_seq").isNull()
    before = fine | (F.col("seq") < F.col("_bad_seq"))
    # a bad batch without a number comes after all others
    whole = fine | F.coalesce(F.col("batch_no") < F.col("_bad_batch"), F.col("batch_no").isNotNull())
    return (
        joined.groupBy("stream_id", "stream_error")
        .agg(
            F.count(F.when(whole, F.lit(1))).alias("total_messages"),
            F.count(F.when(before, F.lit(1))).alias("forwarded_messages"),
        )
        .select(
            "stream_id",
            "total_messages",
            F.col("total_messages").alias("successful_messages"),
            F.lit(0).cast("bigint").alias("failed_messages"),
            "forwarded_messages",
            "stream_error",
        )
    )
