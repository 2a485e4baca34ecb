"""The stored trace lake: log and catalog written from one stream (S7), and the
ingest of raw batches with quarantine and status (S1, V5, S6)."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.model import ALL_KINDS, LOG_DDL, PAYLOAD_DDL
from tracelake.operators.catalog import Catalog
from tracelake.session import scratch
from tracelake.sources.batches import accepted, check_messages, flatten_batches, publish_status
from tracelake.streaming import commits
from tracelake.streaming.catalog_stream import read_catalog, update_catalog

STATUS_DDL = (
    "stream_id STRING, total_messages BIGINT, successful_messages BIGINT, "
    "failed_messages BIGINT, last_error STRING, last_error_at STRUCT<batch_no: BIGINT, seq: BIGINT>"
)
QUARANTINE_DDL = (
    "seq BIGINT, stream_id STRING, batch_no BIGINT, pos INT, segment_id BINARY, source_name STRING, "
    "kind STRING, " + ", ".join(f"{kind} {PAYLOAD_DDL[kind]}" for kind in ALL_KINDS) + ", error STRING"
)


def store_batch(
    log: DataFrame,
    batch_id: int,
    root: str,
    *,
    tombstones: DataFrame | None = None,
    merging: bool = True,
) -> None:
    """Write one micro-batch: messages by kind, then the partial catalog.

    The batch is committed last; readers do not see it before, and a repetition
    of a committed batch changes nothing. ``tombstones`` and ``merging`` as in
    :func:`tracelake.streaming.catalog_stream.update_catalog`.
    """
    spark = log.sparkSession
    if commits.is_committed(spark, root, batch_id):
        return
    folder = commits.new_part(batch_id, batch_id)
    _write_log(log, batch_id, root, folder, tombstones, merging)
    commits.commit(spark, root, batch_id, folder)
    if merging:
        merge_store(spark, root)


def _write_log(
    log: DataFrame, batch_id: int, root: str, folder: str, tombstones: DataFrame | None, merging: bool
) -> None:
    path = f"{root}/log/{folder}"
    log.write.mode("overwrite").partitionBy("kind").parquet(path)
    stored = log.sparkSession.read.schema(LOG_DDL).parquet(path)
    update_catalog(stored, batch_id, f"{root}/catalog", tombstones=tombstones, merging=merging)


def merge_store(spark: SparkSession, root: str) -> int:
    """Merge the parts that are due of the log, the bad messages and the status.

    May run beside the stream that writes them. The catalog has parts of its own
    (:func:`tracelake.streaming.catalog_stream.merge`).
    """

    def write(folders: list[str], folder: str) -> None:
        def rows(table: str, ddl: str) -> DataFrame:
            return commits.read_paths(spark, root, table, ddl, [f"{root}/{table}/{f}" for f in folders])

        # files of a good size, by kind
        log = rows("log", LOG_DDL).hint("rebalance", "kind")
        log.write.mode("overwrite").partitionBy("kind").parquet(f"{root}/log/{folder}")
        if _has(spark, f"{root}/status"):
            bad = rows("quarantine", QUARANTINE_DDL).hint("rebalance")
            bad.write.mode("overwrite").parquet(f"{root}/quarantine/{folder}")
            status = _merged_status(rows("status", STATUS_DDL))
            status.write.mode("overwrite").parquet(f"{root}/status/{folder}")

    return commits.merge_all(spark, root, ["log", "quarantine", "status"], write)


def _has(spark: SparkSession, folder: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def ingest_batch(raw: DataFrame, batch_id: int, root: str, *, merging: bool = True) -> None:
    """Write one micro-batch of wire batches: good messages, bad ones, status.

    Sequence numbers go on from those of the batches committed before. Side tables
    of the batch are deleted after its commit.
    """
    spark = raw.sparkSession
    now = commits.latest(spark, root)
    if now.holds(batch_id):
        return
    folder = commits.new_part(batch_id, batch_id)
    with scratch(spark):
        # the messages are stored already: reading them again costs less than keeping them
        checked = check_messages(flatten_batches(raw, now.next_seq))
        bad = checked.where(F.col("error").isNotNull()).select(*_columns(spark, QUARANTINE_DDL))
        bad.write.mode("overwrite").parquet(f"{root}/quarantine/{folder}")
        status = publish_status(checked)
        status.write.mode("overwrite").parquet(f"{root}/status/{folder}")
        after = now.next_seq + checked.count()
        _write_log(accepted(checked), batch_id, root, folder, None, merging)
        commits.commit(spark, root, batch_id, folder, after)
    if merging:
        merge_store(spark, root)


def _columns(spark: SparkSession, ddl: str) -> list[str]:
    return spark.createDataFrame([], ddl).columns


def start_store(
    log: DataFrame,
    root: str,
    checkpoint: str,
    trigger: dict | None = None,
    tombstones: DataFrame | None = None,
):
    body = functools.partial(store_batch, tombstones=tombstones)
    return _start(log, body, root, checkpoint, trigger)


def start_ingest(raw: DataFrame, root: str, checkpoint: str, trigger: dict | None = None):
    return _start(raw, ingest_batch, root, checkpoint, trigger)


def _start(stream: DataFrame, body, root: str, checkpoint: str, trigger: dict | None):
    return (
        stream.writeStream.foreachBatch(lambda batch, batch_id: body(batch, batch_id, root))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def stored_log(spark: SparkSession, root: str) -> DataFrame:
    """The stored log; a filter on ``kind`` reads only those partitions."""
    return commits.read_committed(spark, root, "log", LOG_DDL)


def stored_catalog(
    spark: SparkSession, root: str, tombstones: DataFrame | None = None
) -> Catalog:
    return read_catalog(spark, f"{root}/catalog", tombstones)


def quarantine(spark: SparkSession, root: str) -> DataFrame:
    """The rejected messages of all committed batches."""
    return commits.read_committed(spark, root, "quarantine", QUARANTINE_DDL)


def _merged_status(parts: DataFrame) -> DataFrame:
    """Status per stream over all batches; the error of the latest batch stays."""
    failed = F.col("failed_messages") > 0
    at = F.when(failed, F.col("last_error_at"))
    return parts.groupBy("stream_id").agg(
        *[
            F.sum(c).cast("bigint").alias(c)
            for c in ("total_messages", "successful_messages", "failed_messages")
        ],
        F.coalesce(F.max_by("last_error", at), F.lit("")).alias("last_error"),
        F.max(at).alias("last_error_at"),
    )


def stored_status(spark: SparkSession, root: str) -> DataFrame:
    """Status per stream over all committed batches."""
    return _merged_status(commits.read_committed(spark, root, "status", STATUS_DDL)).drop("last_error_at")
