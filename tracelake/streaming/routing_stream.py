"""Routing a streaming log to subscribers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.model import LOG_COLUMNS, LOG_DDL
from tracelake.operators.batching import SUBSCRIBE_BATCH, responses
from tracelake.operators.catalog import fold, snapshot
from tracelake.operators.filters import route, settle_filters
from tracelake.operators.subscriptions import route_subscriptions
from tracelake.session import scratch
from tracelake.streaming import commits


def start_routing(
    log: DataFrame,
    filters: DataFrame,
    root: str,
    checkpoint: str,
    trigger: dict | None = None,
):
    """Write every message once per matching filter, by ``subscriber_id``."""
    settled = settle_filters(filters)
    return _start(lambda batch: route(batch, settled), log, root, checkpoint, trigger)


def start_late_subscriber(
    log: DataFrame,
    past: DataFrame,
    at_seq: int,
    filters: DataFrame,
    root: str,
    checkpoint: str,
    trigger: dict | None = None,
):
    """A subscriber that joins a stream after message ``at_seq``.

    The catalog of ``past`` up to ``at_seq`` is written first (``part`` 0), then
    what matches of the later messages of the stream (``part`` 1): no gap and no
    overlap at the boundary, whatever of the past the stream still delivers.
    """
    snapshot(fold(past.where(F.col("seq") <= at_seq))).write.mode("overwrite").parquet(
        f"{root}/snapshot"
    )
    settled = settle_filters(filters)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, folder = batch.sparkSession, commits.new_part(batch_id, batch_id)
        if commits.is_committed(spark, root, batch_id):
            return
        with scratch(spark):
            live = route(batch.where(F.col("seq") > at_seq), settled).select(*LOG_COLUMNS)
            live.write.mode("overwrite").parquet(f"{root}/live/{folder}")
        commits.commit(spark, root, batch_id, folder)

    return (
        log.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def late_delivered(spark: SparkSession, root: str) -> DataFrame:
    """Snapshot and live messages of a late subscriber, by ``part``."""
    first = spark.read.parquet(f"{root}/snapshot").withColumn("part", F.lit(0))
    live = commits.read_committed(spark, root, "live", LOG_DDL)
    return first.unionByName(
        live.select(*LOG_COLUMNS).withColumn("part", F.lit(1)), allowMissingColumns=True
    )


def start_subscriptions(
    log: DataFrame,
    commands: DataFrame | Callable[[], DataFrame],
    root: str,
    checkpoint: str,
    trigger: dict | None = None,
):
    """As above, with filters that change by commands.

    Commands that may still come are given as a function that reads them; it is
    called anew for every micro-batch. A command has to be there before the
    messages that follow it are processed.
    """

    def now() -> DataFrame:
        return commands() if callable(commands) else commands

    return _start(lambda batch: route_subscriptions(batch, now()), log, root, checkpoint, trigger)


def start_responses(
    log: DataFrame,
    filters: DataFrame,
    root: str,
    checkpoint: str,
    batch_size: int = SUBSCRIBE_BATCH,
    trigger: dict | None = None,
):
    """Write responses of bounded size per subscriber; a micro-batch flushes."""

    settled = settle_filters(filters)

    def packed(batch: DataFrame) -> DataFrame:
        return responses(route(batch, settled), batch_size)

    return _start(packed, log, root, checkpoint, trigger)


def _start(transform, log: DataFrame, root: str, checkpoint: str, trigger: dict | None):
    def write(batch: DataFrame, batch_id: int) -> None:
        spark, folder = batch.sparkSession, commits.new_part(batch_id, batch_id)
        if commits.is_committed(spark, root, batch_id):
            return
        with scratch(spark):
            # few files for each subscriber, and a subscriber to everything in several tasks
            out = transform(batch).hint("rebalance", "subscriber_id")
            out.write.mode("overwrite").partitionBy("subscriber_id").parquet(f"{root}/rows/{folder}")
        commits.commit(spark, root, batch_id, folder)

    return (
        log.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def delivered(spark: SparkSession, root: str) -> DataFrame:
    """What has been written for the subscribers so far, by committed batches."""
    found = commits.paths(spark, root, "rows")
    if not found:
        raise ValueError(f"no batch is committed under {root}")
    return spark.read.option("basePath", f"{root}/rows").parquet(*found).drop("part")
