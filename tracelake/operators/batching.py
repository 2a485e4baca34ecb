"""Outgoing batches of bounded size (S3) and subscriber responses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.model import ALL_KINDS
from tracelake.plans.ordered import running_number

# Messages per batch, outgoing and towards a subscriber.
PUBLISH_BATCH = 1000
SUBSCRIBE_BATCH = 1024


def number_batches(
    log: DataFrame,
    stream_keys: Sequence[str],
    batch_size: int = PUBLISH_BATCH,
    *,
    tie: str | None = None,
) -> DataFrame:
    """Add ``batch_no`` and ``batch_pos``: consecutive runs of ``batch_size`` per stream."""
    at = F.col("_position")
    return (
        running_number(log, stream_keys, "_position", tie=tie)
        .withColumn("batch_no", F.floor(at / batch_size).cast("bigint"))
        .withColumn("batch_pos", (at % batch_size).cast("bigint"))
        .drop("_position")
    )


def gather_batches(numbered: DataFrame, stream_keys: Sequence[str]) -> DataFrame:
    """One row per batch with its messages as an array, at most a batch long."""
    message = F.struct("batch_pos", "segment_id", "source_name", "kind", *ALL_KINDS)
    return (
        numbered.groupBy(*stream_keys, "batch_no")
        .agg(F.sort_array(F.collect_list(message)).alias("messages"))
        .withColumn("messages", F.transform("messages", lambda m: m.dropFields("batch_pos")))
    )


def responses(routed: DataFrame, batch_size: int = SUBSCRIBE_BATCH) -> DataFrame:
    """Routed messages packed into subscriber responses.

    ``routed`` may hold several copies of one message for a subscriber, told
    apart by ``filter_no``.
    """
    keys = ["subscriber_id"]
    return gather_batches(number_batches(routed, keys, batch_size, tie="filter_no"), keys)


def unpack(batches: DataFrame, column: str = "messages") -> DataFrame:
    """Messages of batches, one per row, with their position."""
    rest = [c for c in batches.columns if c != column]
    return batches.select(*rest, F.posexplode(column).alias("pos", "m")).select(
        *rest, "pos", "m.*"
    )
