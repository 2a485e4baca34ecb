"""Latest values kept up to date by a stream.

A micro-batch finds the greatest (time, seq) of each signal it touched as the batch form
does, so no task sorts its samples, and writes these signals as a part of a levelled
store; reading and merging keep the greatest of all parts, one row a signal. Late events
therefore change nothing unless they are later in time. Parts grow with the number of
signals, not of events; the store is the only state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.functions.identifiers import key_string
from tracelake.functions.values import render
from tracelake.model import VALUE_DDL
from tracelake.operators.samples import SIGNAL, latest_samples
from tracelake.session import scratch
from tracelake.streaming import commits

KEYS = SIGNAL
LATEST_DDL = (
    "segment_id STRING, source STRING, message STRING, signal STRING, "
    f"last STRUCT<time_ns: BIGINT, seq: BIGINT, value: {VALUE_DDL}>"
)


def _latest(rows: DataFrame) -> DataFrame:
    """One row a signal, the last by (time, seq)."""
    at = F.struct("last.time_ns", "last.seq")
    return rows.groupBy(*KEYS).agg(F.max_by("last", at).alias("last"))


def start_latest(log: DataFrame, root: str, checkpoint: str, trigger: dict | None = None):
    """Start keeping the latest value of each signal of a streaming log under ``root``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        if commits.is_committed(batch.sparkSession, root, batch_id):
            return
        with scratch(batch.sparkSession):
            changed = latest_samples(batch).select(*KEYS, F.struct("time_ns", "seq", "value").alias("last"))
            upsert(changed, batch_id, root)

    return (
        log.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def upsert(changed: DataFrame, batch_id: int, root: str) -> None:
    """``foreachBatch`` body: store the signals that a micro-batch touched, then merge."""
    spark = changed.sparkSession
    if commits.is_committed(spark, root, batch_id):
        return
    folder = commits.new_part(batch_id, batch_id)
    changed.write.mode("overwrite").parquet(f"{root}/latest/{folder}")
    commits.commit(spark, root, batch_id, folder)
    merge(spark, root)


def merge(spark: SparkSession, root: str) -> int:
    """Merge the parts that are due; may run beside the stream."""

    def write(folders: list[str], folder: str) -> None:
        paths = [f"{root}/latest/{f}" for f in folders]
        rows = _latest(commits.read_paths(spark, root, "latest", LATEST_DDL, paths))
        rows.write.mode("overwrite").parquet(f"{root}/latest/{folder}")

    return commits.merge_all(spark, root, ["latest"], write)


def latest_now(spark: SparkSession, root: str) -> DataFrame:
    """The latest values by the batches committed so far, as ``samples.latest_values`` gives them."""
    rows = _latest(commits.read_committed(spark, root, "latest", LATEST_DDL))
    return rows.select(
        *KEYS,
        F.col("last.time_ns").alias("time_ns"),
        key_string(*[F.col(k) for k in KEYS]).alias("full_name"),
        render(F.col("last.value")).alias("value"),
    )
