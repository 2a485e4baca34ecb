"""Incremental catalog maintenance (M10) on stored partial folds.

Each micro-batch writes only its own partial fold, so the cost of a batch does not
grow with the catalog, and commits it. Reading merges the partial folds of the
committed parts; :func:`merge` does so for good, beside the stream, for parts of one
level, and :func:`compact` for all of them. Of the state only the manifest comes
to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.model import EVENT, VALUE_DDL
from tracelake.operators.catalog import (
    SCHEMA_STATE_DDL,
    SEGMENT_STATE_DDL,
    Catalog,
    FoldState,
    drop_removed,
    fold_state,
    merge_rows,
    state_to_catalog,
)
from tracelake.session import scratch
from tracelake.streaming import commits

VALUE_STATE_DDL = (
    "segment_id STRING, event_name STRING, field_name STRING, tag STRING, key STRING, "
    f"seq BIGINT, pos INT, value {VALUE_DDL}, label STRING"
)
_TABLES = {
    "segments": SEGMENT_STATE_DDL,
    "schemas": SCHEMA_STATE_DDL,
    "values": VALUE_STATE_DDL,
}
# Columns that hold the arrival of each state table's rows, for removals.
_ARRIVAL = {"segments": "last_seq", "schemas": "schema_seq", "values": "seq"}


def _write(state: FoldState, root: str, folder: str) -> None:
    for name in _TABLES:
        getattr(state, name).write.mode("overwrite").parquet(f"{root}/{name}/{folder}")


def update_catalog(
    batch: DataFrame,
    batch_id: int,
    root: str,
    *,
    mode: str = "update",
    tombstones: DataFrame | None = None,
    merging: bool = True,
) -> None:
    """``foreachBatch`` body: store the partial fold of one micro-batch.

    ``tombstones`` (segment_id, seq) has to list a removal before the messages
    that follow it are processed, as in the log itself. With ``merging`` the parts
    that are due are merged after the commit; otherwise call :func:`merge` beside.
    """
    spark = batch.sparkSession
    if commits.is_committed(spark, root, batch_id):
        return
    folder = commits.new_part(batch_id, batch_id)
    if mode == "update":
        # events do not count, and are neither joined nor kept
        batch = batch.where(F.col("kind") != EVENT)
    if tombstones is not None:
        batch = drop_removed(batch, tombstones)
    # the three tables of the fold read the batch once
    batch = batch.persist()
    try:
        with scratch(spark):
            _write(fold_state(batch, mode), root, folder)
    finally:
        batch.unpersist()
    commits.commit(spark, root, batch_id, folder)
    if merging:
        merge(spark, root, tombstones)


def read_state(
    spark: SparkSession, root: str, tombstones: DataFrame | None = None
) -> FoldState:
    parts = commits.latest(spark, root).parts
    return _state_of(spark, root, [p.folder for p in parts], tombstones)


def _state_of(
    spark: SparkSession, root: str, folders: list[str], tombstones: DataFrame | None
) -> FoldState:
    parts = {
        name: commits.read_paths(spark, root, name, ddl, [f"{root}/{name}/{f}" for f in folders])
        for name, ddl in _TABLES.items()
    }
    if tombstones is not None:
        # A removal forgets partial folds of batches before it. The messages of
        # its own batch that came before it were left out on writing.
        last = tombstones.groupBy("segment_id").agg(F.max("seq").alias("removed_seq"))
        for name, rows in parts.items():
            parts[name] = (
                rows.join(last, "segment_id", "left")
                .where(
                    F.col("removed_seq").isNull()
                    | (F.col(_ARRIVAL[name]) > F.col("removed_seq"))
                )
                .drop("removed_seq")
            )
    return merge_rows(FoldState(**parts))


def read_catalog(
    spark: SparkSession, root: str, tombstones: DataFrame | None = None
) -> Catalog:
    """The catalog as of the batches stored so far."""
    return state_to_catalog(read_state(spark, root, tombstones))


def merge(spark: SparkSession, root: str, tombstones: DataFrame | None = None) -> int:
    """Merge the partial folds that are due; the number of merges.

    Removals have to be given here as on reading: once merged, what came before a
    removal can't be told from what came after.
    """

    def write(folders: list[str], folder: str) -> None:
        with scratch(spark):
            _write(_state_of(spark, root, folders, tombstones), root, folder)

    return commits.merge_all(spark, root, list(_TABLES), write)


def compact(
    spark: SparkSession,
    root: str,
    new_root: str,
    batch_id: int,
    tombstones: DataFrame | None = None,
) -> None:
    """All partial folds of ``root`` as one, stored in a new folder; removals as in :func:`merge`."""
    folder = commits.new_part(batch_id, batch_id)
    _write(read_state(spark, root, tombstones), new_root, folder)
    commits.commit(spark, new_root, batch_id, folder)


def start_catalog_stream(
    log: DataFrame,
    root: str,
    checkpoint: str,
    *,
    mode: str = "update",
    tombstones: DataFrame | None = None,
    trigger: dict | None = None,
):
    """Start keeping the catalog under ``root`` up to date with a streaming log."""
    return (
        log.writeStream.foreachBatch(
            lambda batch, batch_id: update_catalog(
                batch, batch_id, root, mode=mode, tombstones=tombstones
            )
        )
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
