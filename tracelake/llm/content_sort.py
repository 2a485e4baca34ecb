"""Exact duplicates by sorting contents.

Texts are equal when they are identical after each run of ASCII white space
became one space. Rows are dealt out by sampled splitters over the first bytes
of the normalised text, its hash and the id, so that a group of any size is cut
into ranges of ids; Spark's external sort then puts equal texts next to each
other, by their whole contents. A pass over each sorted partition compares
every text in full with the one before it. A group that was cut shows at the
ends of partitions only: those at most two pieces a partition are merged by
their digest, and that small table, bounded by the number of partitions, is
broadcast back.

Null and empty texts are equal to each other. Of equal texts the row with the
smallest id stays; rows without an id come last; of repeated rows with the
smallest id one stays. An empty table gives an empty result. Other columns do
not matter, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracelake.llm.common import ship, stored

WHITE = "[\\x20\\x09-\\x0D]+"
# Bytes of the text that lead the splitters. Ties go on to hash and id, and the
# sort inside a partition looks at the whole text, so this is layout only.
LEAD_BYTES = 16


def normalized(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, " ")


def equal_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its group's smallest id and size, and whether it stays."""
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("id"), normalized(F.col(f"`{text}`")).alias("norm")
    )
    pieces = stored(_pieces(_sorted(rows), heads_only=False), "pieces")
    merged = _merged_edges(pieces)
    joined = pieces.join(F.broadcast(merged), F.col("edge") & (F.col("sha") == F.col("m_sha")), "left")
    cut = F.col("m_sha").isNotNull()
    return joined.select(
        F.col("id").alias("doc_id"),
        F.when(cut, F.col("m_id")).otherwise(F.col("first_id")).alias("keep_id"),
        F.when(cut, F.col("m_size")).otherwise(F.col("size")).alias("group_size"),
        (F.col("head") & (~cut | (F.col("place") == F.col("m_place")))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def distinct_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, whole."""
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("id"),
        normalized(F.col(f"`{text}`")).alias("norm"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
    )
    again = normalized(F.col("row").getField(text))
    heads = stored(_pieces(_sorted(rows, again), heads_only=True), "heads")
    merged = _merged_edges(heads)
    joined = heads.join(F.broadcast(merged), F.col("edge") & (F.col("sha") == F.col("m_sha")), "left")
    return joined.where("m_sha IS NULL OR place = m_place").select("row.*")


def _sorted(rows: DataFrame, again: Column | None = None) -> DataFrame:
    """Rows by content: dealt out by splitters, then sorted in each partition.

    With ``again`` the normalised text does not travel; it is made anew.
    """
    dealt = rows.select(
        "*",
        F.substring(F.col("norm").cast("binary"), 1, LEAD_BYTES).alias("lead"),
        F.xxhash64("norm").alias("hash"),
    )
    if again is not None:
        dealt = dealt.drop("norm")
    dealt = dealt.repartitionByRange("lead", "hash", F.col("id").asc_nulls_last())
    if again is not None:
        dealt = dealt.withColumn("norm", again)
    return dealt.sortWithinPartitions("lead", "hash", "norm", F.col("id").asc_nulls_last())


def _pieces(rows: DataFrame, heads_only: bool) -> DataFrame:
    """Neighbours compared in full: runs of equal texts within each partition.

    ``edge`` marks runs that may go on in another partition: those that share
    the hash of the partition's first or last row.
    """
    ship(rows.sparkSession)
    fields = [
        T.StructField("id", rows.schema["id"].dataType),
        T.StructField("hash", T.LongType()),
        T.StructField("sha", T.StringType()),
        *([rows.schema["row"]] if heads_only else []),
        T.StructField("place", T.LongType()),
        T.StructField("first_id", rows.schema["id"].dataType),
        T.StructField("size", T.LongType()),
        T.StructField("head", T.BooleanType()),
        T.StructField("edge", T.BooleanType()),
    ]

    def closed(held: pa.Table, edge: np.ndarray, place: int) -> Iterator[pa.RecordBatch]:
        starts = held.column("start").to_numpy()
        first = np.flatnonzero(starts)
        piece = np.cumsum(starts) - 1
        size = np.diff(np.append(first, held.num_rows))[piece]
        ids = held.column("id")
        out = held.drop_columns(["start"])
        for name, values in (
            ("place", np.full(held.num_rows, place)),
            ("first_id", ids.take(pa.array(first[piece]))),
            ("size", size),
            ("head", starts),
            ("edge", edge),
        ):
            out = out.append_column(name, values if name == "first_id" else pa.array(values))
        yield from out.combine_chunks().to_batches()

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId()
        before, first_hash, held = None, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            norm = batch.column("norm")
            starts = np.ones(batch.num_rows, dtype=bool)
            starts[1:] = ~pc.equal(norm[1:], norm[:-1]).to_numpy(zero_copy_only=False)
            starts[0] = before is None or norm[0].as_py() != before
            before = norm[batch.num_rows - 1].as_py()
            part = pa.Table.from_batches([batch]).drop_columns(["norm"])
            part = part.append_column("start", pa.array(starts))
            if first_hash is None:
                first_hash = part.column("hash")[0].as_py()
            if heads_only:
                part = part.filter(part.column("start"))
            held = part if held is None else pa.concat_tables([held, part])
            hashes = held.column("hash").to_numpy()
            changes = np.flatnonzero(hashes[1:] != hashes[:-1])
            if len(changes):
                # what has the latest hash may go on; all before it is closed
                end = int(changes[-1]) + 1
                yield from closed(held.slice(0, end), hashes[:end] == first_hash, place)
                held = held.slice(end)
        if held is not None and held.num_rows:
            yield from closed(held, np.ones(held.num_rows, dtype=bool), place)

    carried = ["id", "hash", F.sha2("norm", 256).alias("sha"), "norm"]
    if heads_only:
        carried.insert(3, "row")
    return rows.select(*carried).mapInArrow(walk, T.StructType(fields))


def _merged_edges(pieces: DataFrame) -> DataFrame:
    """The pieces at the ends of partitions, merged: at most two of them a partition."""
    order = F.struct(F.col("first_id").isNull().alias("n"), F.col("first_id").alias("i"), F.col("place").alias("p"))
    return (
        pieces.where("edge AND head")
        .groupBy(F.col("sha").alias("m_sha"))
        .agg(F.min(order).alias("o"), F.sum("size").alias("m_size"))
        .select("m_sha", "m_size", F.col("o.i").alias("m_id"), F.col("o.p").alias("m_place"))
    )
