"""Counting along an order inside a key, without one task per key.

``seq`` is unique, so a block of ``2**20`` sequence numbers holds at most
``2**20`` rows whatever the data: windows run inside blocks, and block totals
are combined over two more levels that are bounded in the same way. A key that
holds a third of all rows is thereby spread over as many tasks as it has
blocks. Null keys are a key like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracelake.plans.joins import Settled, settle

BLOCK_BITS = 20


def running_number(
    df: DataFrame,
    keys: Sequence[str],
    name: str,
    *,
    seq: str = "seq",
    tie: str | None = None,
    weight: Column | None = None,
    block_bits: int = BLOCK_BITS,
) -> DataFrame:
    """Add the 0-based position of each row in its key by ``seq``, then ``tie``.

    With ``weight`` a row counts that often: the sum over all earlier rows. A
    block holds 2^20 sequence numbers, times the rows that share one. Block totals
    are stored and measured while the plan is built, so the result is bound to
    ``df`` as it is then.
    """
    keys = list(keys)
    weight = F.lit(1) if weight is None else weight
    earlier = (Window.unboundedPreceding, -1)
    blocked = df.withColumn("_block", F.shiftright(F.col(seq), block_bits)).withColumn(
        "_super", F.shiftright(F.col(seq), 2 * block_bits)
    )
    inside = Window.partitionBy(*keys, "_block").orderBy(seq, *([tie] if tie else []))
    before = F.sum(weight.cast("bigint")).over(inside.rowsBetween(*earlier))
    numbered = blocked.withColumn("_at", F.coalesce(before, F.lit(0)))

    side = settle(
        blocked.groupBy(*keys, "_super", "_block").agg(F.sum(weight.cast("bigint")).alias("_n"))
    )
    totals = side.df
    in_super = Window.partitionBy(*keys, "_super").orderBy("_block").rowsBetween(*earlier)
    blocks = totals.withColumn("_before", F.coalesce(F.sum("_n").over(in_super), F.lit(0)))
    supers = totals.groupBy(*keys, "_super").agg(F.sum("_n").alias("_n"))
    in_key = Window.partitionBy(*keys).orderBy("_super").rowsBetween(*earlier)
    supers = supers.select(
        *keys, "_super", F.coalesce(F.sum("_n").over(in_key), F.lit(0)).alias("_super_before")
    )
    offsets = _on(blocks, supers, [*keys, "_super"]).select(
        *keys, "_block", (F.col("_before") + F.col("_super_before")).alias("_offset")
    )
    return (
        _on(numbered, _sized(offsets, side), [*keys, "_block"])
        .withColumn(name, F.col("_at") + F.col("_offset"))
        .drop("_block", "_super", "_at", "_offset")
    )


def _on(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join in which null keys meet; the keys of ``left`` stay."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(renamed[f"_r_{key}"])
    return left.join(renamed, condition).drop(*[f"_r_{k}" for k in keys])


def _sized(offsets: DataFrame, totals: Settled) -> DataFrame:
    """One row per block, as many as the totals: broadcast when those are few.

    Otherwise the join needs no further shuffle of the data either, which the
    window has already laid out by the same keys.
    """
    return F.broadcast(offsets) if totals.broadcastable else offsets


def running_max(
    df: DataFrame, keys: Sequence[str], value: Column, name: str, *, seq: str = "seq", block_bits: int = BLOCK_BITS
) -> DataFrame:
    """Add the largest value of the key so far by ``seq``, the row's own included.

    Rows that share a number see each other's values. Block maxima are stored and
    measured while the plan is built.
    """
    keys = list(keys)
    blocked = (
        df.withColumn("_value", value)
        .withColumn("_block", F.shiftright(F.col(seq), block_bits))
        .withColumn("_super", F.shiftright(F.col(seq), 2 * block_bits))
    )
    inside = Window.partitionBy(*keys, "_block").orderBy(seq)
    local = blocked.withColumn("_local", F.max("_value").over(inside))

    side = settle(
        blocked.groupBy(*keys, "_super", "_block").agg(F.max("_value").alias("_most"))
    )
    totals = side.df
    earlier = (Window.unboundedPreceding, -1)
    in_super = Window.partitionBy(*keys, "_super").orderBy("_block").rowsBetween(*earlier)
    blocks = totals.withColumn("_before", F.max("_most").over(in_super))
    supers = totals.groupBy(*keys, "_super").agg(F.max("_most").alias("_most"))
    in_key = Window.partitionBy(*keys).orderBy("_super").rowsBetween(*earlier)
    supers = supers.select(*keys, "_super", F.max("_most").over(in_key).alias("_long_before"))
    before = _on(blocks, supers, [*keys, "_super"]).select(
        *keys, "_block", F.greatest("_before", "_long_before").alias("_earlier")
    )
    return (
        _on(local, _sized(before, side), [*keys, "_block"])
        .withColumn(name, F.greatest("_local", "_earlier"))
        .drop("_value", "_block", "_super", "_local", "_earlier")
    )


def next_marked(
    df: DataFrame,
    keys: Sequence[str],
    marked: Column,
    name: str,
    *,
    seq: str = "seq",
    block_bits: int = BLOCK_BITS,
) -> DataFrame:
    """Add the ``seq`` of the next later row of the key for which ``marked`` holds."""
    keys = list(keys)
    blocked = (
        df.withColumn("_mark", F.when(marked, F.col(seq)))
        .withColumn("_block", F.shiftright(F.col(seq), block_bits))
        .withColumn("_super", F.shiftright(F.col(seq), 2 * block_bits))
    )
    # Descending order turns "following" into a running minimum over the past.
    earlier = (Window.unboundedPreceding, -1)
    inside = Window.partitionBy(*keys, "_block").orderBy(F.desc(seq)).rowsBetween(*earlier)
    local = blocked.withColumn("_local", F.min("_mark").over(inside))

    side = settle(
        blocked.groupBy(*keys, "_super", "_block").agg(F.min("_mark").alias("_first"))
    )
    totals = side.df
    in_super = Window.partitionBy(*keys, "_super").orderBy(F.desc("_block")).rowsBetween(*earlier)
    blocks = totals.withColumn("_later", F.min("_first").over(in_super))
    supers = totals.groupBy(*keys, "_super").agg(F.min("_first").alias("_first"))
    in_key = Window.partitionBy(*keys).orderBy(F.desc("_super")).rowsBetween(*earlier)
    supers = supers.select(*keys, "_super", F.min("_first").over(in_key).alias("_much_later"))
    following = _on(blocks, supers, [*keys, "_super"]).select(
        *keys, "_block", F.coalesce("_later", "_much_later").alias("_following")
    )
    return (
        _on(local, _sized(following, side), [*keys, "_block"])
        .withColumn(name, F.coalesce("_local", "_following"))
        .drop("_mark", "_block", "_super", "_local", "_following")
    )
