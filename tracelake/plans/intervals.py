"""Intervals of ``seq`` as nodes of a tree, so that stabbing them is an equi-join.

A node (level, number) stands for the numbers whose ``level`` last digits, to the
base ``2**BITS``, are left open. An interval is cut into the fewest nodes that
cover it, some per level; a number lies in it exactly if one of the number's own
nodes, one per level, is among them, and then it is just one. Numbers are counted
from the lowest edge and end behind the highest, so that the tree is only as high as
the edges are apart.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A node has 2**BITS children: more make fewer nodes of a number and more of an
# interval (at most 2 * (2**BITS - 1) a level).
BITS = 2


@dataclass(frozen=True)
class Tree:
    low: int
    levels: int

    @property
    def last(self) -> int:
        """The number that stands for all behind the highest edge."""
        return (1 << BITS * self.levels) - 1


def tree_over(low: int | None, high: int | None) -> Tree:
    low, high = low or 0, high or 0
    span = high - low + 2
    if span >= 1 << 62:
        raise ValueError("edges too far apart to be counted in 62 bits")
    return Tree(low, max(1, -(-span.bit_length() // BITS)))


def _number(seq: Column, tree: Tree) -> Column:
    # clipped before it is subtracted from, so that nothing overflows
    at = F.greatest(F.least(seq, F.lit(tree.low + tree.last)), F.lit(tree.low))
    return at - F.lit(tree.low)


def _above(number: Column, level: Column) -> Column:
    """The first node of a level that begins at a number or after it."""
    return _open(number - 1, level) + 1


def _below(number: Column, level: Column) -> Column:
    """The node of a level that holds the number: the first one not to end before it."""
    return _open(number, level)


def _open(number: Column, level: Column | int) -> Column:
    if isinstance(level, int):
        # a shift by 64 would be none
        return F.shiftright(number, min(BITS * level, 63))
    return F.call_function("shiftright", number, F.least(level * BITS, F.lit(63)))


def nodes_of_number(seq: Column, tree: Tree, levels: list[int]) -> Column:
    """The nodes of a number on the given levels."""
    number = _number(seq, tree)
    return F.array(*[
        F.struct(F.lit(level).alias("level"), _open(number, level).alias("number"))
        for level in levels
    ]).cast("array<struct<level: int, number: bigint>>")


def cut(intervals: DataFrame, after: str, before: str) -> tuple[DataFrame, Tree]:
    """One row per node of each interval, with ``_level`` and ``_number``.

    The nodes cover the numbers above ``after`` and below ``before``. A null ``before``
    has no end; an empty interval has no node. Only levels are gone through whose
    nodes are not wider than the interval.
    """
    edges = intervals.agg(
        F.min(after).alias("low"), F.max(F.greatest(after, before)).alias("high")
    ).first()
    tree = tree_over(edges["low"], edges["high"])
    low = _number(F.col(after), tree) + 1
    high = F.when(F.col(before).isNotNull(), _number(F.col(before), tree)).otherwise(F.lit(tree.last + 1))
    width = F.col("_high") - F.col("_low")
    # one level more than the logarithm says, in case it is rounded
    top = F.least(F.lit(tree.levels), (F.floor(F.log2(width) / BITS) + 1).cast("int"))
    level = F.col("_level")
    begin, end = _above(F.col("_low"), level), _below(F.col("_high"), level)
    begin_up, end_up = _above(F.col("_low"), level + 1), _below(F.col("_high"), level + 1)
    spans = (
        intervals.withColumns({"_low": low, "_high": high})
        .where("_low < _high")
        .withColumn("_level", F.explode(F.sequence(F.lit(0), top)))
        .withColumns({"_begin": begin, "_end": end, "_begin_up": begin_up, "_end_up": end_up})
        .where("_begin < _end")
    )
    # children of whole parents are left to them
    wide = F.col("_begin_up") <= F.col("_end_up")
    left = _numbers(F.col("_begin"), F.when(wide, F.shiftleft("_begin_up", BITS)).otherwise(F.col("_end")))
    right = F.when(wide, _numbers(F.shiftleft("_end_up", BITS), F.col("_end"))).otherwise(_none())
    pieces = spans.withColumn("_number", F.explode(F.concat(left, right)))
    return pieces.drop("_low", "_high", "_begin", "_end", "_begin_up", "_end_up"), tree


def _numbers(begin: Column, end: Column) -> Column:
    """Numbers from ``begin`` up to, not including, ``end``."""
    return F.when(begin < end, F.sequence(begin, end - 1)).otherwise(_none())


def _none() -> Column:
    return F.array().cast("array<bigint>")
