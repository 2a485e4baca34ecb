"""Outgoing batches that close by count or by time (S3).

A batch begins with a message, takes up to ``batch_size`` of them, and closes when
``timeout_ns`` have passed since its first one arrived. Where a batch ends depends
on where it began, so the rule is sequential; it is worked out in blocks of
positions all the same:

1. Every message of a block points to where a batch begun there would end, at most
   ``batch_size`` positions on. Pointers are doubled until they leave the block. So
   for each of its first ``batch_size`` positions, where alone a batch can be the
   first to begin in it, it is known at which of the next block the first one begins.
2. Such tables of neighbouring blocks are put together, first of many blocks, then
   of a stream, and the beginnings handed back down.
3. Each block follows its pointers from its known beginning, by powers of two.

Only positions and times go through these steps, as arrays of bounded length; messages
are joined with what comes out. A stream of one key is thereby worked on by as many
tasks as it has blocks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracelake.operators.batching import PUBLISH_BATCH
from tracelake.plans.joins import written
from tracelake.plans.ordered import running_max, running_number

# Fixed value: how long a batch waits for more messages.
PUBLISH_TIMEOUT_NS = 100_000_000
# Positions of a block, and blocks that are put together in one group.
BLOCK_POSITIONS = 1 << 14
SUPER_BLOCKS = 1 << 8
# The clock before the first message that has a time.
NO_TIME = -(1 << 62)


def _pointers(blocked: DataFrame, batch_size: int, timeout_ns: int, block: int) -> DataFrame:
    """Per block where a batch begun at each of its places ends, as places in the block.

    Places past the block's own, up to ``bound``, are of the next one.
    """
    until = Window.partitionBy("_stream", "_block").orderBy("_clock").rangeBetween(
        Window.unboundedPreceding, timeout_ns - 1
    )
    index = (F.col("_place") - F.col("_block") * block).cast("int")
    ends = F.least(F.count(F.lit(1)).over(until).cast("int"), index + batch_size)
    rows = F.array_sort(F.collect_list(F.struct("index", "ends")))
    return (
        blocked.select("_stream", "_block", index.alias("index"), ends.alias("ends"))
        .groupBy("_stream", "_block").agg(rows.alias("rows"))
        .select(
            "_stream", "_block", F.transform("rows", lambda r: r["ends"]).alias("ends"),
            F.least(F.size("rows"), F.lit(block)).alias("bound"),
        )
    )


def _step(pointers: Column, bound: Column) -> Column:
    """Pointers followed once more, unless they have left the block."""
    return F.transform(pointers, lambda to: F.when(to >= bound, to).otherwise(F.get(pointers, to)))


def _held(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once, not for each use."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _exits(batch_size: int, block: int) -> Column:
    """For each possible first beginning of a block that of the next one."""
    bound = F.col("bound")
    out = F.aggregate(
        F.sequence(F.lit(1), F.lit(block.bit_length())), F.col("ends"), lambda to, _: _step(to, bound)
    )
    entries = F.sequence(F.lit(0), F.lit(batch_size - 1))
    return _held(out, lambda to: F.transform(
        entries, lambda k: F.when((k < bound) & (bound == block), F.get(to, k) - block).otherwise(F.lit(0))
    ))


def _together(exits: Column, batch_size: int) -> Column:
    """The table of neighbouring blocks as of one."""
    return F.aggregate(
        exits, F.sequence(F.lit(0), F.lit(batch_size - 1)),
        lambda to, t: F.transform(to, lambda k: F.get(t["exits"], k)),
    )


def _threaded(tables: Column, entry: Column) -> Column:
    """Where the first batch of each block begins, from that of the first block."""
    none = F.array().cast("array<struct<number: bigint, entry: int>>")
    return F.aggregate(
        tables, F.struct(entry.alias("entry"), none.alias("found")),
        lambda held, t: F.struct(
            F.get(t["exits"], held["entry"]).alias("entry"),
            F.concat(
                held["found"],
                F.array(F.struct(t["number"].alias("number"), held["entry"].alias("entry"))),
            ).alias("found"),
        ),
        lambda held: held["found"],
    )


def _begins(entry: Column, block: int) -> Column:
    """The places of a block at which batches begin: its pointers followed k times, for all k."""
    bound, rounds = F.col("bound"), block.bit_length()
    levels = F.aggregate(
        F.sequence(F.lit(1), F.lit(rounds - 1)), F.array("ends"),
        lambda held, _: F.concat(held, F.array(_step(F.element_at(held, -1), bound))),
    ) if rounds > 1 else F.array("ends")

    def nth(levels: Column, k: Column) -> Column:
        return F.aggregate(
            F.sequence(F.lit(0), F.lit(rounds - 1)), entry,
            lambda at, level: F.when(
                (F.getbit(k, level) == 1) & (at < bound), F.get(F.get(levels, level), at)
            ).otherwise(at),
        )

    places = _held(levels, lambda held: F.transform(F.sequence(F.lit(0), bound - 1), lambda k: nth(held, k)))
    return F.filter(places, lambda at: at < bound)


def number_timed_batches(
    log: DataFrame,
    stream_keys: Sequence[str],
    time: Column | None = None,
    *,
    batch_size: int = PUBLISH_BATCH,
    timeout_ns: int = PUBLISH_TIMEOUT_NS,
) -> DataFrame:
    """Add ``batch_no`` and ``batch_pos`` to messages, ordered by ``seq`` in their stream.

    ``time`` is when a message arrived, by default its own time. Clocks do not run
    back: a message whose time is earlier, or that has none, arrives with the
    latest one before it. A message that arrives ``timeout_ns`` after the first one
    of a batch is in the next batch. Null keys are a stream like any other.
    """
    block = BLOCK_POSITIONS
    if batch_size > block:
        raise ValueError(f"a batch holds at most {block} messages")
    if batch_size < 1 or timeout_ns < 1:
        raise ValueError("a batch takes a message and some time")
    if time is None:
        time = F.coalesce("segment_start.time_ns", "segment_end.time_ns", "event.time_ns")
    stream = F.to_json(F.struct(*[F.col(f"`{k}`") for k in stream_keys])) if stream_keys else F.lit("")
    narrow = log.select("seq", stream.alias("_stream"), time.alias("_time"))
    clocked = running_max(narrow, ["_stream"], F.coalesce("_time", F.lit(NO_TIME)), "_clock").drop("_time")
    placed = written(running_number(clocked, ["_stream"], "_place"))
    # each message is in its block, and the first ones of a block also in the one before
    own = F.floor(F.col("_place") / block).cast("bigint")
    early = (F.col("_place") % block < batch_size) & (own > 0)
    blocked = placed.select(
        "_stream", "_place", "_clock",
        F.explode(F.when(early, F.array(own, own - 1)).otherwise(F.array(own))).alias("_block"),
    )
    pointers = written(_pointers(blocked, batch_size, timeout_ns, block))
    upper = F.floor(F.col("_block") / SUPER_BLOCKS).cast("bigint").alias("_super")
    tables = F.array_sort(F.collect_list(F.struct(F.col("_block").alias("number"), "exits"))).alias("tables")
    supers = written(
        pointers.select("_stream", "_block", upper, _exits(batch_size, block).alias("exits"))
        .groupBy("_stream", "_super").agg(tables)
    )
    of_stream = F.array_sort(F.collect_list(F.struct(F.col("_super").alias("number"), "exits")))
    entries = (
        supers.select("_stream", "_super", _together(F.col("tables"), batch_size).alias("exits"))
        .groupBy("_stream").agg(of_stream.alias("tables"))
        .select("_stream", F.inline(_threaded(F.col("tables"), F.lit(0))))
        .withColumnRenamed("number", "_super")
    )
    handed = (
        supers.join(entries, ["_stream", "_super"])
        .select("_stream", F.inline(_threaded(F.col("tables"), F.col("entry"))))
        .withColumnRenamed("number", "_block")
    )
    begins = (
        pointers.join(handed, ["_stream", "_block"])
        .select("_stream", "_block", F.explode(_begins(F.col("entry"), block)).alias("at"))
        .select("_stream", (F.col("_block") * block + F.col("at")).alias("_place"), F.lit(1).alias("_begins"))
    )
    marked = written(
        placed.select("seq", "_stream", "_place").join(begins, ["_stream", "_place"], "left")
        .withColumn("_begins", F.coalesce("_begins", F.lit(0)))
    )
    begun = running_max(
        marked, ["_stream"], F.when(F.col("_begins") == 1, F.col("_place")), "_begun", seq="_place"
    )
    numbered = running_number(begun, ["_stream"], "_earlier", seq="_place", weight=F.col("_begins")).select(
        "seq",
        (F.col("_earlier") + F.col("_begins") - 1).alias("batch_no"),
        (F.col("_place") - F.col("_begun")).alias("batch_pos"),
    )
    return log.join(numbered, "seq")
