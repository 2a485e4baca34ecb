"""Subscriptions that change over time, replay and late joiners."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.model import EVENT, LOG_COLUMNS
from tracelake.operators.catalog import fold, snapshot
from tracelake.operators.filters import parse_filters, route, settle_filters
from tracelake.plans.intervals import cut, nodes_of_number
from tracelake.plans.joins import settle
from tracelake.plans.ordered import next_marked

SUBSCRIBE = "subscribe"
UNSUBSCRIBE = "unsubscribe"


def subscription_intervals(commands: DataFrame) -> DataFrame:
    """Validity interval of every subscribe command.

    ``commands``: subscriber_id, seq (arrival, on the log's axis), action,
    filter. A row ends at the next unsubscribe of an equal filter by the same
    subscriber; equality is on the parsed parts, so ``*/*/*`` and a missing
    text are one filter. Commands with a bad filter have no effect.
    """
    parsed = parse_filters(commands).where(F.col("error").isNull())
    # A text that identifies the parsed triple, nulls included.
    identity = F.to_json(F.struct("segment_id", "source_name", "event_name"))
    keyed = parsed.withColumn("_filter", identity)
    ended = next_marked(
        keyed, ["subscriber_id", "_filter"], F.col("action") == UNSUBSCRIBE, "end_seq"
    )
    return ended.where(F.col("action") == SUBSCRIBE).select(
        "subscriber_id",
        F.col("seq").alias("sub_seq"),
        "end_seq",
        "segment_id",
        "source_name",
        "event_name",
    )


def route_subscriptions(log: DataFrame, commands: DataFrame) -> DataFrame:
    """Messages each subscriber receives while its filters are in force.

    The time a filter is in force is cut into nodes of a tree over ``seq``, and a
    message looks for its own nodes on the levels in use: an equi-join that meets
    only what is delivered, however many commands come in a burst.
    """
    intervals = settle(subscription_intervals(commands)).df
    pieces, tree = cut(intervals, "sub_seq", "end_seq")
    filters = settle_filters(pieces)
    # at most as many as the tree has
    levels = sorted(r["_level"] for r in filters.df.select("_level").distinct().collect())

    def with_nodes(messages: DataFrame) -> DataFrame:
        nodes = nodes_of_number(F.col("seq"), tree, levels)
        probed = messages.withColumn("_node", F.explode(nodes))
        return probed.withColumns({"_level": F.col("_node.level"), "_number": F.col("_node.number")}).drop("_node")

    return route(log, filters, narrowed=with_nodes, also_on=["_number", "_level"])


def replay_from(log: DataFrame, start_time_ns: int | None) -> DataFrame:
    """Events not older than a start time; control messages stay.

    ``None`` leaves the log as it is, which is what the wire service does.
    """
    if start_time_ns is None:
        return log
    return log.where((F.col("kind") != EVENT) | (F.col("event.time_ns") >= start_time_ns))


def late_subscriber(log: DataFrame, at_seq: int, filters: DataFrame | None = None) -> DataFrame:
    """What a subscriber joining after message ``at_seq`` receives.

    First the whole catalog as control messages (``part`` 0, never filtered),
    then the live messages that match (``part`` 1). Order by ``part``, then
    ``segment_id, phase, event_name, field_pos`` or ``seq``.
    """
    past = log.where(F.col("seq") <= at_seq)
    live = log.where(F.col("seq") > at_seq)
    if filters is not None:
        live = route(live, filters)
    return (
        snapshot(fold(past))
        .withColumn("part", F.lit(0))
        .unionByName(
            live.select(*LOG_COLUMNS).withColumn("part", F.lit(1)), allowMissingColumns=True
        )
    )
