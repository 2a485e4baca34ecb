"""Filter texts, matching and routing.

Routing is an equi-join. A filter fixes any subset of (segment, source, event),
so there are eight shapes, and every filter has exactly one key it can be found
under. Whether a message matches depends on its segment, source and event only:
the distinct ones of a log, which are few, are probed once per shape in use. The
log itself is joined with what matched; no message is copied before it matches,
and there are no nested loops, whatever the number of filters.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelake.functions.identifiers import UUID_PATTERN, normalize_uuid
from tracelake.model import EVENT
from tracelake.plans.joins import Settled, lookup_join, settle


def parse_filters(texts: DataFrame, column: str = "filter") -> DataFrame:
    """Add segment_id, source_name, event_name and ``error`` of filter texts (F1).

    Null in a part means any; a null text matches everything. An empty part is
    a literal empty string.
    """
    pieces = F.split(F.col(column), "/", 3)
    segment = F.try_element_at(pieces, F.lit(1))
    error = (
        F.when(F.col(column).isNull(), F.lit(None).cast("string"))
        .when(F.size(pieces) < 3, F.lit("missing_separator"))
        .when((segment != "*") & ~segment.rlike(UUID_PATTERN), F.lit("invalid_uuid"))
    )
    good = F.col("error").isNull()

    def part(at: int) -> Column:
        piece = F.try_element_at(pieces, F.lit(at))
        return F.when(good & (piece != "*"), piece)

    return texts.withColumn("error", error).select(
        *texts.columns,
        F.when(good & (segment != "*"), normalize_uuid(segment)).alias("segment_id"),
        part(2).alias("source_name"),
        part(3).alias("event_name"),
        "error",
    )


def where_filter(
    log: DataFrame,
    segment_id: str | None = None,
    source_name: str | None = None,
    event_name: str | None = None,
) -> DataFrame:
    """Messages matching one filter known up front (F2): a plain, pushed-down where.

    A filter with an event name matches events only.
    """
    if segment_id is not None:
        log = log.where(F.col("segment_id") == segment_id)
    if source_name is not None:
        log = log.where(F.col("source_name") == source_name)
    if event_name is not None:
        log = log.where((F.col("kind") == EVENT) & (F.col("event.name") == event_name))
    return log


def _filter_keys(filters: DataFrame) -> DataFrame:
    parts = ("segment_id", "source_name", "event_name")
    shape = F.lit(0)
    for bit, part in enumerate(parts):
        shape = shape + F.when(F.col(part).isNotNull(), F.lit(1 << bit)).otherwise(F.lit(0))
    return filters.select(
        *[c for c in filters.columns if c not in parts],
        shape.cast("int").alias("_shape"),
        *[F.coalesce(F.col(p), F.lit("")).alias(f"_k_{p}") for p in parts],
    )


_KEYS = ["_shape", "_k_segment_id", "_k_source_name", "_k_event_name"]
_PLACE = ["_p_segment", "_p_source", "_p_event"]


def settle_filters(filters: DataFrame) -> Settled:
    """Filters computed and measured once, for routing several times."""
    return settle(_filter_keys(filters))


def _with_place(log: DataFrame) -> DataFrame:
    """What matching depends on, never null: segment, source, and event or control."""
    named = lambda c: F.coalesce(F.concat(F.lit("="), c), F.lit(""))
    return log.withColumns({
        "_p_segment": named(F.col("segment_id")),
        "_p_source": named(F.col("source_name")),
        "_p_event": F.when(F.col("kind") == EVENT, named(F.col("event.name"))).otherwise("control"),
    })


def _shapes(keys: DataFrame) -> list[int]:
    """The shapes in use: eight at most, by construction."""
    return sorted(r["_shape"] for r in keys.select("_shape").distinct().collect())


def _probe(shape: int, segment: Column, source: Column, event: Column) -> Column:
    """The key of a shape that a message is looked up under; a null part meets no filter."""
    empty = F.lit("")
    return F.struct(
        F.lit(shape).alias("_shape"),
        (segment if shape & 1 else empty).alias("_k_segment_id"),
        (source if shape & 2 else empty).alias("_k_source_name"),
        (event if shape & 4 else empty).alias("_k_event_name"),
    )


def _matches(placed: DataFrame, keys: DataFrame) -> DataFrame:
    """The filter keys that each distinct place of the log matches, eight at most."""
    # null for what is missing or a control message
    value = lambda c: F.when(F.col(c).startswith("="), F.substring(c, 2, 1 << 30))
    probes = [_probe(shape, *map(value, _PLACE)) for shape in _shapes(keys) or [0]]
    places = placed.select(*_PLACE).distinct()
    probed = places.select(*_PLACE, F.explode(F.array(*probes)).alias("_probe"))
    return lookup_join(
        probed.select(*_PLACE, "_probe.*"), keys.select(*_KEYS).distinct(), _KEYS, "left_semi",
        spread_by="_p_segment",
    )


def _keyed_in_place(log: DataFrame, keys: DataFrame) -> DataFrame:
    """Each message once per filter key that it matches, without a shuffle.

    One look-up per shape marks the message; only marked keys are copied out.
    """
    event = F.when(F.col("kind") == EVENT, F.col("event.name"))
    probes = []
    for shape in _shapes(keys):
        probe = _probe(shape, F.col("segment_id"), F.col("source_name"), event)
        fixed = [part for bit, part in enumerate(_KEYS[1:]) if shape >> bit & 1]
        if not fixed:
            probes.append(probe)
            continue
        mark = f"_hit_{shape}"
        there = keys.where(F.col("_shape") == shape).select(
            *[F.col(c).alias(f"{mark}{c}") for c in fixed], F.lit(True).alias(mark)
        ).distinct()
        condition = F.lit(True)
        for part in fixed:
            condition = condition & (probe[part] == F.col(f"{mark}{part}"))
        log = log.join(F.broadcast(there), condition, "left").drop(*[f"{mark}{c}" for c in fixed])
        probes.append(F.when(F.col(mark), probe))
    marks = [c for c in log.columns if c.startswith("_hit_")]
    hits = F.filter(F.array(*probes), lambda p: p.isNotNull())
    return log.withColumn("_probe", F.explode(hits)).drop(*marks).select("*", "_probe.*").drop("_probe")


def route(
    log: DataFrame,
    filters: DataFrame | Settled,
    narrowed: Callable[[DataFrame], DataFrame] | None = None,
    also_on: Sequence[str] = (),
) -> DataFrame:
    """One copy of each message per matching filter.

    ``filters`` has subscriber_id, segment_id, source_name, event_name and any
    further columns, which are carried along. Bag semantics: a message that
    matches two filters of one subscriber is delivered twice; a subscriber to
    everything is one all-null filter; no filters, no rows. ``also_on`` names
    columns of the filters that have to be equal as well; ``narrowed`` gives them
    to the messages that match a filter so far. The filters, and the places of the
    log if they are needed, are computed while the plan is built.
    """
    side = filters if isinstance(filters, Settled) else settle_filters(filters)
    # what differs most comes first: sorting for a join looks at the first key before all
    keys = [*also_on, *_KEYS]
    if side.broadcastable and _shapes(side.df):
        keyed = _keyed_in_place(log, side.df)
        if narrowed is not None:
            keyed = narrowed(keyed)
        return lookup_join(keyed, side, keys).drop(*keys)
    placed = _with_place(log)
    matches = _matches(placed, side.df)
    if narrowed is None:
        rows = lookup_join(matches, side, _KEYS, spread_by="_p_segment").drop(*_KEYS)
        return lookup_join(placed, rows, _PLACE).drop(*_PLACE)
    # what is compared further are numbers; payloads meet what is delivered
    slim = placed.select("seq", *_PLACE)
    keyed = narrowed(lookup_join(slim, matches, _PLACE).drop(*_PLACE))
    delivered = lookup_join(keyed, side, keys).drop(*keys)
    return log.join(delivered, "seq")
