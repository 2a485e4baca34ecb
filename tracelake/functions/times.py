"""Nanosecond event times next to Spark's microsecond timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ns_remainder(ns: Column) -> Column:
    """The 0..999 ns that a microsecond timestamp cannot hold."""
    return F.pmod(ns, F.lit(1000).cast("bigint"))


def ns_to_micros(ns: Column) -> Column:
    """Whole microseconds, rounded towards minus infinity, in integer arithmetic.

    The division is exact for negative times too; subtracting the remainder
    first would overflow at the low end, so it corrects the quotient instead.
    """
    quotient = F.call_function("div", ns, F.lit(1000).cast("bigint"))
    return quotient - F.when(ns % 1000 < 0, F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def ns_to_timestamp(ns: Column) -> Column:
    """UTC timestamp for windowing. The ns column stays the truth."""
    return F.timestamp_micros(ns_to_micros(ns))


def timestamp_to_ns(ts: Column) -> Column:
    return F.unix_micros(ts) * 1000


def now_ns() -> Column:
    return timestamp_to_ns(F.current_timestamp())
