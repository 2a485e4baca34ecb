"""Type names across systems (T4), as expressions and as a lookup table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.model import TYPE_ALIASES, TYPE_BY_NAME, VALUE_TYPES


def _lookup(pairs, key: Column) -> Column:
    flat = [F.lit(x) for pair in pairs for x in pair]
    return F.try_element_at(F.create_map(*flat), key)


def canonical_type(name: Column, *, extra_spellings: bool = True) -> Column:
    """Canonical name of a type name or alias; null for an unknown name."""
    pairs = [(t.name, t.name) for t in VALUE_TYPES]
    pairs += [(a, c) for a, c in TYPE_ALIASES.items() if extra_spellings or a in ("float", "double")]
    return _lookup(pairs, name)


def type_from_duckdb(name: Column) -> Column:
    return _lookup([(t.duckdb, t.name) for t in VALUE_TYPES], name)


def duckdb_type(name: Column) -> Column:
    return _lookup([(t.name, t.duckdb) for t in VALUE_TYPES], name)


def arrow_type(name: Column) -> Column:
    return _lookup([(t.name, t.arrow) for t in VALUE_TYPES], name)


def spark_type(name: Column) -> Column:
    return _lookup([(t.name, t.spark) for t in VALUE_TYPES], name)


def is_numeric(name: Column) -> Column:
    return _lookup([(t.name, t.numeric) for t in VALUE_TYPES], name)


def type_table(spark: SparkSession) -> DataFrame:
    """The fourteen types as a table; small by construction."""
    rows = [
        (t.name, t.duckdb, t.arrow, t.spark, t.numeric, i + 1) for i, t in enumerate(VALUE_TYPES)
    ]
    return spark.createDataFrame(
        rows, "data_type string, duckdb_type string, arrow_type string, spark_type string, "
        "is_numeric boolean, wire_tag int"
    )


def type_of(name: str):
    """Python-side lookup of one canonical type."""
    return TYPE_BY_NAME[TYPE_ALIASES.get(name, name)]
