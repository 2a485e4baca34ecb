"""Do events and schemas keep the declared rules (V1-V4).

Optional lake jobs: they report, and never change what routing or the fold see.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelake.model import EVENT, EVENT_SCHEMA
from tracelake.operators.catalog import Catalog
from tracelake.plans.joins import lookup_join

NO_SCHEMA = "event_not_found"
NO_FIELD = "field_not_found"
WRONG_TYPE = "type_mismatch"


def check_events(log: DataFrame, catalog: Catalog) -> DataFrame:
    """Events with ``error`` (V3) and ``field_errors``, an array of
    (field, code, expected, found) for each offending field (V1).

    Types must be equal; there is no coercion. Missing fields are allowed. One
    join per event row; fields are compared inside the row.
    """
    # name -> type of each schema, the first definition of a repeated name
    names = F.transform("fields", lambda d: d["name"])
    first = F.filter("fields", lambda d, at: F.array_position(names, d["name"]) == at + 1)
    entries = F.transform(
        first, lambda d: F.struct(d["name"].alias("k"), d["data_type"].alias("v"))
    )
    declared = catalog.event_schemas.select(
        "segment_id",
        F.col("event_name").alias("_event"),
        F.map_from_entries(entries).alias("_declared"),
    )
    events = log.where(F.col("kind") == EVENT).withColumn("_event", F.col("event.name"))
    joined = lookup_join(events, declared, ["segment_id", "_event"], "left")

    def verdict(x: Column) -> Column:
        expected = F.try_element_at("_declared", x["name"])
        found = x["value"]["tag"]
        return F.struct(
            x["name"].alias("field"),
            F.when(expected.isNull(), F.lit(NO_FIELD))
            .when(expected != found, F.lit(WRONG_TYPE))
            .alias("code"),
            expected.alias("expected"),
            found.alias("found"),
        )

    errors = F.filter(F.transform("event.fields", verdict), lambda v: v["code"].isNotNull())
    known = F.col("_declared").isNotNull()
    return joined.withColumns(
        {
            "error": F.when(~known, F.lit(NO_SCHEMA)),
            "field_errors": F.when(known, errors).otherwise(F.array().cast(errors_type())),
        }
    ).drop("_event", "_declared")


def errors_type() -> str:
    return "array<struct<field: string, code: string, expected: string, found: string>>"


def conforming(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("error").isNull() & (F.size("field_errors") == 0)).drop(
        "error", "field_errors"
    )


def rejected(checked: DataFrame) -> DataFrame:
    """The quarantine: one row per problem."""
    whole = F.array(
        F.struct(
            F.lit(None).cast("string").alias("field"),
            F.col("error").alias("code"),
            F.lit(None).cast("string").alias("expected"),
            F.lit(None).cast("string").alias("found"),
        )
    )
    problems = F.when(F.col("error").isNotNull(), whole).otherwise(F.col("field_errors"))
    return checked.withColumn("problem", F.explode(problems)).select(
        "seq", "segment_id", F.col("event.name").alias("event_name"), "problem.*"
    )


def unregistered_events(log: DataFrame, catalog: Catalog) -> DataFrame:
    """Events whose name has no schema in their segment (V3)."""
    known = catalog.event_schemas.select("segment_id", F.col("event_name").alias("_event"))
    events = log.where(F.col("kind") == EVENT).withColumn("_event", F.col("event.name"))
    return lookup_join(events, known, ["segment_id", "_event"], "left_anti").drop("_event")


def duplicate_schemas(log: DataFrame, catalog: Catalog) -> DataFrame:
    """Schema messages for a name that is already defined (V2)."""
    first = catalog.event_schemas.select("segment_id", "event_name", "schema_seq")
    again = log.where(F.col("kind") == EVENT_SCHEMA).withColumn(
        "event_name", F.col("event_schema.name")
    )
    return lookup_join(
        again,
        first,
        ["segment_id", "event_name"],
        residual=lambda left, right: left["seq"] > right["schema_seq"],
    )


def dedupe_schema_fields(fields: Column) -> Column:
    """Field definitions with the last one kept for a repeated name (V4)."""
    return F.filter(
        fields,
        lambda x, at: ~F.exists(
            F.slice(fields, at + 2, F.greatest(F.size(fields) - at - 1, F.lit(0))),
            lambda later: later["name"] == x["name"],
        ),
    )
