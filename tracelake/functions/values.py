"""Column expressions over typed values: build, compare, print, extract.

A typed value is the struct of ``model.VALUE_DDL``. Everything here is built-in
Spark expressions; no UDFs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tracelake.functions.types import type_of
from tracelake.model import INTEGER_TYPES, VALUE_TYPES

_SLOTS = (
    ("i", "bigint"),
    ("u", "decimal(20,0)"),
    ("f", "double"),
    ("ts", "bigint"),
    ("bin", "binary"),
    ("s", "string"),
    ("b", "boolean"),
)


def value_struct(tag: Column, **slots: Column) -> Column:
    """Typed value from a tag column and the slots that are set."""
    parts = [tag.cast("string").alias("tag")]
    for slot, ddl in _SLOTS:
        if slot in slots:
            parts.append(slots[slot].cast(ddl).alias(slot))
        else:
            parts.append(F.expr(f"CAST(NULL AS {ddl}) AS {slot}"))
    return F.struct(*parts)


def typed(data_type: str, content: Column) -> Column:
    """Typed value of one fixed type. float32 is rounded to single first."""
    kind = type_of(data_type)
    if kind.name == "float32":
        content = content.cast("float")
    return value_struct(F.lit(kind.name), **{kind.slot: content})


def value_sql(data_type: str, content: str) -> str:
    """SQL text of :func:`typed`, for jobs written as SQL."""
    kind = type_of(data_type)
    parts = [f"'tag', '{kind.name}'"]
    for slot, ddl in _SLOTS:
        parts.append(f"'{slot}', CAST({content if slot == kind.slot else 'NULL'} AS {ddl})")
    return f"named_struct({', '.join(parts)})"


def field(name: str, value: Column) -> Column:
    """One ``(name, value)`` entry of an event."""
    return F.struct(F.lit(name).alias("name"), value.alias("value"))


def last_per_name(fields: Column) -> Column:
    """Event fields with the last entry kept for a repeated name.

    Rows without a repeat, nearly all, take the cheap branch.
    """
    names = F.transform(fields, lambda x: x["name"])
    deduped = F.filter(
        fields,
        lambda x, at: ~F.exists(
            F.slice(fields, at + 2, F.greatest(F.size(fields) - at - 1, F.lit(0))),
            lambda later: later["name"] == x["name"],
        ),
    )
    return F.when(F.size(F.array_distinct(names)) == F.size(fields), fields).otherwise(deduped)


def value_of(fields: Column, name: Column) -> Column:
    """The value stored under a name (last entry wins), null where absent."""
    return F.try_element_at(F.filter(fields, lambda x: x["name"] == name), F.lit(-1))["value"]


def is_integer_tag(tag: Column) -> Column:
    return tag.isin(*INTEGER_TYPES)


def as_number(value: Column) -> Column:
    """Any integer-tagged value as DECIMAL(20,0); null for every other tag."""
    return F.when(
        is_integer_tag(value["tag"]), F.coalesce(value["i"].cast("decimal(20,0)"), value["u"])
    )


def as_type(value: Column, data_type: str) -> Column:
    """The value in its Spark type if the tag is exactly this type."""
    kind = type_of(data_type)
    return F.when(value["tag"] == kind.name, value[kind.slot].cast(kind.spark))


def _float_magnitude(value: Column) -> Column:
    """Spark's text of the absolute number, in the precision of the tag."""
    f = F.abs(value["f"])
    return F.when(value["tag"] == "float32", f.cast("float").cast("string")).otherwise(
        f.cast("string")
    )


def float_text(value: Column) -> Column:
    """A float value as plain decimal digits: ``3``, ``0.0000001``, ``inf``, ``NaN``.

    Spark writes large and small numbers as ``d.dddE<power>``; the digits are
    moved around the point here.
    """
    text = _float_magnitude(value)
    digits = F.regexp_replace(F.substring_index(text, "E", 1), r"\.0\z|\.", "")
    power = F.substring_index(text, "E", -1).try_cast("int")
    large = F.concat(
        F.rpad(F.substring(digits, F.lit(1), power + 1), power + 1, F.lit("0")),
        F.when(
            F.length(digits) > power + 1, F.concat(F.lit("."), F.substring(digits, power + 2, F.lit(20)))
        ).otherwise(F.lit("")),
    )
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), digits)
    plain = F.when(
        text.endswith(".0"), F.substring(text, F.lit(1), F.length(text) - 2)
    ).otherwise(text)
    magnitude = (
        F.when(text == "Infinity", F.lit("inf"))
        .when(~text.contains("E"), plain)
        .when(power > 0, large)
        .otherwise(small)
    )
    negative = value["f"].cast("string").startswith("-")
    return F.concat(F.when(negative, F.lit("-")).otherwise(F.lit("")), magnitude)


def render(value: Column) -> Column:
    """Text of a value (T3). Exactly one slot is set, so the first one found is it."""
    return F.coalesce(
        value["i"].cast("string"),
        value["s"],
        value["u"].cast("string"),
        value["ts"].cast("string"),
        value["b"].cast("string"),
        base64_text(value["bin"]),
        float_text(value),
    )


def canonical_key(value: Column) -> Column:
    """Text that is equal exactly when two values of one tag are equal.

    Doubles go through their text so that the sign of zero is kept.
    """
    single = value["f"].cast("float").cast("string")
    return F.coalesce(
        value["i"].cast("string"),
        value["s"],
        value["u"].cast("string"),
        value["ts"].cast("string"),
        value["b"].cast("string"),
        F.hex(value["bin"]),
        F.when(value["tag"] == "float32", single).otherwise(value["f"].cast("string")),
    )


def base64_text(raw: Column) -> Column:
    """Standard base64 on one line (Spark may break long lines)."""
    return F.translate(F.base64(raw), "\r\n", "")


# Canonical base64 with required padding and zero trailing bits.
BASE64_PATTERN = (
    r"\A(?:[A-Za-z0-9+/]{4})*"
    r"(?:[A-Za-z0-9+/][AQgw]==|[A-Za-z0-9+/]{2}[AEIMQUYcgkosw048]=)?\z"
)


def bytes_from_base64(text: Column) -> Column:
    """Decoded bytes, null where the text is not canonical base64."""
    return F.when(text.rlike(BASE64_PATTERN), F.unbase64(text))


def in_range(value: Column) -> Column:
    """Whether an integer carrier fits its tag; true for other tags.

    Wire data may carry unsigned numbers in ``u`` whatever their width.
    """
    ok = F.lit(True)
    for kind in VALUE_TYPES:
        if not kind.is_integer or kind.name in ("int64", "uint64"):
            continue
        low, high = kind.low, kind.high
        fits = F.coalesce(
            value["i"].between(low, high),
            value["u"].between(F.lit(low).cast("decimal(20,0)"), F.lit(high).cast("decimal(20,0)")),
            F.lit(False),
        )
        ok = F.when(value["tag"] == kind.name, fits).otherwise(ok)
    return ok


def settle_slots(value: Column) -> Column:
    """Move an in-range wire value into the slots of the log's layout."""
    tag = value["tag"]
    wide = tag == "uint64"
    small_int = is_integer_tag(tag) & ~wide
    return value_struct(
        tag,
        i=F.when(small_int, F.coalesce(value["i"], value["u"].cast("bigint"))),
        u=F.when(wide, F.coalesce(value["u"], value["i"].cast("decimal(20,0)"))),
        f=value["f"],
        ts=value["ts"],
        bin=value["bin"],
        s=value["s"],
        b=value["b"],
    )


def has_content(value: Column) -> Column:
    """Whether a wire value is present: a tag, and the slot the tag asks for."""
    tag = value["tag"]
    present = F.lit(False)
    for slot in ("f", "ts", "bin", "s", "b"):
        names = [t.name for t in VALUE_TYPES if t.slot == slot]
        present = F.when(tag.isin(*names), value[slot].isNotNull()).otherwise(present)
    present = F.when(
        is_integer_tag(tag), value["i"].isNotNull() | value["u"].isNotNull()
    ).otherwise(present)
    return F.coalesce(present, F.lit(False))
