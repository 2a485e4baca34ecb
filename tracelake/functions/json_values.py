"""Typed values from and to JSON, and JSON values as SQL columns.

The JSON token kind comes from the parsed variant, the lexeme from Spark's
exact text extraction: together they tell ``1`` from ``1.0`` and from ``"1"``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tracelake.functions.values import base64_text, bytes_from_base64, value_struct
from tracelake.model import VALUE_TYPES

# ``-0`` is a float: no integer type holds its sign.
_INTEGER_LEXEME = r"\A(?!-0\z)-?[0-9]+\z"


def json_kind(variant: Column) -> Column:
    """``number``, ``string``, ``bool``, ``null``, ``array`` or ``object``."""
    shape = F.schema_of_variant(variant)
    return (
        F.when(shape == "STRING", F.lit("string"))
        .when(shape == "BOOLEAN", F.lit("bool"))
        .when(shape == "VOID", F.lit("null"))
        .when(shape.startswith("ARRAY"), F.lit("array"))
        .when(shape.startswith("OBJECT"), F.lit("object"))
        .when(shape.isNotNull(), F.lit("number"))
    )


def _integer(text: Column) -> Column:
    return F.when(text.rlike(_INTEGER_LEXEME), text.try_cast("decimal(38,0)"))


def typed_from_json(kind: Column, text: Column, data_type: Column) -> Column:
    """``(value, error)`` of one JSON value read as a declared type.

    ``kind`` is from :func:`json_kind`, ``text`` the lexeme (unquoted for a
    string). No coercion: the token kind has to fit the type, integers have to
    be integer lexemes in range. float32 may overflow to infinity.
    """
    number = _integer(text)
    is_number = kind == "number"
    double = F.when(is_number, text.try_cast("double"))
    finite = F.when(F.abs(double) < float("inf"), double)
    raw = F.when(kind == "string", bytes_from_base64(text))

    # timestamps have the range of int64
    bounds = {t.name: (t.low, t.high) for t in VALUE_TYPES if t.is_integer}
    bounds["timestamp[ns]"] = bounds["int64"]

    def bound(which: int) -> Column:
        rows = ", ".join(f"'{name}', {pair[which]}BD" for name, pair in bounds.items())
        return F.try_element_at(F.expr(f"map({rows})"), data_type)

    fits = is_number & number.between(bound(0), bound(1))
    is_wide, is_time = data_type == "uint64", data_type == "timestamp[ns]"
    i = F.when(fits & ~is_wide & ~is_time, number.try_cast("bigint"))
    u = F.when(fits & is_wide, number.try_cast("decimal(20,0)"))
    ts = F.when(fits & is_time, number.try_cast("bigint"))
    f = (
        F.when(data_type == "float32", finite.cast("float").cast("double"))
        .when(data_type == "float64", finite)
    )
    s = F.when((data_type == "string") & (kind == "string"), text)
    b = F.when((data_type == "bool") & (kind == "bool"), text == "true")
    bin_ = F.when(data_type == "binary", raw)

    value = value_struct(data_type, i=i, u=u, f=f, ts=ts, bin=bin_, s=s, b=b)
    filled = [x.isNotNull() for x in (i, u, ts, f, s, b, bin_)]
    found = reduce(lambda a, c: a | c, filled)
    token_fits = (
        (data_type.isin("string", "binary") & (kind == "string"))
        | ((data_type == "bool") & (kind == "bool"))
        | (~data_type.isin("string", "binary", "bool") & is_number)
    )
    error = (
        F.when(data_type.isNull(), F.lit("unknown_type"))
        .when(kind.isNull(), F.lit("invalid_json"))
        .when(~token_fits, F.lit("unsupported_conversion"))
        .when(found, F.lit(None).cast("string"))
        .when(data_type == "binary", F.lit("invalid_base64"))
        .otherwise(F.lit("number_out_of_range"))
    )
    return F.struct(F.when(error.isNull(), value).alias("value"), error.alias("error"))


def json_text(value: Column) -> Column:
    """JSON text of a typed value; null for NaN and infinities, see below."""
    tag = value["tag"]
    number = F.when(~not_json(value), value["f"].cast("string"))
    string = F.when(tag == "binary", base64_text(value["bin"])).when(tag == "string", value["s"])
    # to_json of a one-field struct does the escaping; cut {"v": and } off.
    wrapped = F.to_json(F.struct(string.alias("v")))
    escaped = F.substring(wrapped, F.lit(6), F.length(wrapped) - 6)
    return (
        F.when(tag.isin("binary", "string"), escaped)
        .when(tag == "bool", value["b"].cast("string"))
        .when(tag.isin("float32", "float64"), number)
        .otherwise(
            F.coalesce(
                value["i"].cast("string"), value["u"].cast("string"), value["ts"].cast("string")
            )
        )
    )


def not_json(value: Column) -> Column:
    """True for the floats JSON cannot hold."""
    f = value["f"]
    return F.coalesce(F.isnan(f) | (F.abs(f) == float("inf")), F.lit(False))


def sql_columns(kind: Column, text: Column, data_type: Column) -> Column:
    """JSON value as SQL parameters by declared type.

    A struct ``(text, bytes, time_ns, error)``: base64 strings become bytes for
    binary, numbers become times for timestamps, everything else its text,
    null stays null.
    """
    to_bytes = (kind == "string") & (data_type == "binary")
    to_time = (kind == "number") & (data_type == "timestamp[ns]")
    decoded = F.when(to_bytes, bytes_from_base64(text))
    time_ns = F.when(to_time, _integer(text).try_cast("bigint"))
    plain = F.when(~to_bytes & ~to_time & (kind != "null"), text)
    error = F.when(to_bytes & decoded.isNull(), F.lit("invalid_base64")).when(
        to_time & time_ns.isNull(), F.lit("not_a_time")
    )
    return F.struct(
        plain.alias("text"), decoded.alias("bytes"), time_ns.alias("time_ns"), error.alias("error")
    )
