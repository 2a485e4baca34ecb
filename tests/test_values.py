import math
import random
import struct
from decimal import Decimal

from pyspark.sql import functions as F

from tracelake.functions import json_values as J
from tracelake.functions import types as Y
from tracelake.functions import values as V
from tracelake.functions.times import ns_remainder, ns_to_micros, ns_to_timestamp, timestamp_to_ns
from tracelake.model import VALUE_DDL, VALUE_TYPES
from tests.messages import value


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


JSON_CASES = [
    ("300", "int8", "number_out_of_range"),
    ("127", "int8", 127),
    ("-128", "int8", -128),
    ("1.5", "int32", "number_out_of_range"),
    ("1.0", "int32", "number_out_of_range"),
    ("1e2", "int32", "number_out_of_range"),
    ("-1", "uint8", "number_out_of_range"),
    ("255", "uint8", 255),
    ("18446744073709551615", "uint64", Decimal(2**64 - 1)),
    ("18446744073709551616", "uint64", "number_out_of_range"),
    ("9223372036854775808", "int64", "number_out_of_range"),
    ("-9223372036854775808", "int64", -(2**63)),
    ("1e300", "float32", math.inf),
    ("-1e300", "float32", -math.inf),
    ("0.1", "float32", struct.unpack("f", struct.pack("f", 0.1))[0]),
    ("7", "float64", 7.0),
    ("1e400", "float64", "number_out_of_range"),
    ("1", "bool", "unsupported_conversion"),
    ("true", "bool", True),
    ("false", "bool", False),
    ('"true"', "bool", "unsupported_conversion"),
    ('"AQID"', "binary", b"\x01\x02\x03"),
    ('"AQI"', "binary", "invalid_base64"),
    ('"AQ=="', "binary", b"\x01"),
    ('"AR=="', "binary", "invalid_base64"),
    ('"A QID"', "binary", "invalid_base64"),
    ('""', "binary", b""),
    ('"1"', "timestamp[ns]", "unsupported_conversion"),
    ("1699564234567890123", "timestamp[ns]", 1699564234567890123),
    ("1", "string", "unsupported_conversion"),
    ('"1"', "string", "1"),
    ('"a\\n\\"b\\u00e9"', "string", 'a\n"bé'),
    ("null", "int8", "unsupported_conversion"),
    ("null", "string", "unsupported_conversion"),
    ("[1]", "int8", "unsupported_conversion"),
    ("oops", "int8", "invalid_json"),
]


def test_json_to_typed(spark):
    docs = spark.createDataFrame(
        [(n, '{"v": %s}' % text, t) for n, (text, t, _) in enumerate(JSON_CASES)],
        "n int, doc string, t string",
    )
    kind = J.json_kind(F.try_variant_get(F.try_parse_json("doc"), "$.v", "variant"))
    lexeme = F.try_element_at(F.from_json("doc", "map<string,string>"), F.lit("v"))
    rows = docs.select("n", J.typed_from_json(kind, lexeme, F.col("t")).alias("r")).collect()
    assert len(rows) == len(JSON_CASES)
    for n, r in rows:
        text, data_type, want = JSON_CASES[n]
        got = r.error or r.value[V.type_of(data_type).slot]
        assert (got, type(got) is str) == (want, type(want) is str), (text, data_type)
        assert (r.value is None) == (r.error is not None)


def test_unknown_declared_type(spark):
    r = one(spark, J.typed_from_json(F.lit("number"), F.lit("1"), F.lit(None).cast("string")))
    assert r.error == "unknown_type"


def literal(tag, content):
    return V.typed(tag, F.lit(Decimal(content) if tag == "uint64" else content))


JSON_TEXTS = [
    ("float64", 6.5, "6.5"), ("float32", 0.5, "0.5"), ("binary", b"\x01\x02\x03", '"AQID"'),
    ("uint64", 2**64 - 1, "18446744073709551615"), ("string", 'a"b\n', '"a\\"b\\n"'),
    ("string", "", '""'), ("bool", False, "false"), ("timestamp[ns]", -1, "-1"),
    ("int8", -8, "-8"), ("float64", math.nan, None), ("float64", -math.inf, None),
    ("float32", struct.unpack("f", struct.pack("f", 0.1))[0], "0.10000000149011612"),
]


def values_table(spark, cases):
    rows = [(n, value(tag, content)) for n, (tag, content, _) in enumerate(cases)]
    return spark.createDataFrame(rows, f"n int, v {VALUE_DDL}")


def test_minus_zero_is_a_float(spark):
    read = lambda t: one(spark, J.typed_from_json(F.lit("number"), F.lit("-0"), F.lit(t)))
    assert read("int8").error == read("uint64").error == "number_out_of_range"
    assert str(read("float64").value.f) == "-0.0"
    assert one(spark, J.typed_from_json(F.lit("number"), F.lit("-01"), F.lit("int8"))).error is None


def test_json_text(spark):
    v = F.col("v")
    df = values_table(spark, JSON_TEXTS).select("n", J.json_text(v), J.not_json(v))
    for n, text, spoiled in df.collect():
        assert (text, spoiled) == (JSON_TEXTS[n][2], JSON_TEXTS[n][2] is None)


def test_long_binary_is_one_line(spark):
    v = V.typed("binary", F.lit(bytes(range(256))))
    assert "\n" not in one(spark, V.render(v)) and "\\r" not in one(spark, J.json_text(v))


def plain_digits(x):
    if math.isnan(x):
        return "NaN"
    if math.isinf(x):
        return "-inf" if x < 0 else "inf"
    text = format(Decimal(repr(x)), "f")
    return text[:-2] if text.endswith(".0") else text


def test_rendered_doubles(spark):
    rnd = random.Random(4)
    cases = [0.0, -0.0, 1.0, 3.0, -2.5, 1e7, 1e16, 1e22, 1e300, 1.5e-7, 5e-5, 0.001, 123456789.125,
             math.nan, math.inf, -math.inf, 1.7976931348623157e308]
    cases += [round(rnd.uniform(-1, 1), 6) * 10.0 ** rnd.randrange(-20, 25) for _ in range(200)]
    df = spark.createDataFrame([(value("float64", c),) for c in cases], f"v {VALUE_DDL}")
    got = [r.x for r in df.select(V.render(F.col("v")).alias("x")).collect()]
    assert got == [plain_digits(c) for c in cases]


RENDERED = [
    ("float32", 0.1, "0.1"), ("float32", 3.0, "3"), ("bool", True, "true"), ("int8", -8, "-8"),
    ("uint64", 2**64 - 1, "18446744073709551615"), ("binary", b"\x01\x02\x03", "AQID"),
    ("string", "x", "x"), ("timestamp[ns]", 12, "12"),
]


def test_render(spark):
    df = values_table(spark, RENDERED).select("n", V.render(F.col("v")))
    assert dict(map(tuple, df.collect())) == {n: c[2] for n, c in enumerate(RENDERED)}


def test_canonical_keys(spark):
    def key(tag, content):
        return one(spark, V.canonical_key(literal(tag, content)))

    assert key("float64", 0.0) != key("float64", -0.0)
    assert key("float64", math.nan) == key("float64", math.nan)
    assert key("binary", b"\x01") == "01"


def test_typed_extraction(spark):
    v = literal("uint8", 7)
    assert one(spark, V.as_type(v, "uint8")) == 7
    assert one(spark, V.as_type(v, "int8")) is None
    assert one(spark, V.as_number(v)) == 7
    assert one(spark, V.as_number(literal("uint64", 2**64 - 1))) == 2**64 - 1
    for tag, content in (("float64", 1.0), ("bool", True), ("timestamp[ns]", 1), ("string", "1")):
        assert one(spark, V.as_number(literal(tag, content))) is None


def test_last_entry_of_a_name_counts(spark):
    fields = F.array(
        V.field("a", literal("int8", 1)), V.field("b", literal("int8", 2)),
        V.field("a", literal("int8", 3)),
    )
    rows = one(spark, V.last_per_name(fields))
    assert [(r.name, r.value.i) for r in rows] == [("b", 2), ("a", 3)]
    assert one(spark, V.value_of(fields, F.lit("a"))).i == 3
    assert one(spark, V.value_of(fields, F.lit("z"))) is None


def test_type_names(spark):
    table = Y.type_table(spark)
    name = F.col("data_type")
    rows = table.select(
        "*", Y.canonical_type(name).alias("c"), Y.duckdb_type(name).alias("d"),
        Y.type_from_duckdb(F.col("duckdb_type")).alias("back"), Y.is_numeric(name).alias("n"),
    ).collect()
    assert {r.data_type for r in rows} == {t.name for t in VALUE_TYPES} and len(rows) == 14
    for r in rows:
        assert (r.c, r.d, r.back, r.n) == (r.data_type, r.duckdb_type, r.data_type, r.is_numeric)
        assert r.is_numeric == (r.data_type not in ("timestamp[ns]", "binary", "string"))
    names = spark.createDataFrame([(x,) for x in ("float", "double", "boolean", "decimal")], "x string")
    got = names.select(
        Y.canonical_type(F.col("x")), Y.canonical_type(F.col("x"), extra_spellings=False)
    ).collect()
    assert list(map(tuple, got)) == [
        ("float32", "float32"), ("float64", "float64"), ("bool", None), (None, None)
    ]


def test_json_values_as_columns(spark):
    def cells(kind, text, data_type):
        r = one(spark, J.sql_columns(F.lit(kind), F.lit(text), F.lit(data_type)))
        return (r.text, None if r.bytes is None else bytes(r.bytes), r.time_ns, r.error)

    assert cells("string", "AQID", "binary") == (None, b"\x01\x02\x03", None, None)
    assert cells("string", "AQID", "string") == ("AQID", None, None, None)
    assert cells("string", "?", "binary") == (None, None, None, "invalid_base64")
    assert cells("number", "12", "timestamp[ns]") == (None, None, 12, None)
    assert cells("number", "1.5", "timestamp[ns]") == (None, None, None, "not_a_time")
    assert cells("number", "1.5", "int8") == ("1.5", None, None, None)
    assert cells("null", None, "int8") == (None, None, None, None)
    assert cells("bool", "true", "int8") == ("true", None, None, None)


def test_times(spark):
    cases = [0, 1, 999, 1000, -1, -999, -1000, -1001, 1699564234567890123, 2**63 - 1, -(2**63)]
    df = spark.createDataFrame([(c,) for c in cases], "ns bigint")
    rows = df.select(
        "ns", ns_to_micros(F.col("ns")).alias("us"), ns_remainder(F.col("ns")).alias("rest")
    ).collect()
    for r in rows:
        assert (r.us, r.rest) == divmod(r.ns, 1000)
    whole = df.where(F.abs(F.col("ns") % 1000) == 0)
    assert whole.where(timestamp_to_ns(ns_to_timestamp(F.col("ns"))) != F.col("ns")).count() == 0
