"""Signals, samples, conformance, batches, emission and the wire format."""

from collections import Counter
from decimal import Decimal

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.messages import (
    SEG_A, SEG_B, end, event, log_of, named, plain, random_log, schema, start, value,
)
from tracelake.functions.identifiers import table_name
from tracelake.functions.values import as_type, render
from tracelake.model import ALL_KINDS, BATCH_DDL, LOG_COLUMNS, LOG_DDL
from tracelake.operators import batching, catalog, conformance, samples, signals
from tracelake.sources import batches, emit, wire
from tracelake.sources.catalog_rows import signals_from_rows

# --- keys ---


KEY_TEXTS = [
    ("*/src/a/b.x.y", (None, "src", "a/b", "x.y"), None),
    (f"{SEG_A}/*/m.s", (SEG_A, "*", "m", "s"), None),
    (SEG_A.replace("-", "").upper() + "/s/m.s", (SEG_A, "s", "m", "s"), None),
    ("*/s/m.s p/q", (None, "s", "m", "s p/q"), None),
    ("*/s.t/m.x", None, "not_a_key"),
    ("*/s/m", None, "not_a_key"),
    ("*/s/m.", None, "not_a_key"),
    ("*/s/m.x\n", None, "not_a_key"),
    ("**/s/m.x", None, "invalid_uuid"),
    ("abc/s/m.x", None, "invalid_uuid"),
    (None, None, "not_a_key"),
]


def test_key_text(spark):
    df = spark.createDataFrame(
        [(n, text) for n, (text, _, _) in enumerate(KEY_TEXTS)], "n int, signal_key string"
    )
    for r in signals.parse_keys(df).collect():
        _, parts, error = KEY_TEXTS[r.n]
        got = (r.segment_id, r.source, r.message, r.signal)
        assert (got, r.error) == (parts or (None,) * 4, error), r.signal_key


def two_segments():
    return [
        start(1, SEG_A, 0, "src"), start(2, SEG_B, 0, "src"),
        schema(3, SEG_A, "e", [("a", "uint8", "V"), ("b", "float64")]),
        schema(4, SEG_B, "e", [("a", "uint8")]),
        named(5, SEG_A, "e", "a", [("uint8", 2, "two"), ("uint8", 10, "ten")]),
    ]


def resolve(spark, texts):
    known = catalog.signals(catalog.fold(log_of(spark, two_segments())))
    keys = signals.parse_keys(spark.createDataFrame([(t,) for t in texts], "signal_key string"))
    return Counter(
        (r.data_segment_id[-1], r.signal, r.signal_key)
        for r in signals.resolve(known, keys).collect()
    )


KEYS = ["*/src/e.a", "*/src/e.a", f"{SEG_A}/src/e.b", f"{SEG_B}/src/e.b", "*/other/e.a", "junk"]
FOUND = {
    ("a", "a", "*/src/e.a"): 2, ("b", "a", "*/src/e.a"): 2, ("a", "b", f"{SEG_A}/src/e.b"): 1,
}


def test_resolving_keys(spark):
    assert resolve(spark, KEYS) == FOUND


def test_resolving_keys_beyond_the_broadcast_bound(spark, no_broadcast):
    assert resolve(spark, KEYS) == FOUND


def test_names_and_json(spark):
    folded = catalog.fold(log_of(spark, two_segments()))
    rows = signals.with_names(catalog.signals(folded)).where(f"data_segment_id = '{SEG_A}'")
    row = rows.where("signal = 'a'").first()
    assert row.key_string == f"{SEG_A}/src/e.a"
    assert row.table_name == f'"{SEG_A}"."src/e"'
    assert row.table_key == f"{SEG_A}/src/e"
    texts = {(r.data_segment_id, r.signal): r.json for r in signals.signal_json(folded).collect()}
    head = '{"data_segment_id":"%s","source":"src","message":"e","signal":"%s","data_type":"%s"'
    assert texts[(SEG_A, "a")] == (
        head % (SEG_A, "a", "uint8") + ',"unit":"V","value_table":{"2":"two","10":"ten"}}'
    )
    assert texts[(SEG_A, "b")] == head % (SEG_A, "b", "float64") + "}"
    assert one(spark, table_name(F.lit("s"), F.lit("a"), F.lit("b"))) == '"s"."a/b"'


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_stored_catalog_rows(spark):
    rows = spark.createDataFrame(
        [(SEG_A.upper(), "UTINYINT"), ("nope", "UTINYINT"), (SEG_A, "HUGEINT")],
        "data_segment_id string, data_type string",
    )
    got = [(r.data_segment_id, r.data_type, r.error) for r in signals_from_rows(rows).collect()]
    assert got == [
        (SEG_A, "uint8", None), (None, "uint8", "invalid_uuid"), (SEG_A, None, "unknown_type")
    ]


# --- samples ---


def sample_messages():
    return two_segments() + [
        event(10, SEG_A, 100, "e", [("a", "uint8", 2), ("b", "float64", 1.5)]),
        event(11, SEG_A, 300, "e", [("a", "uint8", 9)]),
        event(12, SEG_A, 200, "e", [("a", "uint8", 10), ("b", "float64", 3.0)]),
        event(13, SEG_A, 300, "e", [("a", "uint8", 1), ("a", "uint8", 10)]),
        event(14, SEG_A, 100, "e", [("a", "int16", 2)]),
    ]


def latest(spark):
    rows = samples.latest_values(log_of(spark, sample_messages())).collect()
    return {r.full_name[37:]: (r.time_ns, r.value) for r in rows}


def test_latest_values(spark):
    # time decides, then arrival; within an event the last entry of a name
    assert latest(spark) == {"src/e.a": (300, "10"), "src/e.b": (200, "3")}


def test_latest_values_beyond_the_broadcast_bound(spark, no_broadcast):
    assert latest(spark) == {"src/e.a": (300, "10"), "src/e.b": (200, "3")}


def test_decoding(spark):
    log = log_of(spark, sample_messages())
    rows = samples.decode_values(log, catalog.fold(log), ["a"]).collect()
    assert sorted((r.seq, r.tag, r.key, r.label) for r in rows) == [
        (10, "uint8", "2", "two"), (11, "uint8", "9", None), (12, "uint8", "10", "ten"),
        (13, "uint8", "10", "ten"), (14, "int16", "2", None),
    ]


def test_wide_table(spark):
    log = log_of(spark, sample_messages())
    columns = samples.message_columns(catalog.fold(log), "e", SEG_A)
    assert columns == [("a", "uint8"), ("b", "float64")]
    wide = samples.wide_events(log, "e", columns).orderBy("seq")
    assert [(r.seq, r.a, r.b) for r in wide.collect()] == [
        (10, 2, 1.5), (11, 9, None), (12, 10, 3.0), (13, 10, None), (14, None, None)
    ]
    assert dict(wide.dtypes)["a"] == "smallint" and dict(wide.dtypes)["b"] == "double"


def test_wide_table_refuses_mixed_types(spark):
    log = log_of(spark, [schema(1, SEG_A, "e", [("a", "int8")]), schema(2, SEG_B, "e", [("a", "bool")])])
    with pytest.raises(ValueError):
        samples.message_columns(catalog.fold(log), "e")


def mixed_log(spark):
    return log_of(spark, [
        schema(1, SEG_A, "e", [("a", "int8"), ("seq", "bool"), ("b", "float64")]),
        schema(2, SEG_B, "e", [("a", "bool"), ("B", "string")]),
        schema(3, SEG_B, "f", [("c", "int64")]),
        event(10, SEG_A, 5, "e", [("a", "int8", 2), ("seq", "bool", True), ("b", "float64", 0.5)]),
        event(11, SEG_A, 6, "e", [("a", "bool", True), ("c", "int64", 4)]),
        event(12, SEG_B, 7, "e", [("a", "bool", False), ("B", "string", "x"), ("b", "float64", 1.0)]),
        event(13, SEG_B, 8, "f", [("c", "int64", 9), ("c", "int64", 10)]),
        event(14, SEG_A, 9, "f", [("c", "int64", 1)]),
        event(15, SEG_B, 9, "f", []),
    ])


MIXED = {
    10: {"a:int8": 2, "seq:bool": True, "b:float64": 0.5},
    11: {},
    12: {"a:bool": False, "B:string": "x"},
    13: {"c": 10},
    15: {},
}


def test_all_wide_tables_keep_types_apart(spark, tmp_path):
    log = mixed_log(spark)
    wide = samples.wide_tables(log, catalog.fold(log))
    fixed = {"seq", "time_ns", *samples.WIDE_KEYS}
    filled = lambda rows: {
        r.seq: {c: v for c, v in r.asDict().items() if c not in fixed and v is not None} for r in rows
    }
    assert filled(wide.collect()) == MIXED
    path = str(tmp_path / "tables")
    samples.write_wide_tables(wide, path)
    stored = spark.read.parquet(path)
    assert filled(stored.collect()) == MIXED and dict(stored.dtypes)["a:int8"] == "tinyint"
    one = spark.read.parquet(f"{path}/segment_id={SEG_B}/source=src/message=f")
    assert sorted(r.seq for r in one.collect()) == [13, 15]
    nothing = samples.wide_tables(log, catalog.fold(log.where("kind = 'event'")))
    assert nothing.count() == 0


def test_all_wide_tables_equal_each_alone(spark, no_broadcast):
    log = log_of(spark, sample_messages())
    folded = catalog.fold(log)
    wide = samples.wide_tables(log, folded).where((F.col("message") == "e") & (F.col("segment_id") == SEG_A))
    alone = samples.wide_events(log, "e", samples.message_columns(folded, "e", SEG_A)).where(
        F.col("segment_id") == SEG_A
    )
    columns = alone.columns
    assert sorted(map(repr, wide.select(columns).collect())) == sorted(map(repr, alone.collect()))


def test_samples_of_keys(spark):
    log = log_of(spark, sample_messages())
    keys = signals.parse_keys(spark.createDataFrame([("*/src/e.b",)], "signal_key string"))
    found = signals.resolve(catalog.signals(catalog.fold(log)), keys)
    rows = samples.signal_samples(log, found).withColumn("x", as_type(F.col("value"), "float64"))
    assert sorted((r.seq, r.key_string, r.x) for r in rows.collect()) == [
        (10, f"{SEG_A}/src/e.b", 1.5), (12, f"{SEG_A}/src/e.b", 3.0)
    ]


# --- conformance ---


def conformance_log():
    return [
        schema(1, SEG_A, "test-event", [("message", "string"), ("count", "uint64")]),
        schema(2, SEG_A, "test-event", [("message", "bool")]),
        event(3, SEG_A, 0, "test-event", [("message", "string", "hello")]),
        event(4, SEG_A, 0, "test-event", [("count", "string", "five")]),
        event(5, SEG_A, 0, "test-event", [("unknown", "string", "x"), ("count", "int64", 1)]),
        event(6, SEG_A, 0, "other", [("x", "int8", 1)]),
        event(7, SEG_B, 0, "test-event", []),
        event(8, SEG_A, 0, "test-event", []),
    ]


def problems(spark):
    log = log_of(spark, conformance_log())
    checked = conformance.check_events(log, catalog.fold(log))
    good = sorted(r.seq for r in conformance.conforming(checked).collect())
    rows = conformance.rejected(checked).collect()
    return good, sorted((r.seq, r.code, r.field or "", r.expected, r.found) for r in rows)


EXPECTED_PROBLEMS = (
    [3, 8],
    [
        (4, "type_mismatch", "count", "uint64", "string"),
        (5, "field_not_found", "unknown", None, "string"),
        (5, "type_mismatch", "count", "uint64", "int64"),
        (6, "event_not_found", "", None, None),
        (7, "event_not_found", "", None, None),
    ],
)


def test_events_against_schemas(spark):
    assert problems(spark) == EXPECTED_PROBLEMS
    log = log_of(spark, conformance_log())
    folded = catalog.fold(log)
    assert sorted(r.seq for r in conformance.unregistered_events(log, folded).collect()) == [6, 7]
    again = conformance.duplicate_schemas(log, folded).collect()
    assert [(r.seq, r.schema_seq) for r in again] == [(2, 1)]


def test_events_against_schemas_beyond_the_broadcast_bound(spark, no_broadcast):
    assert problems(spark) == EXPECTED_PROBLEMS


# --- batches ---


def wire_message(seg, source, kind, body):
    return (seg, source, kind, *[body if k == kind else None for k in ALL_KINDS])


RAW_A = bytes.fromhex(SEG_A.replace("-", ""))


def raw(tag, i=None, u=None, f=None):
    return (tag, i, None if u is None else Decimal(u), f, None, None, None, None)


def with_field(v):
    return wire_message(RAW_A, "s", "event", (1, "e", [("x", v)]))


GOOD = with_field(raw("uint8", u=255))


WIRE_CASES = [
    (GOOD, None),
    (with_field(raw("int8", i=300)), "truncation"),
    (with_field(raw("int8", i=-129)), "truncation"),
    (with_field(raw("int8", i=-128)), None),
    (with_field(raw("uint8", u=256)), "truncation"),
    (with_field(raw("uint16", u=2**64 - 1)), "truncation"),
    (with_field(raw("uint64", u=2**64 - 1)), None),
    (with_field(raw("uint32", u=2**32 - 1)), None),
    (with_field(raw("float32", f=1.0)), None),
    (with_field(None), "missing_value"),
    (with_field(raw(None)), "missing_value"),
    (with_field(raw("timestamp[ns]")), "missing_value"),
    (wire_message(RAW_A[:15], "s", "event", (1, "e", [])), "invalid_uuid"),
    (wire_message(None, "s", "event", (1, "e", [])), "invalid_uuid"),
    (wire_message(RAW_A, "s", None, None), "missing_message"),
    (wire_message(RAW_A, "s", "event_schema", ("e", [("a", "int8", None)])), None),
    (wire_message(RAW_A, "s", "event_schema", ("e", [("a", None, None)])), "missing_data_type"),
    (wire_message(RAW_A, "s", "named_values", ("e", "a", [(raw("int8", i=1), "x")])), None),
    (wire_message(RAW_A, "s", "named_values", ("e", "a", [(None, "x")])), "missing_value"),
    (wire_message(RAW_A, "s", "event",
                  (1, "e", [("x", raw("int8", i=1)), ("y", raw("int8", i=999)), ("z", None)])),
     "truncation"),
    (wire_message(RAW_A, "s", "segment_start", (1, "s")), None),
]


def test_wire_validity(spark):
    df = spark.createDataFrame([("st", 0, [m for m, _ in WIRE_CASES])], BATCH_DDL)
    checked = batches.check_messages(batches.flatten_batches(df))
    for r in checked.collect():
        assert r.error == WIRE_CASES[r.pos][1], WIRE_CASES[r.pos]
    assert batches.accepted(checked).count() == sum(e is None for _, e in WIRE_CASES)


def test_sequence_numbers_follow_batches_of_any_number(spark):
    rows = [("b", 2**44, [GOOD] * 3), ("a", 2**44, [GOOD]), ("a", 5, [GOOD] * 2), (None, 2**62, [GOOD]),
            ("c", 7, []), ("c", 8, None)]
    flat = batches.flatten_batches(spark.createDataFrame(rows, BATCH_DDL), first_seq=100)
    got = [(r.stream_id, r.batch_no, r.pos, r.seq) for r in flat.orderBy("seq").collect()]
    assert got == [
        ("a", 5, 0, 100), ("a", 5, 1, 101), ("a", 2**44, 0, 102), ("b", 2**44, 0, 103),
        ("b", 2**44, 1, 104), ("b", 2**44, 2, 105), (None, 2**62, 0, 106),
    ]


def test_undecodable_batches_are_quarantined_and_counted(spark):
    rows = [("s", 1, [GOOD, GOOD], None), ("s", 2, None, "undecodable"), ("t", 3, None, "undecodable")]
    df = spark.createDataFrame(rows, BATCH_DDL + ", decode_error string")
    checked = batches.check_messages(batches.flatten_batches(df))
    bad = {(r.stream_id, r.batch_no, r.error) for r in batches.quarantined(checked).collect()}
    assert bad == {("s", 2, "undecodable"), ("t", 3, "undecodable")}
    status = {r.stream_id: r for r in batches.publish_status(checked).collect()}
    assert (status["s"].total_messages, status["s"].failed_messages) == (3, 1)
    assert (status["t"].total_messages, status["t"].last_error) == (1, "undecodable")
    assert batches.accepted(checked).count() == 2


def test_accepted_rows_use_the_log_layout(spark):
    df = spark.createDataFrame([("st", 3, [GOOD, with_field(raw("uint64", u=7))])], BATCH_DDL)
    rows = batches.accepted(batches.check_messages(batches.flatten_batches(df))).orderBy("seq")
    first, second = rows.collect()
    assert (first.seq, second.seq) == (0, 1)
    assert first.segment_id == SEG_A
    assert plain(first.event.fields[0].value) == value("uint8", 255)
    assert plain(second.event.fields[0].value) == value("uint64", 7)
    assert tuple(rows.columns) == LOG_COLUMNS


def status_batches(spark):
    bad = with_field(None)
    rows = [
        ("st", 0, [GOOD, GOOD]),
        ("st", 2, [GOOD, bad, GOOD]),
        ("st", 4, [GOOD]),
        ("fine", 1, [GOOD]),
        ("fine", 3, [GOOD, GOOD]),
    ]
    return batches.check_messages(batches.flatten_batches(spark.createDataFrame(rows, BATCH_DDL)))


def check_status(spark):
    checked = status_batches(spark)
    rows = {r.stream_id: r for r in batches.publish_status(checked).collect()}
    st = rows["st"]
    assert (st.total_messages, st.successful_messages, st.failed_messages, st.last_error) == (
        6, 5, 1, "missing_value"
    )
    assert (rows["fine"].failed_messages, rows["fine"].last_error) == (0, "")
    rows = {r.stream_id: r for r in batches.strict_publish_status(checked).collect()}
    assert (rows["st"].total_messages, rows["st"].forwarded_messages) == (2, 3)
    assert rows["st"].stream_error == "missing_value"
    assert (rows["fine"].total_messages, rows["fine"].forwarded_messages) == (3, 3)
    assert batches.accepted(checked).count() == 8
    assert batches.accepted(checked, strict=True).count() == 6


def test_status(spark):
    check_status(spark)


def test_status_beyond_the_broadcast_bound(spark, no_broadcast):
    check_status(spark)


# --- emission ---


def test_emitted_messages(spark):
    run = spark.createDataFrame([(SEG_A, "src")], "segment_id string, source_name string")

    def at(seq, **columns):
        return run.withColumns({"seq": F.lit(seq), **columns})

    defs = F.array(*[
        F.struct(F.lit(n).alias("name"), F.lit(t).alias("data_type"), F.lit(None).cast("string").alias("unit"))
        for n, t in (("sig", "int8"), ("sig", "int32"))
    ])
    ten = F.expr("array(named_struct('name', 'sig', 'value', named_struct('tag', 'int32', 'i', 10L, "
                 "'u', NULL, 'f', NULL, 'ts', NULL, 'bin', NULL, 's', NULL, 'b', NULL)))")
    name = F.lit("hello")
    log = emit.union_log(
        emit.emit_start(at(0)),
        emit.emit_schemas(at(1, event_name=name, fields=defs)),
        emit.emit_events(at(2, event_name=name, fields=ten)),
        emit.emit_events(at(3, event_name=name, fields=ten, time_ns=F.lit(5))),
        emit.emit_end(at(4, time_ns=F.lit(None).cast("bigint"))),
    )
    assert log.schema.simpleString() == spark.createDataFrame([], LOG_DDL).schema.simpleString()
    rows = log.orderBy("seq").collect()
    assert [r.kind for r in rows] == ["segment_start", "event_schema", "event", "event", "segment_end"]
    assert rows[0].segment_start.source_name == "src"
    assert plain(rows[1].event_schema.fields) == [("sig", "int32", None)]
    assert plain(rows[2].event.fields) == [("sig", value("int32", 10))]
    assert rows[3].event.time_ns == 5
    now = rows[2].event.time_ns
    assert rows[0].segment_start.time_ns == now == rows[4].segment_end.time_ns > 1.7e18


# --- wire format ---


def all_types():
    return event(30, SEG_A, 7, "all", [
        ("i8", "int8", -8), ("i16", "int16", -16), ("i32", "int32", -32), ("i64", "int64", -(2**63)),
        ("u8", "uint8", 8), ("u16", "uint16", 16), ("u32", "uint32", 2**32 - 1),
        ("u64", "uint64", 2**64 - 1), ("f32", "float32", 0.5), ("f64", "float64", 2.718281828459045),
        ("ts", "timestamp[ns]", -5), ("bin", "binary", b"\x01\x02\x03"), ("str", "string", "hé"),
        ("bool", "bool", False),
    ])


def test_wire_round_trip(spark):
    messages = [m for m in random_log(3, 60) if m[0] < 500] + [
        (1000, *all_types()[1:]), start(1001, SEG_B, -1, "x"),
        schema(1002, SEG_B, "s", [("a", "timestamp[ns]", ""), ("b", "bool")]),
    ]
    log = log_of(spark, messages).withColumn("source_name", F.lit("src"))
    packed = batching.gather_batches(batching.number_batches(log, ["source_name"], 7), ["source_name"])
    payloads = wire.encode_batches(packed).withColumnRenamed("source_name", "stream_id")
    assert payloads.columns == ["stream_id", "batch_no", "payload"]
    decoded = wire.decode_batches(payloads)
    assert decoded.where("decode_error IS NOT NULL").count() == 0
    back = batches.accepted(batches.check_messages(batches.flatten_batches(decoded)))
    got = [plain(r)[1:] for r in back.orderBy("seq").collect()]
    want = [plain(r)[1:] for r in log.orderBy("seq").collect()]
    assert got == want


def test_wire_bytes_are_as_documented(spark):
    # hand-written bytes: message 1 { id(1), source(7) "s", event(6) { time(1), name(2) "e",
    # field(3) { name(1) "x", value(2) { uint8(5) 7 } } } }
    entry = b"\x0a\x01x" + b"\x12\x02\x28\x07"
    body = b"\x09" + (5).to_bytes(8, "little") + b"\x12\x01e" + b"\x1a" + bytes([len(entry)]) + entry
    msg = b"\x0a\x10" + RAW_A + b"\x3a\x01s" + b"\x32" + bytes([len(body)]) + body
    good = b"\x0a" + bytes([len(msg)]) + msg
    empty_value = good.replace(b"\x12\x02\x28\x07", b"\x12\x02\x78\x01")  # unknown value tag
    df = spark.createDataFrame(
        [("a", 0, good), ("a", 1, empty_value), ("a", 2, b"\xff\xff\xff"), ("a", 3, b"")],
        "stream_id string, batch_no bigint, payload binary",
    )
    decoded = wire.decode_batches(df)
    assert [r.batch_no for r in decoded.where("decode_error = 'undecodable'").collect()] == [2]
    checked = batches.check_messages(batches.flatten_batches(decoded)).orderBy("seq").collect()
    assert [r.error for r in checked] == [None, "missing_value", "undecodable"]
    assert plain(checked[0].event.fields) == [("x", raw("uint8", u=7))]
    assert checked[0].event.time_ns == 5 and checked[0].source_name == "s"


def test_go_style_empty_timestamp_is_quarantined(spark):
    df = spark.createDataFrame([("st", 0, [with_field(raw(None)), GOOD])], BATCH_DDL)
    checked = batches.check_messages(batches.flatten_batches(df))
    assert batches.quarantined(checked).count() == 1
    assert [render_first(r) for r in batches.accepted(checked).select(
        render(F.col("event.fields")[0]["value"]).alias("x")).collect()] == ["255"]


def render_first(row):
    return row.x


def test_end_message_only(spark):
    assert catalog.fold(log_of(spark, [end(1, SEG_A, 3, "z")])).segments.first().source == "z"


def numbered(spark, rows):
    flat = batches.flatten_batches(spark.createDataFrame(rows, BATCH_DDL).repartition(3))
    return sorted((r.seq, r.stream_id, r.batch_no, r.pos, r.decode_error) for r in flat.collect())


def test_batches_without_a_number_are_bad_messages(spark):
    one = (b"x" * 16, "s", "segment_start", (1, "s"), None, None, None, None)
    got = numbered(spark, [("a", 1, [one]), ("a", None, [one, one]), (None, None, None), ("b", 0, [one])])
    assert [g[0] for g in got] == [0, 1, 2, 3]
    assert [g[1:] for g in got[:2]] == [("b", 0, 0, None), ("a", 1, 0, None)]
    assert {g[1:] for g in got[2:]} == {(s, None, 0, "missing_batch_no") for s in (None, "a")}
    flat = batches.flatten_batches(spark.createDataFrame([("a", 1, [one]), ("a", None, [one, one])], BATCH_DDL))
    status = batches.publish_status(batches.check_messages(flat)).first()
    assert tuple(status)[1:5] == (2, 1, 1, "missing_batch_no")
    strict = batches.strict_publish_status(batches.check_messages(flat)).first()
    assert tuple(strict)[1:6] == (1, 1, 0, 1, "missing_batch_no")


def test_null_and_empty_streams_are_two(spark):
    one = (b"x" * 16, "s", "segment_start", (1, "s"), None, None, None, None)
    got = numbered(spark, [(None, 1, [one, one]), ("", 1, [one, one])])
    assert [g[:4] for g in got] == [(0, None, 1, 0), (1, None, 1, 1), (2, "", 1, 0), (3, "", 1, 1)]


def test_rows_of_one_stream_and_number_have_numbers_of_their_own(spark):
    one = (b"x" * 16, "s", "segment_start", (1, "s"), None, None, None, None)
    got = numbered(spark, [("a", 1, [one, one]), ("a", 1, [one, one]), ("a", 1, [one]), ("a", 0, [one])])
    assert [g[0] for g in got] == list(range(6)) and got[0][2] == 0
    assert sorted(g[3] for g in got[1:]) == [0, 0, 0, 1, 1]


def test_wire_batches_are_never_held_many_at_a_time(spark):
    class Caught:
        def select(self, *columns):
            return self

        def mapInArrow(self, function, ddl):
            return function

    message = b"\x0a\x15" + b"\x0a\x10" + RAW_A + b"\x3a\x01s"
    part = pa.RecordBatch.from_pylist([{"stream_id": "a", "batch_no": k, "payload": message * 1000} for k in range(20)])
    parts = list(wire.decode_batches(Caught())(iter([part])))
    assert sum(len(m) for p in parts for m in p.column("trace_messages").to_pylist()) == 20_000
    assert max(sum(map(len, p.column("trace_messages").to_pylist())) for p in parts) <= wire.STEP_MESSAGES
    # and they are stored a message a row
    df = spark.createDataFrame([("a", 1, [GOOD, GOOD]), ("a", 0, [GOOD])], BATCH_DDL)
    flat = batches.flatten_batches(df)
    assert all("trace_messages" not in spark.read.parquet(f).columns for f in flat.inputFiles())
    assert sorted((r.seq, r.batch_no, r.pos) for r in flat.collect()) == [(0, 0, 0), (1, 1, 0), (2, 1, 1)]


def test_messages_encoded_one_by_one_are_the_same_bytes(spark):
    log = log_of(spark, [m for m in random_log(5, 80) if m[0] < 500]).withColumn("source_name", F.lit("src"))
    numbered = batching.number_batches(log, ["source_name"], 7)
    want = wire.encode_batches(batching.gather_batches(numbered, ["source_name"]))
    got = wire.encode_messages(numbered, ["source_name"])
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
