import random

import pytest

from tests.messages import (
    SEG_A, SEG_B, catalog_as_dicts, end, event, log_of, named, random_log, schema,
    sequential_fold, start,
)
from tracelake.model import LOG_COLUMNS
from tracelake.operators import catalog as C


def folded(spark, *messages, **options):
    return catalog_as_dicts(C.fold(log_of(spark, messages), **options))


def test_start_and_end_of_one_segment(spark):
    seg = "0196c84d-6eb8-7c46-83b1-e4cac73ba9b6"
    first = start(1, seg, 0, "src")
    assert folded(spark, first)[seg] == {"source": "src", "start": 0, "end": None, "schemas": {}}
    assert folded(spark, first, end(2, seg, 1))[seg]["end"] == 1


def test_earliest_start_last_source_last_end(spark):
    got = folded(
        spark,
        start(1, SEG_A, 5, "a"), start(2, SEG_A, 3, "b"), start(3, SEG_A, 9, "c", envelope="zz"),
        end(4, SEG_A, 9), end(5, SEG_A, 4), end(6, SEG_B, 7, source="z"),
    )
    assert (got[SEG_A]["start"], got[SEG_A]["source"], got[SEG_A]["end"]) == (3, "c", 4)
    assert (got[SEG_B]["start"], got[SEG_B]["source"]) == (None, "z")


def test_first_schema_wins(spark):
    got = folded(
        spark, schema(1, SEG_A, "e", [("a", "int8")]), schema(2, SEG_A, "e", [("a", "float64")])
    )
    assert got[SEG_A]["schemas"]["e"] == [(("a", "int8", None), {})]


def test_value_tables(spark):
    got = C.fold(log_of(spark, [
        named(1, SEG_A, "e", "a", [("uint8", 9, "LOST")]),
        schema(2, SEG_A, "e", [("a", "uint8")]),
        named(3, SEG_A, "e", "a", [("uint8", 3, "X"), ("uint8", 3, "Y"), ("int8", 1, "I")]),
        named(4, SEG_A, "e", "nope", [("uint8", 0, "Z")]),
        named(5, SEG_A, "e", "a", [("uint8", 1, "U")]),
        named(6, SEG_A, "e", "a", [("uint8", 3, "LAST")]),
    ]))
    rows = {(r.tag, r.key): r.label for r in got.value_tables.collect()}
    assert rows == {("uint8", "3"): "LAST", ("int8", "1"): "I", ("uint8", "1"): "U"}


def test_signed_zero_keys_stay_apart(spark):
    got = C.fold(log_of(spark, [
        schema(1, SEG_A, "e", [("a", "float64")]),
        named(2, SEG_A, "e", "a", [
            ("float64", 0.0, "plus"), ("float64", -0.0, "minus"),
            ("float64", float("nan"), "n1"), ("float64", float("nan"), "n2"),
        ]),
    ]))
    assert sorted(r.label for r in got.value_tables.collect()) == ["minus", "n2", "plus"]


def test_who_creates_segments(spark):
    only = event(1, SEG_A, 5, "e", [], source="s")
    assert folded(spark, only) == {}
    assert folded(spark, only, mode="from") == {
        SEG_A: {"source": "s", "start": None, "end": None, "schemas": {}}
    }
    with pytest.raises(ValueError):
        C.fold(log_of(spark, [only]), mode="both")


def test_removal_forgets_the_past(spark):
    tombs = spark.createDataFrame([(SEG_A, 3)], "segment_id string, seq bigint")
    got = folded(
        spark, start(1, SEG_A, 5, "s"), schema(2, SEG_A, "e", [("a", "int8")]),
        end(4, SEG_A, 9, source="late"), tombstones=tombs,
    )
    assert got == {SEG_A: {"source": "late", "start": None, "end": 9, "schemas": {}}}


def test_snapshot_rows(spark):
    rows = C.snapshot(C.fold(log_of(spark, [
        schema(1, SEG_A, "e", [("a", "int8")]),
        named(2, SEG_B, "e", "a", [("uint8", 1, "never kept")]),
    ]))).collect()
    assert [(r.segment_id, r.kind) for r in rows] == [(SEG_A, "event_schema")]


def test_snapshot_order_and_source(spark):
    rows = C.snapshot(C.fold(log_of(spark, [
        end(1, SEG_A, 9, source="env"), schema(2, SEG_A, "b", [("x", "int8"), ("y", "int8")]),
        schema(3, SEG_A, "a", []), named(4, SEG_A, "b", "y", [("int8", 1, "l")]),
        named(5, SEG_A, "b", "x", [("int8", 1, "l")]), start(6, SEG_A, 4, "real", envelope="env"),
    ])))
    rows = rows.orderBy("segment_id", "phase", "event_name", "field_pos").collect()
    assert [r.kind for r in rows] == [
        "segment_start", "event_schema", "event_schema", "named_values", "named_values",
        "segment_end",
    ]
    assert {r.source_name for r in rows} == {"real"}
    assert [r.named_values.field_name for r in rows if r.kind == "named_values"] == ["x", "y"]
    assert len({r.seq for r in rows}) == len(rows)


@pytest.mark.parametrize("seed", range(5))
def test_fold_equals_sequential_fold(spark, seed):
    messages = random_log(seed)
    tombs = [("00000000-0000-7000-8000-00000000000b", 200)]
    random.Random(seed).shuffle(messages)
    log = log_of(spark, messages).repartition(7)
    for mode in ("update", "from"):
        assert catalog_as_dicts(C.fold(log, mode)) == sequential_fold(messages, mode)
    removed = C.fold(log, tombstones=spark.createDataFrame(tombs, "segment_id string, seq bigint"))
    assert catalog_as_dicts(removed) == sequential_fold(messages, "update", tombs)


@pytest.mark.parametrize("seed", range(3))
def test_any_split_merges_to_the_same_catalog(spark, seed):
    messages = random_log(seed + 50)
    cut = random.Random(seed).randrange(450)
    log = log_of(spark, messages)
    parts = [C.fold_state(log.where(f"seq < {cut}")), C.fold_state(log.where(f"seq >= {cut}"))]
    for first, second in (parts, parts[::-1]):
        merged = C.state_to_catalog(C.merge_states(first, second))
        assert catalog_as_dicts(merged) == sequential_fold(messages)


@pytest.mark.parametrize("seed", range(3))
def test_snapshot_refolds_to_itself(spark, seed):
    messages = random_log(seed + 90)
    want = sequential_fold(messages)
    kept = {
        k: v for k, v in want.items()
        if v["start"] is not None or v["end"] is not None or v["schemas"]
    }
    rows = C.snapshot(C.fold(log_of(spark, messages)))
    assert catalog_as_dicts(C.fold(rows.select(*LOG_COLUMNS))) == kept


def test_a_large_value_table_is_one_message_unless_asked(spark):
    entries = [("int32", n, f"l{n}") for n in range(25_000)]
    messages = [schema(1, SEG_A, "e", [("a", "int32")]), named(2, SEG_A, "e", "a", entries)]
    folded = C.fold(log_of(spark, messages))
    rows = C.snapshot(folded)
    named_rows = rows.where("kind = 'named_values'").select("seq", "named_values").collect()
    assert len(named_rows) == 1 and len(named_rows[0].named_values["values"]) == 25_000
    assert rows.select("seq").distinct().count() == rows.count()
    spread = C.snapshot(folded, table_entries=10_000)
    parts = spread.where("kind = 'named_values'").select("seq", "part_no").collect()
    assert len(parts) == 3 == len(set(parts))
    assert catalog_as_dicts(C.fold(spread.select(*LOG_COLUMNS))) == sequential_fold(messages)


def test_signals(spark):
    folded_ = C.fold(log_of(spark, [
        start(1, SEG_A, 0, "src"),
        schema(2, SEG_A, "e", [("a", "uint8", "V"), ("b", "uint8"), ("c", "uint8")]),
        named(3, SEG_A, "e", "a", [("string", "x", "text only")]),
        named(4, SEG_A, "e", "b", [("uint8", 1, "u"), ("int64", 1, "i"), ("bool", True, "no")]),
    ]))
    rows = {r.signal: r for r in C.signals(folded_).collect()}
    assert (rows["a"].has_value_table, rows["a"].n_values, rows["a"].unit) == (True, 0, "V")
    assert (rows["b"].has_value_table, rows["b"].n_values) == (True, 1)
    assert (rows["c"].has_value_table, rows["c"].n_values) == (False, 0)
    values = [(r.field_name, int(r.number), r.label) for r in C.signal_values(folded_).collect()]
    assert values == [("b", 1, "i")]


def test_repeated_field_name_finds_the_first(spark):
    folded_ = C.fold(log_of(spark, [
        start(1, SEG_A, 0, "src"),
        schema(2, SEG_A, "e", [("a", "uint8"), ("a", "float64")]),
        named(3, SEG_A, "e", "a", [("uint8", 1, "one")]),
    ]))
    rows = C.signals(folded_).orderBy("field_pos").collect()
    assert [(r.data_type, r.has_value_table, r.is_first) for r in rows] == [
        ("uint8", True, True), ("float64", False, False)
    ]
