"""What a task holds or reads does not grow with the table."""

import pytest
from pyspark.sql import functions as F

from tests.messages import SEG_A, event, log_of, start, value
from tests.test_streaming import file_stream
from tracelake.functions.identifiers import uuid_to_bytes
from tracelake.model import ALL_KINDS, BATCH_DDL, LOG_DDL
from tracelake.operators import samples
from tracelake.operators import subscriptions as subs
from tracelake.plans import intervals, joins, queries
from tracelake.session import new_folder
from tracelake.streaming import catalog_stream, store
from tracelake.streaming.latest_stream import latest_now, start_latest

SF = "/root/testdata/sf0.001"
MESSAGES = [start(1, SEG_A, 0, "s"), event(2, SEG_A, 5, "e", [("x", "int64", 1)]), event(3, SEG_A, 4, "e", [("x", "int64", 2)])]


def test_a_stream_has_files_of_bounded_size(spark, monkeypatch):
    path = new_folder(spark, "stream")
    monkeypatch.setattr(queries, "new_folder", lambda *_: path)
    monkeypatch.setattr(queries, "FILE_EVENTS", 20)
    queries._log_stream(spark, SF)
    events = queries.read_events(spark, SF).count()
    sizes = [r["count"] for r in spark.read.schema(LOG_DDL).parquet(path).groupBy(F.input_file_name()).count().collect()]
    assert events > 160 and len(sizes) > events / 20 * 0.8
    assert max(sizes) < 3 * sum(sizes) / len(sizes)
    assert queries._files(spark, SF, 4) == -(-events // 20)


def test_the_catalog_of_a_stream_keeps_no_events(spark, monkeypatch):
    seen, fold = [], catalog_stream.fold_state

    def caught(batch, mode):
        seen.extend(r["kind"] for r in batch.select("kind").collect())
        return fold(batch, mode)

    monkeypatch.setattr(catalog_stream, "fold_state", caught)
    for mode, kinds in (("update", ["segment_start"]), ("from", ["segment_start", "event", "event"])):
        seen.clear()
        catalog_stream.update_catalog(log_of(spark, MESSAGES), 0, new_folder(spark, "catalog"), mode=mode)
        assert seen == kinds


def test_ingested_messages_are_not_kept_in_memory(spark, monkeypatch):
    frame, kept = type(spark.range(1)), []
    persist = frame.persist
    monkeypatch.setattr(frame, "persist", lambda df, *a: kept.append(df.where("event IS NOT NULL").count()) or persist(df, *a))
    message = F.struct(uuid_to_bytes(F.col("segment_id")).alias("segment_id"), "source_name", "kind", *ALL_KINDS)
    raw = log_of(spark, MESSAGES).groupBy().agg(F.sort_array(F.collect_list(message)).alias("trace_messages"))
    raw = raw.select(F.lit("a").alias("stream_id"), F.lit(0).cast("bigint").alias("batch_no"), "trace_messages")
    root = new_folder(spark, "lake")
    store.ingest_batch(spark.createDataFrame(raw.collect(), BATCH_DDL), 0, root)
    assert kept == [0]
    assert store.stored_log(spark, root).count() == 3
    assert store.stored_status(spark, root).first()["total_messages"] == 3


def test_latest_values_of_a_stream_are_not_sorted(spark):
    root, offsets = new_folder(spark, "latest"), new_folder(spark, "offsets")
    messages = [*MESSAGES, event(4, SEG_A, None, "f", [("y", "int64", 7)])]
    start_latest(file_stream(spark, messages, [2]), root, offsets).awaitTermination()
    assert sorted((r.message, r.time_ns, r.value) for r in latest_now(spark, root).collect()) == [("e", 5, "1"), ("f", None, "7")]
    # no aggregate of the stream's own, which sorts what it takes the greatest of
    assert not store._has(spark, f"{offsets}/state")
    plan = samples.latest_samples(log_of(spark, messages))._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def test_bytes_are_measured_of_few_rows_only(spark, no_broadcast, monkeypatch):
    monkeypatch.setattr(joins.F, "to_json", lambda *_: pytest.fail("measured"))
    assert not joins.settle(spark.range(10)).broadcastable


def test_intervals_are_cut_by_plain_columns_and_joined_by_number(spark, no_broadcast):
    rows = spark.createDataFrame([(3, 900), (5, None), (8, 8)], "a bigint, b bigint")
    pieces, _ = intervals.cut(rows, "a", "b")
    assert "lambda" not in pieces._jdf.queryExecution().optimizedPlan().toString()
    commands = spark.createDataFrame([("A", 1, "subscribe", "*/*/e")], queries.COMMANDS_DDL)
    routed = subs.route_subscriptions(log_of(spark, MESSAGES), commands)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = routed.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin [_number" in plan
    assert sorted(r["seq"] for r in routed.collect()) == [2, 3]
