from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.messages import (
    SEG_A, catalog_as_dicts, end, event, log_of, random_log, schema, sequential_fold, start,
)
from tracelake.model import LOG_DDL
from tracelake.operators.filters import route
from tracelake.session import new_folder
from tracelake.sources.log_table import read_log, stream_log, write_log
from tracelake.streaming import catalog_stream as CS
from tracelake.streaming.routing_stream import delivered, start_responses, start_routing, start_subscriptions
from tracelake.streaming.store import start_store, stored_catalog, stored_log
from tracelake.operators.subscriptions import route_subscriptions


def file_stream(spark, messages, cuts):
    """Messages as one file per range of seq, one file per micro-batch."""
    path = new_folder(spark, "in")
    edges = [-1, *cuts, 10**9]
    for low, high in zip(edges, edges[1:]):
        part = [m for m in messages if low < m[0] <= high]
        log_of(spark, part).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(LOG_DDL).option("maxFilesPerTrigger", 1).parquet(path)


@pytest.mark.parametrize("seed, cuts", [(0, []), (1, [100]), (2, [60, 200, 201])])
def test_streamed_catalog_equals_sequential_fold(spark, seed, cuts):
    messages = random_log(seed)
    root = new_folder(spark, "cat")
    CS.start_catalog_stream(
        file_stream(spark, messages, cuts), root, new_folder(spark, "offsets")
    ).awaitTermination()
    assert catalog_as_dicts(CS.read_catalog(spark, root)) == sequential_fold(messages)
    smaller = new_folder(spark, "cat")
    CS.compact(spark, root, smaller, 99)
    assert catalog_as_dicts(CS.read_catalog(spark, smaller)) == sequential_fold(messages)


def test_repeated_batch_changes_nothing(spark):
    root, messages = new_folder(spark, "cat"), random_log(5)
    log = log_of(spark, messages)
    for batch_id, part in ((0, "seq < 200"), (1, "seq >= 200"), (1, "seq >= 200")):
        CS.update_catalog(log.where(part), batch_id, root)
    assert catalog_as_dicts(CS.read_catalog(spark, root)) == sequential_fold(messages)


def test_nothing_is_seen_before_the_first_commit(spark):
    root = new_folder(spark, "cat")
    assert catalog_as_dicts(CS.read_catalog(spark, root)) == {}
    messages = random_log(3)
    # an attempt that was cut off before its commit
    CS._write(CS.fold_state(log_of(spark, messages), "update"), root, "part=0-0-lost")
    assert catalog_as_dicts(CS.read_catalog(spark, root)) == {}
    CS.update_catalog(log_of(spark, messages), 0, root)
    assert catalog_as_dicts(CS.read_catalog(spark, root)) == sequential_fold(messages)


def test_compaction_after_a_removal(spark):
    messages = [
        start(1, SEG_A, 5, "s"), schema(2, SEG_A, "e", [("a", "int8")]),
        start(12, SEG_A, 99, "s"), schema(13, SEG_A, "f", [("b", "int8")]),
    ]
    tombs = spark.createDataFrame([(SEG_A, 10)], "segment_id string, seq bigint")
    root, log = new_folder(spark, "cat"), log_of(spark, messages)
    CS.update_catalog(log.where("seq <= 2"), 0, root)
    CS.update_catalog(log.where("seq > 2"), 1, root, tombstones=tombs)
    want = sequential_fold(messages, tombstones=[(SEG_A, 10)])
    assert catalog_as_dicts(CS.read_catalog(spark, root, tombs)) == want
    smaller = new_folder(spark, "cat")
    CS.compact(spark, root, smaller, 2, tombs)
    assert catalog_as_dicts(CS.read_catalog(spark, smaller, tombs)) == want
    assert catalog_as_dicts(CS.read_catalog(spark, smaller)) == want


def test_removal_between_batches(spark):
    messages = [
        start(1, SEG_A, 5, "s"), schema(2, SEG_A, "e", [("a", "int8")]), end(4, SEG_A, 9, "late"),
        schema(6, SEG_A, "f", []),
    ]
    tombs = spark.createDataFrame([(SEG_A, 3)], "segment_id string, seq bigint")
    root, log = new_folder(spark, "cat"), log_of(spark, messages)
    CS.update_catalog(log.where("seq <= 2"), 0, root)
    CS.update_catalog(log.where("seq > 2"), 1, root, tombstones=tombs)
    got = catalog_as_dicts(CS.read_catalog(spark, root, tombs))
    assert got == sequential_fold(messages, tombstones=[(SEG_A, 3)])


def test_store_keeps_log_and_catalog(spark):
    messages, root = random_log(8), new_folder(spark, "store")
    start_store(
        file_stream(spark, messages, [150]), root, new_folder(spark, "offsets")
    ).awaitTermination()
    assert sorted(r.seq for r in stored_log(spark, root).collect()) == sorted(m[0] for m in messages)
    assert catalog_as_dicts(stored_catalog(spark, root)) == sequential_fold(messages)


def test_streamed_routes_and_subscriptions(spark):
    messages = [event(s, SEG_A, s, "ef"[s % 2], []) for s in range(40)]
    wanted = spark.createDataFrame(
        [("x", 0, None, None, None), ("x", 1, None, None, "e"), ("y", 0, None, None, "f")],
        "subscriber_id string, filter_no bigint, segment_id string, source_name string, "
        "event_name string",
    )
    log = log_of(spark, messages)

    def counts(df):
        return Counter((r.subscriber_id, r.seq) for r in df.collect())

    root = new_folder(spark, "routed")
    start_routing(
        file_stream(spark, messages, [7, 20]), wanted, root, new_folder(spark, "offsets")
    ).awaitTermination()
    assert counts(delivered(spark, root)) == counts(route(log, wanted))

    commands = spark.createDataFrame(
        [("x", 5, "subscribe", "*/*/e"), ("x", 25, "unsubscribe", "*/*/e")],
        "subscriber_id string, seq bigint, action string, filter string",
    )
    root = new_folder(spark, "routed")
    start_subscriptions(
        file_stream(spark, messages, [10]), commands, root, new_folder(spark, "offsets")
    ).awaitTermination()
    assert counts(delivered(spark, root)) == counts(route_subscriptions(log, commands))

    root = new_folder(spark, "responses")
    start_responses(
        file_stream(spark, messages, []), wanted, root, new_folder(spark, "offsets"), 16
    ).awaitTermination()
    sizes = delivered(spark, root).select("subscriber_id", "batch_no", F.size("messages").alias("n"))
    assert sorted(map(tuple, sizes.collect())) == [
        ("x", 0, 16), ("x", 1, 16), ("x", 2, 16), ("x", 3, 12), ("y", 0, 16), ("y", 1, 4)
    ]


def test_log_table(spark):
    messages, path = random_log(9), new_folder(spark, "log")
    write_log(log_of(spark, messages), path)
    control = read_log(spark, path).where("kind = 'segment_end'")
    plan = control._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(kind" in plan
    assert control.count() == sum(m[3] == "segment_end" for m in messages)
    assert stream_log(spark, path).isStreaming
