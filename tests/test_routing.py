import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.messages import (
    SEG_A, SEG_B, SEG_C, end, event, log_of, named, random_log, schema, start,
)
from tracelake.operators import filters, subscriptions as subs
from tracelake.operators.batching import number_batches, responses, unpack
from tracelake.plans.ordered import next_marked, running_number
from tracelake.session import shared_folder

FILTERS = "subscriber_id string, segment_id string, source_name string, event_name string"


FILTER_TEXTS = [
    ("*/*/*", (None, None, None), None),
    (None, (None, None, None), None),
    ("*/src/a/b", (None, "src", "a/b"), None),
    ("*//e", (None, "", "e"), None),
    ("*/s/", (None, "s", ""), None),
    ("x/y", (None, None, None), "missing_separator"),
    ("", (None, None, None), "missing_separator"),
    ("zz/s/e", (None, None, None), "invalid_uuid"),
    (f"{SEG_A}/s/e", (SEG_A, "s", "e"), None),
    (SEG_A.replace("-", "").upper() + "/s/e", (SEG_A, "s", "e"), None),
    ("{" + SEG_A + "}/s/*", (SEG_A, "s", None), None),
    (f"urn:uuid:{SEG_A}/*/e", (SEG_A, None, "e"), None),
    ("{" + SEG_A + "/s/e", (None, None, None), "invalid_uuid"),
    ("{" + SEG_A.replace("-", "") + "}/s/e", (None, None, None), "invalid_uuid"),
    (f"URN:UUID:{SEG_A}/s/e", (None, None, None), "invalid_uuid"),
    (f"{SEG_A}\n/s/e", (None, None, None), "invalid_uuid"),
]


def test_filter_text(spark):
    df = spark.createDataFrame(
        [(n, text) for n, (text, _, _) in enumerate(FILTER_TEXTS)], "n int, filter string"
    )
    for r in filters.parse_filters(df).collect():
        got = ((r.segment_id, r.source_name, r.event_name), r.error)
        assert got == FILTER_TEXTS[r.n][1:], r.filter


def matches(f, m):
    seg, source, name = f
    if seg is not None and seg != m[1] or source is not None and source != m[2]:
        return False
    return name is None or (m[3] == "event" and m[8][1] == name)


def some_filters(seed):
    rnd = random.Random(seed)
    return [
        (f"sub{rnd.randrange(3)}", rnd.choice((None, SEG_A, SEG_B)),
         rnd.choice((None, "s1", "s2", "")), rnd.choice((None, "e", "f")))
        for _ in range(12)
    ]


def expected_routes(messages, wanted):
    return Counter((f[0], m[0]) for m in messages for f in wanted if matches(f[1:], m))


def routed(log, wanted):
    return Counter((r.subscriber_id, r.seq) for r in filters.route(log, wanted).collect())


@pytest.mark.parametrize("seed", range(3))
def test_routing_equals_brute_force(spark, seed):
    messages, wanted = random_log(seed), some_filters(seed)
    got = routed(log_of(spark, messages), spark.createDataFrame(wanted, FILTERS))
    assert got == expected_routes(messages, wanted)


def test_routing_beyond_the_broadcast_bound(spark, no_broadcast):
    messages, wanted = random_log(7), some_filters(7)
    got = routed(log_of(spark, messages), spark.createDataFrame(wanted, FILTERS))
    assert got == expected_routes(messages, wanted)


def test_one_copy_per_matching_filter(spark):
    log = log_of(spark, [event(1, SEG_A, 5, "hello", [])])
    both = spark.createDataFrame(
        [("x", None, None, None), ("x", None, "src", "hello")], FILTERS
    )
    assert filters.route(log, both).count() == 2
    assert filters.route(log, both.limit(0)).count() == 0


def test_event_filter_takes_events_only(spark):
    log = log_of(spark, [
        schema(1, SEG_A, "hello", []), named(2, SEG_A, "hello", "x", []), start(3, SEG_A, 0, "src"),
        end(4, SEG_A, 1), event(5, SEG_A, 0, "hello", []),
    ])
    wanted = spark.createDataFrame([("x", None, None, "hello")], FILTERS)
    assert [r.seq for r in filters.route(log, wanted).collect()] == [5]
    assert [r.seq for r in filters.where_filter(log, event_name="hello").collect()] == [5]
    assert filters.where_filter(log, SEG_A, "src").count() == 5


COMMANDS = "subscriber_id string, seq bigint, action string, filter string"


def brute_force_subscriptions(messages, commands):
    def parse(text):
        if text is None:
            return (None, None, None)
        parts = text.split("/", 2)
        if len(parts) < 3 or parts[0] not in ("*", SEG_A, SEG_B):
            return None
        return tuple(None if p == "*" else p for p in parts)

    out, active = Counter(), []
    todo = [(c[1], 0, c) for c in commands] + [(m[0], 1, m) for m in messages]
    for _, kind, item in sorted(todo, key=lambda x: x[:2]):
        if kind == 1:
            for sub, f in active:
                out[(sub, item[0])] += matches(f, item)
            continue
        sub, _, action, text = item
        f = parse(text)
        if f is None:
            continue
        if action == "subscribe":
            active.append((sub, f))
        else:
            active = [a for a in active if a != (sub, f)]
    return +out


def test_same_filter_twice_then_unsubscribed(spark):
    log = log_of(spark, [event(s, SEG_A, 0, "e", []) for s in (5, 15, 25, 35)])
    commands = [("x", 1, "subscribe", "*/*/e"), ("x", 10, "subscribe", "*/*/e"),
                ("x", 20, "unsubscribe", "*/*/e")]
    rows = subs.route_subscriptions(log, spark.createDataFrame(commands, COMMANDS)).collect()
    assert Counter(r.seq for r in rows) == {5: 1, 15: 2}


@pytest.mark.parametrize("seed", range(3))
def test_subscriptions_equal_brute_force(spark, seed):
    rnd = random.Random(seed)
    messages = [(m[0] * 2, *m[1:]) for m in random_log(seed)]
    texts = (None, "*/*/*", "*/s1/*", f"{SEG_A}/*/e", "*/s2/f", "bad")
    commands = [
        (rnd.choice("xy"), seq * 2 + 1, rnd.choice(("subscribe", "subscribe", "unsubscribe")),
         rnd.choice(texts))
        for seq in rnd.sample(range(450), 30)
    ]
    got = subs.route_subscriptions(
        log_of(spark, messages), spark.createDataFrame(commands, COMMANDS)
    )
    got = Counter((r.subscriber_id, r.seq) for r in got.collect())
    assert got == brute_force_subscriptions(messages, commands)


def test_unsubscribe_of_any_leaves_other_filters(spark):
    commands = [("x", 1, "subscribe", "*/s/e"), ("x", 2, "subscribe", "*/*/*"),
                ("x", 3, "unsubscribe", None)]
    rows = subs.subscription_intervals(spark.createDataFrame(commands, COMMANDS)).collect()
    assert sorted((r.sub_seq, r.end_seq) for r in rows) == [(1, None), (2, 3)]


def test_replay(spark):
    log = log_of(spark, [start(1, SEG_A, 0, "s"), event(2, SEG_A, 5, "e", []),
                         event(3, SEG_A, 9, "e", [])])
    assert [r.seq for r in subs.replay_from(log, 6).orderBy("seq").collect()] == [1, 3]
    assert subs.replay_from(log, None).count() == 3


def test_late_subscriber_gets_all_metadata_then_matching_live(spark):
    log = log_of(spark, [
        start(1, SEG_A, 0, "src"), schema(2, SEG_A, "e", [("a", "int8")]),
        event(3, SEG_A, 1, "e", []), schema(4, SEG_A, "f", [("a", "int8")]),
        event(5, SEG_A, 2, "f", []), event(6, SEG_A, 3, "e", []), end(7, SEG_A, 9),
    ])
    wanted = spark.createDataFrame([("x", None, None, "e")], FILTERS)
    rows = subs.late_subscriber(log, 3, wanted).orderBy("part", "phase", "seq").collect()
    assert [(r.part, r.kind, r.seq) for r in rows] == [
        (0, "segment_start", 1), (0, "event_schema", 2), (1, "event", 6)
    ]
    assert subs.late_subscriber(log, 3).where("part = 1").count() == 4


@pytest.mark.parametrize("bits", (1, 2, 20))
def test_ordered_counting_equals_brute_force(spark, bits):
    rnd = random.Random(bits)
    rows = [(seq, rnd.choice("aab"), rnd.random() < 0.3) for seq in rnd.sample(range(200), 60)]
    df = spark.createDataFrame(rows, "seq bigint, k string, hit boolean").repartition(5)
    per_key = {k: sorted(r[0] for r in rows if r[1] == k) for k in "ab"}
    got = running_number(df, ["k"], "n", block_bits=bits).collect()
    assert {(r.k, r.seq): r.n for r in got} == {
        (k, seq): n for k, seqs in per_key.items() for n, seq in enumerate(seqs)
    }
    got = next_marked(df, ["k"], df["hit"], "next", block_bits=bits).collect()
    hits = {k: [r[0] for r in rows if r[1] == k and r[2]] for k in "ab"}
    assert {(r.k, r.seq): r.next for r in got} == {
        (k, seq): min((h for h in hits[k] if h > seq), default=None)
        for k, seqs in per_key.items() for seq in seqs
    }


def test_batches_are_runs_in_order(spark):
    log = log_of(spark, [event(s, SEG_A, s, "e", []) for s in range(25)]
                 + [event(100 + s, SEG_B, s, "e", [], source="other") for s in range(3)])
    rows = number_batches(log.repartition(6), ["source_name"], 10).collect()
    for r in rows:
        at = r.seq if r.source_name == "src" else r.seq - 100
        assert (r.batch_no, r.batch_pos) == divmod(at, 10)


def test_responses_unpack_to_what_was_routed(spark):
    messages = [event(s, SEG_C, s, "e", []) for s in range(9)]
    wanted = spark.createDataFrame(
        [("x", 0, None, None, None), ("x", 1, None, None, "e")],
        "subscriber_id string, filter_no bigint, segment_id string, source_name string, "
        "event_name string",
    )
    packed = responses(filters.route(log_of(spark, messages), wanted), 4)
    rows = unpack(packed).orderBy("batch_no", "pos").collect()
    assert [r.event.time_ns for r in rows] == sorted(list(range(9)) * 2)
    assert [r.batch_no for r in rows] == [n // 4 for n in range(18)]


def test_null_keys_are_keys(spark):
    rows = [(1, "a"), (2, None), (3, None), (4, "a")]
    df = spark.createDataFrame(rows, "seq bigint, stream string")
    got = running_number(df, ["stream"], "n", block_bits=1).collect()
    assert sorted((r.seq, r.n) for r in got) == [(1, 0), (2, 0), (3, 1), (4, 1)]
    marked = next_marked(df, ["stream"], F.col("seq") >= 3, "next", block_bits=1).collect()
    assert sorted((r.seq, r.next) for r in marked) == [(1, 4), (2, 3), (3, None), (4, None)]


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session())
