"""Intervals as nodes of a tree, against plain comparison."""

import random

import pytest
from pyspark.sql import functions as F

from tests.messages import SEG_A, event, log_of
from tracelake.operators import subscriptions as subs
from tracelake.plans import intervals

COMMANDS = "subscriber_id string, seq bigint, action string, filter string"


@pytest.mark.parametrize("low, spread", [(0, 40), (-25, 60), (10**12, 3000), (0, 2**61)])
def test_numbers_meet_the_intervals_that_hold_them_once(spark, low, spread):
    rnd = random.Random(spread)
    edge = lambda: low + rnd.randrange(spread)
    rows = [(k, edge(), rnd.choice((None, edge(), edge()))) for k in range(60)]
    rows += [(60, low, low), (61, low, low + 1), (62, low, None), (63, low + spread, low)]
    numbers = sorted({edge() for _ in range(80)} | {low - 7, low, low + spread, low + 2 * spread, low + 1})
    df = spark.createDataFrame(rows, "id int, a bigint, b bigint")
    pieces, tree = intervals.cut(df, "a", "b")
    levels = [r[0] for r in pieces.select("_level").distinct().collect()]
    seen = spark.createDataFrame([(n,) for n in numbers], "seq bigint").select(
        "seq", F.explode(intervals.nodes_of_number(F.col("seq"), tree, levels)).alias("n")
    )
    met = pieces.join(seen, (F.col("_level") == F.col("n.level")) & (F.col("_number") == F.col("n.number")))
    want = [(k, n) for k, a, b in rows for n in numbers if n > a and (b is None or n < b)]
    assert sorted((r.id, r.seq) for r in met.collect()) == want
    for r in pieces.groupBy("id").count().collect():
        assert r["count"] <= 2 * (2**intervals.BITS - 1) * (tree.levels + 1)


def test_no_intervals(spark):
    pieces, _ = intervals.cut(spark.createDataFrame([], "a bigint, b bigint"), "a", "b")
    assert pieces.count() == 0


def burst(spark, n):
    """``n`` subscriptions inside 2n numbers, each for a moment, and a late one."""
    own = spark.range(n).select(
        F.concat(F.lit("s"), (F.col("id") % 7).cast("string")).alias("subscriber_id"), F.col("id").alias("k"),
    )
    text = F.concat(F.lit("*/src/e"), (F.col("k") % 3).cast("string"))
    ons = own.select("subscriber_id", (2 * F.col("k") + 1000).alias("seq"), F.lit("subscribe").alias("action"), text.alias("filter"))
    offs = own.select("subscriber_id", (2 * F.col("k") + 1043).alias("seq"), F.lit("unsubscribe").alias("action"), text.alias("filter"))
    late = spark.createDataFrame([("late", 10**12, "subscribe", "*/*/*")], COMMANDS)
    return ons.union(offs).union(late)


@pytest.mark.parametrize("way", ["broadcast", "shuffle"])
def test_a_burst_compares_what_it_delivers(spark, request, way):
    if way == "shuffle":
        request.getfixturevalue("no_broadcast")
    n = 100_000 if way == "broadcast" else 3000
    commands = burst(spark, n)
    at = [0, 900, 1000, 1001, 1043, 1500, 1501, 2222, 5000, 2 * n + 990, 2 * n + 1043, 10**12, 10**12 + 1, 10**15]
    log = log_of(spark, [event(s, SEG_A, s, f"e{s % 4}", []) for s in at])
    routed = subs.route_subscriptions(log, commands)
    got = sorted((r.subscriber_id, r.seq) for r in routed.select("subscriber_id", "seq").collect())
    want = []
    for k in range(n):
        off = min((2 * j + 1043 for j in range(max(0, k - 60), min(n, k + 60))
                   if j % 21 == k % 21 and 2 * j + 1043 > 2 * k + 1000), default=None)
        want += [(f"s{k % 7}", s) for s in at if s % 4 == k % 3 and s > 2 * k + 1000 and (off is None or s < off)]
    want += [("late", s) for s in at if s > 10**12]
    assert got == sorted(want)
    # each pair that meets is delivered: the join has no condition besides equality
    plan = routed._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert not [line for line in plan.splitlines() if "Join" in line and ("<" in line or "> " in line)]
