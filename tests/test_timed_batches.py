"""Batches by count or time against the sequential rule."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.messages import SEG_A, event, log_of, schema
from tracelake.operators import timed_batches as tb


def sequential(rows, size, timeout):
    """seq -> (batch_no, batch_pos) of one stream; rows of seq, time in order."""
    out, clock, begun, number, pos = {}, tb.NO_TIME, None, -1, 0
    for seq, time in rows:
        clock = clock if time is None else max(clock, time)
        if begun is None or pos == size or clock >= begun + timeout:
            begun, number, pos = clock, number + 1, 0
        out[seq] = (number, pos)
        pos += 1
    return out


def found(df):
    rows = df.collect()
    assert len({r["seq"] for r in rows}) == len(rows)
    return {r["seq"]: (r["batch_no"], r["batch_pos"]) for r in rows}


@pytest.mark.parametrize("size, timeout, block, supers", [(5, 20, 8, 2), (1, 7, 4, 3), (8, 1, 8, 2), (7, 10**9, 16, 2), (4, 60, 64, 4)])
def test_small_blocks_equal_the_sequential_rule(spark, monkeypatch, size, timeout, block, supers):
    monkeypatch.setattr(tb, "BLOCK_POSITIONS", block)
    monkeypatch.setattr(tb, "SUPER_BLOCKS", supers)
    rnd = random.Random(size * timeout)
    rows, clock = [], 0
    for seq in rnd.sample(range(2000), 240):
        rows.append(seq)
    rows.sort()
    data = []
    for seq in rows:
        clock += rnd.choice((0, 0, 1, 3, 10, 50))
        data.append((seq, rnd.choice(("a", "a", "a", None, "b")), rnd.choice((clock, clock, clock, clock - 30, None))))
    df = spark.createDataFrame(data, "seq bigint, k string, t bigint").repartition(5)
    got = tb.number_timed_batches(df, ["k"], F.col("t"), batch_size=size, timeout_ns=timeout)
    want = {}
    for k in ("a", "b", None):
        want |= sequential([(s, t) for s, key, t in data if key == k], size, timeout)
    assert got.columns == ["seq", "k", "t", "batch_no", "batch_pos"]
    assert found(got) == want


@pytest.mark.usefixtures("no_broadcast")
def test_one_hot_stream_without_broadcasts(spark, monkeypatch):
    monkeypatch.setattr(tb, "BLOCK_POSITIONS", 256)
    monkeypatch.setattr(tb, "SUPER_BLOCKS", 4)
    rng = np.random.default_rng(3)
    times = np.cumsum(rng.exponential(20.0, 6000)).astype(int).tolist()
    df = spark.createDataFrame(list(enumerate(times)), "seq bigint, t bigint").repartition(6)
    got = tb.number_timed_batches(df, [], F.col("t"), batch_size=100, timeout_ns=1500)
    assert found(got) == sequential(list(enumerate(times)), 100, 1500)


def test_messages_use_their_own_time(spark):
    log = log_of(spark, [
        schema(1, SEG_A, "e", [("a", "int8")]), event(2, SEG_A, 100, "e", []), schema(3, SEG_A, "f", []),
        event(4, SEG_A, 90, "e", []), event(5, SEG_A, 199, "e", []), event(6, SEG_A, 200, "e", []),
    ])
    got = found(tb.number_timed_batches(log, ["segment_id"], batch_size=10, timeout_ns=100))
    assert got == {1: (0, 0), 2: (1, 0), 3: (1, 1), 4: (1, 2), 5: (1, 3), 6: (2, 0)}


def test_empty_and_refused(spark):
    df = spark.createDataFrame([], "seq bigint, k string, t bigint")
    assert tb.number_timed_batches(df, ["k"], F.col("t")).count() == 0
    for bad in ({"batch_size": 0}, {"timeout_ns": 0}, {"batch_size": tb.BLOCK_POSITIONS + 1}):
        with pytest.raises(ValueError):
            tb.number_timed_batches(df, ["k"], F.col("t"), **bad)
