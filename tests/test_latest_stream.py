"""Latest values by a stream against the batch form, with late times and restarts."""

import random

import pytest

from tests.messages import SEG_A, SEG_B, event, log_of, value
from tests.test_streaming import file_stream
from tracelake.model import LOG_DDL
from tracelake.operators.samples import latest_values
from tracelake.session import new_folder
from tracelake.streaming import commits
from tracelake.streaming.latest_stream import LATEST_DDL, latest_now, merge, start_latest, upsert


def events(seed, count):
    """Events whose times jump back and repeat."""
    rnd = random.Random(seed)
    out = []
    for seq in range(count):
        fields = [(rnd.choice("xyz"), "int64", rnd.randrange(100)) for _ in range(rnd.randint(0, 4))]
        out.append(event(seq, rnd.choice((SEG_A, SEG_B)), rnd.choice((seq, seq // 3, 50, 7)), rnd.choice("ef"), fields))
    return out


def rows(df):
    return sorted(map(tuple, df.select("full_name", "time_ns", "value").collect()))


@pytest.mark.parametrize("cuts", [[], [10, 60, 61, 200]])
def test_stream_equals_batch(spark, cuts):
    messages, root = events(1, 300), new_folder(spark, "latest")
    start_latest(file_stream(spark, messages, cuts), root, new_folder(spark, "offsets")).awaitTermination()
    assert rows(latest_now(spark, root)) == rows(latest_values(log_of(spark, messages)))


def test_a_restarted_stream_goes_on(spark, monkeypatch):
    monkeypatch.setattr(commits, "FANOUT", 2)
    messages, root, offsets, path = events(2, 240), *(new_folder(spark, n) for n in ("latest", "offsets", "in"))
    for k in range(4):
        log_of(spark, messages[60 * k : 60 * k + 60]).coalesce(1).write.mode("append").parquet(path)
        log = spark.readStream.schema(LOG_DDL).option("maxFilesPerTrigger", 1).parquet(path)
        start_latest(log, root, offsets).awaitTermination()
        assert rows(latest_now(spark, root)) == rows(latest_values(log_of(spark, messages[: 60 * k + 60])))
    assert len(commits.latest(spark, root).parts) <= 2
    assert merge(spark, root) == 0


def test_repeated_batches_and_an_empty_store(spark):
    root = new_folder(spark, "latest")
    assert latest_now(spark, root).count() == 0
    df = spark.createDataFrame([("s", "a", "m", "x", (5, 1, value("string", "now")))], LATEST_DDL)
    upsert(df, 0, root)
    upsert(df.limit(0), 0, root)
    assert rows(latest_now(spark, root)) == [("s/a/m.x", 5, "now")]
