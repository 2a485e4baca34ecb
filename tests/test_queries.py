"""Registered queries against their SQL twins, and the plans they run with."""

import importlib.util
import pathlib

import pytest

import __spark_entry__ as contract
from tests.messages import SEG_A, event, log_of
from tracelake.model import LOG_DDL
from tracelake.operators import catalog, filters, samples
from tracelake.plans.queries import QUERIES
from tracelake.plans.sample_log import sample_log

ROOT = pathlib.Path(__file__).resolve().parents[1]
DATA = "/root/testdata/sf0.001"

spec = importlib.util.spec_from_file_location("check_oracle", ROOT / "tools" / "check_oracle.py")
check_oracle = importlib.util.module_from_spec(spec)
spec.loader.exec_module(check_oracle)

pytestmark = pytest.mark.skipif(not pathlib.Path(DATA).exists(), reason="no test data here")


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, name):
    df = contract.queries()[name](spark, DATA)
    text = plan(df)
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert name == "wire_round_trip" or "Python" not in text and "InArrow" not in text
    got = check_oracle.normalized(df.columns, [tuple(r) for r in df.collect()])
    names, _, rows = check_oracle.duckdb_rows(DATA, contract.oracle_sql()[name])
    assert got == check_oracle.normalized(names, rows)


def test_entry(spark):
    assert contract.entry(spark).count() == 15


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_event_jobs_do_not_touch_control_branches(spark):
    text = plan(sample_log(spark, DATA).where("kind = 'event'").select("seq"))
    assert text.count("FileScan") == 1 and "Exchange" not in text
    assert "ReadSchema: struct<event_id:bigint>" in text


def test_routing_is_an_equi_join(spark):
    wanted = spark.createDataFrame(
        [("x", None, None, None), ("y", None, "s", None)],
        "subscriber_id string, segment_id string, source_name string, event_name string",
    )
    text = plan(filters.route(sample_log(spark, DATA), wanted))
    assert "BroadcastHashJoin" in text
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_events_are_not_shuffled_to_meet_the_catalog(spark):
    log = spark.createDataFrame([], LOG_DDL).unionByName(
        log_of(spark, [event(1, SEG_A, 0, "e", [("a", "int8", 1)])])
    )
    text = plan(samples.decode_values(log, catalog.fold(log)))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert "hashpartitioning" not in text


def test_latest_values_do_not_sort_the_samples(spark):
    text = plan(samples.latest_values(sample_log(spark, DATA)))
    assert "SortAggregate" not in text and "SortMergeJoin" not in text
