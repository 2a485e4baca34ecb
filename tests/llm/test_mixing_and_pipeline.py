"""Mixing, the pipeline and the registered queries."""

import collections
import importlib.util
import math
import pathlib

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from tests.llm.messy import TEXTS, empty, messy
from tracelake.llm import mixing
from tracelake.llm.queries import LLM_ORACLE, LLM_QUERIES

ROOT = pathlib.Path(__file__).resolve().parents[2]
DATA = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

spec = importlib.util.spec_from_file_location("check_oracle", ROOT / "tools" / "check_oracle.py")
check_oracle = importlib.util.module_from_spec(spec)
spec.loader.exec_module(check_oracle)

needs_data = pytest.mark.skipif(not pathlib.Path(DATA).exists(), reason="no test data here")


def test_sources_meet_their_weights(spark):
    rows = [(i, "x" * 9, "big" if i < 3000 else "small") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(4)
    got = mixing.mix(docs, {"big": 1.0, "small": 3.0}).collect()
    found = collections.Counter(r.source for r in got)
    # of 4,000: a quarter and three quarters, within five standard deviations
    assert abs(found["big"] - 1000) < 5 * math.sqrt(1000)
    assert abs(found["small"] - 3000) < 5 * math.sqrt(3000)
    copies = collections.defaultdict(list)
    for r in got:
        copies[r.doc_id].append(r.copy)
    assert all(sorted(c) == list(range(1, len(c) + 1)) for c in copies.values())
    # Poisson with mean 3: the share of documents that do not appear
    missing = sum(i not in copies for i in range(3000, 4000)) / 1000
    assert abs(missing - math.exp(-3)) < 0.03


def test_large_rates_are_sums_of_draws(spark):
    docs = spark.createDataFrame([(i, "x", "s") for i in range(200)], "doc_id bigint, text string, source string")
    got = mixing.mix(docs, {"s": 1.0}, total=400 * 100.0).count()
    assert abs(got - 20_000) < 5 * math.sqrt(20_000)


def test_only_listed_sources_and_a_null_source(spark):
    docs = spark.createDataFrame(
        [(i, "x", ["a", None, "b"][i % 3]) for i in range(300)], "doc_id bigint, text string, source string"
    )
    assert {r.source for r in mixing.mix(docs, {None: 1.0, "b": 2.0, "z": 5.0}).collect()} == {None, "b"}
    assert mixing.mix(docs, {}).count() == 0


def test_the_order_is_shuffled_and_repeatable(spark):
    got = [r.shuffle_key for r in mixing.mix(messy(spark)).collect()]
    again = [r.shuffle_key for r in mixing.mix(messy(spark).repartition(7)).collect()]
    assert sorted(got) == sorted(again)


def test_messy_and_empty_tables(spark):
    got = mixing.mix(messy(spark))
    assert [c for c in got.columns if c not in ("copy", "shuffle_key")] == [c for c in messy(spark).columns if c != "copy"]
    assert {r.text for r in got.collect()} <= {t for _, t in TEXTS}
    assert mixing.mix(empty(spark)).count() == 0


def test_without_broadcasts_the_result_is_the_same(spark, no_broadcast):
    got = sorted(r.shuffle_key for r in mixing.mix(messy(spark)).collect())
    spark.conf.set("spark.tracelake.broadcast.maxRows", "1000")
    assert got == sorted(r.shuffle_key for r in mixing.mix(messy(spark)).collect())


def test_the_main_path_is_native(spark):
    text = mixing.mix(messy(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and text.count("REPARTITION_BY_COL") == 1


@needs_data
@pytest.mark.parametrize("name", list(LLM_QUERIES))
def test_query_equals_its_sql(spark, name):
    df = LLM_QUERIES[name](spark, DATA)
    got = [tuple(r) for r in df.collect()]
    assert got
    if name in LLM_ORACLE:
        names, _, rows = check_oracle.duckdb_rows(DATA, LLM_ORACLE[name])
        assert check_oracle.normalized(df.columns, got) == check_oracle.normalized(names, rows)


@needs_data
def test_registered_names():
    names = list(contract.queries())
    assert "pipeline" in names
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op")) == list(range(1, 14))


@needs_data
def test_pipeline_stages_keep_the_columns_and_shrink(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    before = {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, DATA), name)
        assert docs.columns == COLUMNS
        after = {r.doc_id for r in docs.collect()}
        assert after <= before and len(after) > 0.5 * len(before)
        before = after
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, DATA).collect()
    assert {r.doc_id for r in mixed} <= before
    assert sorted(map(repr, mixed)) == sorted(map(repr, corpus_pipeline.run(spark, DATA).collect()))


@needs_data
def test_pipeline_stages_on_messy_and_empty_documents(spark):
    for docs in (messy(spark), empty(spark)):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, DATA)
            out.write.format("noop").mode("overwrite").save()
            assert stage is corpus_pipeline.STAGES[-1][1] or out.columns == docs.columns
