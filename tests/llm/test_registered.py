"""Registered queries of the subpackage against DuckDB, and the pipeline against plain steps."""

import re

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from tests.llm.test_decontamination import brute as contaminated
from tests.llm.test_near_duplicates import brute as near
from tidings.llm.oracles import ORACLES
from tidings.llm.queries import QUERIES
from tidings.llm.tables import stored

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_matches_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "benchmark", "conversations", "embeddings"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    cursor = duck.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    got = queries()[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(tuple, got.select(columns).collect()), key=repr) == sorted(cursor.fetchall(), key=repr)


def test_all_are_registered():
    assert {re.match(r"op\d+_", n)[0] for n in QUERIES} == {f"op{i}_" for i in range(1, 14)}
    assert {*QUERIES, "pipeline"} <= set(queries())
    assert set(ORACLES) <= set(oracle_sql())


def test_pipeline_stages_against_plain_steps(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    columns, seen = docs.columns, {"documents": {r["doc_id"]: r["text"] for r in docs.collect()}}
    for name in list(stages)[:-1]:
        docs = stored(stages[name](spark, docs, sf), name)
        assert docs.columns == columns
        seen[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert seen["line_dedup"].keys() == seen["toxicity"].keys() <= seen["documents"].keys()
    groups = near(list(seen["line_dedup"].items()), 5, 80)
    assert seen["near_dedup"].keys() == {i for i, (_, root) in groups.items() if i == root}
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    clean = {r[0] for r in contaminated(list(seen["near_dedup"].items()), items, 10) if r[2] == 0}
    assert seen["decontamination"].keys() == clean
    packed = stages["packing"](spark, docs, sf)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == clean
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 1024").count() == 0


def test_pipeline_leaves_only_what_its_result_reads(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tidings.shared.shared_folder", lambda spark: str(tmp_path))
    packed = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert sorted(p.name.split("-")[0] for p in tmp_path.iterdir()) == ["decontamination", "pieces"]
    assert packed.count()


def test_pipeline_takes_extra_columns_and_no_rows(spark, odd_docs, no_docs):
    sf = "/root/testdata/sf0.001"
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            columns = docs.columns
            docs = stored(stage(spark, docs, sf), name)
            assert name == "packing" or docs.columns == columns
