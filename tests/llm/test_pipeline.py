"""The pipeline stage by stage, and the queries of the subpackage."""

from __future__ import annotations

import os
import random
import re

import pytest

import corpus_pipeline
from skycat.llm import queries as q
from skycat.llm.common import written
from tests.compare import TESTDATA, check, connect
from tests.llm import data

SF_DIR = f"{TESTDATA}/sf0.001"


@pytest.fixture
def folder(spark, tmp_path):
    rng = random.Random(12)
    item = data.prose(rng, 40)
    rows, labels = [], []
    for i in range(120):
        rows.append((i, data.prose(rng, 80) + (" you vile troll and liar " if i % 4 == 0 else " kind words "), "en", "s", 1))
        labels.append((i, 1, int(i % 4 == 0)))
    rows.append((200, rows[1][1], "en", "s", 1))
    rows.append((201, data.prose(rng, 30) + " kind words " + item, "en", "s", 1))
    rows.append((202, data.prose(rng, 30) + ' kind words password="abcdef123456"', "en", "s", 1))
    rows.append((None, "kind words", None, None, None))
    spark.createDataFrame(rows, data.SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(0, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, left = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, folder))
        left[name] = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert name == corpus_pipeline.STAGES[-1][0] or docs.columns == columns
        if name == "secret_scan":
            assert "abcdef123456" not in next(r["text"] for r in docs.collect() if r["doc_id"] == 202)
    clean = {i for i in range(120) if i % 4}
    assert left["toxicity"] == clean | {200, 201, 202, None}
    assert left["near_dedup"] == clean | {201, 202, None}
    assert left["decontamination"] == left["secret_scan"] == left["sentencepiece"] == clean | {202, None}
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, folder).collect()} == left["sentencepiece"]


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
@pytest.mark.parametrize("name", list(q.ORACLES))
def test_query_equals_sql(spark, name):
    problem, _ = check(spark, connect(SF_DIR), q.QUERIES[name], q.ORACLES[name], SF_DIR)
    assert problem == ""


def test_names_of_queries():
    import __spark_entry__ as entry

    names = [n for n in entry.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()
