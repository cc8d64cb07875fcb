"""The registered operator queries and the pipeline against SQL, at the smallest scale."""

from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from trainlake.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    with duckdb.connect() as connection:
        for t in ("documents", "embeddings", "pages", "benchmark"):
            connection.execute(f"create view {t} as select * from '{SF_DIR}/{t}.parquet'")
        yield connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, db, name):
    ours = QUERIES[name](spark, SF_DIR)
    theirs = db.sql(ORACLES[name])
    names = sorted(ours.columns)
    assert names == sorted(theirs.columns)
    rows = Counter(map(repr, map(tuple, ours.select(*names).collect())))
    assert rows == Counter(map(repr, theirs.select(*[f'"{n}"' for n in names]).fetchall())) and rows


def test_there_is_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    given = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF_DIR)
        assert after.columns == docs.columns, name
        docs = spark.createDataFrame(after.collect(), after.schema)
    left = {r.doc_id: r.text for r in docs.collect()}
    assert 0 < len(left) < len(given) and sum(left[i] == given[i] for i in left) > len(left) / 2
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == set(left)
