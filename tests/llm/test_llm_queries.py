"""Every query with SQL against DuckDB, the others for one row per input row."""

import pytest
from compare import assert_same, connect
from conftest import DATA
from messy import empty, messy

import corpus_pipeline
from ratingloom.llm.queries import ORACLES, QUERIES
from ratingloom.session import durable


@pytest.fixture(scope="module")
def con():
    return connect(DATA)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, con, name):
    assert_same(QUERIES[name](spark, DATA), con, ORACLES[name])


def test_one_query_per_operator():
    assert sorted({int(n[2:].split("_")[0]) for n in QUERIES}) == list(range(1, 14))


def test_pipeline_keeps_clean_documents(spark):
    stages = [name for name, _ in corpus_pipeline.STAGES]
    assert len(stages) == 5
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    before = {r.doc_id: r.text for r in docs.collect()}
    result = corpus_pipeline.run(spark, DATA).collect()
    assert 0.5 * len(before) < len(result) < len(before)
    assert len({r.doc_id for r in result}) == len(result)
    same = sum(before[r.doc_id] == r.text for r in result)
    assert same > 0.8 * len(result)
    assert all(r.n_chars == len(r.text) for r in result if before[r.doc_id] != r.text)
    assert all(0 < r.taken <= 2 * r.size for r in result)


def chained(spark, docs):
    """All stages one after the other; what each returns."""
    tables = []
    for _, stage in corpus_pipeline.STAGES:
        docs = durable(stage(spark, docs, DATA))
        tables.append(docs)
    return tables


def test_pipeline_over_awkward_rows(spark):
    docs = messy(spark)
    *kept, mixed = chained(spark, docs)
    assert all(table.columns == docs.columns for table in kept)
    ids = [sorted(str(r.doc_id) for r in table.select("doc_id").collect()) for table in (docs, *kept)]
    for before, after in zip(ids, ids[1:]):
        assert not set(after) - set(before) and len(after) <= len(before)
    # texts without words are nobody's copies, and clean ones stay
    assert {"1", "2", "3", "4", "5", "6", "7", "12", "13"} <= set(ids[-1])
    assert ids[2].count("9") == 1 and "10" not in ids[2] and ids[2].count("None") == 1
    assert mixed.count() > 0 and mixed.where("taken < 1 OR taken > 2 * size").isEmpty()


def test_pipeline_over_an_empty_table(spark):
    assert [table.count() for table in chained(spark, empty(spark))] == [0] * 5
