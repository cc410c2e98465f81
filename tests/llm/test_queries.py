"""Every registered query of the subpackage against DuckDB where it has a text, else for its rows."""

import pytest

import corpus_pipeline
from lakekit.llm import queries
from oracle import compare, connect


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_oracle(spark, sf, name):
    err, rows = compare(spark, connect(sf), queries.QUERIES[name], queries.ORACLES[name], sf)
    assert err is None
    assert rows > 0


def test_operators_and_the_pipeline():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_copies", "secrets", "mixture", "encoding"]


def test_pipeline(spark, sf, docs):
    rows = corpus_pipeline.run(spark, sf).collect()
    assert rows and all(r.round_trip for r in rows)
    assert {r.doc_id for r in rows} <= set(docs)


def test_pipeline_stages_on_edges(spark, sf, edges, empty):
    for start in (edges, empty):
        got = start
        for _, stage in corpus_pipeline.STAGES[:-1]:
            got = stage(spark, got, sf)
            assert got.columns == edges.columns
            got.collect()
        corpus_pipeline.STAGES[-1][1](spark, got, sf).collect()
