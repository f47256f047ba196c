"""The driver contract: every query matches its DuckDB oracle on sf0.001."""

import pytest

import __spark_entry__ as E
from oracle import compare, duck

SF = "/root/testdata/sf0.001"
CORPUS = {k for k in E.queries() if k == "pipeline" or k.startswith("op")}  # tests/llm covers them


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["dataset", "check_name", "column_name", "total", "violations", "passed"]
    assert df.count() == 17


def test_every_query_has_an_oracle():
    assert set(E.queries()) - set(E.oracle_sql()) <= CORPUS
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("key", sorted(set(E.oracle_sql()) - CORPUS))
def test_query_matches_oracle(spark, con, key):
    problems, ns, nd = compare(spark, con, E.queries()[key], E.oracle_sql()[key], SF)
    assert not problems, problems
    assert ns > 0
