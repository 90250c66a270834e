"""Every registered query beside its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from check_oracle import compare, connect
from pairclf.plans.oracle import ORACLE
from pairclf.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, connection, name):
    assert compare(spark, connection, SF_DIR, name) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_entry_gives_the_best_model_of_every_pair(spark):
    best = entry.entry(spark).collect()
    assert len(best) == 45 and all(row["numIter"] in (10, 50, 100, 300) for row in best)


def test_the_rest_works_where_the_corpus_operators_cannot_be_imported(monkeypatch):
    import sys

    monkeypatch.setitem(sys.modules, "pairclf.llm.queries", None)
    assert set(entry.queries()) == set(QUERIES) and set(entry.oracle_sql()) == set(ORACLE)
