"""Queries of the subpackage against their SQL."""

import duckdb
import pytest

from modelweave.llm.oracle import ORACLE
from modelweave.llm.queries import QUERIES
from tests.compare import difference

TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con(small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, small, con, name):
    assert difference(QUERIES[name](spark, small), con, ORACLE[name]) is None


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
