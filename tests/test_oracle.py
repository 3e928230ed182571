"""Every registered query against its SQL on the smallest data."""

import pytest

import __spark_entry__ as entry
from modelweave.plans.oracle import oracle
from modelweave.plans.queries import registered
from tests.compare import connect, difference

QUERIES = registered()
SQL = oracle()


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, small, con, name):
    df = QUERIES[name](spark, small)
    assert difference(df, con, SQL[name]) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [bad for bad in ("CartesianProduct", "PythonUDF", "InPandas") if bad in plan]


HOT = (
    "ordered_links", "ordered_atomic_values", "model_elements", "taxonomy", "atomic_attributes", "containment_forward",
    "assoc_generalizations", "applied_stereotypes", "errors_by_element", "library_imports", "classify_changes",
    "missing_dependencies", "ordered_atomic_tags", "unordered_stereotype_refs", "resolve_profile", "typed_values",
)


@pytest.fixture(scope="module")
def no_broadcast_all_hot(spark):
    """Nothing may be broadcast and 50 rows make a key hot, so every join is salted."""
    settings = {"spark.modelweave.broadcastRows": "0", "spark.modelweave.hotRows": "50"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


@pytest.mark.parametrize("name", HOT)
def test_hot_key_paths_equal_sql(spark, small, con, no_broadcast_all_hot, name):
    # another spelling of the folder: a workspace of its own, built under these settings
    assert difference(QUERIES[name](spark, small + "/."), con, SQL[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
