"""What a query reads and writes: no table that it does not need, no shuffle that a hash can spare."""

import pytest
from pyspark.sql import functions as F

from modelweave.functions import scale
from modelweave.operators import checks as X
from modelweave.operators import values as V
from modelweave.plans.queries import registered
from modelweave.plans.workspace import METAMODEL, MetamodelLookups, Workspace
from modelweave.sources import tables as TB
from modelweave.sources.star import StarGraph
from modelweave.sources.star_sql import ELEMENT_ROWS
from tests.conftest import rows


@pytest.fixture(scope="module")
def own(spark, small):
    """A workspace that only the tests of this file use; the first of them needs no line item."""
    return Workspace(spark, small)


def test_no_table_is_built_that_is_not_asked_for(spark, small, own, monkeypatch):
    monkeypatch.setattr("modelweave.plans.queries.workspace", lambda *_: own)
    found = registered()
    for name in ("lookup_inverse_property", "attr_lookup_ordered_enumeration", "unordered_structured_values"):
        found[name](spark, small)
    assert "containment_reverse" in own.all.__dict__ and "containment_forward" not in own.all.__dict__
    assert "effective" not in own.all.__dict__
    assert "lineitem_at" not in own.graph._tables


def test_elements_of_a_kind_are_those_of_all_elements(own):
    every = own.graph.element
    assert {r[0] for r in every.select("kind").distinct().collect()} == set(ELEMENT_ROWS)
    for kinds in (("Class",), ("Class", "Association"), ("User", "Stereotype", "Package")):
        assert rows(own.graph.elements_of(*kinds)) == rows(every.filter(F.col("kind").isin(*kinds)))


def test_slots_of_a_lookup_keep_every_match(spark, own):
    wanted = spark.createDataFrame([("Order", "total"), ("Vector", "label"), ("Gone", "x")], "metaclass string, feature_name string")
    keys = ["metaclass", "feature_name"]
    assert rows(own.graph.slots_of(wanted).join(wanted, keys)) == rows(own.graph.slot.join(wanted, keys))
    assert rows(own.graph.slots_of(wanted, limit=2)) == rows(own.graph.slot)


def test_lookups_of_a_kind_are_those_of_all_lookups(own):
    every = own.all.attribute_lookups
    for kind, ordered in (("atomic", False), ("atomic", True), ("enumeration", True)):
        found = own.all.attribute_lookups_of(kind, ordered)
        assert rows(found) == rows(every.filter((F.col("kind") == kind) & (F.col("is_ordered") == ordered)), *found.columns)


def test_hot_keys_are_counted_exactly(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 990, F.col("id") % 3).alias("k"), (F.col("id") % 2).alias("j"))
    got = rows(scale.hot_keys(df, ["k", "j"], 100))
    want = df.groupBy("k", "j").agg(F.count(F.lit(1)).alias("n")).filter("n > 100")
    assert got == rows(want) and len(got) == 6
    assert scale.hot_keys(df, ["k", "j"], 1000).count() == 0


def test_cold_keys_write_no_hot_keys(spark, monkeypatch):
    monkeypatch.setattr(scale, "materialize", lambda *_: pytest.fail("keys were counted one by one"))
    df = spark.range(500).select((F.col("id") % 250).alias("k"), "id")
    assert scale.numbered(df, ["k"], ["id"], hot_rows=400).filter("index = 1").count() == 250


def _values(spark, *given):
    return spark.createDataFrame(list(given), "table string, resource string, entity string, attribute string, index int, value string")


def test_losses_are_told_per_collection(spark):
    whole = [("orderedAtomicValues", "r", f"e{i % 50}", f"a{i % 4}", i // 50, f"v{i}") for i in range(400)]
    lost = whole[7]
    left = _values(spark, *[v for v in whole if v != lost])
    n = sum(v[:4] == lost[:4] for v in whole)
    assert rows(X.lost_values(_values(spark, *whole), left)) == [(*lost[:4], n, n - 1)]
    assert rows(X.lost_values(_values(spark, *whole), _values(spark, *whole))) == []
    swapped = _values(spark, *[(*v[:5], "other") if v == lost else v for v in whole])
    found = rows(X.lost_values(_values(spark, *whole), swapped))
    assert len(found) == 1 and found[0][4] == found[0][5]


def test_collections_without_a_key_still_meet_nothing(spark):
    one = _values(spark, ("unorderedLinks", None, "e", "a", None, "v"), ("unorderedLinks", "r", "e", "a", None, "v"))
    assert rows(X.lost_values(one, one)) == [("unorderedLinks", None, "e", "a", 0, 1), ("unorderedLinks", None, "e", "a", 1, 0)]


def test_only_what_differs_is_compared_by_collection(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(X, "_prints", lambda df, n, own=X._prints: seen.append(df.count()) or own(df, n))
    whole = [("orderedLinks", "r", f"e{i}", f"a{i % 2}", 0, "v") for i in range(2000)]
    found = X.lost_values(_values(spark, *whole), _values(spark, *whole[1:]))
    assert rows(found) == [("orderedLinks", "r", "e0", "a0", 1, 0)]
    assert max(seen) < 50


def test_written_tables_are_compressed_and_read_back(spark, tmp_path):
    one = spark.createDataFrame([("r", "Model")], "resource string, kind string")
    TB.write_tables({"resources": one}, str(tmp_path), "Model")
    assert list((tmp_path / "resources").glob("*.json.gz")) and not list((tmp_path / "resources").glob("*.json"))
    assert rows(TB.read_tables(spark, str(tmp_path), "Model")["resources"], *one.columns) == rows(one)


def test_unordered_collections_are_grouped_where_they_are_numbered(spark):
    df = _values(spark, *[("t", "r", f"e{i % 9}", "a", None, f"v{i}") for i in range(90)]).drop("index")
    rebuilt = V.rebuild_slots(scale.numbered(df, ["table", "resource", "entity", "attribute"], ["value"]))
    assert rebuilt._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_lookups_of_one_metamodel_write_no_table_of_all(spark, small):
    w = Workspace(spark, small)
    every = MetamodelLookups(StarGraph(spark, small), w.graph.document.filter(F.col("resource") == METAMODEL), "every")
    for name in ("classes", "features", "oriented", "attributes", "matched", "taxonomy", "attribute_lookups", "forward"):
        assert rows(getattr(w.business, name)) == rows(getattr(every, name)), name
    kept = {"raw_feature", "raw_class", "raw_type", "raw_generalization", "end_pair"}
    assert not kept & set(w.graph._tables) and not w.business.graph.kept
