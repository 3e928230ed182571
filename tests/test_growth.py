"""What a query shuffles, writes and keeps on disk as its tables grow."""

import gzip

import pytest
from pyspark.sql import functions as F

from modelweave.functions import scale
from modelweave.operators import checks as X
from modelweave.operators import values as V
from modelweave.plans import exports as B
from modelweave.plans.workspace import workspace
from modelweave.sources import tables as TB
from modelweave.sources.star import StarGraph
from tests.conftest import rows

VALUES = "table string, resource string, entity string, attribute string, index int, value string"


def test_a_written_table_leaves_no_shuffle_files(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(scale, "new_folder", lambda s, label, own=scale.new_folder: seen.append(s.conf.get(scale.FREE_SHUFFLES)) or own(s, label))
    before = spark.conf.get(scale.FREE_SHUFFLES)
    tracker = spark.sparkContext._jsc.sc().env().mapOutputTracker()
    held = tracker.shuffleStatuses().size()
    kept = scale.materialize(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    assert kept.count() == 7 and seen
    assert spark.conf.get(scale.FREE_SHUFFLES) == before
    # the write's own shuffle is gone; only the count above may have left one
    assert tracker.shuffleStatuses().size() <= held + 1


def test_losses_are_the_same_pass_by_pass(spark, monkeypatch):
    whole = [(f"{w}AtomicValues", "r", f"e{i % 50}", f"a{i % 4}", i // 50 if w == "ordered" else None, f"v{i}")
             for i in range(400) for w in ("ordered", "unordered")]
    whole += [(None, "r", "e1", "a", 0, "v"), ("orderedLinks", None, "e1", "a", 0, "v")]
    changed = [v for v in whole if v[5] != "v7"] + [("newLinks", "r", "e", "a", 0, "v")]
    expected, found = spark.createDataFrame(whole, VALUES), spark.createDataFrame(changed, VALUES)
    at_once = rows(X.lost_values(expected, found))
    assert len(at_once) == 7
    labels = []
    monkeypatch.setattr(X, "materialize", lambda df, label, own=X.materialize: labels.append(label) or own(df, label))
    spark.conf.set("spark.modelweave.passRows", "150")
    try:
        assert rows(X.lost_values(expected, found)) == at_once
    finally:
        spark.conf.unset("spark.modelweave.passRows")
    assert labels.count("found-shares") > 4


def test_every_row_is_in_one_pass(spark):
    df = spark.range(3000).select(
        F.element_at(F.array(*[F.lit(x) for x in ("a", "b", "c", None)]), (F.col("id") % 4 + 1).cast("int")).alias("table"),
        F.lit("r").alias("resource"), F.col("id").cast("string").alias("entity"))
    counts = {(r[0], r[1]): r[2] for r in df.filter("table <> 'c'").groupBy("table", X._share()).count().collect()}
    passes = X._passes(counts, 200)
    assert len(passes) > 8
    number = sum((F.coalesce(p, F.lit(False)).cast("int") for p in passes), F.lit(0))
    assert df.filter(number != 1).isEmpty()
    assert all(df.filter(p).count() <= 220 for p in passes[:-1])


def test_single_values_are_whole_collections_without_a_shuffle(spark):
    given = spark.createDataFrame([("t", "r", f"e{i}", "a", i % 3 * 7000, None if i == 1 else f"v{i}") for i in range(9)], VALUES)
    alone = V.rebuild_alone(given)
    assert "Exchange" not in alone._jdf.queryExecution().executedPlan().toString()
    assert rows(alone) == rows(V.rebuild_slots(given))


def test_slots_apart_are_the_slots_of_the_lookup(spark, small):
    graph = StarGraph(spark, small)
    names = ["quantity", "tax", "returnflag", "charges"]
    given = [("LineItem", f, f"ft:{f}") for f in names] + [("Order", "total", "ft:total"), ("LineItem", "discount", "ft:tax")]
    lookup = spark.createDataFrame(given, "metaclass string, feature_name string, target string")
    others, whole = graph.slots_apart(lookup, "target")
    # tax and discount lead to one target, charges come in pairs, orders are not numbered
    assert {r[0] for r in whole.select("feature_name").distinct().collect()} == {"quantity", "returnflag"}
    assert whole.groupBy("entity", "feature_name").count().filter("count > 1").isEmpty()
    assert rows(others.unionByName(whole)) == rows(graph.slots_of(lookup))
    assert graph.slots_apart(lookup, "target", limit=2)[1] is None


def test_line_items_of_one_order_key_are_told_apart(spark, small, tmp_path):
    df = spark.read.parquet(f"{small}/lineitem.parquet").limit(40)
    twice = df.unionByName(df).withColumn("l_orderkey", F.when(F.col("l_orderkey") % 2 == 0, F.col("l_orderkey")))
    twice.write.parquet(f"{tmp_path}/lineitem.parquet")
    graph = StarGraph(spark, str(tmp_path), kept=())
    lookup = spark.createDataFrame([("LineItem", "tax", "t")], "metaclass string, feature_name string, target string")
    _, whole = graph.slots_apart(lookup, "target")
    assert whole.count() == 80 == whole.select("entity").distinct().count()


def test_slot_tables_are_read_where_they_are_used(spark, small, monkeypatch):
    w = workspace(spark, small)
    g, b = w.graph, w.business
    docs = w.selected_documents
    b.forward, b.attribute_lookups
    written = B.slot_tables(B.D.in_documents(g.slot, docs, "Model"), b.attribute_lookups, b.forward)
    monkeypatch.setattr(B, "materialize", lambda *_: pytest.fail("slot tables were written"))
    views = B.slot_views(g.slots_of, b.attribute_lookups, b.forward, docs)
    counts = {r[0]: tuple(r)[1:] for r in _sums(written).collect()}
    assert len(counts) > 5
    for title, df in views.items():
        assert {r[0]: tuple(r)[1:] for r in _sums(df.filter(F.col("table") == title)).collect()}.get(title) == counts.get(title), title


def _sums(df):
    number = F.xxhash64(*sorted(c for c in df.columns if c != "table")).cast("decimal(38,0)")
    return df.groupBy("table").agg(F.count(F.lit(1)), F.sum(number))


def test_references_to_elements_are_shuffled_once(spark):
    links = spark.createDataFrame([(f"e{i % 30}", f"e{i}", "a") for i in range(200)] + [(None, "e1", "b")] * 3,
                                  "sourceElement string, targetElement string, metaAssociation string")
    values = spark.createDataFrame([("t", "e5"), ("t", "gone"), (None, "gone")], "attribute string, value string")
    universes = {
        "elements": spark.createDataFrame([(f"e{i}",) for i in range(198)], "uuid string"),
        "associations": spark.createDataFrame([("a",)], "uuid string"), "attributes": spark.createDataFrame([("t",)], "uuid string"),
    }
    tables = {"unorderedLinks": links, "orderedLinks": links, "orderedStructuredValues": values}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = scale.bucketed(universes["elements"], "keys", ["uuid"])
        found = X.unresolved_references(tables, universes | {"elements": kept})
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("hashpartitioning(reference") == 1 + 2 * 2  # elements; two sides of two small universes
        assert rows(found) == sorted([
            *[(f"{w}Links", "targetElement", f"e{i}", 1) for w in ("ordered", "unordered") for i in (198, 199)],
            *[(f"{w}Links", "metaAssociation", "b", 3) for w in ("ordered", "unordered")],
            ("orderedStructuredValues", "value", "gone", 2)], key=repr)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    scale.drop_bucketed(spark)


def test_lines_are_written_at_the_fastest_level(spark, tmp_path):
    one = spark.range(1, 2000, 1, 1).select(F.concat(F.lit("urn:"), F.xxhash64("id").cast("string")).alias("resource"), F.lit("Model").alias("kind"))
    TB.write_tables({"resources": one}, str(tmp_path), "Model")
    file = next((tmp_path / "resources").glob("*.json.gz")).read_bytes()
    lines = gzip.decompress(file)
    fast, usual = (abs(len(file) - len(gzip.compress(lines, level))) for level in (1, 6))
    assert fast < usual


def test_content_sums_of_any_size(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("x"))
    got = B.table_contents(B.Export({"t": df}, df.limit(0).select(F.col("x").alias("message")))).first()
    number = F.conv(F.substring(F.md5(B.row_text(df)), 1, 15), 16, 10).cast("decimal(38,0)")
    assert (got["n_rows"], got["content"]) == (5000, str(df.select(F.sum(number)).first()[0]))
