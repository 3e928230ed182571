"""The hot-key paths give the same rows as the plain ones."""

import os
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from modelweave.functions import scale
from modelweave.operators import errors as E
from modelweave.operators import taxonomy as T
from modelweave.operators import values as V
from modelweave.operators.documents import reachable
from tests.conftest import rows


@pytest.fixture(scope="module")
def skewed(spark):
    """1,000 rows, two thirds of them under one key."""
    key = F.when(F.col("id") % 3 == 0, F.concat(F.lit("k"), (F.col("id") % 10).cast("string"))).otherwise("hub")
    return spark.range(1000).select(key.alias("key"), (F.col("id") * 7919 % 1009).alias("v"), "id").cache()


def test_numbered_splits_hot_keys(skewed):
    plain = rows(scale.numbered(skewed, ["key"], ["v", "id"]))
    split = rows(scale.numbered(skewed, ["key"], ["v", "id"], hot_rows=50))
    assert plain == split
    by_key = {}
    for key, _, _, index in split:
        by_key.setdefault(key, []).append(index)
    assert all(sorted(ix) == list(range(len(ix))) for ix in by_key.values())


def test_numbered_keeps_ties_in_one_range(spark):
    df = spark.range(300).select(F.lit("k").alias("key"), (F.col("id") % 3).alias("v"))
    got = [r["index"] for r in scale.numbered(df, ["key"], ["v"], hot_rows=20).orderBy("index").collect()]
    assert got == list(range(300))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_lookup_join_salts_hot_keys(spark, skewed, how):
    lookup = spark.createDataFrame([("hub", "a"), ("hub", "b"), ("k1", "c"), ("zz", "d")], "key string, w string")
    plain = rows(skewed.join(lookup, ["key"], how).select(*sorted(
        skewed.columns if how.startswith("left_") else [*skewed.columns, "w"])))
    for limits in ({"broadcast_rows": 0, "hot_rows": 50}, {"broadcast_rows": 0}, {"broadcast_rows": 2, "hot_rows": 10}):
        got = scale.lookup_join(skewed, lookup, ["key"], how, **limits)
        assert rows(got.select(*sorted(got.columns))) == plain


@pytest.mark.parametrize("how", ["inner", "left", "left_anti"])
def test_lookup_join_spreads_null_keys(spark, how):
    facts = spark.range(300).select(F.when(F.col("id") % 3 == 0, F.lit("k")).alias("key"), "id")
    lookup = spark.createDataFrame([("k", "a"), (None, "b")], "key string, w string")
    plain, split = facts.join(lookup, ["key"], how), scale.lookup_join(
        facts, lookup, ["key"], how, broadcast_rows=0, hot_rows=20)
    assert rows(split.select(*sorted(split.columns))) == rows(plain.select(*sorted(plain.columns)))


@pytest.mark.parametrize("limit", [0, 10])
def test_keep_listed_changes_no_join(spark, skewed, limit):
    lookup = spark.createDataFrame([("hub", 1), ("k1", 2), (None, 3)], "key string, w int")
    kept = scale.keep_listed(skewed, lookup, ["key"], limit)
    assert rows(kept.join(lookup, ["key"])) == rows(skewed.join(lookup, ["key"]))
    assert (kept.count() < skewed.count()) == (limit > 0)


def test_lookup_join_broadcasts_only_counted_small_lookups(spark, skewed):
    lookup = spark.createDataFrame([("hub", "a")], "key string, w string")
    plan = scale.lookup_join(skewed, lookup, ["key"])._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan
    plan = scale.lookup_join(skewed, lookup, ["key"], broadcast_rows=0)._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" not in plan


def test_session_without_a_checkpoint_folder(tmp_path):
    """Intermediate tables go below the warehouse then, and can be removed."""
    (tmp_path / "conf").mkdir()
    script = """
from modelweave.session import local_session
from modelweave.functions import scale
spark = local_session(1)
assert spark.sparkContext.getConf().get("spark.checkpoint.dir") is None
assert scale.materialize(spark.range(3), "three").count() == 3
print("folder", scale.shared_folder(spark))
scale.remove_folders(spark)
"""
    env = os.environ | {"SPARK_CONF_DIR": str(tmp_path / "conf"), "PYTHONPATH": str(Path(__file__).resolve().parents[1])}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    left = tmp_path / "spark-warehouse" / "_intermediate"
    assert str(left) in done.stdout and not list(left.glob("modelweave-*"))


def test_shared_folder_is_the_configured_one(spark):
    assert scale.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scale.new_folder(spark, "x") != scale.new_folder(spark, "x")


def test_closure_ends_on_cycles_and_keeps_the_shortest_depth(spark):
    nodes = spark.createDataFrame([(c,) for c in "abcd"], "uuid string")
    edges = spark.createDataFrame(
        [("a", "b"), ("b", "c"), ("c", "a"), ("a", "c"), ("d", "a"), ("d", "x")], "specific string, general string")
    got = {(r[0], r[1]): r[2] for r in T.closure(nodes, edges).collect()}
    assert got[("a", "c")] == 1 and got[("d", "c")] == 2 and got[("a", "a")] == 0
    assert set(got) == {(x, y) for x in "abc" for y in "abc"} | {("d", y) for y in "abcd"}


def test_taxonomy_lists_general_classes_first(spark):
    classes = spark.createDataFrame([(c, c.upper()) for c in "abcd"], "uuid string, name string")
    # a -> b -> c -> d and a -> d directly: d has depth 1 but must still come before b
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("a", "d")], "specific string, general string")
    found = T.taxonomy(classes, edges).filter("metaclass = 'a'").orderBy("level").collect()
    assert [r["supertype"] for r in found] == ["d", "c", "b", "a"]
    assert [r["depth"] for r in found] == [1, 2, 1, 0]


def test_reachable_ends_on_cycles(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "a"), ("b", "c"), ("x", "y")], "src string, dst string")
    start = spark.createDataFrame([("a",)], "node string")
    assert rows(reachable(start, edges)) == [("a", 0), ("b", 1), ("c", 2)]


def _errors(spark, n):
    return spark.range(n).select(
        F.lit("r").alias("resource"), F.when(F.col("id") < 3, F.lit(None)).otherwise("hub").alias("element"),
        F.lit("error").alias("severity"), F.lit("c").alias("code"),
        F.format_string("m%04d", F.col("id")).alias("message"))


@pytest.mark.parametrize("hot_rows", [10, 10_000])
def test_errors_by_element_keeps_every_message(spark, hot_rows):
    found = E.errors_by_element(_errors(spark, 100).unionByName(_errors(spark, 100)), "model", 20, hot_rows).collect()
    by = {(r["element"], r["block"]): r for r in found}
    assert by[("model", 0)]["messages"] == "m0000\nm0001\nm0002"
    assert [by[("hub", b)]["n_messages"] for b in range(5)] == [20, 20, 20, 20, 17]
    joined = "\n".join(by[("hub", b)]["messages"] for b in range(5))
    assert joined.split("\n") == [f"m{i:04d}" for i in range(3, 100)]


def test_rebuild_slots_continues_long_collections(spark):
    values = spark.range(25).select(
        F.lit("r").alias("resource"), F.lit("e").alias("entity"), F.lit("a").alias("attribute"),
        F.col("id").cast("string").alias("value"), F.col("id").cast("int").alias("index"))
    found = sorted(V.rebuild_slots(values, values_per_row=10).collect(), key=lambda r: r["block"])
    assert [len(r["values"]) for r in found] == [10, 10, 5]
    assert [i for r in found for i in r["indexes"]] == list(range(25))


def test_rounds_of_the_closure_hold_no_node_without_one_below_it(spark, monkeypatch):
    leaves = [(f"leaf{i}", "a") for i in range(50)] + [("leaf0", "c"), ("leaf1", "leaf1")]
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), *leaves], "specific string, general string")
    nodes = spark.createDataFrame([(n,) for n in ["a", "b", "c", "d", *[f"leaf{i}" for i in range(50)]]], "uuid string")
    written, real = [], T.materialize
    monkeypatch.setattr(T, "materialize", lambda df, label: written.append(real(df, label)) or written[-1])
    found = T.closure(nodes, edges)
    rounds = [df for df in written[:-1] if df.columns == ["node", "ancestor", "depth"]]
    assert rounds and all(df.filter("node LIKE 'leaf%' AND node <> 'leaf1'").isEmpty() for df in rounds)
    got = {(r[0], r[1]): r[2] for r in found.filter("node LIKE 'leaf%'").collect()}
    assert len(got) == 50 * 5 and got["leaf0", "c"] == 1 and got["leaf0", "d"] == 2 and got["leaf2", "d"] == 4


@pytest.mark.parametrize("limit", ["0", "3", "100"])
def test_inherited_is_the_join_with_and_without_a_broadcast(spark, limit):
    taxa = spark.createDataFrame(
        [("a", "a"), ("b", "b"), ("c", "c"), ("b", "a"), ("c", "a"), ("c", "b")], "metaclass string, supertype string")
    held = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), ("c", 3), ("x", 4), (None, 5)], "supertype string, v int")
    spark.conf.set("spark.modelweave.broadcastRows", limit)
    try:
        used = scale.used_lookup(held, taxa.filter("metaclass <> supertype"), ["supertype"])
        assert used.count() == (6 if limit == "100" else 3)
        got = rows(T.inherited(taxa, held, "supertype"), "metaclass", "supertype", "v")
    finally:
        spark.conf.unset("spark.modelweave.broadcastRows")
    assert got == rows(taxa.join(held, "supertype"), "metaclass", "supertype", "v")
