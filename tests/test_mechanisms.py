"""Closures and cycles, overrides, gates, loss proof, commits as units, all-or-none notification, many sets in one read."""

import json
import re

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException, StreamingQueryException
from pyspark.sql import functions as F

from modelweave.functions import scale as SC
from modelweave.operators import changes as C
from modelweave.operators import checks as X
from modelweave.operators import documents as D
from modelweave.operators import errors as E
from modelweave.operators import lookups as U
from modelweave.operators import taxonomy as T
from modelweave.operators import values as V
from modelweave.plans.workspace import workspace
from modelweave.schemas import ERRORS, RAW, struct
from modelweave.sources import document_sets as S
from modelweave.sources import tables as TB
from modelweave.streaming import changes as ST
from modelweave.streaming import commits as CM
from tests.conftest import rows
from tests.test_io import _document, _set_file
from tests.test_quirks import PAIR_DDL, _pair

# ---------------------------------------------------------------- closure and cycles


def _graph(spark, edges, nodes=None):
    nodes = nodes or sorted({x for e in edges for x in e})
    classes = spark.createDataFrame([("r", n) for n in nodes], "resource string, uuid string")
    return classes, spark.createDataFrame(edges, "specific string, general string")


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    n = 600
    classes, edges = _graph(spark, [(f"c{i:04d}", f"c{i + 1:04d}") for i in range(n - 1)])
    written = []
    real = T.materialize
    monkeypatch.setattr(T, "materialize", lambda df, label: written.append(label) or real(df, label))
    found = T.closure(classes, edges)
    assert found.count() == n * (n + 1) // 2
    assert len(written) <= 13  # one per doubling of 600 and the edges
    wrong = found.filter(F.col("depth") != F.substring("ancestor", 2, 4).cast("int") - F.substring("node", 2, 4).cast("int"))
    assert wrong.isEmpty()


def test_depth_is_the_shortest_over_shortcuts(spark):
    edges = [(f"n{i}", f"n{i + 1}") for i in range(9)] + [("n0", "n4"), ("n2", "n9"), ("n4", "n6")]
    classes, given = _graph(spark, edges)
    got = {(a, b): d for a, b, d in rows(T.closure(classes, given))}
    best = {(n, n): 0 for n in {x for e in edges for x in e}}
    for _ in range(10):
        for (a, b), d in list(best.items()):
            for x, y in edges:
                if x == b:
                    best[a, y] = min(best.get((a, y), 99), d + 1)
    assert got == best


def test_cycles_are_named_once_each(spark):
    edges = [("a", "b"), ("b", "c"), ("c", "a"), ("d", "a"), ("x", "y"), ("y", "x"), ("s", "s"), ("t", "s"), ("a", "a")]
    classes, given = _graph(spark, edges, [*"abcdxyst"])
    pairs = T.closure(classes, given)
    assert rows(T.strong_components(pairs)) == [("a", "a"), ("b", "a"), ("c", "a"), ("x", "x"), ("y", "x")]
    assert rows(T.cyclic_generalizations(classes, pairs, given), "element", "severity", "message") == [
        ("a", "fatal", "Classes generalize each other: 3 from a"),
        ("s", "fatal", "Classes generalize each other: 1 from s"),
        ("x", "fatal", "Classes generalize each other: 2 from x")]
    assert T.closure(classes, given.filter("false")).count() == 8
    assert T.cyclic_generalizations(classes, T.closure(classes, given.filter("false")), given.filter("false")).isEmpty()


# ---------------------------------------------------------------- overrides


@pytest.fixture(scope="module")
def diamond(spark):
    nodes = spark.createDataFrame([("r", c, c.upper()) for c in "abcdet"], "resource string, uuid string, name string")
    edges = spark.createDataFrame(
        [("d", "b"), ("d", "c"), ("b", "a"), ("c", "a"), ("e", "d")], "specific string, general string")
    return nodes, T.taxonomy(nodes.select("uuid", "name"), edges).cache()


def test_incomparable_holders_are_an_error(spark, diamond):
    classes, taxa = diamond
    pairs = spark.createDataFrame(
        [_pair("a", "1", "x"), _pair("b", "2", "x__from_A"), _pair("c", "3", "x"), _pair("a", "4", "y"), _pair("b", "5", "y")],
        PAIR_DDL)
    kept = U.minimal_holders(U.inherited_keys(pairs, taxa, redefining=True), taxa)
    assert rows(kept.filter("metaclass = 'd'"), "key", "holder") == [("x", "b"), ("x", "c"), ("y", "b")]
    found = U.ambiguous_features(pairs, taxa, classes, redefining=True)
    assert rows(found, "element", "message") == [
        ("d", "2 unrelated classes give the feature x, among them b"),
        ("e", "2 unrelated classes give the feature x, among them b")]
    below = pairs.unionByName(spark.createDataFrame([_pair("d", "9", "x")], PAIR_DDL))
    assert U.ambiguous_features(below, taxa, classes, redefining=True).isEmpty()
    # the forward lookup takes one of the minimal holders
    chosen = U.containment_forward(pairs, taxa).join(
        kept.select("metaclass", "key", "association"), ["metaclass", "key", "association"], "left_anti")
    assert chosen.isEmpty()


# ---------------------------------------------------------------- gates


def _step(spark, good, bad, severity="error"):
    table = spark.createDataFrame([(r, "x") for r in good], "resource string, uuid string")
    errors = spark.createDataFrame([(r, "e", severity, "c", "m") for r in bad], struct(ERRORS))
    return lambda resources: E.Result(
        table.join(resources, "resource", "left_semi"), errors.join(resources, "resource", "left_semi"))


def test_a_step_with_errors_only_stops_its_document(spark):
    chain = E.Chain(spark.createDataFrame([(r,) for r in ("a", "b", "c", "c", None)], "resource string"))
    chain.step("one", _step(spark, ["a", "a", "c"], ["a", "b"]))
    two = chain.step("two", _step(spark, ["a", "b", "c"], []))
    chain.step("three", _step(spark, [], ["c"], severity="warning"))
    assert rows(two.rows, "resource") == [("a",), ("c",)]
    assert rows(chain.gates()) == [
        ("a", 0, "one", 2, 1, "partial"), ("a", 1, "two", 1, 0, "done"), ("a", 2, "three", 0, 0, "done"),
        ("b", 0, "one", 0, 1, "stopped"),
        ("c", 0, "one", 1, 0, "done"), ("c", 1, "two", 1, 0, "done"), ("c", 2, "three", 0, 0, "done")]


def test_strict_stops_for_a_package_that_is_not_found(spark, tmp_path):
    wanted = spark.createDataFrame([("T1",), ("T2",)], "tool_package_id string")
    packages = spark.createDataFrame([("r", "u", "Package", "n", None, False, "T1", None)], struct(RAW["element"]))
    one = spark.createDataFrame([("r", "Model")], "resource string, kind string")
    for strict in (False, True):
        errors = D.lookup_document_packages(wanted, packages, strict=strict).errors
        if strict:
            with pytest.raises(ValueError, match="fatal"):
                TB.write_tables({"resources": one}, f"{tmp_path}/{strict}", "Model", errors, strict=True)
        else:
            TB.write_tables({"resources": one}, f"{tmp_path}/{strict}", "Model", errors, strict=True)
            assert spark.read.json(f"{tmp_path}/{strict}/resources").count() == 1


def test_ways_to_missing_packages(spark):
    selection = spark.createDataFrame([("a",), ("b",)], "scope_package string")
    imports = spark.createDataFrame(
        [("a", "x", "P"), ("b", "x", "P"), ("x", "y", "P"), ("b", "z", "P"), ("z", "y", "P"), ("y", "a", "P"), ("q", "r", "P")],
        struct(RAW["import"]))
    applied = spark.createDataFrame([("r", "y", "p"), ("r", None, "p2")], struct(RAW["profile_application"]))
    assert rows(D.missing_dependency_paths(selection, imports, applied)) == [
        ("p", 3, "a > x > y > p"), ("x", 1, "a > x"), ("y", 2, "a > x > y"), ("z", 1, "b > z")]
    assert D.missing_dependency_paths(selection, imports.filter("false"), applied.filter("false")).isEmpty()


# ---------------------------------------------------------------- loss proof


def test_every_planted_loss_is_one_row(spark):
    schema = "table string, resource string, entity string, attribute string, index int, value string"
    given = [("orderedAtomicValues", "r", "e", "a", i, v) for i, v in enumerate(["x", None, "x", "y"])]
    given += [("unorderedLinks", "r", "e", "l", None, v) for v in ("p", "p", "q")]
    expected = spark.createDataFrame(given, schema)

    def found(changed):
        table = spark.createDataFrame(changed, schema)
        numbered = table.withColumn("index", F.coalesce("index", F.hash("value") % 100))
        return X.lost_values(expected, X.collected_values(V.rebuild_slots(numbered, values_per_row=2)))

    assert found(given).isEmpty()
    assert rows(found(given[:-1]), "attribute", "n_expected", "n_found") == [("l", 3, 2)]
    assert rows(found([*given, given[-1]]), "attribute", "n_expected", "n_found") == [("l", 3, 4)]
    swapped = [("orderedAtomicValues", "r", "e", "a", i, v) for i, v in enumerate(["x", "x", None, "y"])] + given[4:]
    assert rows(found(swapped), "attribute", "n_expected", "n_found") == [("a", 4, 4)]
    other = [*given[:5], ("unorderedLinks", "r", "e", "l", None, "q"), given[6]]
    assert rows(found(other), "attribute", "n_expected", "n_found") == [("l", 3, 3)]
    assert rows(found([*given, ("unorderedLinks", "r", "new", "l", None, "q")]), "entity", "n_expected", "n_found") == [
        ("new", 0, 1)]


# ---------------------------------------------------------------- commits


def _events(spark, *of):
    made = [{"txn": t, "seq": s, "entity": f"{t}{s}", "is_element": True, "metaclass": "B", "property": "p"} for t, s in of]
    fields = struct(RAW["change"]).fields
    return spark.createDataFrame([tuple(m.get(f.name) for f in fields) for m in made], struct(RAW["change"]))


def test_commits_wait_until_they_are_whole_and_come_once(spark, tmp_path):
    whole = CM.with_markers(_events(spark, ("a", 1), ("a", 2), ("a", 3), ("b", 4)))
    is_marker = F.col("property") == CM.COMMITTED
    parts = [
        whole.filter((F.col("txn") == "a") & (is_marker | (F.col("seq") == 3))),
        whole.filter((F.col("txn") == "a") & F.col("seq").isin(1, 3)),  # one event comes again
        whole.filter(((F.col("txn") == "a") & (F.col("seq") == 2)) | ((F.col("txn") == "b") & ~is_marker)),
        whole.filter((F.col("txn") == "b") | (F.col("seq") == 2)),  # a late repetition of a commit given out
        whole.filter("txn = 'a'"),
    ]
    buffer = CM.CommitBuffer(spark, f"{tmp_path}/buffer")
    given_out = []
    for batch, part in enumerate(parts):
        for _ in range(2):  # a batch that runs again gives the same
            found = rows(buffer.release(part, batch), "txn", "seq")
        given_out.append(found)
    assert given_out == [[], [], [("a", 1), ("a", 2), ("a", 3)], [("b", 4)], []]
    assert buffer.waiting(4).isEmpty()


def test_split_commits_after_a_restart(spark, small, tmp_path):
    w = workspace(spark, small)
    given = w.graph.change.filter("txn < '2024-01-08'")
    events = CM.with_markers(given).withColumn("_part", F.pmod(F.xxhash64("seq", "txn"), F.lit(3))).cache()
    folders = {x: f"{tmp_path}/{x}" for x in ("in", "out", "offsets", "buffer", "manifest")}
    seen = []
    for part in range(3):
        events.filter(F.col("_part") == part).drop("_part").repartition(2).write.mode("append").parquet(folders["in"])
        run = CM.classify_commits(
            ST.read_changes(spark, folders["in"], stream=True), w.business.changes, [ST.write_records(folders["out"])],
            folders["offsets"], folders["buffer"], available_now=True, manifest=folders["manifest"])
        run.awaitTermination()
        seen.append(ST.notified(spark.read.parquet(folders["out"]), folders["manifest"]).count())
    found = ST.notified(spark.read.parquet(folders["out"]), folders["manifest"]).drop("batch")
    expected = C.classify_changes(given, w.business.changes)
    assert rows(found, *sorted(expected.columns)) == rows(expected, *sorted(expected.columns))
    assert seen[0] < seen[-1] == expected.count()
    for batch in range(3):  # in order, file after file
        files = sorted((tmp_path / "out" / f"batch={batch}").glob("part-*.parquet"))
        order = [(r.txn, r.seq) for f in files for r in spark.read.parquet(str(f)).collect()]
        assert order == sorted(order)


def test_all_notifiers_or_none(spark, small, tmp_path):
    w = workspace(spark, small)
    w.graph.change.filter("txn < '2024-01-03'").write.parquet(f"{tmp_path}/in")
    calls = []

    def fails_once(records, batch_id):
        calls.append(batch_id)
        if len(calls) == 1:
            raise RuntimeError("planned")

    def run():
        ST.classify_stream(
            ST.read_changes(spark, f"{tmp_path}/in", stream=True), w.business.changes,
            [ST.write_records(f"{tmp_path}/out"), fails_once], f"{tmp_path}/offsets", available_now=True,
            manifest=f"{tmp_path}/manifest").awaitTermination()

    ST.notify_all(spark.range(0), -1, [], f"{tmp_path}/manifest")  # a manifest that names another batch
    with pytest.raises(StreamingQueryException):
        run()
    written = spark.read.parquet(f"{tmp_path}/out")
    n = written.count()
    assert n > 0 and ST.notified(written, f"{tmp_path}/manifest").isEmpty()
    run()
    assert calls == [0, 0]
    assert ST.notified(spark.read.parquet(f"{tmp_path}/out"), f"{tmp_path}/manifest").count() == n


# ---------------------------------------------------------------- many sets in one read


def test_many_sets_are_one_scan(spark, tmp_path):
    paths = [_set_file(tmp_path / f"s {n}.json", n, n + 50) for n in range(12)]
    S.write_document_set(
        S.read_document_sets(spark, paths[:5]).select(*S.document_schema().fieldNames()), f"{tmp_path}/folder", 3)
    found = S.read_document_sets(spark, [*paths, f"{tmp_path}/folder", paths[0]])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan json") == 1 and "Union" not in plan
    got = rows(found, "set", "block", "place", "toolSpecificPackageID")
    assert [g for g in got if g[0] == 3] == [(3, 0, 0, "T3"), (3, 0, 1, "T53")]
    assert [g[3] for g in got if g[0] == 13] == ["T0", "T50"]
    assert sorted(g[3] for g in got if g[0] == 12) == sorted(f"T{n + d}" for n in range(5) for d in (0, 50))
    assert {g[1] for g in got if g[0] == 12} == {0, 1, 2, 3}


def test_a_bad_set_is_named(spark, tmp_path):
    good, bad = _set_file(tmp_path / "good.json", 1), tmp_path / "bad.json"
    bad.write_text(json.dumps({"documents": [_document(1)]})[:-20])
    with pytest.raises((PySparkException, Py4JJavaError), match=r"bad\.json"):
        S.read_document_sets(spark, [good, str(bad)]).collect()


# ---------------------------------------------------------------- counts in the pass that writes


def _errors(spark, *rows_):
    return spark.createDataFrame(list(rows_), struct(ERRORS))


def test_a_report_counts_while_it_writes(spark):
    one = _errors(spark, ("r", "a", "error", "c", "m"), ("r", "a", "error", "c", "m"), ("r", None, "fatal", "c", None))
    two = _errors(spark, ("r", "a", "error", "c", "m"), ("r", "b", "warning", "c", "m"))
    found = E.report({"first": one, "second": two, "third": two.filter("false")})
    assert rows(found.by_step()) == [("first", "error", 1), ("first", "fatal", 1), ("second", "warning", 1)]
    assert found.counts["third", "fatal"] == 0 and len(found.counts) == 9
    assert rows(found.errors, "element", "step") == [("a", "first"), ("b", "second"), (None, "first")]
    with pytest.raises(ValueError, match="fatal errors: first 1$"):
        found.stop()
    none = E.report({"only": two.filter("false")})
    none.stop()
    assert none.by_step().isEmpty() and none.errors.isEmpty()


def test_errors_are_read_once_for_their_totals(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(x):
        seen.add(1)
        return x

    given = _errors(spark, *[("r", f"e{i % 3}", "error", "c", f"m{i}") for i in range(30)]).repartition(2)
    found = E.errors_by_element(given.withColumn("message", counted.asNondeterministic()("message")), "root")
    assert {(r.n_messages, r.n_of_element, r.n_of_all) for r in found.collect()} == {(10, 10, 30)}
    assert seen.value == 30


def test_metrics_of_empty_and_filled_tables(spark):
    n = {"n": F.count(F.lit(1)), "top": F.max("id")}
    kept, seen = SC.measured(spark.range(1000).filter("id % 7 = 0"), "some", n)
    assert seen == {"n": kept.count(), "top": 994}
    kept, seen = SC.measured(spark.range(10).filter("id < 0"), "none", n)
    assert seen["n"] == 0 and seen["top"] is None and kept.isEmpty()


# ---------------------------------------------------------------- buckets


def _above(plan, line_mark):
    """The operators above the line that holds the mark, nearest first, up to the next join."""
    lines = plan.split("\n")
    at = next(i for i, line in enumerate(lines) if line_mark in line)
    depth, out = re.search(r"[A-Za-z*]", lines[at]).start(), []
    for line in reversed(lines[:at]):
        start = re.search(r"[A-Za-z*]", line)
        if start and start.start() < depth:
            depth = start.start()
            out.append(line)
            if "Join" in line:
                break
    return out


def test_references_meet_elements_without_a_shuffle_of_them(spark):
    elements = spark.createDataFrame([(f"e{i}",) for i in range(500)] + [("e1",), (None,)], "uuid string")
    links = spark.createDataFrame([(f"e{i % 510}", "e1", "a") for i in range(2000)] + [(None, "e2", "a")],
                                  "sourceElement string, targetElement string, metaAssociation string")
    universes = {"elements": elements, "associations": spark.createDataFrame([("a",)], "uuid string")}
    expected = rows(X.unresolved_references({"unorderedLinks": links}, universes))
    assert len(expected) == 10
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = SC.bucketed(elements.filter("uuid IS NOT NULL"), "keys", ["uuid"])
        found = X.unresolved_references({"unorderedLinks": links}, universes | {"elements": kept})
        above = _above(found._jdf.queryExecution().executedPlan().toString(), "Bucketed: true")
        assert "SortMergeJoin" in above[-1]
        assert not [line for line in above if "Exchange" in line]
        assert rows(found) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    SC.drop_bucketed(spark)
    assert not spark.catalog.listTables(pattern=f"{SC.BUCKETED}*")


def test_the_workspace_keeps_elements_in_buckets(spark, small):
    w = workspace(spark, small)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        refs = w.graph.slot.select("ref").filter("ref IS NOT NULL").groupBy("ref").count()
        joined = refs.join(w.element_keys.withColumnRenamed("uuid", "ref"), "ref", "left_anti")
        above = _above(joined._jdf.queryExecution().executedPlan().toString(), "Bucketed: true")
        assert not [line for line in above if "Exchange" in line]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_row_texts_tell_nulls_and_separators_apart(spark):
    from modelweave.plans.exports import row_text

    given = [("a|b", "c"), ("a", "b|c"), (None, "~"), ("~", None), ("-", "-"), (None, None), ("", ""), ("1:a", ""), ("1", ":a")]
    df = spark.createDataFrame(given, "x string, y string")
    assert df.select(row_text(df).alias("text")).distinct().count() == len(given)


def test_whole_texts_are_slots(spark, small):
    """Hand-counted: every page, turn and ship date stands in a slot as it is."""
    from modelweave.sources.star import StarGraph

    graph = StarGraph(spark, small)
    for table, column, name in (("pages", "html", "html"), ("conversations", "text", "text"), ("lineitem", "l_shipdate", "shipdate")):
        want = graph.table(table).selectExpr(f"CAST({column} AS {'DATE' if name == 'shipdate' else 'STRING'}) AS value")
        got = graph.slot.filter(f"feature_name = '{name}'").select("value")
        want = want.selectExpr("CAST(value AS STRING) AS value")
        assert want.count() > 0 and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_only_keys_of_several_holders_are_compared(spark):
    given = spark.createDataFrame(
        [("d", "x", "b"), ("d", "x", "c"), ("d", "y", "b"), ("d", "z", "d"), ("d", "z", "b"), ("d", None, "b"), ("d", None, "a")],
        "metaclass string, key string, holder string")
    taxa = spark.createDataFrame(
        [("d", "d"), ("d", "b"), ("d", "c"), ("d", "a"), ("b", "b"), ("b", "a"), ("c", "c"), ("c", "a"), ("a", "a")],
        "metaclass string, supertype string")
    several = U.contested(given.unionByName(given))
    assert several.filter("key = 'y'").isEmpty() and several.count() == 12
    expected = [("d", "x", "b"), ("d", "x", "c"), ("d", "z", "d"), ("d", None, "a"), ("d", None, "b")]
    assert rows(U.minimal_holders(several, taxa)) == sorted(expected, key=repr)
    more = several.withColumn("n", F.lit(1))
    assert rows(U.minimal_holders(more, taxa).select("metaclass", "key", "holder").distinct()) == sorted(expected, key=repr)
