"""Readers, writers and the stream."""

import json

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from modelweave.operators import changes as C
from modelweave.plans.queries import registered
from modelweave.plans.workspace import workspace
from modelweave.schemas import FAMILIES, LIBRARY, struct
from modelweave.sources import document_sets as S
from modelweave.sources import tables as TB
from modelweave.streaming import changes as ST
from tests.conftest import rows


def test_files_one_per_table(spark, tmp_path):
    (tmp_path / "primitiveDataTypes.json").write_text(
        '{"resource":"r","uuid":"1","name":"Real","datatypeMapDefinition":"xsd:double"}\n'
        '{"resource":"r","uuid":"2","name":"Integer","datatypeMapDefinition":"xsd:integer"}\n')
    (tmp_path / "enumeration2literals.json").write_text('{"resource":"r","enumeration":"e","literal":"l","index":3}\n')
    tables = TB.read_library(spark, str(tmp_path))
    assert set(tables) == set(LIBRARY)
    assert rows(tables["primitiveDataTypes"], "uuid") == [("1",), ("2",)]
    assert rows(tables["enumeration2literals"]) == [("r", "e", "l", 3)]
    absent = tables["attributes"]
    assert absent.count() == 0 and absent.columns == ["resource", "uuid", "name"]


def test_malformed_row_fails_the_load(spark, tmp_path):
    (tmp_path / "attributes.json").write_text('{"resource":"r","uuid":"1"}\n{not json}\n')
    with pytest.raises((PySparkException, Py4JJavaError)):
        TB.read_metamodel(spark, str(tmp_path))["attributes"].collect()


@pytest.mark.parametrize("family", sorted(FAMILIES))
@pytest.mark.parametrize("by_resource", [False, True])
def test_round_trip_of_every_table(spark, tmp_path, family, by_resource):
    sample = {"string": "x", "int": 7, "boolean": True}
    tables = {}
    for name, ddl in FAMILIES[family].items():
        schema = struct(ddl)
        tables[name] = spark.createDataFrame([tuple(sample[f.dataType.simpleString()] for f in schema.fields)], schema)
    TB.write_tables(tables, str(tmp_path), family, by_resource=by_resource)
    back = TB.read_tables(spark, str(tmp_path), family)
    for name, df in tables.items():
        assert rows(back[name].select(*df.columns)) == rows(df), name


def _errors(spark, severity):
    return spark.createDataFrame([("r", "e", severity, "c", "m")],
                                 "resource string, element string, severity string, code string, message string")


def test_errors_are_written_with_the_tables(spark, tmp_path):
    one = spark.createDataFrame([("r", "Model")], "resource string, kind string")
    TB.write_profiles_and_models({"resources": one}, {"resources": one}, str(tmp_path), _errors(spark, "fatal"))
    assert spark.read.json(f"{tmp_path}/models/errors").count() == 1
    assert spark.read.json(f"{tmp_path}/models/resources").count() == 1


def test_strict_export_refuses_fatal_errors(spark, tmp_path):
    one = spark.createDataFrame([("r", "Model")], "resource string, kind string")
    with pytest.raises(ValueError):
        TB.write_tables({"resources": one}, f"{tmp_path}/a", "Model", _errors(spark, "fatal"), strict=True)
    TB.write_tables({"resources": one}, f"{tmp_path}/b", "Model", _errors(spark, "error"), strict=True)
    assert spark.read.json(f"{tmp_path}/b/resources").count() == 1


# ---------------------------------------------------------------- document sets


def _document(n):
    return {
        "characteristics": {"packageURI": f"urn:{n:03d}", "documentURL": "u", "artifactKind": {"type": "k"},
                            "nsPrefix": "n", "uuidPrefix": "p"},
        "toolSpecificPackageID": f"T{n}", "toolSpecificPackageURL": "t", "overrideID": [], "overrideUUID": [],
        "excludeNestedElements": []}


def _set_file(path, *numbers):
    path.write_text(json.dumps({"documents": [_document(n) for n in numbers]}, indent=2))
    return str(path)


def test_document_sets_keep_order_and_append_the_selection(spark, tmp_path):
    a, b = _set_file(tmp_path / "a.json", 3, 1), _set_file(tmp_path / "b.json", 2)
    selection = S.read_document_set(spark, b).select(*S.document_schema().fieldNames())
    found = S.read_document_sets(spark, [a, b], selection)
    assert found.count() == 4
    assert rows(found.filter(F.col("file").endswith("a.json")), "place", "toolSpecificPackageID") == [(0, "T3"), (1, "T1")]
    assert S.read_document_set(spark, None).count() == 0


def test_one_bad_document_set_fails_all(spark, tmp_path):
    good, bad = _set_file(tmp_path / "a.json", 1), tmp_path / "b.json"
    bad.write_text('{"documents": [ {"toolSpecificPackageID": ')
    with pytest.raises((PySparkException, Py4JJavaError)):
        S.read_document_sets(spark, [good, str(bad)]).collect()


@pytest.mark.parametrize("per_file", [2, 100])
def test_document_set_round_trip(spark, tmp_path, per_file):
    source = S.read_document_set(spark, _set_file(tmp_path / "a.json", *range(7)))
    S.write_document_set(source.select(*S.document_schema().fieldNames()), f"{tmp_path}/out", per_file)
    back = S.read_document_set(spark, f"{tmp_path}/out")
    fields = S.document_schema().fieldNames()
    assert rows(back, *fields) == rows(source, *fields)
    assert back.select("file").distinct().count() == (4 if per_file == 2 else 1)


# ---------------------------------------------------------------- stream


def test_stream_equals_batch_and_calls_every_notifier(spark, small, tmp_path):
    w = workspace(spark, small)
    for txn in ("2024-01-01", "2024-01-02", "2024-01-03"):
        w.graph.change.filter(F.col("txn") == txn).coalesce(1).write.mode("append").parquet(f"{tmp_path}/commits")
    calls = []
    run = ST.classify_stream(
        ST.read_changes(spark, f"{tmp_path}/commits", stream=True), w.business.changes,
        [ST.write_records(f"{tmp_path}/records"), ST.write_change_events(f"{tmp_path}/log"),
         lambda records, batch: calls.append((batch, records.count()))],
        f"{tmp_path}/offsets", available_now=True)
    run.awaitTermination()
    batch = C.classify_changes(ST.read_changes(spark, f"{tmp_path}/commits"), w.business.changes)
    stream = spark.read.parquet(f"{tmp_path}/records").drop("batch")
    assert rows(stream, *sorted(stream.columns)) == rows(batch, *sorted(batch.columns))
    assert len(calls) == 1 and sum(n for _, n in calls) == batch.count()  # three commits, one batch
    assert spark.read.json(f"{tmp_path}/log").count() == batch.count()


def test_repeated_batch_replaces_its_records(spark, tmp_path):
    frame = spark.createDataFrame([("t", 1, "d", "x")], "txn string, seq bigint, description string, event string")
    write = ST.write_change_events(str(tmp_path))
    write(frame, 0)
    write(frame, 0)
    write(frame, 1)
    log = spark.read.json(str(tmp_path))
    assert rows(log, "batch", "record") == [(0, '{"txn":"t","seq":1,"event":"x"}'), (1, '{"txn":"t","seq":1,"event":"x"}')]


# ---------------------------------------------------------------- invariants on the star graph


def test_rows_and_errors_cover_all_elements(spark, small):
    q = registered()
    total = workspace(spark, small).graph.element.join(
        workspace(spark, small).graph.document.filter("kind = 'Model'").select("resource"), "resource", "left_semi")
    assert q["model_elements"](spark, small).count() + q["model_element_errors"](spark, small).count() == total.count()


def test_ordered_and_unordered_owner_tables_cover_all_attributes(spark, small):
    q = registered()
    parts = [q[f"metaclass2{o}_{k}_attribute"](spark, small).count()
             for o in ("ordered", "unordered") for k in ("atomic", "enumeration", "structured")]
    assert sum(parts) == q["attributes"](spark, small).count()
