"""Micro graphs, one behaviour each."""

import pytest
from pyspark.sql import functions as F

from modelweave.functions import expressions as X
from modelweave.operators import changes as C
from modelweave.operators import checks as H
from modelweave.operators import documents as D
from modelweave.operators import errors as E
from modelweave.operators import library as L
from modelweave.operators import links as K
from modelweave.operators import lookups as U
from modelweave.operators import metamodel as M
from modelweave.operators import model as O
from modelweave.operators import profile as P
from modelweave.operators import taxonomy as T
from modelweave.operators import values as V
from modelweave.plans import exports as B
from modelweave.schemas import RAW, struct
from tests.conftest import rows

DEFAULTS = {"string": None, "int": 0, "boolean": False, "bigint": 0}


def table(spark, name, *records):
    """A raw table from dicts; columns left out get a neutral value."""
    schema = struct(RAW[name])
    full = [
        tuple(r.get(f.name, DEFAULTS[f.dataType.simpleString()]) for f in schema.fields) for r in records
    ]
    return spark.createDataFrame(full, schema)


@pytest.fixture(scope="module")
def docs(spark):
    return table(
        spark, "document",
        {"resource": "urn:mm", "scope_package": "pkg:mm", "kind": "Metamodel"},
        {"resource": "urn:mm2", "scope_package": "pkg:mm2", "kind": "Metamodel"},
        {"resource": "urn:lib", "scope_package": "pkg:lib", "kind": "Library"},
        {"resource": "urn:pf", "scope_package": "pf:1", "kind": "Profile"},
        {"resource": "urn:pf2", "scope_package": "pf:2", "kind": "Profile"},
        {"resource": "urn:m", "scope_package": "pkg:m", "kind": "Model"},
    )


@pytest.fixture(scope="module")
def classes(spark):
    return spark.createDataFrame(
        [("urn:mm", u, u.upper(), a) for u, a in (("a", True), ("b", False), ("c", False))],
        "resource string, uuid string, name string, isAbstract boolean")


# ---------------------------------------------------------------- library, documents


def test_unknown_primitive_is_a_fatal_row(spark):
    types = table(spark, "type", {"resource": "r", "uuid": "1", "name": "Real", "type_kind": "primitive"},
                  {"resource": "r", "uuid": "2", "name": "Decimal", "type_kind": "primitive"},
                  {"resource": "r", "uuid": "3", "name": "E", "type_kind": "enumeration"})
    found = L.primitive_types(types)
    assert rows(found.rows) == [("r", "1", "Real", "xsd:double")]
    assert rows(found.errors, "element", "severity", "code") == [("2", "fatal", "unknown-primitive")]


def test_all_primitive_names(spark):
    df = spark.createDataFrame([(n,) for n in X.PRIMITIVE_TYPES], "name string")
    got = dict(rows(df.select("name", X.datatype_of(F.col("name")))))
    assert got == {"Boolean": "xsd:boolean", "Integer": "xsd:integer", "Real": "xsd:double", "String": "xsd:string",
                   "UnlimitedNatural": "xsd:string"}


def test_imports_are_split_by_document_kind_or_written_twice(spark, docs):
    imports = table(spark, "import", {"importer": "pkg:mm", "imported": "pkg:lib"},
                    {"importer": "pkg:mm", "imported": "pkg:mm2"}, {"importer": "pkg:mm", "imported": "pkg:gone"})
    split = D.package_imports(imports, docs, "Metamodel", imported_document_kind="Library")
    assert rows(split.rows) == [("urn:mm", "urn:lib")]
    assert rows(split.errors, "element", "severity") == [("pkg:mm", "warning")]
    both = D.package_imports(imports, docs, "Metamodel")
    assert rows(both.rows) == [("urn:mm", "urn:lib"), ("urn:mm", "urn:mm2")]


def test_profile_imports_must_be_profiles(spark, docs):
    imports = table(spark, "import", {"importer": "pf:1", "imported": "pf:2", "imported_kind": "Profile"},
                    {"importer": "pf:1", "imported": "pkg:mm", "imported_kind": "Package"})
    assert rows(D.package_imports(imports, docs, "Profile", imported_kind="Profile").rows) == [("urn:pf", "urn:pf2")]


def test_missing_package_keeps_the_found_ones(spark):
    elements = table(spark, "element", {"resource": "r", "uuid": "p", "kind": "Package", "tool_id": "T1"},
                     {"resource": "r", "uuid": "x", "kind": "Class", "tool_id": "T2"})
    config = spark.createDataFrame([("T1",), ("T2",), ("T3",)], "tool_package_id string")
    found = D.lookup_document_packages(config, elements)
    assert rows(found.rows, "uuid") == [("p",)]
    assert found.errors.count() == 2


def test_element_without_uuid_is_an_error(spark):
    elements = table(spark, "element", {"resource": "r", "uuid": "p", "kind": "K"},
                     {"resource": "r", "kind": "K", "name": "n"})
    found = D.identity(elements)
    assert rows(found.rows) == [("r", "p")] and rows(found.errors, "severity") == [("fatal",)]


def test_selected_package_without_document(spark, docs):
    selection = spark.createDataFrame([("pkg:m",), ("pkg:none",)], "scope_package string")
    chosen, errors = B.export_selected(selection, docs)
    assert rows(chosen, "resource") == [("urn:m",)] and rows(errors, "element") == [("pkg:none",)]


def test_split_profiles_and_packages(spark):
    elements = table(spark, "element", {"uuid": "p", "kind": "Package"}, {"uuid": "f", "kind": "Profile"},
                     {"uuid": "q", "kind": "Package"})
    selection = spark.createDataFrame([("p",), ("f",)], "scope_package string")
    profiles, packages = D.split_profiles_packages(elements, selection)
    assert rows(profiles, "uuid") == [("f",)] and rows(packages, "uuid") == [("p",)]


# ---------------------------------------------------------------- metamodel


def _association(spark, target_name, missing=False):
    features = table(spark, "feature", {"uuid": "e1", "name": "src", "type": "A", "upper": 1, "is_composite": True},
                     {"uuid": "e2", "name": target_name, "type": "B", "upper": -1, "is_ordered": True})
    association = table(spark, "association", {"resource": "r", "uuid": "as", "name": "n", "end1": "e1",
                                               "end2": "gone" if missing else "e2"})
    return M.orient_associations(association, features)


@pytest.mark.parametrize("name,source,target", [("tgt", "e1", "e2"), ("_tgt", "e2", "e1"), ("UMLtgt", "e2", "e1"),
                                                ("tgt_", "e1", "e2")])
def test_association_orientation(spark, name, source, target):
    found = _association(spark, name)
    assert rows(found.rows, "source_end", "target_end") == [(source, target)]
    roles = dict(rows(M.association_ends(found.rows), "uuid", "role"))
    assert roles[source] == "source"
    assert roles[target] == ("targetReference" if target == "e2" else "targetComposite")


def test_missing_end_is_fatal(spark):
    found = _association(spark, "tgt", missing=True)
    assert found.rows.count() == 0 and rows(found.errors, "code", "severity") == [("association-end-missing", "fatal")]


@pytest.mark.parametrize("source", ["subsets", "redefines"])
@pytest.mark.parametrize("target", ["subsets", "redefines"])
def test_association_generalization(spark, source, target):
    oriented = spark.createDataFrame(
        [("r", "A", "as", "at"), ("r", "B", "bs", "bt"), ("r", "C", "cs", "ct")],
        "resource string, association string, source_end string, target_end string")
    rels = table(spark, "feature_rel", {"feature": "as", "rel": source, "target": "bs"},
                 {"feature": "at", "rel": target, "target": "bt"}, {"feature": "as", "rel": source, "target": "cs"})
    got = rows(M.association_generalizations(oriented, rels))
    assert got == [("r", "A", "B", source == "redefines", target == "redefines")]
    assert M.association_generalizations(oriented, rels, (source, target)).count() == 1


def test_parent_outside_the_metamodel_is_not_written(spark):
    classes = spark.createDataFrame([("r1", "a"), ("r1", "b"), ("r2", "c")], "resource string, uuid string")
    edges = table(spark, "generalization", {"specific": "a", "general": "b"}, {"specific": "a", "general": "c"},
                  {"specific": "a", "general": "z"})
    assert rows(M.metaclass_generalizations(edges, classes)) == [("r1", "a", "b")]


def test_attribute_numbering_drops_derived_for_atomic_only(spark, classes):
    features = table(
        spark, "feature", {"uuid": "f0", "owner": "b", "position": 0, "name": "d", "type": "p", "is_derived": True},
        {"uuid": "f1", "owner": "b", "position": 1, "name": "x", "type": "p"},
        {"uuid": "f2", "owner": "b", "position": 2, "name": "e", "type": "e", "is_derived": True},
        {"uuid": "f3", "owner": "b", "position": 3, "name": "s", "type": "s"},
        {"uuid": "f4", "owner": "b", "position": 4, "name": "y", "type": "p"})
    types = table(spark, "type", {"uuid": "p", "type_kind": "primitive"}, {"uuid": "e", "type_kind": "enumeration"},
                  {"uuid": "s", "type_kind": "structured"})
    got = {u: (k, i) for u, k, i in rows(M.class_attributes(features, types, classes), "uuid", "kind", "index")}
    assert got == {"f1": ("atomic", 0), "f4": ("atomic", 2), "f2": ("enumeration", 2), "f3": ("structured", 3)}


# ---------------------------------------------------------------- lookups


PAIR_DDL = ("holder string, association string, feature string, feature_name string, opposite string,"
            " opposite_name string, source_class string, source_class_name string, target_class string,"
            " target_class_name string, is_ordered boolean, target_composite boolean")


def _pair(holder, association, name, target="t"):
    return (holder, association, f"f:{association}", name, f"o:{association}", f"opp_{association}", holder,
            holder.upper(), target, target.upper(), False, True)


@pytest.fixture(scope="module")
def taxa(spark):
    nodes = spark.createDataFrame([(c, c.upper()) for c in "abct"], "uuid string, name string")
    edges = spark.createDataFrame([("c", "b"), ("b", "a")], "specific string, general string")
    return T.taxonomy(nodes, edges).cache()


def test_override_replaces_inherited_feature_even_when_it_is_absent(spark, taxa):
    pairs = spark.createDataFrame(
        [_pair("a", "1", "x"), _pair("b", "2", "x__from_A"), _pair("b", "3", "only__from_A")], PAIR_DDL)
    got = {(m, k): a for m, k, a in rows(U.containment_forward(pairs, taxa), "metaclass", "key", "association")}
    assert got == {("a", "x"): "1", ("b", "x"): "2", ("c", "x"): "2", ("b", "only"): "3", ("c", "only"): "3"}
    assert rows(U.redefinition_override(pairs, taxa), "metaclass", "key") == [
        ("b", "only"), ("b", "x"), ("c", "only"), ("c", "x")]


def test_more_specific_class_wins_over_an_inherited_override(spark, taxa):
    pairs = spark.createDataFrame([_pair("b", "1", "x__from_A"), _pair("c", "2", "x")], PAIR_DDL)
    got = dict(rows(U.containment_forward(pairs, taxa), "metaclass", "association"))
    assert got == {"b": "1", "c": "2"}


def test_reverse_lookup_takes_the_nearest_and_lists_ambiguous_keys(spark, taxa):
    pairs = spark.createDataFrame([_pair("t", "9", "x", "a"), _pair("t", "5", "x", "b"), _pair("t", "4", "x", "b")],
                                  PAIR_DDL)
    assert dict(rows(U.reverse_lookup(pairs, taxa), "metaclass", "association")) == {"a": "9", "b": "4", "c": "4"}
    assert dict(rows(U.ambiguous_reverse_keys(pairs, taxa), "metaclass", "candidates")) == {"b": 3, "c": 3}


def test_forward_before_inverse_and_containment_before_reference(spark, taxa):
    one = spark.createDataFrame([_pair("a", "1", "x")], PAIR_DDL)
    two = spark.createDataFrame([_pair("a", "2", "x"), _pair("a", "3", "y")], PAIR_DDL)
    back = spark.createDataFrame([_pair("t", "4", "z", "a")], PAIR_DDL).withColumn("opposite_name", F.lit("x"))
    lookups = U.AssociationLookups(
        U.containment_forward(one, taxa), U.reference_forward(two, taxa), U.reverse_lookup(back, taxa),
        U.reverse_lookup(back.withColumn("opposite_name", F.lit("w")), taxa))
    routes = {p: (r, a) for p, r, a in
              rows(U.property_routes(lookups).filter("metaclass = 'A'"), "property", "route", "association")}
    assert routes == {"x": ("forward containment", "1"), "y": ("forward reference", "3"),
                      "w": ("inverse reference", "4")}
    assert dict(rows(U.lookup_inverse_property(lookups).filter("metaclass = 'a'"), "property", "association")) == {
        "x": "4", "w": "4"}


# ---------------------------------------------------------------- values


LOOKUP = "metaclass string, kind string, is_ordered boolean, name string, metaclass_name string, attribute string," \
    " type string, implementation string, implementation_ordered boolean, implementation_derived boolean"


@pytest.fixture(scope="module")
def lookups(spark):
    def one(name, kind, ordered, derived=False, impl_ordered=None):
        return ("b", kind, ordered, name, "B", f"at:{name}", "t", f"im:{name}",
                ordered if impl_ordered is None else impl_ordered, derived)

    return spark.createDataFrame([
        one("oa", "atomic", True), one("ua", "atomic", False), one("ol", "enumeration", True),
        one("ul", "enumeration", False), one("os", "structured", True), one("us", "structured", False),
        one("dv", "atomic", False, derived=True),
    ], LOOKUP).cache()


def _slot(entity, name, position, kind, collection=True, **more):
    return {"resource": "r", "entity": entity, "metaclass": "B", "feature_name": name, "position": position,
            "is_collection": collection, "value_kind": kind, **more}


@pytest.fixture(scope="module")
def slots(spark):
    return table(
        spark, "slot",
        _slot("e", "oa", 0, "atomic", value="p"), _slot("e", "oa", 1, "atomic", value="q"),
        _slot("s", "oa", 5, "atomic", collection=False, value="z"),
        _slot("e", "ua", 0, "atomic", value="d"), _slot("e", "ua", 1, "atomic", value="d"),
        _slot("e", "dv", 0, "atomic", value="hidden"),
        _slot("e", "ol", 0, "literal", value="l0"), _slot("e", "ol", 1, "atomic", value="no"),
        _slot("e", "ol", 2, "literal", value="l2"),
        _slot("e", "ul", 0, "literal", value="l9"),
        _slot("e", "os", 0, "instance", ref="v0", ref_instance="i0"), _slot("e", "os", 1, "instance", ref="v1"),
        _slot("e", "os", 2, "instance", ref="v2", ref_instance="i2"),
        _slot("e", "us", 0, "instance", collection=False, ref="v3", ref_instance="i3"),
        _slot("e", "nobody", 0, "atomic", value="x"),
    ).cache()


def test_values(slots, lookups):
    v = V.attribute_values(slots, lookups)
    assert rows(V.atomic_values(v, True)) == [
        ("r", "e", "at:oa", "p", 0), ("r", "e", "at:oa", "q", 1), ("r", "s", "at:oa", "z", 0)]
    assert rows(V.atomic_values(v, False)) == [("r", "e", "at:ua", "d")] * 2
    assert rows(V.literal_values(v, True)) == [("r", "e", "at:ol", "l0", 0), ("r", "e", "at:ol", "l2", 2)]
    assert rows(V.literal_values(v, False)) == [("r", "e", "at:ul", "l9")]
    assert rows(V.structured_values(v, True)) == [("r", "e", "at:os", "i0", 0), ("r", "e", "at:os", "i2", 2)]
    assert rows(V.structured_values(v, False)) == [("r", "e", "at:us", "i3")]


def test_reference_behaviour_on_request(slots, lookups):
    v = V.attribute_values(slots, lookups)
    assert V.atomic_values(v, False, require_impl_ordered=True).count() == 0
    assert V.literal_values(v, False, require_impl_ordered=True).count() == 0
    assert rows(V.structured_values(v, False, scalar_value_node=True)) == [("r", "e", "at:us", "v3")]


def test_rebuild_is_the_inverse_of_the_ordered_values(slots, lookups):
    ordered = V.atomic_values(V.attribute_values(slots, lookups), True)
    back = V.rebuild_slots(ordered).select(
        "resource", "entity", "attribute", F.explode(F.arrays_zip("indexes", "values")).alias("z")
    ).select("resource", "entity", "attribute", F.col("z.values").alias("value"), F.col("z.indexes").alias("index"))
    assert rows(back) == rows(ordered)


def test_typed_values(spark):
    values = spark.createDataFrame(
        [("r", "e", a, v) for a, v in (("b", "true"), ("i", "12"), ("d", "1.5"), ("s", "x"), ("i", "bad"))],
        "resource string, entity string, attribute string, value string")
    types = spark.createDataFrame([(c, f"t{c}") for c in "bids"], "attribute string, type string")
    primitives = spark.createDataFrame(
        [("tb", "xsd:boolean"), ("ti", "xsd:integer"), ("td", "xsd:double"), ("ts", "xsd:string")],
        "uuid string, datatypeMapDefinition string")
    got = rows(V.typed_values(values, types, primitives), "value", "booleanValue", "integerValue", "doubleValue",
               "stringValue")
    assert got == [("1.5", None, None, 1.5, None), ("12", None, 12, None, None), ("bad", None, None, None, None),
                   ("true", True, None, None, None), ("x", None, None, None, "x")]


# ---------------------------------------------------------------- links, one pass


@pytest.fixture(scope="module")
def forward(spark):
    return spark.createDataFrame([("B", "lo", "as:o", True), ("B", "lu", "as:u", False)],
                                 "metaclass string, feature_name string, association string, is_ordered boolean")


@pytest.fixture(scope="module")
def link_slots(spark):
    return table(
        spark, "slot", _slot("e", "lo", 0, "element", ref="x"), _slot("e", "lo", 1, "atomic", value="?"),
        _slot("e", "lo", 2, "element", ref="y"), _slot("e", "lu", 0, "element", ref="z"),
        _slot("f", "lu", 0, "element", collection=False, ref="w"), _slot("f", "lo", 0, "element", collection=False, ref="w"))


def test_links(link_slots, forward):
    ordered, unordered = K.links(link_slots, forward)
    assert rows(ordered.rows) == [("r", "e", "x", "as:o", 0), ("r", "e", "y", "as:o", 2)]
    assert rows(ordered.errors, "element", "message") == [("e", "No element at lo[1]")]
    assert rows(unordered) == [("r", "e", "z", "as:u")]
    both = K.unordered_links(K.association_slots(link_slots, forward), include_single_valued=True)
    assert rows(both, "sourceElement", "targetElement") == [("e", "z"), ("f", "w")]


def test_one_pass_gives_the_same_tables(slots, link_slots, lookups, forward):
    every = slots.unionByName(link_slots)
    one = B.slot_tables(every, lookups, forward)
    v, m = V.attribute_values(every, lookups), K.association_slots(every, forward)
    expected = {
        ("atomic", True): V.atomic_values(v, True), ("atomic", False): V.atomic_values(v, False),
        ("enumeration", True): V.literal_values(v, True), ("enumeration", False): V.literal_values(v, False),
        ("structured", True): V.structured_values(v, True), ("structured", False): V.structured_values(v, False),
        ("link", True): K.ordered_links(m), ("link", False): K.unordered_links(m),
    }
    for key, df in expected.items():
        got = B._slot_table(one, *key)
        assert rows(got.select(*sorted(got.columns))) == rows(df.select(*sorted(df.columns))), key
    assert rows(B._slot_errors(one)) == rows(K.link_errors(m))


# ---------------------------------------------------------------- profiles and models


@pytest.fixture(scope="module")
def stereos(spark):
    return spark.createDataFrame([("urn:pf", "S", "S", False), ("urn:pf", "G", "G", True)],
                                 "resource string, uuid string, name string, isAbstract boolean")


@pytest.fixture(scope="module")
def profile_types(spark):
    return table(
        spark, "type", {"uuid": "cb", "name": "B", "type_kind": "class"}, {"uuid": "cx", "name": "X", "type_kind": "class"},
        {"uuid": "S", "name": "S", "type_kind": "stereotype"}, {"uuid": "other", "name": "O", "type_kind": "stereotype"},
        {"resource": "urn:lib", "uuid": "int", "name": "Integer", "type_kind": "primitive"},
        {"resource": "urn:else", "uuid": "int2", "name": "Integer", "type_kind": "primitive"},
        {"resource": "urn:else", "uuid": "odd", "name": "Odd", "type_kind": "structured"},
        {"uuid": "en", "name": "En", "type_kind": "enumeration"})


def _property(uuid, type_, position=0, **more):
    return {"uuid": uuid, "owner": "S", "name": uuid, "type": type_, "position": position, **more}


def test_base_properties(spark, stereos, profile_types, classes):
    features = table(spark, "feature", _property("p1", "cb", is_extension_end=True),
                     _property("p2", "cx", is_extension_end=True), _property("p3", None, is_extension_end=True),
                     _property("p4", "cb"))
    found = P.stereotype_extends(features, stereos, profile_types, classes)
    assert rows(found.rows) == [("urn:pf", "S", "b")]
    assert [m.split(":")[0] for _, m in rows(found.errors, "element", "message")] == [
        "Base property p2 refers to an unknown metaclass", "Base property without a metaclass"]


def test_stereotype_attributes_use_the_library_and_keep_positions(spark, stereos, profile_types):
    features = table(spark, "feature", _property("r", "cb", 0), _property("n", "int2", 1), _property("o", "odd", 2),
                     _property("m", "int", 3))
    library = profile_types.filter("resource = 'urn:lib'")
    got = P.stereotype_attributes(features, stereos, profile_types, library)
    assert rows(got, "uuid", "type", "index") == [("m", "int", 3), ("n", "int", 1)]


def test_class_and_stereotype_properties(spark, stereos, profile_types, classes):
    features = table(
        spark, "feature", _property("c", "cb", is_composite=True), _property("u", "cx"),
        _property("d", "cb", is_derived=True), _property("x", "cb", is_extension_end=True), _property("s", "S"),
        _property("o", "other"), _property("n", "int"))
    found = P.stereotype_metaclass_props(features, stereos, profile_types, classes)
    assert rows(found.rows, "uuid", "target") == [("c", "b")]
    assert rows(found.errors, "element", "severity") == [("u", "fatal")]
    same = P.stereotype_stereotype_props(features, stereos, profile_types)
    assert rows(same, "uuid", "target") == [("s", "S")]
    ends = P.association_target_ends(found.rows.unionByName(same))
    assert rows(ends, "uuid", "role") == [("c", "targetComposite"), ("s", "targetReference")]


def test_stereotype_generalization_swap(spark, stereos):
    edges = table(spark, "generalization", {"specific": "S", "general": "G"}, {"specific": "S", "general": "class"})
    every = stereos.select("uuid")
    right = P.stereotype_generalizations(edges, stereos, every)
    swapped = P.stereotype_generalizations(edges, stereos, every, legacy_swap=True)
    assert rows(right, "specific", "general") == [("S", "G")] and rows(swapped, "specific", "general") == [("G", "S")]


def test_profiles_of_applied_stereotypes(spark, docs, stereos):
    def app(element, stereotype, profile):
        return {"resource": "urn:m", "element": element, "stereotype": stereotype, "base_property": "b",
                "profile": profile}

    applications = table(
        spark, "application", app("e1", "S", "pf:1"), app("e2", "S", "pf:1"), app("e1", "No", "pf:1"),
        app("e2", "No", "pf:1"), app("e3", "S", None), app("e4", "S", "pf:2"), app("e5", "S", "pf:none"))
    exported = spark.createDataFrame([("urn:pf",)], "resource string")
    found = O.apply_profiles(applications, docs, exported, stereos)
    assert rows(found.rows) == [("urn:m", "e1", "S"), ("urn:m", "e2", "S")]
    got = {(c, m) for c, m in rows(found.errors, "code", "message")}
    assert got == {
        ("unknown-stereotype", "Unknown stereotype No: 2 applications"),
        ("stereotype-without-profile", "Stereotype without a profile S: 1 applications"),
        ("profile-not-exported", "Profile is not exported: pf:2"),
        ("profile-without-document", "No document for profile pf:none"),
    }


def test_model_elements_and_profile_applications(spark, docs, classes):
    elements = table(spark, "element", {"resource": "urn:m", "uuid": "1", "kind": "B"},
                     {"resource": "urn:m", "uuid": "2", "kind": "Ghost"})
    found = O.model_elements(elements, classes)
    assert rows(found.rows) == [("urn:m", "1", "b")]
    assert rows(found.errors, "element", "severity", "code") == [("2", "fatal", "unknown-metaclass")]
    applications = table(
        spark, "profile_application", {"resource": "urn:m", "applying_package": "p", "applied_profile": "pf:1"},
        {"resource": "urn:m", "applied_profile": "pf:1"}, {"resource": "urn:m", "applying_package": "p"},
        {"resource": "urn:m", "applying_package": "p", "applied_profile": "pf:none"})
    assert rows(O.applied_profiles(applications, docs)) == [("urn:m", "p", "urn:pf", "pf:1")]


def test_tags(spark, profile_types):
    features = table(spark, "feature", _property("f:i", "int", is_ordered=True), _property("f:e", "en", is_ordered=True),
                     _property("f:s", "odd", is_ordered=True), _property("f:c", "cb", is_ordered=True),
                     _property("f:u", "cb"), {**_property("f:g", "int", is_ordered=True), "owner": "G"},
                     {**_property("f:z", "int", is_ordered=True), "owner": "Z"})
    nodes = spark.createDataFrame([(c, c) for c in "SGZ"], "uuid string, name string")
    taxa = T.taxonomy(nodes, spark.createDataFrame([("S", "G")], "specific string, general string"))
    applications = table(spark, "application", {"element": "e", "stereotype": "S"})

    def tag(feature, position, kind, entity="e", **more):
        return {"resource": "r", "entity": entity, "metaclass": "B", "feature": feature, "position": position,
                "is_collection": True, "value_kind": kind, **more}

    slots = table(
        spark, "slot", tag("f:i", 0, "atomic", value="1"), tag("f:g", 0, "atomic", value="2"),
        tag("f:z", 0, "atomic", value="3"), tag("f:i", 0, "atomic", entity="other", value="4"),
        tag("f:e", 0, "atomic", value="no"), tag("f:e", 1, "literal", value="lit"),
        tag("f:s", 0, "instance", ref="v", ref_instance="i"), tag("f:c", 0, "element", ref="x"),
        tag("f:c", 1, "instance", ref="v", ref_instance="y"), tag("f:c", 2, "atomic", value="bad"),
        tag("f:u", 0, "element", ref="w"))
    tags = V.stereotype_slots(slots, features, profile_types, applications, taxa)
    assert rows(V.ordered_atomic_tags(tags), "attribute", "value", "index") == [("f:g", "2", 0), ("f:i", "1", 0)]
    assert rows(V.ordered_literal_tags(tags), "attribute", "value", "index") == [("f:e", "lit", 1)]
    assert V.ordered_structured_tags(tags).count() == 2
    ordered, unordered = V.stereotype_references(tags, True), V.stereotype_references(tags, False)
    assert rows(ordered.rows, "associationTargetEnd", "referencedElement", "index") == [
        ("f:c", "x", 0), ("f:c", "y", 1)]
    assert ordered.errors.count() == 1
    assert rows(unordered.rows, "associationTargetEnd", "referencedElement") == [("f:u", "w")]


# ---------------------------------------------------------------- errors and checks


def test_append_merges_rows_and_errors(spark):
    def result(n):
        frame = spark.createDataFrame([(n,)], "n int")
        return E.Result(frame, E.error_rows(frame, "c", F.lit("m"), element=F.lit(None), resource=F.lit(None)))

    both = E.append(result(1), result(2))
    assert rows(both.rows) == [(1,), (2,)] and both.errors.count() == 2
    assert E.distinct_errors(both.errors).count() == 1
    assert rows(E.error_totals(both.errors)) == [("error", "c", 1)]
    assert E.append(result(1), E.Result(both.rows.limit(0), E.no_errors(spark))).errors.count() == 1


def test_unresolved_references(spark):
    links = spark.createDataFrame([("a", "b", "as"), ("a", "z", "as"), ("c", "z", "no")],
                                  "sourceElement string, targetElement string, metaAssociation string")
    known = {"elements": spark.createDataFrame([("a",), ("b",), ("c",)], "uuid string"),
             "associations": spark.createDataFrame([("as",)], "uuid string")}
    assert rows(H.unresolved_references({"orderedLinks": links}, known)) == [
        ("orderedLinks", "metaAssociation", "no", 1), ("orderedLinks", "targetElement", "z", 2)]


# ---------------------------------------------------------------- changes


@pytest.fixture(scope="module")
def change_lookups(spark, lookups, taxa):
    concrete = spark.createDataFrame([("B", "b")], "metaclass_name string, metaclass string")
    routes = spark.createDataFrame(
        [("forward reference", "B", "fw", "1", "fw", "o", "B", "A"), ("inverse reference", "B", "iv", "2", "f", "iv", "A", "B")],
        "route string, metaclass string, property string, association string, feature_name string,"
        " opposite_name string, source_class_name string, target_class_name string")
    return C.ChangeLookups(concrete, routes, lookups, taxa)


def _change(seq, prop, old=None, new=None, metaclass="B", shape="indexed", **more):
    return {"txn": "t", "seq": seq, "entity": "e", "is_element": True, "metaclass": metaclass, "property": prop,
            "old_value": old, "new_value": new, "value_kind": "atomic", "shape": shape, "index": 4, **more}


@pytest.fixture(scope="module")
def changes(spark):
    return table(
        spark, "change",
        _change(1, "INSTANCE_CREATED"), _change(2, "INSTANCE_DELETED"), _change(3, "BEFORE_DELETE"),
        _change(4, "INSTANCE_CREATED", metaclass="Ghost"), _change(5, "multiplicity", None, "1"),
        {**_change(6, "oa", None, "1"), "is_element": False},
        _change(7, "oa", None, "1"), _change(8, "oa", "1", None, shape="position"), _change(9, "oa", "1", "2"),
        _change(10, "oa", "1", "2", shape="plain"), _change(11, "oa", None, None),
        _change(12, "ol", None, "lit", value_kind="literal"), _change(13, "ol", None, "txt"),
        _change(14, "ol", None, None, value_kind="literal"),
        _change(15, "ua", "1", "2"), _change(16, "ul", "lit", None, value_kind="literal"),
        _change(17, "fw", None, "x", value_kind="element", value_metaclass="C"),
        _change(18, "fw", "x", None, value_kind="element", value_metaclass="A"),
        _change(19, "fw", None, "x", value_kind="element", value_metaclass="T"),
        _change(20, "fw", "x", "y", value_kind="element", value_metaclass="A"),
        _change(21, "iv", None, "x", value_kind="element", value_metaclass="A"),
        _change(22, "nobody", None, "1"),
    ).cache()


def test_classification(changes, change_lookups):
    got = rows(C.classify_changes(changes, change_lookups), "seq", "event", "changeKind", "value", "index")
    oa, ol = C.VALUE_EVENTS["atomic", True], C.VALUE_EVENTS["enumeration", True]
    assert sorted(got) == sorted([
        (1, C.ELEMENT_EVENT, "AddedChange", None, None), (2, C.ELEMENT_EVENT, "DeletedChange", None, None),
        (7, oa, "AddedChange", "1", 4), (8, oa, "DeletedChange", "1", 4), (9, oa, "ModifiedChange", "2", 4),
        (11, oa, "ModifiedChange", None, 4), (12, ol, "AddedChange", "lit", 4),
        (15, C.VALUE_EVENTS["atomic", False], "ModifiedChange", "2", None),
        (16, C.VALUE_EVENTS["enumeration", False], "DeletedChange", "lit", None),
    ], key=lambda r: r[0])
    assert rows(C.classify_changes(changes, change_lookups).select("resource").distinct()) == [("",)]


def test_routes_and_logs(changes, change_lookups):
    routed = C.route_change(changes, change_lookups)
    route = dict(rows(routed, "seq", "route"))
    assert 5 not in route and 6 not in route
    assert {s: route[s] for s in (1, 2, 3, 7, 17, 21, 22)} == {
        1: "created", 2: "deleted", 3: "before delete", 7: "attribute", 17: "forward", 21: "inverse", 22: "attribute"}
    assert rows(C.pre_delete_log(routed), "seq") == [(3,)]
    assert rows(C.unknown_element_log(routed, change_lookups), "seq") == [(4,)]
    assert dict(rows(C.forward_link_changes(routed, change_lookups), "seq", "linkChange")) == {
        17: "new", 18: "del", 19: "unknown", 20: "unknown"}
    assert C.inverse_link_changes(routed, change_lookups).count() == 0
    assert rows(C.inverse_link_changes(routed, change_lookups, show_inverse=True), "seq", "linkChange", "path") == [
        (21, "new", "A::iv -> f::B")]
    assert rows(routed.filter("seq = 8"), "description") == [("e : oa => Old value: 1, new value: null",)]


def test_records_can_be_given_their_resource(spark, changes, change_lookups):
    elements = table(spark, "element", {"resource": "urn:home", "uuid": "e"})
    filled = C.fill_resource(C.classify_changes(changes, change_lookups), elements)
    assert rows(filled.select("resource").distinct()) == [("urn:home",)]
