"""Registered queries: every operator over the model graph of a star folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modelweave.functions.scale import lookup_join, new_folder, numbered
from modelweave.operators import changes as C
from modelweave.operators import checks as X
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
from modelweave.plans.workspace import METAMODEL, Workspace, workspace
from modelweave.sources import document_sets as S
from modelweave.sources import tables as TB
from modelweave.streaming import changes as ST
from modelweave.streaming import commits as CM

# Rows of a listing that one task numbers.
PLACES_PER_RANGE = 1_000

_QUERIES: dict[str, Callable[[Workspace], DataFrame]] = {}


def query(fn: Callable[[Workspace], DataFrame]) -> Callable[[Workspace], DataFrame]:
    _QUERIES[fn.__name__] = fn
    return fn


def _same_plan(names_and_fns: dict[str, Callable[[Workspace], DataFrame]]) -> None:
    _QUERIES.update(names_and_fns)


# ---------------------------------------------------------------- documents and selection


@query
def select_kind(w):
    return D.select_kind(w.graph.elements_of("Customer", "Supplier"), ["Customer", "Supplier"]).select("resource", "uuid", "kind", "name")


@query
def select_kind_of(w):
    found = D.select_kind_of(w.graph.element, "Party", w.business.taxonomy)
    return found.select("resource", "uuid", "kind", "name")


@query
def resource_rows(w):
    return D.resource_rows(w.graph.document)


@query
def entity_identities(w):
    return D.identity(w.graph.element).rows


@query
def split_profiles_packages(w):
    profiles, packages = D.split_profiles_packages(w.graph.element, w.graph.selection)
    return profiles.withColumn("kind", F.lit("Profile")).unionByName(packages.withColumn("kind", F.lit("Package")))


@query
def lookup_document_packages(w):
    return D.lookup_document_packages(w.graph.configuration, w.graph.element).rows


@query
def lookup_document_package_errors(w):
    return D.lookup_document_packages(w.graph.configuration, w.graph.element).errors


def _config_columns(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("characteristics.packageURI").alias("packageURI"),
        F.col("characteristics.documentURL").alias("documentURL"),
        F.col("characteristics.artifactKind.type").alias("artifactKind"),
        F.col("characteristics.nsPrefix").alias("nsPrefix"), F.col("characteristics.uuidPrefix").alias("uuidPrefix"),
        "toolSpecificPackageID", "toolSpecificPackageURL",
    )


@query
def document_config_rows(w):
    return _config_columns(D.document_config_rows(w.graph.element, w.graph.document))


@query
def document_set_round_trip(w):
    """Configuration rows written as nested JSON and read back."""
    folder = new_folder(w.spark, "document-set")
    S.write_document_set(D.document_config_rows(w.graph.element, w.graph.document), folder)
    return _config_columns(S.read_document_set(w.spark, folder))


@query
def read_document_sets(w):
    """Two configuration folders read together, the current selection appended."""
    rows = D.document_config_rows(w.graph.element, w.graph.document)
    folders = []
    for artifact in ("LibraryArtifact", "ProfileArtifact"):
        folders.append(new_folder(w.spark, "document-set"))
        S.write_document_set(rows.filter(F.col("characteristics.artifactKind.type") == artifact), folders[-1])
    selection = rows.filter(F.col("characteristics.artifactKind.type") == "MetamodelArtifact")
    found = S.read_document_sets(w.spark, folders, selection)
    return found.select(
        "set", "place", F.col("characteristics.packageURI").alias("packageURI"),
        F.col("characteristics.artifactKind.type").alias("artifactKind"), "toolSpecificPackageID",
    )


@query
def export_per_document(w):
    return D.selected_documents(w.graph.selection, w.graph.document).rows.select("resource", "scope_package", "kind")


@query
def export_per_document_errors(w):
    return D.selected_documents(w.graph.selection, w.graph.document).errors


@query
def missing_dependencies(w):
    return D.missing_dependencies(w.graph.selection, getattr(w.graph, "import"), w.graph.profile_application)


@query
def missing_dependency_paths(w):
    return D.missing_dependency_paths(w.graph.selection, getattr(w.graph, "import"), w.graph.profile_application)


# ---------------------------------------------------------------- library


@query
def primitive_types(w):
    return L.primitive_types(w.graph.type).rows


@query
def primitive_type_errors(w):
    return L.primitive_types(w.graph.type).errors


@query
def enumeration_types(w):
    return L.enumeration_types(w.graph.type)


@query
def enumeration_literals_indexed(w):
    return L.enumeration_literals_indexed(w.graph.literal)


@query
def enumeration_literal_names(w):
    return L.enumeration_literal_names(w.graph.literal)


def _import_query(kind: str, **options):
    def run(w):
        return D.package_imports(getattr(w.graph, "import"), w.graph.document, kind, **options).rows

    return run


_same_plan({
    "library_imports": _import_query("Library"),
    "metamodel_imports": _import_query("Metamodel", imported_document_kind="Metamodel"),
    "metamodel_library_imports": _import_query("Metamodel", imported_document_kind="Library"),
    "profile_imports": _import_query("Profile", imported_kind="Profile"),
})


@query
def library_import_warnings(w):
    return D.package_imports(getattr(w.graph, "import"), w.graph.document, "Library").errors


def _library(w) -> B.Export:
    g = w.graph
    return B.export_library(w.spark, g.document, g.type, g.literal, getattr(g, "import"))


@query
def export_library(w):
    return B.table_contents(_library(w))


@query
def library_round_trip(w):
    """Library tables written as JSON lines and read back: contents of every table."""
    folder = new_folder(w.spark, "library")
    export = _library(w)
    TB.write_library(export.tables, folder, export.errors)
    return B.table_contents(B.Export(TB.read_library(w.spark, folder), export.errors))


# ---------------------------------------------------------------- metamodel


@query
def meta_classes(w):
    return M.meta_classes(w.graph.elements_of("Class"), w.graph.document)


@query
def meta_associations(w):
    return M.meta_associations(w.graph.elements_of("Association"), w.graph.document)


@query
def sorted_by_name(w):
    """Classes with their place in the listing order."""
    rows = M.meta_classes(w.graph.elements_of("Class"), w.graph.document).withColumn("_all", F.lit(0))
    # more than a few rows are numbered by ranges, never in one task
    return numbered(rows, ["_all"], D.name_order(), out="place", hot_rows=PLACES_PER_RANGE).drop("_all")


def _oriented(w) -> E.Result:
    own = D.in_documents(w.graph.association, w.graph.document, "Metamodel")
    return M.orient_associations(own, w.graph.feature)


@query
def orient_associations(w):
    return _oriented(w).rows.select(
        "resource", "association", "name", "source_end", "source_name", "source_class", "target_end", "target_name",
        "target_class",
    )


def _generalization_query(relations):
    return lambda w: M.association_generalizations(w.all.oriented, w.graph.feature_rel, relations)


_same_plan({
    "assoc_generalizations": _generalization_query(None),
    "assoc_gen_subset_subset": _generalization_query(("subsets", "subsets")),
    "assoc_gen_subset_redefine": _generalization_query(("subsets", "redefines")),
    "assoc_gen_redefine_subset": _generalization_query(("redefines", "subsets")),
    "assoc_gen_redefine_redefine": _generalization_query(("redefines", "redefines")),
})


@query
def metaclass_generalizations(w):
    return M.metaclass_generalizations(w.graph.generalization, w.all.classes)


@query
def association_source(w):
    return M.association_source(w.all.oriented)


@query
def association_target(w):
    return M.association_target(w.all.oriented)


@query
def association_ends(w):
    return M.association_ends(w.all.oriented)


@query
def association_end_types(w):
    return M.association_end_types(w.all.oriented)


def _bounded(w):
    return M.bounded_features(w.all.oriented, w.all.attributes)


@query
def feature_lower_bounds(w):
    return M.feature_lower_bounds(_bounded(w))


@query
def feature_upper_bounds(w):
    return M.feature_upper_bounds(_bounded(w))


@query
def feature_ordering(w):
    return M.feature_ordering(_bounded(w))


@query
def feature_bounds(w):
    return _bounded(w)


@query
def attributes(w):
    return M.attribute_names(w.all.attributes)


@query
def attribute_types(w):
    return M.attribute_types(w.all.attributes)


@query
def feature_type_uuid(w):
    return M.feature_type_uuid(w.graph.feature, w.graph.type).rows


@query
def feature_type_errors(w):
    return M.feature_type_uuid(w.graph.feature, w.graph.type).errors


def _class_attributes_query(kind):
    def run(w):
        found = M.class_attributes(w.all.features, w.graph.type, w.all.classes, kinds=(kind,))
        return found.select("resource", "owner", "uuid", "name", "type", "index", "is_ordered")

    return run


def _owned_table_query(kind, ordered):
    return lambda w: M.owned_attribute_table(w.all.attributes, kind, ordered)


for _kind in M.KINDS:
    _same_plan({f"{_kind}_attributes": _class_attributes_query(_kind)})
    for _ordered in (True, False):
        _same_plan({
            f"metaclass2{'ordered' if _ordered else 'unordered'}_{_kind}_attribute": _owned_table_query(_kind, _ordered)
        })


@query
def export_metamodel(w):
    g = w.graph
    return B.table_contents(B.export_metamodel(
        g.document, g.elements_of("Class", "Association"), g.association, g.feature, g.feature_rel, g.generalization, g.type,
        getattr(g, "import"), attributes=w.all.attributes, classes=w.all.classes, ends=w.all.oriented,
    ))


@query
def metamodel_round_trip(w):
    """Metamodel tables written as JSON lines and read back: contents of every table."""
    g, folder = w.graph, new_folder(w.spark, "metamodel")
    export = B.export_metamodel(
        g.document, g.elements_of("Class", "Association"), g.association, g.feature, g.feature_rel, g.generalization, g.type,
        getattr(g, "import"), attributes=w.all.attributes, classes=w.all.classes, ends=w.all.oriented,
    )
    TB.write_metamodel(export.tables, folder, export.errors)
    return B.table_contents(B.Export(TB.read_metamodel(w.spark, folder), export.errors))


# ---------------------------------------------------------------- lookups


_TAXON = ("metaclass", "metaclass_name", "supertype", "supertype_name", "depth", "level")


@query
def taxonomy(w):
    return T.taxonomy(w.all.classes, w.graph.generalization).select(*_TAXON)


@query
def generalization_cycles(w):
    """Parts as classes: each is below the part of a third of its number, and each ninth and tenth below each other."""
    key = F.col("p_partkey")
    parts = w.spark.read.parquet(f"{w.graph.folder}/part.parquet").select("p_partkey").distinct()
    name = lambda c: F.concat(F.lit("par:"), c.cast("string"))
    classes = parts.select(F.lit("urn:parts").alias("resource"), name(key).alias("uuid"))
    above = F.when(key % 10 == 9, key + 1).when(key % 10 == 0, F.when(key % 100 == 0, key).otherwise(key - 1)).otherwise(
        F.floor(key / 3)
    )
    edges = parts.select(name(key).alias("specific"), name(above).alias("general"))
    return T.cyclic_generalizations(classes, T.closure(classes, edges), edges)


@query
def specializations(w):
    return T.specializations(w.all.taxonomy)


@query
def effective_attributes(w):
    found = T.effective_attributes(w.all.taxonomy, w.all.attributes)
    return found.select("metaclass", "metaclass_name", "attribute", "name", "type", "kind", "is_ordered", "owner")


@query
def concrete_metaclass_lookup(w):
    return U.concrete_metaclass_lookup(w.all.implementation, w.all.classes)


@query
def association_views(w):
    return U.association_views(w.all.oriented, w.all.classes)


_PAIR = ("association", "feature", "feature_name", "opposite", "opposite_name", "source_class", "target_class",
         "is_ordered")


@query
def association_view_match(w):
    return U.association_view_match(w.all.features, w.all.classes, w.all.views).select("holder", *_PAIR)


@query
def containment_forward(w):
    return U.containment_forward(U.containment_pairs(w.all.matched), w.all.taxonomy).select("metaclass", "key", *_PAIR)


@query
def redefinition_override(w):
    found = U.redefinition_override(U.containment_pairs(w.all.matched), w.all.taxonomy)
    return found.select("metaclass", "key", *_PAIR)


@query
def ambiguous_features(w):
    """Features that a class has from several unrelated ones; attributes compete by name like references."""
    holders = w.all.attributes.select(F.col("owner").alias("holder"), F.col("name").alias("feature_name"))
    pairs = U.reference_pairs(w.all.matched).select("holder", "feature_name")
    # every general class gives one more name, so that classes with several unrelated supertypes are found
    general = w.all.taxonomy.filter("metaclass <> supertype").select(
        F.col("supertype").alias("holder"), F.lit("kind").alias("feature_name")
    )
    every = E.union_all([pairs, holders, general]).distinct()
    return U.ambiguous_features(every, w.all.taxonomy, w.all.classes, redefining=False)


@query
def reference_forward(w):
    return U.reference_forward(U.reference_pairs(w.all.matched), w.all.taxonomy).select("metaclass", "key", *_PAIR)


@query
def containment_reverse(w):
    return U.reverse_lookup(U.containment_pairs(w.all.matched), w.all.taxonomy).select("metaclass", "key", *_PAIR)


@query
def reference_reverse(w):
    return U.reverse_lookup(U.reference_pairs(w.all.matched), w.all.taxonomy).select("metaclass", "key", *_PAIR)


@query
def ambiguous_reverse_keys(w):
    found = {"composite": U.containment_pairs(w.all.matched), "reference": U.reference_pairs(w.all.matched)}
    return E.union_all([
        U.ambiguous_reverse_keys(pairs, w.all.taxonomy).withColumn("kind", F.lit(kind)) for kind, pairs in found.items()
    ])


@query
def association_pair_counts(w):
    return U.association_pair_counts(w.all.containment_forward, w.all.reference_forward)


@query
def lookup_forward_property(w):
    return U.lookup_forward_property(w.all).select("metaclass", "property", "association", "feature_name")


@query
def lookup_inverse_property(w):
    return U.lookup_inverse_property(w.all).select("metaclass", "property", "association", "feature_name")


def _attribute_lookup_query(kind, ordered):
    return lambda w: U.attribute_lookup(w.all.attribute_lookups_of(kind, ordered), kind, ordered)


for _kind in ("atomic", "enumeration"):
    for _ordered in (True, False):
        _same_plan({
            f"attr_lookup_{'ordered' if _ordered else 'unordered'}_{_kind}": _attribute_lookup_query(_kind, _ordered)
        })


# ---------------------------------------------------------------- profiles


@query
def stereotypes(w):
    return P.stereotypes(w.graph.elements_of("Stereotype"), w.graph.document)


@query
def stereotype_extends(w):
    return P.stereotype_extends(w.graph.feature, w.stereotypes, w.graph.type, w.business.classes).rows


@query
def stereotype_extends_errors(w):
    return P.stereotype_extends(w.graph.feature, w.stereotypes, w.graph.type, w.business.classes).errors


@query
def stereotype_attributes(w):
    found = P.stereotype_attributes(w.graph.feature, w.stereotypes, w.graph.type, w.library_types)
    return P.stereotype_attribute_table(found)


@query
def stereotype_metaclass_props(w):
    found = P.stereotype_metaclass_props(w.graph.feature, w.stereotypes, w.graph.type, w.business.classes)
    return P.metaclass_property_table(found.rows)


@query
def stereotype_metaclass_prop_errors(w):
    return P.stereotype_metaclass_props(w.graph.feature, w.stereotypes, w.graph.type, w.business.classes).errors


@query
def stereotype_stereotype_props(w):
    return P.stereotype_property_table(P.stereotype_stereotype_props(w.graph.feature, w.stereotypes, w.graph.type))


@query
def stereotype_generalizations(w):
    every = w.graph.type.filter(F.col("type_kind") == "stereotype")
    return P.stereotype_generalizations(w.graph.generalization, w.stereotypes, every)


@query
def extended_metamodels(w):
    return P.extended_metamodels(D.resource_rows(w.graph.document, "Profile"), METAMODEL)


@query
def profile_association_ends(w):
    g = w.graph
    found = P.stereotype_metaclass_props(g.feature, w.stereotypes, g.type, w.business.classes).rows.unionByName(
        P.stereotype_stereotype_props(g.feature, w.stereotypes, g.type)
    )
    return P.association_target_ends(found)


def _profile(w) -> B.Export:
    g = w.graph
    return B.export_profile(
        w.spark, w.selected_documents, g.elements_of("Stereotype"), g.feature, g.type, w.library_types, w.business.classes,
        g.generalization, getattr(g, "import"), METAMODEL,
    )


@query
def export_profile(w):
    return B.table_contents(_profile(w))


# ---------------------------------------------------------------- model elements


def _model_rows(w):
    return D.in_documents(w.graph.element, w.graph.document, "Model")


@query
def model_elements(w):
    return O.model_elements(_model_rows(w), w.business.classes).rows


@query
def model_element_errors(w):
    return O.model_elements(_model_rows(w), w.business.classes).errors


@query
def element_tool_ids(w):
    return O.element_tool_ids(_model_rows(w))


@query
def element_tool_urls(w):
    return O.element_tool_urls(_model_rows(w))


@query
def instantiated_metamodels(w):
    return O.instantiated_metamodels(D.resource_rows(w.graph.document, "Model"), METAMODEL)


@query
def applied_profiles(w):
    return O.applied_profiles(w.graph.profile_application, w.graph.document)


@query
def application_counts(w):
    return O.application_counts(w.graph.application)


@query
def stereotypes_by_profile(w):
    return O.stereotypes_by_profile(w.graph.application).rows


@query
def stereotypes_by_profile_errors(w):
    return O.stereotypes_by_profile(w.graph.application).errors


def _exported_profiles(w):
    return D.resource_rows(w.selected_documents, "Profile")


def _resolved(w) -> E.Result:
    return O.resolve_profile(O.stereotypes_by_profile(w.graph.application).rows, w.graph.document,
                             _exported_profiles(w))


@query
def resolve_profile(w):
    return _resolved(w).rows


@query
def resolve_profile_errors(w):
    return _resolved(w).errors


def _applied(w) -> E.Result:
    return O.apply_profiles(w.graph.application, w.graph.document, _exported_profiles(w), w.stereotypes)


@query
def applied_stereotypes(w):
    return _applied(w).rows


@query
def append_errors(w):
    """Errors of the three steps that lead to the applied stereotypes."""
    return _applied(w).errors


def _error_steps(w) -> dict[str, DataFrame]:
    """Errors of all steps, warnings included, by the name of the step."""
    g = w.graph
    imports = {
        f"{kind} imports": D.package_imports(getattr(g, "import"), g.document, kind, **options).errors
        for kind, options in (("Library", {}), ("Metamodel", {}), ("Profile", {"imported_kind": "Profile"}))
    }
    return imports | {
        "applied stereotypes": _applied(w).errors,
        "elements": O.model_elements(_model_rows(w), w.business.classes).errors,
        "document packages": D.lookup_document_packages(g.configuration, g.element).errors,
        "references": _tag_refs(w, True).errors.unionByName(_tag_refs(w, False).errors),
        "structured tags": V.ordered_structured_tags(w.tags),
        "links": K.link_errors(_matched(w)),
        "extended metaclasses": P.stereotype_extends(g.feature, w.stereotypes, g.type, w.business.classes).errors,
        "metaclass properties":
            P.stereotype_metaclass_props(g.feature, w.stereotypes, g.type, w.business.classes).errors,
    }


def _all_errors(w) -> DataFrame:
    none = w.graph.document.limit(0)
    return E.append(*[E.Result(none, errors) for errors in _error_steps(w).values()]).errors


@query
def errors_by_step(w):
    """Every error once, counted by the first step that gives it, in the pass that writes the report."""
    return E.report(_error_steps(w)).by_step()


@query
def errors_by_element(w):
    return E.errors_by_element(_all_errors(w), root="model")


@query
def error_totals(w):
    return E.error_totals(_all_errors(w))


@query
def export_gates(w):
    """The chain of a model export, document by document: elements, applied stereotypes, links, references."""
    g, kept = w.graph, lambda df, resources: lookup_join(df, resources, ["resource"], how="left_semi")
    chain = E.Chain(_model_rows(w))
    chain.step("elements", lambda r: O.model_elements(kept(_model_rows(w), r), w.business.classes))
    chain.step("applied stereotypes", lambda r: O.apply_profiles(
        kept(g.application, r), g.document, _exported_profiles(w), w.stereotypes))
    chain.step("links", lambda r: E.Result(
        *[f(K.association_slots(kept(g.slot, r), w.business.forward)) for f in (K.ordered_links, K.link_errors)]))
    chain.step("references", lambda r: V.stereotype_references(kept(w.tags, r), ordered=False))
    return chain.gates()


# ---------------------------------------------------------------- values


def _values(w, kind, ordered, slots=None):
    lookups = w.business.attribute_lookups
    if slots is None:
        slots = w.graph.slots_of(V.wanted_attributes(lookups, kind, ordered))
    return V.attribute_values(slots, lookups, kind, ordered)


def _atomic(w, ordered, slots=None):
    return V.atomic_values(_values(w, "atomic", ordered, slots), ordered)


def _literal(w, ordered, slots=None):
    return V.literal_values(_values(w, "enumeration", ordered, slots), ordered)


def _structured(w, ordered, slots=None):
    return V.structured_values(_values(w, "structured", ordered, slots), ordered)


_same_plan({
    "ordered_atomic_values": lambda w: _atomic(w, True),
    "ordered_literal_values": lambda w: _literal(w, True),
    "ordered_structured_values": lambda w: _structured(w, True),
    "unordered_atomic_values": lambda w: _atomic(w, False),
    "unordered_literal_values": lambda w: _literal(w, False),
    "unordered_structured_values": lambda w: _structured(w, False),
})


def _tag_refs(w, ordered):
    return V.stereotype_references(w.tags, ordered)


_same_plan({
    "ordered_atomic_tags": lambda w: V.ordered_atomic_tags(w.tags),
    "ordered_literal_tags": lambda w: V.ordered_literal_tags(w.tags),
    "ordered_structured_tags": lambda w: V.ordered_structured_tags(w.tags),
    "ordered_stereotype_refs": lambda w: _tag_refs(w, True).rows,
    "unordered_stereotype_refs": lambda w: _tag_refs(w, False).rows,
    "unordered_stereotype_ref_errors": lambda w: _tag_refs(w, False).errors,
})


@query
def rebuild_slots(w):
    """Ordered collections as comma-separated text in index order."""
    found = V.rebuild_slots(_atomic(w, True))
    return found.select("resource", "entity", "attribute", "block", F.array_join("values", ",", "null").alias("values"))


def _titled(tables: dict[str, DataFrame]) -> DataFrame:
    return E.union_all(df.withColumn("table", F.lit(t)) for t, df in tables.items())


def _rebuilt(w) -> DataFrame:
    links = {True: K.ordered_links(_matched(w, True)), False: K.unordered_links(_matched(w, False))}
    of = {"Atomic": (_atomic, "atomic"), "Literal": (_literal, "enumeration"), "Structured": (_structured, "structured")}
    parts = []
    for ordered, word in ((True, "ordered"), (False, "unordered")):
        found, alone = {}, {}
        for name, (fn, kind) in of.items():
            wanted = V.wanted_attributes(w.business.attribute_lookups, kind, ordered)
            slots, whole = w.graph.slots_apart(wanted, "attribute")
            found[f"{word}{name}Values"] = fn(w, ordered, slots)
            if whole is not None:
                alone[f"{word}{name}Values"] = fn(w, ordered, whole)
        found[f"{word}Links"] = links[ordered].withColumnsRenamed(
            {"sourceElement": "entity", "metaAssociation": "attribute", "targetElement": "value"}
        )
        rows = _titled(found)
        if not ordered:
            rows = numbered(rows, ["table", "resource", "entity", "attribute"], ["value"], out="index")
        # each part by itself: the unordered rows are grouped where they were numbered, without another shuffle
        parts.append(V.rebuild_slots(rows))
        if alone:  # collections of one value are whole where they are read, and shuffled by nobody
            single = _titled(alone)
            parts.append(V.rebuild_alone(single if ordered else single.withColumn("index", F.lit(0))))
    return E.union_all(parts)


@query
def rebuild_all_slots(w):
    """Every value and link table back as collections: ordered ones by index, the others sorted by value."""
    return _rebuilt(w).select(
        "table", "resource", "entity", "attribute", "block", F.array_join("values", ",", "null").alias("values")
    )


def _losses(w, found: DataFrame) -> DataFrame:
    return X.lost_values(X.expected_values(w.graph.slot, w.business.attribute_lookups, w.business.forward), found)


@query
def lost_values(w):
    """The raw slots against the collections rebuilt from the tables: nothing is lost."""
    return _losses(w, X.collected_values(_rebuilt(w)))


@query
def lost_values_planted(w):
    """The same with a loss planted: the third value of every ordered collection of atomic values is left out."""
    gone = (F.col("table") == "orderedAtomicValues") & (F.col("index") == 2)
    return _losses(w, X.collected_values(_rebuilt(w)).filter(~F.coalesce(gone, F.lit(False))))


@query
def typed_values(w):
    atomic = _atomic(w, False).unionByName(_atomic(w, True).drop("index"))
    primitives = L.primitive_types(w.graph.type).rows
    return V.typed_values(atomic, M.attribute_types(w.business.attributes), primitives)


# ---------------------------------------------------------------- links


def _matched(w, ordered=None):
    forward = w.business.forward if ordered is None else w.business.forward.filter(F.col("is_ordered") == ordered)
    return K.association_slots(w.graph.slots_of(forward), w.business.forward, ordered)


@query
def ordered_links(w):
    return K.ordered_links(_matched(w, True))


@query
def unordered_links(w):
    return K.unordered_links(_matched(w, False))


@query
def unordered_links_single_valued(w):
    return K.unordered_links(_matched(w, False), include_single_valued=True)


@query
def link_errors(w):
    return K.link_errors(_matched(w))


@query
def links_per_association(w):
    """Ordered links with their association's name, counted per document and association."""
    found = K.ordered_links(_matched(w, True))
    named = w.business.views.select(F.col("association").alias("metaAssociation"), F.col("name").alias("associationName"))
    counted = found.groupBy("resource", "metaAssociation").agg(
        F.count(F.lit(1)).alias("n_links"), F.max("index").alias("last_index")
    )
    return counted.join(named, "metaAssociation").select("resource", "associationName", "n_links", "last_index")


# ---------------------------------------------------------------- whole model, checks


@query
def export_model(w):
    return B.table_contents(w.model_export)


@query
def profiles_and_models_round_trip(w):
    """Profile and model bundles written with their errors and read back, as rows per table."""
    folder = new_folder(w.spark, "profiles-and-models")
    profile, model = _profile(w), w.model_export
    errors = E.distinct_errors(profile.errors.unionByName(model.errors))
    TB.write_profiles_and_models(profile.tables, model.tables, folder, errors)
    parts = []
    for family, sub in (("Profile", "profiles"), ("Model", "models")):
        back = B.Export(TB.read_tables(w.spark, f"{folder}/{sub}", family), E.no_errors(w.spark))
        parts.append(B.table_contents(back).withColumn("family", F.lit(family)))
    return E.union_all(parts)


@query
def unresolved_references(w):
    export = w.model_export
    universes = {
        "elements": w.element_keys, "metaClasses": w.business.classes, "attributes": w.business.attributes,
        "literals": w.graph.literal, "stereotypes": w.stereotypes, "features": w.graph.feature,
        "profiles": w.graph.document.select(F.col("scope_package").alias("uuid")),
        "associations": w.business.views.select(F.col("association").alias("uuid")),
    }
    return X.unresolved_references(export.tables, universes)


# ---------------------------------------------------------------- change events


def _routed(w):
    return C.route_change(w.graph.change, w.business.changes)


@query
def relevant_changes(w):
    return C.relevant_changes(w.graph.change).select("txn", "seq", "entity", "property")


@query
def route_change(w):
    return _routed(w).select("txn", "seq", "entity", "property", "route", "association")


@query
def change_kind(w):
    return C.relevant_changes(w.graph.change).select(
        "txn", "seq", C.change_kind(F.col("old_value"), F.col("new_value")).alias("changeKind"),
        C.changed_value(F.col("old_value"), F.col("new_value")).alias("value"),
    )


@query
def change_description(w):
    return _routed(w).select("txn", "seq", "description")


_RECORD = ("txn", "seq", "changeKind", "resource", "uuid", "metaClass")


@query
def element_added(w):
    return C.element_added(_routed(w), w.business.changes).select(*_RECORD)


@query
def element_deleted(w):
    return C.element_deleted(_routed(w), w.business.changes).select(*_RECORD)


@query
def unknown_element_log(w):
    return C.unknown_element_log(_routed(w), w.business.changes)


@query
def pre_delete_log(w):
    return C.pre_delete_log(_routed(w))


@query
def forward_link_changes(w):
    return C.forward_link_changes(_routed(w), w.business.changes).drop("description")


@query
def inverse_link_changes(w):
    return C.inverse_link_changes(_routed(w), w.business.changes, show_inverse=True).drop("description")


def _value_changes_query(kind, ordered):
    return lambda w: C.value_changes(
        C.attribute_changes(_routed(w), w.business.changes), kind, ordered
    ).drop("description")


_same_plan({
    "ordered_atomic_changes": _value_changes_query("atomic", True),
    "ordered_literal_changes": _value_changes_query("enumeration", True),
    "unordered_atomic_changes": _value_changes_query("atomic", False),
    "unordered_literal_changes": _value_changes_query("enumeration", False),
})


@query
def classify_changes(w):
    return C.classify_changes(w.graph.change, w.business.changes)


@query
def classify_changes_filled(w):
    return C.fill_resource(C.classify_changes(w.graph.change, w.business.changes), w.graph.element).select(
        "txn", "seq", "event", "resource", "entity"
    )


def _stream(w, notifiers):
    """Events written as files, then classified as a stream until all files are read."""
    source = new_folder(w.spark, "commits")
    # one file per commit
    w.graph.change.withColumn("commit", F.col("txn")).repartition("commit").write.partitionBy("commit").parquet(source)
    events = ST.read_changes(w.spark, source, stream=True)
    run = ST.classify_stream(events, w.business.changes, notifiers, new_folder(w.spark, "offsets"), available_now=True)
    run.awaitTermination()


@query
def classify_changes_stream(w):
    out = new_folder(w.spark, "records")
    _stream(w, [ST.write_records(out)])
    return w.spark.read.parquet(out).drop("batch")


@query
def write_change_events(w):
    """The stream's message log: one notifier writes records, the other messages with JSON."""
    out, log = new_folder(w.spark, "records"), new_folder(w.spark, "messages")
    _stream(w, [ST.write_records(out), ST.write_change_events(log)])
    schema = "txn string, seq bigint, messages array<string>, record string"
    messages = w.spark.read.schema(schema).json(log)
    return messages.select(
        "txn", "seq", F.array_join("messages", "\n").alias("messages"),
        F.get_json_object("record", "$.event").alias("event"),
        F.get_json_object("record", "$.changeKind").alias("changeKind"),
    )


@query
def classify_split_commits(w):
    """Commits spread over shuffled files and several micro-batches, given out whole; stopped and started again."""
    source, out, buffer = (new_folder(w.spark, x) for x in ("split-commits", "records", "commit-buffer"))
    manifest, offsets = new_folder(w.spark, "manifest"), new_folder(w.spark, "offsets")
    events = CM.with_markers(w.graph.change).withColumn("_part", F.pmod(F.xxhash64("seq", "txn"), F.lit(4)))
    for part in range(4):  # each run ends when it has read all files so far
        events.filter(F.col("_part") == part).drop("_part").write.mode("append").parquet(source)
        run = CM.classify_commits(
            ST.read_changes(w.spark, source, stream=True), w.business.changes, [ST.write_records(out)], offsets, buffer,
            available_now=True, manifest=manifest,
        )
        run.awaitTermination()
    return ST.notified(w.spark.read.parquet(out), manifest).drop("batch")


@query
def notified_records(w):
    """Records of a stream whose second notifier fails at first: seen only when both have ended."""
    out, manifest, failed = new_folder(w.spark, "records"), new_folder(w.spark, "manifest"), []

    def fails_once(records, batch_id):
        if not failed:
            failed.append(batch_id)
            raise RuntimeError("planned failure of a notifier")

    source, offsets = new_folder(w.spark, "commits"), new_folder(w.spark, "offsets")
    w.graph.change.write.parquet(source)
    for _ in range(2):
        run = ST.classify_stream(
            ST.read_changes(w.spark, source, stream=True), w.business.changes, [ST.write_records(out), fails_once],
            offsets, available_now=True, manifest=manifest,
        )
        try:
            run.awaitTermination()
        except StreamingQueryException as e:
            if "planned failure" not in str(e):
                raise
    return ST.notified(w.spark.read.parquet(out), manifest).drop("batch")


@query
def read_changes(w):
    folder = new_folder(w.spark, "commits")
    w.graph.change.write.parquet(folder)
    return ST.read_changes(w.spark, folder)


# ---------------------------------------------------------------- registry


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn):
        return lambda spark, folder: fn(workspace(spark, folder))

    return {name: bind(fn) for name, fn in _QUERIES.items()}
