"""Bundles of tables per resource kind; one run covers all documents of that kind.

There is no loop over documents: ``resource`` is a column of every table.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from modelweave.operators import documents as D
from modelweave.operators import library as L
from modelweave.operators import metamodel as M
from modelweave.operators import model as O
from modelweave.operators import profile as P
from modelweave.functions.scale import keep_listed, lookup_join, materialize
from modelweave.operators import values as V
from modelweave.operators.errors import error_rows, union_all
from modelweave.schemas import LIBRARY, LIBRARY_EMPTY, struct


@dataclass(frozen=True)
class Export:
    tables: dict[str, DataFrame]
    errors: DataFrame


def _imports(rows: DataFrame, importing: str, imported: str) -> DataFrame:
    return rows.select(F.col("importing").alias(importing), F.col("imported").alias(imported))


def export_library(
    spark: SparkSession, documents: DataFrame, types: DataFrame, literals: DataFrame, imports: DataFrame
) -> Export:
    """Library tables; structured datatypes are declared but stay empty."""
    own_types = D.in_documents(types, documents, "Library")
    own_literals = D.in_documents(literals, documents, "Library")
    primitives = L.primitive_types(own_types)
    imported = D.package_imports(imports, documents, "Library")
    tables = {
        "resources": D.resource_rows(documents, "Library"),
        "importedLibraries": _imports(imported.rows, "importingResource", "importedLibrary"),
        "primitiveDataTypes": primitives.rows,
        "enumerationDataTypes": L.enumeration_types(own_types),
        "enumeration2literals": L.enumeration_literals_indexed(own_literals),
        "enumerationLiterals": L.enumeration_literal_names(own_literals),
    }
    tables.update({name: spark.createDataFrame([], struct(LIBRARY[name])) for name in LIBRARY_EMPTY})
    return Export(tables, primitives.errors.unionByName(imported.errors))


def export_metamodel(
    documents: DataFrame, elements: DataFrame, associations: DataFrame, features: DataFrame,
    feature_rels: DataFrame, generalizations: DataFrame, types: DataFrame, imports: DataFrame,
    attributes: DataFrame | None = None, legacy_imports: bool = False, classes: DataFrame | None = None,
    ends: DataFrame | None = None,
) -> Export:
    """Metamodel tables; ``attributes``, ``classes`` and oriented ``ends`` may be given where they are known.

    An import is written as metamodel or library import by the kind of the imported document;
    ``legacy_imports`` writes every import as both.
    """
    # Each of these three is the source of several tables.
    if classes is None:
        classes = materialize(M.meta_classes(elements, documents), "classes")
    oriented = M.orient_associations(D.in_documents(associations, documents, "Metamodel"), features)
    if ends is None:
        ends = materialize(oriented.rows, "associations")
    if attributes is None:
        attributes = materialize(M.class_attributes(features, types, classes), "attributes")
    bounded = M.bounded_features(ends, attributes)
    kind = (None, None) if legacy_imports else ("Metamodel", "Library")
    metamodels = D.package_imports(imports, documents, "Metamodel", imported_document_kind=kind[0])
    libraries = D.package_imports(imports, documents, "Metamodel", imported_document_kind=kind[1])
    tables = {
        "resources": D.resource_rows(documents, "Metamodel"),
        "importedMetamodels": _imports(metamodels.rows, "importingMetamodel", "importedMetamodel"),
        "importedLibraries": _imports(libraries.rows, "importingResource", "importedLibrary"),
        "metaClasses": classes,
        "metaClassGeneralizations": M.metaclass_generalizations(generalizations, classes),
        "metaAssociations": M.meta_associations(elements, documents),
        "metaAssociationGeneralizations": M.association_generalizations(ends, feature_rels),
        "metaAssociation2Source": M.association_source(ends),
        "metaAssociation2Target": M.association_target(ends),
        "metaAssociationEnds": M.association_ends(ends),
        "metaAssociationEnd2MetaClass": M.association_end_types(ends),
        "attributes": M.attribute_names(attributes),
        "featureLowerBounds": M.feature_lower_bounds(bounded),
        "featureUpperBounds": M.feature_upper_bounds(bounded),
        "featureOrdering": M.feature_ordering(bounded),
        "attribute2type": M.attribute_types(attributes),
    }
    for kind_name in M.KINDS:
        for ordered in (True, False):
            name = f"metaClass2{'ordered' if ordered else 'unordered'}{kind_name.capitalize()}Attribute"
            tables[name] = M.owned_attribute_table(attributes, kind_name, ordered)
    return Export(tables, oriented.errors.unionByName(metamodels.errors))


def export_profile(
    spark: SparkSession, documents: DataFrame, elements: DataFrame, features: DataFrame, types: DataFrame,
    library_types: DataFrame, classes: DataFrame, generalizations: DataFrame, imports: DataFrame, metamodel: str,
) -> Export:
    """Profile tables for the profile documents given; ``classes`` are those of the extended metamodel."""
    profiles = D.resource_rows(documents, "Profile")
    stereos = materialize(P.stereotypes(elements, documents), "stereotypes")
    extends = P.stereotype_extends(features, stereos, types, classes)
    attributes = materialize(
        P.stereotype_attributes(features, stereos, types, library_types), "stereotype-attributes"
    )
    to_classes = P.stereotype_metaclass_props(features, stereos, types, classes)
    to_stereotypes = P.stereotype_stereotype_props(features, stereos, types)
    ends = materialize(to_classes.rows.unionByName(to_stereotypes), "stereotype-ends")
    bounded = P.bounded_properties(attributes, ends)
    imported = D.package_imports(imports, documents, "Profile", imported_kind="Profile")
    all_stereotypes = types.filter(F.col("type_kind") == "stereotype")
    tables = {
        "resources": profiles,
        "extendedMetamodels": P.extended_metamodels(profiles, metamodel),
        "importedProfiles": _imports(imported.rows, "importingProfile", "importedProfile"),
        "importedLibraries": spark.createDataFrame([], "importingResource string, importedLibrary string"),
        "stereotypes": stereos,
        "generalizations": P.stereotype_generalizations(generalizations, stereos, all_stereotypes),
        "extendedMetaclasses": extends.rows,
        "stereotypeAttributes": P.stereotype_attribute_table(attributes),
        "stereotype2MetaClassProperty": P.metaclass_property_table(to_classes.rows),
        "stereotype2StereotypeProperty": P.stereotype_property_table(to_stereotypes),
        "associationTargetEnds": P.association_target_ends(ends),
        "attributes": M.attribute_names(attributes),
        "featureLowerBounds": M.feature_lower_bounds(bounded),
        "featureUpperBounds": M.feature_upper_bounds(bounded),
        "featureOrdering": M.feature_ordering(bounded),
        "attribute2type": M.attribute_types(attributes),
    }
    return Export(tables, union_all([extends.errors, to_classes.errors, imported.errors]))


# Tables filled from slots: (what the feature is, ordered) -> table.
SLOT_TABLES = {
    ("atomic", True): "orderedAtomicValues", ("atomic", False): "unorderedAtomicValues",
    ("enumeration", True): "orderedLiteralValues", ("enumeration", False): "unorderedLiteralValues",
    ("structured", True): "orderedStructuredValues", ("structured", False): "unorderedStructuredValues",
    ("link", True): "orderedLinks", ("link", False): "unorderedLinks",
}
_LINK_ERRORS = "linkErrors"
_SLOT_KEYS = ["metaclass", "feature_name"]


def _slot_lookup(attributes: DataFrame, forward: DataFrame) -> DataFrame:
    return attributes.filter(~F.col("implementation_derived")).select(
        F.col("metaclass_name").alias("metaclass"), F.col("name").alias("feature_name"),
        F.col("attribute").alias("target"), "kind", "is_ordered",
    ).unionByName(forward.select(
        "metaclass", "feature_name", F.col("association").alias("target"), F.lit("link").alias("kind"), "is_ordered"
    ))


def _no_element() -> Column:
    return F.col("is_collection") & ((F.col("value_kind") != "element") | F.col("ref").isNull())


def slot_tables(slots: DataFrame, attributes: DataFrame, forward: DataFrame) -> DataFrame:
    """Rows of all slot tables in one pass over the slots, told apart by ``table``.

    Attribute and association lookups are one lookup, so the slots are joined once. The same rows
    come from ``values`` and ``links`` table by table.
    """
    lookup = _slot_lookup(attributes, forward)
    return _slot_rows(keep_listed(slots.drop("feature"), lookup, _SLOT_KEYS), lookup)


def _slot_rows(slots: DataFrame, lookup: DataFrame) -> DataFrame:
    joined = lookup_join(slots, lookup, _SLOT_KEYS)
    kind, of = F.col("kind"), F.col("value_kind")
    value = (
        F.when(kind == "atomic", F.col("value"))
        .when((kind == "enumeration") & (of == "literal"), F.col("value"))
        .when((kind == "structured") & (of == "instance"), F.col("ref_instance"))
        .when((kind == "link") & F.col("is_collection") & (of == "element"), F.col("ref"))
    )
    table = F.lit(None).cast("string")
    for (name, ordered), title in SLOT_TABLES.items():
        table = F.when((kind == name) & (F.col("is_ordered") == F.lit(ordered)), title).otherwise(table)
    no_element = (kind == "link") & _no_element()
    # Values of another kind than their attribute's are skipped; a literal without a value is a value.
    kept = (kind == "atomic") | ((kind == "enumeration") & (of == "literal")) | no_element | value.isNotNull()
    index = F.when(F.col("is_collection"), F.col("position")).otherwise(F.lit(0))
    return joined.select(
        F.when(no_element, _LINK_ERRORS).otherwise(table).alias("table"), "resource", "entity", "target",
        F.when(no_element, F.col("feature_name")).otherwise(value).alias("value"), index.alias("index"), "kind",
        kept.alias("kept"),
    ).filter("kept").drop("kind", "kept")


# What a slot must be for a table of that kind; columns of the slots alone, so that scans of other kinds are left out.
_OF_KIND = {
    "atomic": lambda: F.lit(True), "enumeration": lambda: F.col("value_kind") == "literal",
    "structured": lambda: F.col("value_kind") == "instance",
    "link": lambda: F.col("is_collection") & (F.col("value_kind") == "element") & F.col("ref").isNotNull(),
}


def slot_views(
    slots_of: Callable[[DataFrame], DataFrame], attributes: DataFrame, forward: DataFrame, documents: DataFrame
) -> dict[str, DataFrame]:
    """Rows of `slot_tables` with those of each table, read where they are used from the slots that can give them.

    Nothing is written or sorted by table before its reader. ``slots_of`` gives the slots for a lookup.
    """
    lookup = _slot_lookup(attributes, forward)

    def rows(of: DataFrame, wanted: Column) -> DataFrame:
        return _slot_rows(D.in_documents(slots_of(of).drop("feature").filter(wanted), documents, "Model"), of)

    out = {}
    for (kind, ordered), title in SLOT_TABLES.items():
        of = lookup.filter((F.col("kind") == kind) & (F.col("is_ordered") == F.lit(ordered)))
        out[title] = rows(of, _OF_KIND[kind]())
    out[_LINK_ERRORS] = rows(lookup.filter("kind = 'link'"), _no_element())
    return out


def _slot_table(rows: DataFrame, kind: str, ordered: bool) -> DataFrame:
    own = rows.filter(F.col("table") == SLOT_TABLES[kind, ordered])
    names = (("sourceElement", "metaAssociation", "targetElement") if kind == "link"
             else ("entity", "attribute", "value"))
    columns = [F.col(c).alias(n) for c, n in zip(("entity", "target", "value"), names)]
    return own.select("resource", *columns, *(["index"] if ordered else []))


def _slot_errors(rows: DataFrame) -> DataFrame:
    return error_rows(
        rows.filter(F.col("table") == _LINK_ERRORS), "link-to-non-element",
        F.concat(F.lit("No element at "), F.col("value"), F.lit("["), F.col("index").cast("string"), F.lit("]")),
        element="entity",
    )


@dataclass(frozen=True)
class ModelInput:
    """What a model export needs besides the documents; ``forward`` and ``attributes`` are the lookups.

    ``slots_of`` gives the slots that can match a lookup, where the source can read them apart.
    """

    elements: DataFrame
    slots: DataFrame
    tag_slots: DataFrame
    applications: DataFrame
    profile_applications: DataFrame
    features: DataFrame
    types: DataFrame
    classes: DataFrame
    stereotypes: DataFrame
    stereotype_taxa: DataFrame
    forward: DataFrame
    attributes: DataFrame
    metamodel: str
    slots_of: Callable[[DataFrame], DataFrame] | None = None


def export_model(documents: DataFrame, exported_profiles: DataFrame, given: ModelInput) -> Export:
    """Model tables of the ``documents`` given; errors of the value and reference steps are kept with the others.

    Every table, also those of slots and applications, holds rows of these documents only.
    The eight tables that come from slots are read from the slots they can come from, where these can be read apart;
    else they are written in one job, split by table, and reading one of them back touches its own files only.
    """
    own = D.in_documents(given.elements, documents, "Model")
    applications = D.in_documents(given.applications, documents, "Model")
    models = D.resource_rows(documents, "Model")
    elements = O.model_elements(own, given.classes)
    applied = O.apply_profiles(applications, documents, exported_profiles, given.stereotypes)
    if given.slots_of is not None:
        rows = slot_views(given.slots_of, given.attributes, given.forward, documents)
    else:
        slots = D.in_documents(given.slots, documents, "Model")
        written = materialize(slot_tables(slots, given.attributes, given.forward), "slot-tables", ["table"])
        rows = dict.fromkeys((*SLOT_TABLES.values(), _LINK_ERRORS), written)
    tag_slots = D.in_documents(given.tag_slots, documents, "Model")
    tags = materialize(
        V.stereotype_slots(tag_slots, given.features, given.types, applications, given.stereotype_taxa),
        "stereotype-slots",
    )
    ordered_refs = V.stereotype_references(tags, ordered=True)
    unordered_refs = V.stereotype_references(tags, ordered=False)
    tables = {
        "resources": models,
        "instantiatedMetamodels": O.instantiated_metamodels(models, given.metamodel),
        "appliedProfiles": O.applied_profiles(
            D.in_documents(given.profile_applications, documents, "Model"), documents
        ),
        "elements": elements.rows,
        "elementIDs": O.element_tool_ids(own),
        "elementURLs": O.element_tool_urls(own),
        **{name: _slot_table(rows[name], *key) for key, name in SLOT_TABLES.items()},
        "appliedStereotypes": applied.rows,
        "orderedStereotypeReferences": ordered_refs.rows,
        "unorderedStereotypeReferences": unordered_refs.rows,
    }
    errors = [elements.errors, applied.errors, _slot_errors(rows[_LINK_ERRORS]), V.ordered_structured_tags(tags),
              ordered_refs.errors, unordered_refs.errors]
    return Export(tables, union_all(errors))


def export_selected(selection: DataFrame, documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents to export, errors): the selected packages, found or not."""
    chosen = D.selected_documents(selection, documents)
    return chosen.rows.select(*documents.columns), chosen.errors


def row_text(df: DataFrame) -> Column:
    """All columns of a row as one text, in the order of their names: bytes, ``:``, text; a null is ``-``."""
    texts = [F.col(c).cast("string") for c in sorted(df.columns)]
    return F.concat(*[F.coalesce(F.concat(F.octet_length(t), F.lit(":"), t), F.lit("-")) for t in texts])


def table_contents(export: Export) -> DataFrame:
    """Rows per table of a bundle, errors included, and the sum of a 60-bit hash of every row's text.

    Equal sums mean equal rows in whatever order, so bundles can be compared without listing them.
    """
    sums = []
    # Halves of 30 bits, so that tasks add plain longs.
    high, low = F.sum(F.shiftright("hash", 30)), F.sum(F.col("hash").bitwiseAND(F.lit((1 << 30) - 1)))
    content = high.cast("decimal(28,0)") * F.lit(1 << 30).cast("decimal(10,0)") + low.cast("decimal(20,0)")
    for name, df in {**export.tables, "errors": export.errors}.items():
        number = F.conv(F.substring(F.md5(row_text(df)), 1, 15), 16, 10).cast("bigint")
        sums.append(df.select(F.lit(name).alias("table"), number.alias("hash")).groupBy("table").agg(
            F.count(F.lit(1)).alias("n_rows"), content.cast("decimal(38,0)").cast("string").alias("content")
        ))
    return union_all(sums)


