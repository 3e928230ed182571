"""Column layouts of the raw model graph (input) and of the normalized tables (output).

A layout is a DDL string; every reader uses it, nothing is inferred.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------- input: raw model graph

RAW = {
    "document": "resource string, scope_package string, kind string, package_uri string,"
    " document_url string, artifact_kind string, ns_prefix string, uuid_prefix string,"
    " tool_package_id string, tool_package_url string",
    "element": "resource string, uuid string, kind string, name string, owner string,"
    " is_abstract boolean, tool_id string, tool_url string",
    "type": "resource string, uuid string, name string, type_kind string",
    "literal": "resource string, enumeration string, uuid string, name string, position int",
    "feature": "resource string, uuid string, owner string, position int, name string, type string,"
    " lower int, upper int, is_ordered boolean, is_derived boolean, is_composite boolean,"
    " is_container boolean, is_containment boolean, is_changeable boolean, opposite string,"
    " is_extension_end boolean",
    "association": "resource string, uuid string, name string, is_abstract boolean, end1 string, end2 string",
    "feature_rel": "feature string, rel string, target string",
    "generalization": "specific string, general string",
    "import": "importer string, imported string, imported_kind string",
    "slot": "resource string, entity string, metaclass string, feature string, feature_name string,"
    " position int, is_collection boolean, value_kind string, value string, ref string, ref_instance string",
    "application": "resource string, element string, stereotype string, base_property string, profile string",
    "profile_application": "resource string, applying_package string, applied_profile string",
    "change": "txn string, seq bigint, entity string, is_element boolean, metaclass string, property string,"
    " old_value string, new_value string, value_kind string, value_metaclass string, shape string, index int",
}

# ---------------------------------------------------------------- output: table families

_OWNED = "resource string, metaClass string, attribute string, index int"

LIBRARY = {
    "resources": "resource string, kind string",
    "importedLibraries": "importingResource string, importedLibrary string",
    "primitiveDataTypes": "resource string, uuid string, name string, datatypeMapDefinition string",
    "enumerationDataTypes": "resource string, uuid string, name string",
    "enumeration2literals": "resource string, enumeration string, literal string, index int",
    "enumerationLiterals": "resource string, literal string, name string",
    "structuredDataTypes": "resource string, uuid string, name string",
    "generalizations": "resource string, specific string, general string",
    "structure2attribute": "resource string, structure string, attribute string, index int",
    "attributes": "resource string, uuid string, name string",
    "featureLowerBounds": "resource string, feature string, lower int",
    "featureUpperBounds": "resource string, feature string, upper int",
    "featureOrdering": "resource string, feature string, isOrdered boolean",
    "attribute2type": "resource string, attribute string, type string",
}

# Library tables that always stay empty: structured datatypes are known only through their values.
LIBRARY_EMPTY = (
    "structuredDataTypes",
    "generalizations",
    "structure2attribute",
    "attributes",
    "featureLowerBounds",
    "featureUpperBounds",
    "featureOrdering",
    "attribute2type",
)

METAMODEL = {
    "resources": "resource string, kind string",
    "importedMetamodels": "importingMetamodel string, importedMetamodel string",
    "importedLibraries": "importingResource string, importedLibrary string",
    "metaClasses": "resource string, uuid string, name string, isAbstract boolean",
    "metaClassGeneralizations": "resource string, specific string, general string",
    "metaAssociations": "resource string, uuid string, name string, isAbstract boolean",
    "metaAssociationGeneralizations": "resource string, specific string, general string,"
    " sourceRestriction boolean, targetRestriction boolean",
    "metaClass2orderedAtomicAttribute": _OWNED,
    "metaClass2unorderedAtomicAttribute": _OWNED,
    "metaClass2orderedEnumerationAttribute": _OWNED,
    "metaClass2unorderedEnumerationAttribute": _OWNED,
    "metaClass2orderedStructuredAttribute": _OWNED,
    "metaClass2unorderedStructuredAttribute": _OWNED,
    "metaAssociation2Source": "resource string, association string, sourceEnd string",
    "metaAssociation2Target": "resource string, association string, targetEnd string",
    "metaAssociationEnds": "resource string, uuid string, name string, role string",
    "metaAssociationEnd2MetaClass": "resource string, associationEnd string, type string",
    "attributes": "resource string, uuid string, name string",
    "featureLowerBounds": "resource string, feature string, lower int",
    "featureUpperBounds": "resource string, feature string, upper int",
    "featureOrdering": "resource string, feature string, isOrdered boolean",
    "attribute2type": "resource string, attribute string, type string",
}

PROFILE = {
    "resources": "resource string, kind string",
    "extendedMetamodels": "resource string, extendedMetamodel string",
    "importedProfiles": "importingProfile string, importedProfile string",
    "importedLibraries": "importingResource string, importedLibrary string",
    "stereotypes": "resource string, uuid string, name string, isAbstract boolean",
    "generalizations": "resource string, specific string, general string",
    "extendedMetaclasses": "resource string, extendingStereotype string, extendedMetaclass string",
    "stereotypeAttributes": "resource string, stereotype string, attribute string, index int",
    "stereotype2MetaClassProperty": "resource string, sourceStereotype string, associationTargetEnd string,"
    " targetMetaClass string",
    "stereotype2StereotypeProperty": "resource string, sourceStereotype string, associationTargetEnd string,"
    " targetStereotype string",
    "associationTargetEnds": "resource string, uuid string, name string, role string",
    "attributes": "resource string, uuid string, name string",
    "featureLowerBounds": "resource string, feature string, lower int",
    "featureUpperBounds": "resource string, feature string, upper int",
    "featureOrdering": "resource string, feature string, isOrdered boolean",
    "attribute2type": "resource string, attribute string, type string",
}

_VALUE = "resource string, entity string, attribute string, value string"

MODEL = {
    "resources": "resource string, kind string",
    "instantiatedMetamodels": "instantiatedMetamodel string, instantiatingModel string",
    "appliedProfiles": "applyingResource string, applyingPackage string, appliedResource string,"
    " appliedProfile string",
    "elements": "resource string, uuid string, metaClass string",
    "elementIDs": "resource string, uuid string, toolVendorID string, toolElementID string",
    "elementURLs": "resource string, uuid string, toolVendorID string, toolElementURL string",
    "orderedAtomicValues": f"{_VALUE}, index int",
    "orderedLiteralValues": f"{_VALUE}, index int",
    "orderedStructuredValues": f"{_VALUE}, index int",
    "unorderedAtomicValues": _VALUE,
    "unorderedLiteralValues": _VALUE,
    "unorderedStructuredValues": _VALUE,
    "appliedStereotypes": "resource string, modelElement string, appliedStereotype string",
    "orderedStereotypeReferences": "resource string, modelElement string, associationTargetEnd string,"
    " referencedElement string, index int",
    "unorderedStereotypeReferences": "resource string, modelElement string, associationTargetEnd string,"
    " referencedElement string",
    "orderedLinks": "resource string, sourceElement string, targetElement string, metaAssociation string, index int",
    "unorderedLinks": "resource string, sourceElement string, targetElement string, metaAssociation string",
}

FAMILIES = {"Library": LIBRARY, "Metamodel": METAMODEL, "Profile": PROFILE, "Model": MODEL}

ERRORS = "resource string, element string, severity string, code string, message string"

# One nested JSON file per document set.
DOCUMENT_SET = (
    "documents array<struct<"
    "characteristics:struct<packageURI:string,documentURL:string,"
    "artifactKind:struct<type:string>,nsPrefix:string,uuidPrefix:string>,"
    "toolSpecificPackageID:string,toolSpecificPackageURL:string,"
    "overrideID:array<string>,overrideUUID:array<string>,excludeNestedElements:array<string>>>"
)


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)
