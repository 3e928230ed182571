"""Profile tables: stereotypes, the classes they extend, their attributes and references."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelweave.functions.scale import lookup_join, numbered
from modelweave.operators.documents import in_documents
from modelweave.operators.errors import Result, error_rows

DATATYPES = ("primitive", "enumeration", "structured")


def stereotypes(elements: DataFrame, documents: DataFrame) -> DataFrame:
    kept = in_documents(elements.filter(F.col("kind") == "Stereotype"), documents, "Profile")
    return kept.select("resource", "uuid", "name", F.col("is_abstract").alias("isAbstract"))


def _properties(features: DataFrame, stereos: DataFrame, types: DataFrame) -> DataFrame:
    """Owned properties of the stereotypes with the kind and name of their type."""
    owned = features.drop("resource").join(stereos.select("resource", F.col("uuid").alias("owner")), "owner")
    kinds = types.select(F.col("uuid").alias("type"), "type_kind", F.col("name").alias("type_name"))
    return lookup_join(owned, kinds, ["type"], how="left")


def stereotype_extends(features: DataFrame, stereos: DataFrame, types: DataFrame, classes: DataFrame) -> Result:
    """Metaclass extended through each base property, found by type name."""
    base = _properties(features.filter("is_extension_end"), stereos, types)
    known = classes.select(F.col("name").alias("type_name"), F.col("uuid").alias("extendedMetaclass"))
    found = lookup_join(base, known, ["type_name"], how="left")
    missing = found.filter(F.col("extendedMetaclass").isNull())
    untyped = F.col("type").isNull()
    message = F.when(untyped, F.concat(F.lit("Base property without a metaclass: "), F.col("uuid"))).otherwise(
        F.concat(F.lit("Base property "), F.col("uuid"), F.lit(" refers to an unknown metaclass: "),
                 F.coalesce("type_name", "type"))
    )
    errors = error_rows(missing, "base-property", message)
    return Result(
        found.filter(F.col("extendedMetaclass").isNotNull()).select(
            "resource", F.col("owner").alias("extendingStereotype"), "extendedMetaclass"
        ),
        errors,
    )


def stereotype_attributes(
    features: DataFrame, stereos: DataFrame, types: DataFrame, library_types: DataFrame
) -> DataFrame:
    """Datatype-typed owned properties; the type is looked up by name in the library, else dropped.

    The index counts all owned properties of the stereotype.
    """
    owned = features.join(stereos.select(F.col("uuid").alias("owner")), "owner", "left_semi")
    places = numbered(owned, ["owner"], ["position", "uuid"])
    known = library_types.filter(F.col("type_kind").isin(*DATATYPES)).select(
        F.col("name").alias("type_name"), F.col("uuid").alias("library_type")
    )
    typed = _properties(places, stereos, types.filter(F.col("type_kind").isin(*DATATYPES)))
    return lookup_join(typed, known, ["type_name"]).select(
        "resource", "owner", "uuid", "name", F.col("library_type").alias("type"), "lower", "upper", "is_ordered", "index"
    )


def stereotype_attribute_table(attributes: DataFrame) -> DataFrame:
    return attributes.select("resource", F.col("owner").alias("stereotype"), F.col("uuid").alias("attribute"), "index")


_END = ("resource", "owner", "uuid", "name", "lower", "upper", "is_ordered", "is_composite")


def stereotype_metaclass_props(
    features: DataFrame, stereos: DataFrame, types: DataFrame, classes: DataFrame
) -> Result:
    """Properties typed by a class that is no stereotype; the class is found by name.

    A class that is not known is a fatal error row.
    """
    props = _properties(features.filter("NOT is_derived AND NOT is_extension_end"), stereos, types).filter(
        F.col("type_kind") == "class"
    )
    known = classes.select(F.col("name").alias("type_name"), F.col("uuid").alias("target"))
    found = lookup_join(props, known, ["type_name"], how="left")
    return Result(
        found.filter(F.col("target").isNotNull()).select(*_END, "target"),
        error_rows(
            found.filter(F.col("target").isNull()), "property-metaclass",
            F.concat(F.lit("Property "), F.col("uuid"), F.lit(" must be typed by a known metaclass: "),
                     F.coalesce("type_name", F.lit("?"))),
            severity="fatal",
        ),
    )


def stereotype_stereotype_props(features: DataFrame, stereos: DataFrame, types: DataFrame) -> DataFrame:
    """Properties typed by a stereotype of the same profile."""
    props = _properties(features.filter("NOT is_derived"), stereos, types).filter(F.col("type_kind") == "stereotype")
    same = stereos.select("resource", F.col("uuid").alias("type"))
    return lookup_join(props, same, ["resource", "type"], how="left_semi").select(*_END, F.col("type").alias("target"))


def metaclass_property_table(props: DataFrame) -> DataFrame:
    return props.select("resource", F.col("owner").alias("sourceStereotype"),
                        F.col("uuid").alias("associationTargetEnd"), F.col("target").alias("targetMetaClass"))


def stereotype_property_table(props: DataFrame) -> DataFrame:
    return props.select("resource", F.col("owner").alias("sourceStereotype"),
                        F.col("uuid").alias("associationTargetEnd"), F.col("target").alias("targetStereotype"))


def stereotype_generalizations(
    generalizations: DataFrame, stereos: DataFrame, all_stereotypes: DataFrame, legacy_swap: bool = False
) -> DataFrame:
    """Parent edges of the stereotypes; ``legacy_swap`` writes child and parent the wrong way round."""
    edges = generalizations.join(stereos.select("resource", F.col("uuid").alias("specific")), "specific")
    edges = lookup_join(edges, all_stereotypes.select(F.col("uuid").alias("general")), ["general"], how="left_semi")
    child, parent = ("general", "specific") if legacy_swap else ("specific", "general")
    return edges.select("resource", F.col("specific").alias(child), F.col("general").alias(parent))


def extended_metamodels(profiles: DataFrame, metamodel: str) -> DataFrame:
    return profiles.select("resource", F.lit(metamodel).alias("extendedMetamodel"))


def association_target_ends(ends: DataFrame) -> DataFrame:
    role = F.when(F.col("is_composite"), "targetComposite").otherwise("targetReference")
    return ends.select("resource", "uuid", "name", role.alias("role"))


def bounded_properties(attributes: DataFrame, ends: DataFrame) -> DataFrame:
    """Attributes and target ends with lower, upper and ordering."""
    columns = ("resource", F.col("uuid").alias("feature"), "lower", "upper", F.col("is_ordered").alias("isOrdered"))
    return attributes.select(*columns).unionByName(ends.select(*columns))
