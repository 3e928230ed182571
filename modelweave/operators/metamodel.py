"""Metamodel tables: classes, associations with oriented ends, attributes and their bounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelweave.functions.expressions import points_backwards
from modelweave.functions.scale import lookup_join, numbered, used_lookup
from modelweave.operators.documents import in_documents
from modelweave.operators.errors import Result, error_rows, union_all

KINDS = ("atomic", "enumeration", "structured")
_KIND_OF_TYPE = {"primitive": "atomic", "enumeration": "enumeration", "structured": "structured"}

# (relation of the source ends, relation of the target ends) -> (source, target) restriction
RESTRICTIONS = {
    ("subsets", "subsets"): (False, False),
    ("subsets", "redefines"): (False, True),
    ("redefines", "subsets"): (True, False),
    ("redefines", "redefines"): (True, True),
}


def _named(elements: DataFrame) -> DataFrame:
    return elements.select("resource", "uuid", "name", F.col("is_abstract").alias("isAbstract"))


def meta_classes(elements: DataFrame, documents: DataFrame) -> DataFrame:
    return _named(in_documents(elements.filter(F.col("kind") == "Class"), documents, "Metamodel"))


def meta_associations(elements: DataFrame, documents: DataFrame) -> DataFrame:
    return _named(in_documents(elements.filter(F.col("kind") == "Association"), documents, "Metamodel"))


def orient_associations(associations: DataFrame, features: DataFrame) -> Result:
    """Source and target end of each association.

    The declared target becomes the source when its name starts with ``_`` or ``UML``. An
    association with a missing end is a fatal error row.
    """

    def end(prefix: str) -> DataFrame:
        kept = ("uuid", "owner", "name", "type", "lower", "upper", "is_ordered", "is_composite")
        return features.select(*[F.col(c).alias(f"{prefix}_{c}") for c in kept])

    both = (
        associations.select("resource", F.col("uuid").alias("association"), "name", "is_abstract", "end1", "end2")
        .join(end("a").withColumnRenamed("a_uuid", "end1").withColumn("a_uuid", F.col("end1")), "end1", "left")
        .join(end("b").withColumnRenamed("b_uuid", "end2").withColumn("b_uuid", F.col("end2")), "end2", "left")
    )
    whole = F.col("a_uuid").isNotNull() & F.col("b_uuid").isNotNull()
    swap = points_backwards(F.col("b_name"))
    fields = {"uuid": "end", "name": "name", "type": "class", "lower": "lower", "upper": "upper",
              "is_ordered": "is_ordered", "is_composite": "is_composite"}
    picked = []
    for field, label in fields.items():
        first, second = F.col(f"a_{field}"), F.col(f"b_{field}")
        picked.append(F.when(swap, second).otherwise(first).alias(f"source_{label}"))
        picked.append(F.when(swap, first).otherwise(second).alias(f"target_{label}"))
    return Result(
        both.filter(whole).select("resource", "association", "name", "is_abstract", *picked),
        error_rows(
            both.filter(~whole), "association-end-missing",
            F.concat(F.lit("Association without two ends: "), F.coalesce("name", F.lit("null"))), element="association", severity="fatal",
        ),
    )


def association_generalizations(
    oriented: DataFrame, feature_rels: DataFrame, relations: tuple[str, str] | None = None
) -> DataFrame:
    """A specializes B when the ends of A subset or redefine the ends of B.

    ``relations`` restricts the result to one (source, target) combination; ``None`` gives all four.
    """
    ends = oriented.select("resource", "association", "source_end", "target_end")
    rels = feature_rels.filter(F.col("rel").isin("subsets", "redefines"))

    def rel(end: str) -> DataFrame:
        return rels.select(
            F.col("feature").alias(f"{end}_end"), F.col("rel").alias(f"{end}_rel"),
            F.col("target").alias(f"general_{end}_end"),
        )

    general = ends.select(
        F.col("association").alias("general"), F.col("source_end").alias("general_source_end"),
        F.col("target_end").alias("general_target_end"),
    )
    related = lookup_join(ends.join(rel("source"), "source_end"), general, ["general_source_end"])
    pairs = related.join(rel("target"), ["target_end", "general_target_end"])
    if relations is not None:
        pairs = pairs.filter((F.col("source_rel") == relations[0]) & (F.col("target_rel") == relations[1]))
    return pairs.select(
        "resource", F.col("association").alias("specific"), "general",
        (F.col("source_rel") == "redefines").alias("sourceRestriction"),
        (F.col("target_rel") == "redefines").alias("targetRestriction"),
    ).distinct()


def metaclass_generalizations(generalizations: DataFrame, classes: DataFrame) -> DataFrame:
    """Parent edges between classes of the same metamodel; a parent elsewhere is not written."""
    specific = classes.select("resource", F.col("uuid").alias("specific"))
    general = classes.select("resource", F.col("uuid").alias("general"))
    edges = generalizations.join(specific, "specific")
    return lookup_join(edges, general, ["resource", "general"], how="left_semi").select(
        "resource", "specific", "general"
    )


# ---------------------------------------------------------------- attributes


def class_attributes(
    features: DataFrame, types: DataFrame, classes: DataFrame, kinds: tuple[str, ...] = KINDS
) -> DataFrame:
    """Owned datatype attributes of the classes with their index in the owner's list.

    Atomic attributes are numbered after derived features were dropped; enumeration and structured
    attributes keep their place among all owned features, derived ones included.
    """
    columns = ("resource", "owner", "uuid", "name", "type", "lower", "upper", "is_ordered", "is_derived")
    owned = features.select(*columns, "position").join(classes.select(F.col("uuid").alias("owner")), "owner", "left_semi")
    datatypes = used_lookup(
        types.filter(F.col("type_kind").isin(*_KIND_OF_TYPE)).select(F.col("uuid").alias("type"), "type_kind"),
        features, ["type"],
    )

    def of_kinds(places: DataFrame, wanted: list[str]) -> DataFrame:
        own = datatypes.filter(F.col("type_kind").isin(*[t for t, k in _KIND_OF_TYPE.items() if k in wanted]))
        return lookup_join(places, own, ["type"]).select(*columns, "index", "type_kind")

    parts = []
    if "atomic" in kinds:
        places = numbered(owned.filter(~F.col("is_derived")), ["owner"], ["position", "uuid"])
        parts.append(of_kinds(places, ["atomic"]).withColumn("kind", F.lit("atomic")))
    others = [k for k in ("enumeration", "structured") if k in kinds]
    if others:
        places = numbered(owned, ["owner"], ["position", "uuid"])
        # these kinds are called as the kinds of their types
        parts.append(of_kinds(places, others).withColumn("kind", F.col("type_kind")))
    return union_all(parts).drop("type_kind")


def owned_attribute_table(attributes: DataFrame, kind: str, ordered: bool) -> DataFrame:
    """One of the six class-to-attribute tables."""
    flag = F.col("is_ordered") if ordered else ~F.col("is_ordered")
    return attributes.filter((F.col("kind") == kind) & flag).select(
        "resource", F.col("owner").alias("metaClass"), F.col("uuid").alias("attribute"), "index"
    )


# ---------------------------------------------------------------- ends, bounds


def association_source(oriented: DataFrame) -> DataFrame:
    return oriented.select("resource", "association", F.col("source_end").alias("sourceEnd"))


def association_target(oriented: DataFrame) -> DataFrame:
    return oriented.select("resource", "association", F.col("target_end").alias("targetEnd"))


def _both_ends(oriented: DataFrame, *fields: str) -> DataFrame:
    """Source and target ends as rows, in one pass over the associations."""
    sides = [
        F.struct(F.col(f"{side}_end").alias("end"), F.lit(side).alias("side"),
                 *[F.col(f"{side}_{f}").alias(f) for f in fields])
        for side in ("source", "target")
    ]
    return oriented.select("resource", F.inline(F.array(*sides)))


def association_ends(oriented: DataFrame) -> DataFrame:
    role = (
        F.when(F.col("side") == "source", "source")
        .when(F.col("is_composite"), "targetComposite")
        .otherwise("targetReference")
    )
    return _both_ends(oriented, "name", "is_composite").select(
        "resource", F.col("end").alias("uuid"), "name", role.alias("role")
    )


def association_end_types(oriented: DataFrame) -> DataFrame:
    return _both_ends(oriented, "class").select(
        "resource", F.col("end").alias("associationEnd"), F.col("class").alias("type")
    )


def bounded_features(oriented: DataFrame, attributes: DataFrame) -> DataFrame:
    """All ends and attributes with lower, upper and ordering."""
    ends = _both_ends(oriented, "lower", "upper", "is_ordered")
    return ends.select(
        "resource", F.col("end").alias("feature"), "lower", "upper", F.col("is_ordered").alias("isOrdered")
    ).unionByName(
        attributes.select(
            "resource", F.col("uuid").alias("feature"), "lower", "upper", F.col("is_ordered").alias("isOrdered")
        )
    )


def feature_lower_bounds(bounded: DataFrame) -> DataFrame:
    return bounded.select("resource", "feature", "lower")


def feature_upper_bounds(bounded: DataFrame) -> DataFrame:
    return bounded.select("resource", "feature", "upper")


def feature_ordering(bounded: DataFrame) -> DataFrame:
    return bounded.select("resource", "feature", "isOrdered")


def attribute_names(attributes: DataFrame) -> DataFrame:
    return attributes.select("resource", "uuid", "name")


def attribute_types(attributes: DataFrame) -> DataFrame:
    return attributes.select("resource", F.col("uuid").alias("attribute"), "type")


def feature_type_uuid(features: DataFrame, types: DataFrame) -> Result:
    """Type of each feature and whether it is a class or a datatype; an untyped feature is an error."""
    kinds = types.select(F.col("uuid").alias("type"), "type_kind")
    typed = lookup_join(features.select("resource", F.col("uuid").alias("feature"), "type"), kinds, ["type"], how="left")
    role = F.when(F.col("type_kind").isin("class", "stereotype"), "class").when(
        F.col("type_kind").isin(*_KIND_OF_TYPE), "datatype"
    )
    return Result(
        typed.filter(role.isNotNull()).select("resource", "feature", "type", role.alias("typeRole"), "type_kind"),
        error_rows(
            typed.filter(role.isNull()), "feature-without-type",
            F.concat(F.lit("Feature without a known type: "), F.col("feature")), element="feature",
        ),
    )
