"""Property-change events to typed change records; the same functions serve batch and streams.

All lookups are static and small, so classification is one pass over the events: left joins to
broadcast lookups, no shuffle, no state.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelweave.functions.expressions import change_description, change_kind, changed_value
from modelweave.functions.scale import lookup_join

# Property names of the editor's life-cycle events.
CREATED = "INSTANCE_CREATED"
BEFORE_DELETE = "BEFORE_DELETE"
DELETED = "INSTANCE_DELETED"

# Properties that carry no model change of their own.
IGNORED_PROPERTIES = (
    "ID",
    "APPLIED_STEREOTYPES", "APPLIED_PROFILES", "TO_DO", "Active Hyperlink", "TYPE_MODIFIER",
    "allocatedFrom", "allocatedTo", "tracedFrom", "refines", "satisfies",
    "allSpecifyingElements", "specifyingElement", "verifies", "allRealizingElements", "realizingElement",
    "Base Classifiers", "allGeneralClassifiers", "allSpecificClassifiers", "specificClassifier",
    "realizingClassifier", "participatesInActivity", "participatesInInteraction", "describingBehavior",
    "realizingClass", "realizingComponent", "Realized Interfaces", "specifyingComponent",
    "specifyingUseCase", "describedUseCase", "metaclass", "multiplicity",
)

INDEXED_SHAPES = ("indexed", "position")

# (kind, ordered) -> record type
VALUE_EVENTS = {
    ("atomic", True): "ModelOrderedAttributeAtomicValueChangedEvent",
    ("enumeration", True): "ModelOrderedAttributeEnumerationLiteralValueChangedEvent",
    ("atomic", False): "ModelUnorderedAttributeAtomicValueChangedEvent",
    ("enumeration", False): "ModelUnorderedAttributeEnumerationLiteralValueChangedEvent",
}
ELEMENT_EVENT = "ModelElementChangedEvent"


@dataclass(frozen=True)
class ChangeLookups:
    """``concrete`` (metaclass_name, metaclass), ``routes`` and ``attributes`` of the metamodel, its taxonomy."""

    concrete: DataFrame
    routes: DataFrame
    attributes: DataFrame
    taxonomy: DataFrame


def relevant_changes(changes: DataFrame) -> DataFrame:
    return changes.filter(F.col("is_element") & ~F.col("property").isin(*IGNORED_PROPERTIES))


def route_change(changes: DataFrame, lookups: ChangeLookups) -> DataFrame:
    """Each relevant event with the first test it meets: life cycle, forward, inverse, attribute."""
    routes = lookups.routes.withColumnRenamed("route", "found")
    routed = lookup_join(relevant_changes(changes), routes, ["metaclass", "property"], how="left")
    route = (
        F.when(F.col("property") == CREATED, "created")
        .when(F.col("property") == BEFORE_DELETE, "before delete")
        .when(F.col("property") == DELETED, "deleted")
        .when(F.col("found").startswith("forward"), "forward")
        .when(F.col("found").startswith("inverse"), "inverse")
        .otherwise("attribute")
    )
    return routed.withColumn("route", route).withColumn(
        "description",
        change_description(F.col("entity"), F.col("property"), F.col("old_value"), F.col("new_value")),
    )


# ---------------------------------------------------------------- life cycle


def _element_candidates(routed: DataFrame, lookups: ChangeLookups) -> DataFrame:
    concrete = lookups.concrete.select(
        F.col("metaclass_name").alias("metaclass"), F.col("metaclass").alias("class_uuid")
    )
    life = routed.filter(F.col("route").isin("created", "deleted"))
    return lookup_join(life, concrete, ["metaclass"], how="left")


def element_changes(routed: DataFrame, lookups: ChangeLookups) -> DataFrame:
    """Added and deleted elements of known concrete classes."""
    kind = F.when(F.col("route") == "created", "AddedChange").otherwise("DeletedChange")
    return _element_candidates(routed, lookups).filter(F.col("class_uuid").isNotNull()).select(
        "txn", "seq", kind.alias("changeKind"), F.lit("").alias("resource"), F.col("entity").alias("uuid"),
        F.col("class_uuid").alias("metaClass"), "description",
    )


def element_added(routed: DataFrame, lookups: ChangeLookups) -> DataFrame:
    return element_changes(routed, lookups).filter(F.col("changeKind") == "AddedChange")


def element_deleted(routed: DataFrame, lookups: ChangeLookups) -> DataFrame:
    return element_changes(routed, lookups).filter(F.col("changeKind") == "DeletedChange")


def unknown_element_log(routed: DataFrame, lookups: ChangeLookups) -> DataFrame:
    """Life-cycle events of unknown or abstract classes: logged, no record."""
    return _element_candidates(routed, lookups).filter(F.col("class_uuid").isNull()).select(
        "txn", "seq", "entity", "route", "description"
    )


def pre_delete_log(routed: DataFrame) -> DataFrame:
    return routed.filter(F.col("route") == "before delete").select("txn", "seq", "entity", "description")


# ---------------------------------------------------------------- association events


def _link_changes(routed: DataFrame, lookups: ChangeLookups, route: str, end_class: str) -> DataFrame:
    """new: from null to an instance of the end's class; del: the reverse; anything else is unknown."""
    below = lookups.taxonomy.select(
        F.col("metaclass_name").alias("value_metaclass"), F.col("supertype_name").alias(end_class),
        F.lit(True).alias("is_instance"),
    )
    checked = lookup_join(routed.filter(F.col("route") == route), below, ["value_metaclass", end_class], how="left")
    instance = (F.col("value_kind") == "element") & F.coalesce("is_instance", F.lit(False))
    old, new = F.col("old_value"), F.col("new_value")
    change = (
        F.when(old.isNull() & new.isNotNull() & instance, "new")
        .when(old.isNotNull() & new.isNull() & instance, "del")
        .otherwise("unknown")
    )
    path = F.concat("source_class_name", F.lit("::"), "opposite_name", F.lit(" -> "), "feature_name", F.lit("::"),
                    "target_class_name")
    return checked.select("txn", "seq", "entity", "property", "association", change.alias("linkChange"),
                          path.alias("path"), "description")


def forward_link_changes(routed: DataFrame, lookups: ChangeLookups) -> DataFrame:
    """Events of a forward association property: a log table, no change record."""
    return _link_changes(routed, lookups, "forward", "target_class_name")


def inverse_link_changes(routed: DataFrame, lookups: ChangeLookups, show_inverse: bool = False) -> DataFrame:
    """Events of an inverse association property; consumed either way, listed only on request."""
    found = _link_changes(routed, lookups, "inverse", "source_class_name")
    return found if show_inverse else found.limit(0)


# ---------------------------------------------------------------- attribute events


def attribute_changes(routed: DataFrame, lookups: ChangeLookups) -> DataFrame:
    """Indexed or position events of known attributes; one event may meet several of the four tests."""
    known = lookups.attributes.filter(F.col("kind").isin("atomic", "enumeration")).filter(
        F.col("implementation_ordered") == F.col("is_ordered")
    ).select(F.col("metaclass_name").alias("metaclass"), F.col("name").alias("property"), "attribute", "kind",
             "is_ordered")
    events = routed.filter((F.col("route") == "attribute") & F.col("shape").isin(*INDEXED_SHAPES))
    value = changed_value(F.col("old_value"), F.col("new_value"))
    literal = (F.col("value_kind") == "literal") & value.isNotNull()
    return (
        lookup_join(events, known, ["metaclass", "property"])
        .filter((F.col("kind") == "atomic") | literal)
        .select(
            "txn", "seq", change_kind(F.col("old_value"), F.col("new_value")).alias("changeKind"),
            F.lit("").alias("resource"), "entity", "attribute", value.alias("value"), "index", "kind", "is_ordered",
            "description",
        )
    )


def value_changes(attribute_rows: DataFrame, kind: str, ordered: bool) -> DataFrame:
    """One of the four value record types; only ordered ones carry an index."""
    kept = attribute_rows.filter((F.col("kind") == kind) & (F.col("is_ordered") == ordered))
    return kept.drop("kind", "is_ordered") if ordered else kept.drop("kind", "is_ordered", "index")


# ---------------------------------------------------------------- whole pipeline


def classify_changes(changes: DataFrame, lookups: ChangeLookups) -> DataFrame:
    """All change records of the events, in one table; ``txn`` and ``seq`` keep the order.

    Association events give no record.
    """
    routed = route_change(changes, lookups)
    null = F.lit(None)
    elements = element_changes(routed, lookups).select(
        "txn", "seq", F.lit(ELEMENT_EVENT).alias("event"), "changeKind", "resource", F.col("uuid").alias("entity"),
        "metaClass", null.cast("string").alias("attribute"), null.cast("string").alias("value"),
        null.cast("int").alias("index"), "description",
    )
    event = F.lit(None).cast("string")
    for (kind, ordered), name in VALUE_EVENTS.items():
        event = F.when((F.col("kind") == kind) & (F.col("is_ordered") == F.lit(ordered)), name).otherwise(event)
    values = attribute_changes(routed, lookups).select(
        "txn", "seq", event.alias("event"), "changeKind", "resource", "entity",
        null.cast("string").alias("metaClass"), "attribute", "value",
        F.when(F.col("is_ordered"), F.col("index")).alias("index"), "description",
    )
    return elements.unionByName(values)


def fill_resource(records: DataFrame, elements: DataFrame) -> DataFrame:
    """Records with the resource of their element instead of the empty default."""
    homes = elements.select(F.col("uuid").alias("entity"), F.col("resource").alias("home"))
    return lookup_join(records, homes, ["entity"], how="left").withColumn(
        "resource", F.coalesce("home", "resource")
    ).drop("home")
