"""Attribute values and stereotype property values of model elements.

A slot is one value of one feature of one element and already carries the element's metaclass, so
the only join on the large side is with the (counted, usually broadcast) attribute lookup.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelweave.functions.expressions import typed_value
from modelweave.functions.scale import keep_listed, lookup_join
from modelweave.operators.errors import Result, error_rows

VALUES_PER_ROW = 10_000


def wanted_attributes(lookups: DataFrame, kind: str | None = None, ordered: bool | None = None) -> DataFrame:
    """The attributes whose values are kept, by metaclass and feature name: derived ones are dropped."""
    wanted = lookups.filter(~F.col("implementation_derived"))
    if kind is not None:
        wanted = wanted.filter(F.col("kind") == kind)
    if ordered is not None:
        wanted = wanted.filter(F.col("is_ordered") == ordered)
    return wanted.select(
        F.col("metaclass_name").alias("metaclass"), F.col("name").alias("feature_name"), "attribute", "kind",
        "is_ordered", "implementation_ordered",
    )


def attribute_values(
    slots: DataFrame, lookups: DataFrame, kind: str | None = None, ordered: bool | None = None
) -> DataFrame:
    """Slots matched by name to the effective attributes of their element's class.

    ``kind`` and ``ordered`` restrict the attributes first, and with them the classes whose slots
    are scanned. Derived attributes are dropped. The index is the place in the collection before any value is
    filtered, so skipped values leave gaps; a scalar has index 0.
    """
    wanted = wanted_attributes(lookups, kind, ordered)
    index = F.when(F.col("is_collection"), F.col("position")).otherwise(F.lit(0))
    keys = ["metaclass", "feature_name"]
    listed = keep_listed(slots.drop("feature"), wanted, keys)
    return lookup_join(listed, wanted, keys).withColumn("index", index)


def _value_table(values: DataFrame, kind: str, ordered: bool, require_impl_ordered: bool) -> DataFrame:
    kept = values.filter((F.col("kind") == kind) & (F.col("is_ordered") == ordered))
    return kept.filter("implementation_ordered") if require_impl_ordered else kept


def _project(values: DataFrame, value: str, ordered: bool) -> DataFrame:
    columns = ["resource", "entity", "attribute", F.col(value).alias("value")]
    return values.select(*columns, "index") if ordered else values.select(*columns)


def atomic_values(values: DataFrame, ordered: bool, require_impl_ordered: bool = False) -> DataFrame:
    """String form of every value of an atomic attribute; duplicates are kept."""
    return _project(_value_table(values, "atomic", ordered, require_impl_ordered), "value", ordered)


def literal_values(values: DataFrame, ordered: bool, require_impl_ordered: bool = False) -> DataFrame:
    """Enumeration literals only; any other value of the collection is skipped."""
    kept = _value_table(values, "enumeration", ordered, require_impl_ordered)
    return _project(kept.filter(F.col("value_kind") == "literal"), "value", ordered)


def structured_values(
    values: DataFrame, ordered: bool, require_impl_ordered: bool = False, scalar_value_node: bool = False
) -> DataFrame:
    """Instance behind each instance value; values without one are skipped.

    ``scalar_value_node`` gives the value node itself for a scalar.
    """
    kept = _value_table(values, "structured", ordered, require_impl_ordered).filter(F.col("value_kind") == "instance")
    target = F.col("ref_instance")
    if scalar_value_node:
        target = F.when(F.col("is_collection"), target).otherwise(F.col("ref"))
    return _project(kept.withColumn("_target", target).filter(F.col("_target").isNotNull()), "_target", ordered)


# ---------------------------------------------------------------- stereotype properties


def stereotype_slots(
    slots: DataFrame, features: DataFrame, types: DataFrame, applications: DataFrame, stereotype_taxa: DataFrame
) -> DataFrame:
    """Slots whose feature belongs to a stereotype applied to the element, or to one of its parents."""
    tags = (
        features.select(F.col("uuid").alias("feature"), F.col("owner").alias("holder"),
                        F.col("name").alias("property"), "type", "is_ordered")
        .join(stereotype_taxa.select(F.col("supertype").alias("holder")).distinct(), "holder", "left_semi")
    )
    tags = lookup_join(tags, types.select(F.col("uuid").alias("type"), "type_kind"), ["type"], how="left").drop("type")
    held = lookup_join(
        applications.select(F.col("element").alias("entity"), "stereotype"),
        stereotype_taxa.select(F.col("metaclass").alias("stereotype"), F.col("supertype").alias("holder")),
        ["stereotype"],
    ).select("entity", "holder")
    return lookup_join(slots, tags, ["feature"]).join(held, ["entity", "holder"], "left_semi").withColumn(
        "index", F.col("position")
    )


def ordered_atomic_tags(tags: DataFrame) -> DataFrame:
    kept = tags.filter((F.col("type_kind") == "primitive") & F.col("is_ordered"))
    return kept.select("resource", "entity", F.col("feature").alias("attribute"), "value", "index")


def ordered_literal_tags(tags: DataFrame) -> DataFrame:
    kept = tags.filter(
        (F.col("type_kind") == "enumeration") & F.col("is_ordered") & (F.col("value_kind") == "literal")
    )
    return kept.select("resource", "entity", F.col("feature").alias("attribute"), "value", "index")


def ordered_structured_tags(tags: DataFrame) -> DataFrame:
    """Instance values of any other type are not representable: one error row each."""
    other = F.col("type_kind").isNull() | ~F.col("type_kind").isin("primitive", "enumeration")
    kept = tags.filter(other & F.col("is_ordered") & (F.col("value_kind") == "instance"))
    return error_rows(
        kept, "structured-tag-unsupported",
        F.concat(F.lit("Structured value of "), F.col("feature"), F.lit(" is not supported: value="),
                 F.coalesce("ref_instance", F.lit("null")), F.lit(", index="), F.col("index").cast("string")),
        element="entity",
    )


def stereotype_references(tags: DataFrame, ordered: bool) -> Result:
    """Elements referenced by class-typed properties; any other value is an error row."""
    flag = F.col("is_ordered") if ordered else ~F.col("is_ordered")
    typed = tags.filter(F.col("type_kind").isin("class", "stereotype") & flag)
    target = F.when(F.col("value_kind") == "element", F.col("ref")).when(
        F.col("value_kind") == "instance", F.col("ref_instance")
    )
    found = typed.withColumn("referencedElement", target)
    columns = ["resource", F.col("entity").alias("modelElement"), F.col("feature").alias("associationTargetEnd"),
               "referencedElement"]
    return Result(
        found.filter(F.col("referencedElement").isNotNull()).select(*columns, *(["index"] if ordered else [])),
        error_rows(
            found.filter(F.col("referencedElement").isNull()), "reference-value",
            F.concat(F.lit("Value of "), F.col("feature"), F.lit(" refers to no element, index="),
                     F.col("index").cast("string")),
            element="entity",
        ),
    )


# ---------------------------------------------------------------- back to slots, typed


def rebuild_slots(ordered_values: DataFrame, values_per_row: int = VALUES_PER_ROW) -> DataFrame:
    """Collections in index order; a collection longer than ``values_per_row`` continues in the next block.

    With a column ``table``, the collections of several tables are told apart by it.
    """
    keys = [c for c in ("table", "resource", "entity", "attribute") if c in ordered_values.columns]
    entry = F.struct("index", "value")
    return (
        ordered_values.withColumn("block", F.floor(F.col("index") / values_per_row).cast("int"))
        .groupBy(*keys, "block")
        .agg(F.array_sort(F.collect_list(entry)).alias("entries"))
        .select(*keys, "block",
                F.transform("entries", lambda e: e["index"]).alias("indexes"),
                F.transform("entries", lambda e: e["value"]).alias("values"))
    )


def rebuild_alone(values: DataFrame, values_per_row: int = VALUES_PER_ROW) -> DataFrame:
    """`rebuild_slots` for values that are each the only one of their collection: nothing has to be brought together."""
    keys = [c for c in ("table", "resource", "entity", "attribute") if c in values.columns]
    return values.select(
        *keys, F.floor(F.col("index") / values_per_row).cast("int").alias("block"),
        F.array("index").alias("indexes"), F.array("value").alias("values"),
    )


def typed_values(values: DataFrame, attribute_types: DataFrame, primitives: DataFrame) -> DataFrame:
    """Atomic values decoded by the datatype of their attribute, one nullable column per datatype."""
    datatypes = lookup_join(
        attribute_types.select("attribute", "type"), primitives.select(F.col("uuid").alias("type"), "datatypeMapDefinition"),
        ["type"],
    ).select("attribute", "datatypeMapDefinition")
    decoded = lookup_join(values, datatypes, ["attribute"])
    columns = typed_value(F.col("value"), F.col("datatypeMapDefinition"))
    return decoded.select("resource", "entity", "attribute", "value", "datatypeMapDefinition",
                          *[c.alias(name) for name, c in columns.items()])
