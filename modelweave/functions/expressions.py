"""Column expressions shared by several operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Primitive type name -> XML Schema datatype.
PRIMITIVE_TYPES = {
    "Boolean": "xsd:boolean",
    "Integer": "xsd:integer",
    "Real": "xsd:double",
    "String": "xsd:string",
    "UnlimitedNatural": "xsd:string",
}

# Fixed value: separates a redefining feature's name from the class it comes from.
OVERRIDE_MARKER = "__from_"


def datatype_of(name: Column) -> Column:
    """``xsd:`` name of a primitive type, null when the name is not a primitive."""
    pairs = [F.lit(x) for pair in PRIMITIVE_TYPES.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), name)


def is_override(name: Column) -> Column:
    return F.instr(name, OVERRIDE_MARKER) > 0


def redefined_name(name: Column) -> Column:
    """``x__from_Y`` redefines ``x``; any other name stands for itself."""
    return F.substring_index(name, OVERRIDE_MARKER, 1)


def points_backwards(end_name: Column) -> Column:
    """A target end with such a name is really the source end."""
    return end_name.startswith("_") | end_name.startswith("UML")


def change_kind(old: Column, new: Column) -> Column:
    return (
        F.when(old.isNull() & new.isNotNull(), F.lit("AddedChange"))
        .when(old.isNotNull() & new.isNull(), F.lit("DeletedChange"))
        .otherwise(F.lit("ModifiedChange"))
    )


def changed_value(old: Column, new: Column) -> Column:
    """The old value of a deletion, else the new one; null when both are null."""
    return F.when(old.isNotNull() & new.isNull(), old).otherwise(new)


def change_description(entity: Column, prop: Column, old: Column, new: Column) -> Column:
    null = F.lit("null")
    return F.concat(
        entity, F.lit(" : "), prop,
        F.lit(" => Old value: "), F.coalesce(old, null),
        F.lit(", new value: "), F.coalesce(new, null),
    )


def typed_value(value: Column, datatype: Column) -> dict[str, Column]:
    """One nullable column per XML Schema datatype, filled for the matching one."""
    return {
        "booleanValue": F.when(datatype == "xsd:boolean", value.try_cast("boolean")),
        "integerValue": F.when(datatype == "xsd:integer", value.try_cast("bigint")),
        "doubleValue": F.when(datatype == "xsd:double", value.try_cast("double")),
        "stringValue": F.when(datatype == "xsd:string", value),
    }
