"""Library tables: primitive types, enumerations and their literals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelweave.functions.expressions import datatype_of
from modelweave.operators.errors import Result, error_rows


def primitive_types(types: DataFrame) -> Result:
    """Primitive types with their ``xsd:`` name; an unknown primitive is a fatal error row."""
    mapped = types.filter(F.col("type_kind") == "primitive").withColumn(
        "datatypeMapDefinition", datatype_of(F.col("name"))
    )
    return Result(
        mapped.filter(F.col("datatypeMapDefinition").isNotNull()).select(
            "resource", "uuid", "name", "datatypeMapDefinition"
        ),
        error_rows(
            mapped.filter(F.col("datatypeMapDefinition").isNull()), "unknown-primitive",
            F.concat(F.lit("No datatype is known for the primitive type "), F.coalesce("name", F.lit("null"))), severity="fatal",
        ),
    )


def enumeration_types(types: DataFrame) -> DataFrame:
    return types.filter(F.col("type_kind") == "enumeration").select("resource", "uuid", "name")


def enumeration_literals_indexed(literals: DataFrame) -> DataFrame:
    return literals.select("resource", "enumeration", F.col("uuid").alias("literal"), F.col("position").alias("index"))


def enumeration_literal_names(literals: DataFrame) -> DataFrame:
    return literals.select("resource", F.col("uuid").alias("literal"), "name")
