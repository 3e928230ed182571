"""Model tables: elements, tool identifiers, applied profiles and stereotypes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelweave.functions.scale import lookup_join, materialize
from modelweave.operators.errors import Result, error_rows, union_all

# Names the tool that owns the element identifiers.
TOOL_VENDOR = "model-editor"


def model_elements(elements: DataFrame, classes: DataFrame) -> Result:
    """(resource, uuid, metaclass uuid) of every element; an unknown metaclass is a fatal error row."""
    known = classes.select(F.col("name").alias("kind"), F.col("uuid").alias("metaClass"))
    found = lookup_join(elements.select("resource", "uuid", "kind"), known, ["kind"], how="left")
    return Result(
        found.filter(F.col("metaClass").isNotNull()).select("resource", "uuid", "metaClass"),
        error_rows(
            found.filter(F.col("metaClass").isNull()), "unknown-metaclass",
            F.concat(F.lit("Element of an unknown metaclass: "), F.coalesce("kind", F.lit("null"))), severity="fatal",
        ),
    )


def element_tool_ids(elements: DataFrame, vendor: str = TOOL_VENDOR) -> DataFrame:
    return elements.select("resource", "uuid", F.lit(vendor).alias("toolVendorID"),
                           F.col("tool_id").alias("toolElementID"))


def element_tool_urls(elements: DataFrame, vendor: str = TOOL_VENDOR) -> DataFrame:
    return elements.select("resource", "uuid", F.lit(vendor).alias("toolVendorID"),
                           F.col("tool_url").alias("toolElementURL"))


def instantiated_metamodels(models: DataFrame, metamodel: str) -> DataFrame:
    return models.select(F.lit(metamodel).alias("instantiatedMetamodel"), F.col("resource").alias("instantiatingModel"))


def applied_profiles(profile_applications: DataFrame, documents: DataFrame) -> DataFrame:
    """Applications with both ends set whose profile has a document."""
    whole = profile_applications.dropna(subset=["applying_package", "applied_profile"])
    known = documents.select(F.col("scope_package").alias("applied_profile"), F.col("resource").alias("appliedResource"))
    return lookup_join(whole, known, ["applied_profile"]).select(
        F.col("resource").alias("applyingResource"), F.col("applying_package").alias("applyingPackage"),
        "appliedResource", F.col("applied_profile").alias("appliedProfile"),
    )


# ---------------------------------------------------------------- applied stereotypes


def application_counts(applications: DataFrame) -> DataFrame:
    """Number of elements each stereotype is applied to, per document and profile."""
    return (
        applications.select("resource", "profile", "stereotype", "base_property", "element").distinct()
        .groupBy("resource", "profile", "stereotype", "base_property")
        .agg(F.count(F.lit(1)).alias("applications"))
    )


def _counted_error(df: DataFrame, code: str, text: str) -> DataFrame:
    """One error per document and stereotype, with the number of elements concerned."""
    counts = application_counts(df)
    return error_rows(
        counts, code,
        F.concat(F.lit(f"{text} "), F.col("stereotype"), F.lit(": "), F.col("applications").cast("string"),
                 F.lit(" applications")),
        element="stereotype",
    )


def stereotypes_by_profile(applications: DataFrame) -> Result:
    """Applications of a known profile; those without a profile become errors with their counts."""
    return Result(
        applications.filter(F.col("profile").isNotNull()),
        _counted_error(applications.filter(F.col("profile").isNull()), "stereotype-without-profile",
                       "Stereotype without a profile"),
    )


def resolve_profile(applied: DataFrame, documents: DataFrame, exported: DataFrame) -> Result:
    """(resource, profile, profile resource) of every applied profile.

    ``exported`` holds the resources of the exported profiles. A profile without a document and a
    profile that is not exported are two different errors.
    """
    pairs = applied.filter(F.col("profile").isNotNull()).select("resource", "profile").distinct()
    known = documents.select(F.col("scope_package").alias("profile"), F.col("resource").alias("profile_resource"))
    chosen = exported.select(F.col("resource").alias("profile_resource"), F.lit(True).alias("exported"))
    found = lookup_join(lookup_join(pairs, known, ["profile"], how="left"), chosen.distinct(), ["profile_resource"], "left")
    code = F.when(F.col("profile_resource").isNull(), "profile-without-document").when(
        F.col("exported").isNull(), "profile-not-exported"
    )
    bad = found.filter(code.isNotNull())
    without = error_rows(bad.filter(F.col("profile_resource").isNull()), "profile-without-document",
                         F.concat(F.lit("No document for profile "), F.col("profile")), element="profile")
    hidden = error_rows(bad.filter(F.col("profile_resource").isNotNull()), "profile-not-exported",
                        F.concat(F.lit("Profile is not exported: "), F.col("profile")), element="profile")
    return Result(
        found.filter(code.isNull()).select("resource", "profile", "profile_resource"), without.unionByName(hidden)
    )


def applied_stereotypes(applications: DataFrame, resolved: DataFrame, stereos: DataFrame) -> Result:
    """(element, stereotype) where the resolved profile holds the stereotype.

    An unknown stereotype is one error with the number of its elements.
    """
    profiles = resolved.select("resource", "profile", "profile_resource")
    known = stereos.select(F.col("resource").alias("profile_resource"), F.col("uuid").alias("stereotype"),
                           F.lit(True).alias("known"))
    placed = lookup_join(applications, profiles, ["resource", "profile"])
    found = lookup_join(placed, known, ["profile_resource", "stereotype"], how="left")
    return Result(
        found.filter(F.col("known")).select("resource", F.col("element").alias("modelElement"),
                                            F.col("stereotype").alias("appliedStereotype")),
        _counted_error(found.filter(F.col("known").isNull()), "unknown-stereotype", "Unknown stereotype"),
    )


def apply_profiles(
    applications: DataFrame, documents: DataFrame, exported: DataFrame, stereos: DataFrame
) -> Result:
    """Group by profile, resolve the profiles, keep the known stereotypes; errors of all three steps."""
    grouped = stereotypes_by_profile(applications)
    resolved = resolve_profile(grouped.rows, documents, exported)
    applied = applied_stereotypes(grouped.rows, materialize(resolved.rows, "resolved-profiles"), stereos)
    return Result(applied.rows, union_all([applied.errors, grouped.errors, resolved.errors]))
