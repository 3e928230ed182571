"""Documents: kinds, selections, imports between packages, configuration rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelweave.functions.scale import lookup_join, materialize
from modelweave.operators.errors import Result, error_rows


def select_kind(df: DataFrame, kinds: list[str], column: str = "kind") -> DataFrame:
    """Rows whose kind is one of ``kinds``."""
    return df.filter(F.col(column).isin(*kinds))


def select_kind_of(df: DataFrame, kind: str, taxonomy: DataFrame, column: str = "kind") -> DataFrame:
    """Rows whose kind is ``kind`` or a specialization of it (by name)."""
    names = taxonomy.filter(F.col("supertype_name") == kind).select(F.col("metaclass_name").alias(column)).distinct()
    return df.join(names, column, "left_semi")


def resource_rows(documents: DataFrame, kind: str | None = None) -> DataFrame:
    rows = documents.select("resource", "kind")
    return rows if kind is None else rows.filter(F.col("kind") == kind)


def in_documents(df: DataFrame, documents: DataFrame, kind: str) -> DataFrame:
    """Rows that belong to a document of the given kind."""
    own = documents.filter(F.col("kind") == kind).select("resource").distinct()
    return lookup_join(df, own, ["resource"], how="left_semi")


def identity(elements: DataFrame) -> Result:
    """(resource, uuid) of every element; an element without uuid is an error."""
    missing = elements.filter(F.col("uuid").isNull())
    return Result(
        elements.filter(F.col("uuid").isNotNull()).select("resource", "uuid"),
        error_rows(missing, "no-uuid", F.concat(F.lit("Element without identity: "), F.coalesce("name", F.lit("?"))),
                   element=F.lit(None), severity="fatal"),
    )


def split_profiles_packages(elements: DataFrame, selection: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The selected packages, as (profiles, plain packages)."""
    chosen = elements.join(selection.select(F.col("scope_package").alias("uuid")), "uuid", "left_semi")
    columns = ("resource", "uuid", "name")
    return (
        select_kind(chosen, ["Profile"]).select(*columns),
        select_kind(chosen, ["Package"]).select(*columns),
    )


def package_imports(
    imports: DataFrame,
    documents: DataFrame,
    kind: str,
    imported_kind: str | None = None,
    imported_document_kind: str | None = None,
) -> Result:
    """(importing resource, imported resource) for the documents of one kind.

    An import of a package that no document covers is skipped with a warning. ``imported_kind``
    restricts the imported package, ``imported_document_kind`` the kind of its document.
    """
    own = documents.filter(F.col("kind") == kind).select(
        F.col("scope_package").alias("importer"), F.col("resource").alias("importing")
    )
    edges = imports if imported_kind is None else imports.filter(F.col("imported_kind") == imported_kind)
    scopes = documents.select(
        F.col("scope_package").alias("imported"), F.col("resource").alias("imported_resource"),
        F.col("kind").alias("document_kind"),
    )
    found = lookup_join(lookup_join(edges, own, ["importer"]), scopes, ["imported"], how="left")
    rows = found.filter(F.col("imported_resource").isNotNull())
    if imported_document_kind is not None:
        rows = rows.filter(F.col("document_kind") == imported_document_kind)
    return Result(
        rows.select("importing", F.col("imported_resource").alias("imported")),
        error_rows(
            found.filter(F.col("imported_resource").isNull()), "import-without-document",
            F.concat(F.col("importer"), F.lit(" imports a package without a known document: "), F.col("imported")),
            element="importer", resource="importing", severity="warning",
        ),
    )


def lookup_document_packages(
    configuration: DataFrame, elements: DataFrame, tool_id: str = "tool_package_id", strict: bool = False
) -> Result:
    """Packages and profiles named by the configuration's tool ids; the others become one error each.

    With ``strict`` such an error is fatal, so a strict writer stops before any table.
    """
    packages = select_kind(elements, ["Package", "Profile"]).select(
        F.col("tool_id").alias(tool_id), "resource", "uuid", "kind"
    )
    found = configuration.select(tool_id).join(packages, tool_id, "left")
    return Result(
        found.filter(F.col("uuid").isNotNull()),
        error_rows(
            found.filter(F.col("uuid").isNull()), "package-not-found",
            F.concat(F.lit("No package or profile found with tool id "), F.coalesce(tool_id, F.lit("null"))),
            element=F.lit(None), resource=F.lit(None), severity="fatal" if strict else "error",
        ),
    )


def document_config_rows(elements: DataFrame, documents: DataFrame) -> DataFrame:
    """Configuration row of every package that has root characteristics; other packages are skipped."""
    packages = select_kind(elements, ["Package", "Profile"]).select(
        F.col("uuid").alias("scope_package"), "tool_id", "tool_url"
    )
    return packages.join(documents, "scope_package").select(
        F.struct(
            F.col("package_uri").alias("packageURI"), F.col("document_url").alias("documentURL"),
            F.struct(F.col("artifact_kind").alias("type")).alias("artifactKind"),
            F.col("ns_prefix").alias("nsPrefix"), F.col("uuid_prefix").alias("uuidPrefix"),
        ).alias("characteristics"),
        F.col("tool_id").alias("toolSpecificPackageID"), F.col("tool_url").alias("toolSpecificPackageURL"),
        *[F.array().cast("array<string>").alias(c) for c in ("overrideID", "overrideUUID", "excludeNestedElements")],
    )


def selected_documents(selection: DataFrame, documents: DataFrame, strict: bool = False) -> Result:
    """Documents of the selected packages; a selected package without a document is an error, with ``strict`` a fatal one."""
    found = selection.select("scope_package").join(documents, "scope_package", "left")
    return Result(
        found.filter(F.col("resource").isNotNull()),
        error_rows(
            found.filter(F.col("resource").isNull()), "no-document",
            F.concat(F.lit("No document for the selected package "), F.col("scope_package")),
            element="scope_package", severity="fatal" if strict else "error",
        ),
    )


def reachable(start: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes reachable from ``start`` over ``edges(src, dst)``, with their distance.

    One shuffle per step; a step only extends the nodes found last, and cycles end because known
    nodes are not found again.
    """
    edges = materialize(edges.select("src", "dst").distinct(), "edges")
    known = materialize(start.select(F.col("node"), F.lit(0).alias("depth")).distinct(), "reached")
    frontier, depth = known, 0
    while not frontier.isEmpty():
        depth += 1
        found = (
            lookup_join(edges, frontier.select(F.col("node").alias("src")), ["src"], how="left_semi")
            .select(F.col("dst").alias("node")).distinct()
            .join(known, "node", "left_anti")
            .withColumn("depth", F.lit(depth))
        )
        frontier = materialize(found, "reached")
        known = known.unionByName(frontier)
    return known


def _needs(imports: DataFrame, profile_applications: DataFrame) -> DataFrame:
    """(src, dst): package src needs dst."""
    applied = profile_applications.dropna(subset=["applying_package", "applied_profile"])
    return imports.select(F.col("importer").alias("src"), F.col("imported").alias("dst")).unionByName(
        applied.select(F.col("applying_package").alias("src"), F.col("applied_profile").alias("dst"))
    )


def missing_dependency_paths(
    selection: DataFrame, imports: DataFrame, profile_applications: DataFrame
) -> DataFrame:
    """(missing, depth, path): why each missing package is needed, as one shortest way from a selected one.

    The search keeps for each package the smallest one that needs it a step nearer to the selection. The ways of
    the missing ones are followed back at the same time, so a round joins only ways that are not at their end.
    """
    edges = materialize(_needs(imports, profile_applications).distinct(), "needs")
    start = selection.select(F.col("scope_package").alias("node")).distinct()
    reached = materialize(reachable(start, edges), "reached")
    source = reached.select(F.col("node").alias("src"), F.col("depth").alias("_before"))
    target = reached.select(F.col("node").alias("dst"), "depth")
    steps = edges.join(source, "src").join(target, "dst").filter("depth = _before + 1")
    via = materialize(steps.groupBy(F.col("dst").alias("at")).agg(F.min("src").alias("_via")), "predecessors")
    ways = reached.join(start, "node", "left_anti").select(
        F.col("node").alias("missing"), "depth", F.col("node").alias("at"), F.col("node").alias("path")
    )
    done = []
    while not (ways := materialize(ways, "ways")).isEmpty():
        ways = ways.join(via, "at", "left").withColumn("path", F.concat_ws(" > ", "_via", "path"))
        ways = materialize(ways.withColumn("at", F.col("_via")), "ways")
        done.append(ways.filter("at is null").select("missing", F.col("depth").cast("int").alias("depth"), "path"))
        ways = ways.filter("at is not null").select("missing", "depth", "at", "path")
    columns = "missing string, depth int, path string"
    return reduce(DataFrame.unionByName, done) if done else selection.sparkSession.createDataFrame([], columns)


def missing_dependencies(
    selection: DataFrame, imports: DataFrame, profile_applications: DataFrame
) -> DataFrame:
    """Packages and profiles a selection needs, directly or indirectly, but does not hold."""
    edges = _needs(imports, profile_applications)
    start = selection.select(F.col("scope_package").alias("node"))
    return (
        reachable(start, edges)
        .join(start, "node", "left_anti")
        .select(F.col("node").alias("missing"), F.col("depth").cast("int").alias("depth"))
    )


def name_order(name: str = "name") -> list[Column]:
    """Order in which classes, associations, datatypes and stereotypes are listed."""
    return [F.col(name).asc_nulls_first(), F.col("uuid")]
