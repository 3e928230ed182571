"""One star folder with its lookups, which are computed once per session and written down."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modelweave.functions.scale import bucketed, drop_bucketed, lookup_join, materialize, remove_folders
from modelweave.operators import documents as D
from modelweave.operators import lookups as U
from modelweave.operators import metamodel as M
from modelweave.operators import profile as P
from modelweave.operators import taxonomy as T
from modelweave.operators import values as V
from modelweave.operators.changes import ChangeLookups
from modelweave.plans.exports import Export, ModelInput, export_model, export_selected
from modelweave.sources.star import StarGraph

# The metamodel all models of a star folder instantiate, and the library its types come from.
METAMODEL = "urn:mm:business"
LIBRARY = "urn:lib:types"


class MetamodelLookups:
    """Classes, oriented associations, taxonomy and lookups of some metamodel documents."""

    def __init__(self, graph: StarGraph, documents: DataFrame, label: str, resource: str | None = None):
        """``resource`` tells the only document where there is one; its rows are then filtered in the scans."""
        self.graph = graph
        self.documents = documents
        self.label = label
        self.resource = resource

    def _own(self, df: DataFrame) -> DataFrame:
        return df if self.resource is None else df.filter(F.col("resource") == self.resource)

    def _keep(self, df: DataFrame, name: str) -> DataFrame:
        return materialize(df, f"{self.label}-{name}")

    @cached_property
    def classes(self) -> DataFrame:
        return self._keep(M.meta_classes(self._own(self.graph.elements_of("Class")), self.documents), "classes")

    @cached_property
    def oriented(self) -> DataFrame:
        own = D.in_documents(self._own(self.graph.association), self.documents, "Metamodel")
        return self._keep(M.orient_associations(own, self.features).rows, "associations")

    @cached_property
    def features(self) -> DataFrame:
        found = D.in_documents(self._own(self.graph.feature), self.documents, "Metamodel")
        # read from the table of all features where that is kept
        return found if "raw_feature" in self.graph.kept else self._keep(found, "features")

    @cached_property
    def taxonomy(self) -> DataFrame:
        return self._keep(T.taxonomy(self.classes, self.graph.generalization), "taxonomy")

    @cached_property
    def attributes(self) -> DataFrame:
        return self._keep(M.class_attributes(self.features, self.graph.type, self.classes), "attributes")

    @cached_property
    def effective(self) -> DataFrame:
        return self._keep(T.effective_attributes(self.taxonomy, self.attributes), "effective")

    @cached_property
    def attribute_lookups(self) -> DataFrame:
        return self._keep(U.attribute_lookups(self.effective, self.features, self.taxonomy), "attribute-lookups")

    def attribute_lookups_of(self, kind: str, ordered: bool) -> DataFrame:
        """Those of `attribute_lookups` that have one kind and ordering; only attributes of these are inherited.

        Lookups are taken by class, kind, ordering and name, so attributes of another kind, and features of a name
        that no such attribute has, change none of them.
        """
        own = self.attributes.filter((F.col("kind") == kind) & (F.col("is_ordered") == ordered))
        features = lookup_join(self.features, own.select("name").distinct(), ["name"], how="left_semi")
        return U.attribute_lookups(T.effective_attributes(self.taxonomy, own), features, self.taxonomy)

    @cached_property
    def views(self) -> DataFrame:
        return self._keep(U.association_views(self.oriented, self.classes), "views")

    @cached_property
    def matched(self) -> DataFrame:
        return self._keep(U.association_view_match(self.features, self.classes, self.views), "matched")

    @cached_property
    def containment_forward(self) -> DataFrame:
        return self._keep(
            U.containment_forward(U.containment_pairs(self.matched), self.taxonomy), "containment-forward")

    @cached_property
    def reference_forward(self) -> DataFrame:
        return self._keep(U.reference_forward(U.reference_pairs(self.matched), self.taxonomy), "reference-forward")

    @cached_property
    def containment_reverse(self) -> DataFrame:
        return self._keep(U.reverse_lookup(U.containment_pairs(self.matched), self.taxonomy), "containment-reverse")

    @cached_property
    def reference_reverse(self) -> DataFrame:
        return self._keep(U.reverse_lookup(U.reference_pairs(self.matched), self.taxonomy), "reference-reverse")

    @cached_property
    def associations(self) -> U.AssociationLookups:
        return U.AssociationLookups(self.containment_forward, self.reference_forward,
                                    self.containment_reverse, self.reference_reverse)

    @cached_property
    def forward(self) -> DataFrame:
        return self._keep(U.forward_features(self.containment_forward, self.reference_forward), "forward")

    @cached_property
    def implementation(self) -> DataFrame:
        """Implementation classes: every class of the metamodel documents, by name."""
        own = D.in_documents(self._own(self.graph.elements_of("Class")), self.documents, "Metamodel")
        return own.select("name", "is_abstract")

    @cached_property
    def changes(self) -> ChangeLookups:
        return ChangeLookups(
            self._keep(U.concrete_metaclass_lookup(self.implementation, self.classes), "concrete"),
            self._keep(U.property_routes(self.associations), "routes"),
            self.attribute_lookups,
            self.taxonomy,
        )


class Workspace:
    """Raw graph, lookups of the instantiated metamodel, and of all metamodels."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.graph = StarGraph(spark, folder)

    @cached_property
    def all(self) -> MetamodelLookups:
        return MetamodelLookups(self.graph, self.graph.document, "all")

    @cached_property
    def business(self) -> MetamodelLookups:
        graph = StarGraph(self.spark, self.graph.folder, kept=())
        return MetamodelLookups(graph, self.graph.document.filter(F.col("resource") == METAMODEL), "business", METAMODEL)

    @cached_property
    def _selected(self) -> tuple[DataFrame, DataFrame]:
        return export_selected(self.graph.selection, self.graph.document)

    @cached_property
    def selected_documents(self) -> DataFrame:
        return materialize(self._selected[0], "selected-documents")

    @property
    def selection_errors(self) -> DataFrame:
        return self._selected[1]

    @cached_property
    def element_keys(self) -> DataFrame:
        """The uuids of all model elements in sorted buckets, for the joins that look references up in them."""
        own = D.in_documents(self.graph.element, self.graph.document, "Model")
        return bucketed(own.select("uuid").filter("uuid IS NOT NULL"), "element-keys", ["uuid"])

    @cached_property
    def stereotypes(self) -> DataFrame:
        """Stereotypes of the exported profiles."""
        return materialize(P.stereotypes(self.graph.elements_of("Stereotype"), self.selected_documents), "stereotypes")

    @cached_property
    def stereotype_taxa(self) -> DataFrame:
        names = D.select_kind(self.graph.elements_of("Stereotype"), ["Stereotype"]).select("uuid", "name")
        return materialize(T.taxonomy(names, self.graph.generalization), "stereotype-taxonomy")

    @cached_property
    def tags(self) -> DataFrame:
        """Slots of stereotype properties of applied stereotypes, of all documents."""
        g = self.graph
        own = g.feature.filter(F.col("resource").startswith("urn:profile:"))
        return materialize(V.stereotype_slots(g.tag_slot, own, g.type, g.application, self.stereotype_taxa), "tags")

    @cached_property
    def model_export(self) -> Export:
        """The export of the selected models, shared by all queries; a package without a document is an error of it."""
        profiles = D.resource_rows(self.selected_documents, "Profile")
        export = export_model(self.selected_documents, profiles, self.model_input)
        return Export(export.tables, export.errors.unionByName(self.selection_errors))

    def close(self) -> None:
        """Forget the lookups and remove all intermediate tables of the application."""
        _OPEN.clear()
        drop_bucketed(self.spark)
        remove_folders(self.spark)

    @cached_property
    def library_types(self) -> DataFrame:
        return self.graph.datatype.filter(F.col("resource") == LIBRARY)

    @cached_property
    def model_input(self) -> ModelInput:
        g, b = self.graph, self.business
        return ModelInput(
            g.element, g.slot, g.tag_slot, g.application, g.profile_application, g.feature, g.type, b.classes,
            self.stereotypes, self.stereotype_taxa, b.forward, b.attribute_lookups, METAMODEL, g.slots_of,
        )


_OPEN: dict[tuple[str, str], Workspace] = {}


def workspace(spark: SparkSession, folder: str) -> Workspace:
    """The workspace of a folder; its lookups are shared by all queries of a session."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _OPEN:
        _OPEN[key] = Workspace(spark, folder)
    return _OPEN[key]
