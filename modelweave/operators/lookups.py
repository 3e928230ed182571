"""Lookup relations of a metamodel: association features by direction, attributes by name."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from modelweave.functions.expressions import is_override, redefined_name
from modelweave.functions.scale import lookup_join, materialize, used_lookup
from modelweave.operators.errors import error_rows, union_all
from modelweave.operators.taxonomy import inherited

PAIR = (
    "association", "feature", "feature_name", "opposite", "opposite_name",
    "source_class", "source_class_name", "target_class", "target_class_name", "is_ordered", "target_composite",
)


def concrete_metaclass_lookup(implementation: DataFrame, classes: DataFrame) -> DataFrame:
    """Concrete implementation classes matched by name to exported metaclasses."""
    return implementation.filter(~F.col("is_abstract")).select(F.col("name").alias("metaclass_name")).join(
        classes.select(F.col("uuid").alias("metaclass"), F.col("name").alias("metaclass_name")), "metaclass_name"
    )


def association_views(oriented: DataFrame, classes: DataFrame) -> DataFrame:
    """Associations with the names and classes of both ends; the target end decides the ordering."""

    def named(side: str) -> DataFrame:
        return classes.select(F.col("uuid").alias(f"{side}_class"), F.col("name").alias(f"{side}_class_name"))

    placed = lookup_join(lookup_join(oriented, named("source"), ["source_class"]), named("target"), ["target_class"])
    return placed.select(
        "resource", "association", "name", "source_end", "source_name", "source_class", "source_class_name",
        "target_end", "target_name", "target_class", "target_class_name",
        F.col("target_is_ordered").alias("is_ordered"), F.col("target_is_composite").alias("target_composite"),
    )


def association_view_match(features: DataFrame, classes: DataFrame, views: DataFrame) -> DataFrame:
    """Feature/opposite pairs matched to associations by the names and types of both ends.

    ``source_class`` owns the feature, ``target_class`` is its type.
    """

    def named(side: str) -> DataFrame:
        return classes.select(F.col("uuid").alias(f"{side}_type"), F.col("name").alias(f"{side}_class_name"))

    flags = ("is_container", "is_containment", "is_changeable", "is_derived")
    forward = features.filter(F.col("opposite").isNotNull()).select(
        F.col("uuid").alias("feature"), F.col("name").alias("target_name"), F.col("owner").alias("holder"),
        F.col("type").alias("target_type"), "opposite", *flags,
    )
    back = features.select(
        F.col("uuid").alias("opposite"), F.col("name").alias("source_name"), F.col("type").alias("source_type"),
        *[F.col(f).alias(f"opposite_{f}") for f in flags],
    )
    pairs = lookup_join(forward.join(back, "opposite"), named("target"), ["target_type"])
    pairs = lookup_join(pairs, named("source"), ["source_type"])
    by = ["source_name", "source_class_name", "target_name", "target_class_name"]
    seen = views.select("association", "is_ordered", "target_composite", *by)
    return pairs.join(seen, by).select(
        "holder", "association", "feature", F.col("target_name").alias("feature_name"), "opposite",
        F.col("source_name").alias("opposite_name"), F.col("source_type").alias("source_class"), "source_class_name",
        F.col("target_type").alias("target_class"), "target_class_name", "is_ordered", "target_composite",
        *flags, *[f"opposite_{f}" for f in flags],
    )


def containment_pairs(matched: DataFrame) -> DataFrame:
    return matched.filter(
        "is_containment AND is_changeable AND opposite_is_container AND opposite_is_changeable"
    ).select("holder", *PAIR)


def reference_pairs(matched: DataFrame) -> DataFrame:
    plain = "NOT is_container AND NOT is_containment AND NOT is_derived"
    opposite = "NOT opposite_is_container AND NOT opposite_is_containment AND NOT opposite_is_derived"
    return matched.filter(f"{plain} AND {opposite}").select("holder", *PAIR)


def _first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def _inherited(pairs: DataFrame, taxa: DataFrame) -> DataFrame:
    """Pairs of every class and its supertypes."""
    return inherited(
        taxa.select("metaclass", "metaclass_name", F.col("supertype").alias("holder"), "depth", "level"), pairs, "holder"
    )


def _first_inherited(pairs: DataFrame, taxa: DataFrame, key: Column, order: list[Column]) -> DataFrame:
    """Of the pairs of a class and its supertypes, the first of each key.

    Pairs of supertypes are ranked by number, so that a row that many classes inherit is not shuffled whole.
    """
    columns = ["metaclass", "metaclass_name", "key"]
    taxa = taxa.select("metaclass", "metaclass_name", F.col("supertype").alias("holder"), "level")
    own, above = taxa.filter("metaclass = holder"), taxa.filter("metaclass <> holder")
    general = materialize(
        used_lookup(pairs, above, ["holder"]).withColumn("_pair", F.monotonically_increasing_id()), "general-pairs"
    )
    whole = F.struct(*PAIR)
    ranked = ["metaclass", "metaclass_name", "level", "feature_name", "association"]
    from_above = lookup_join(above, general.select("holder", "feature_name", "association", "_pair"), ["holder"])
    by_itself = lookup_join(own, pairs, ["holder"]).select(*ranked, whole.alias("_own"))
    candidates = from_above.select(*ranked, "_pair").unionByName(by_itself, allowMissingColumns=True)
    chosen = _first(candidates.withColumn("key", key), ["metaclass", "key"], order)
    found = lookup_join(
        chosen.select(*columns, "_pair", "_own"), general.select("_pair", whole.alias("_shared")), ["_pair"], "left"
    )
    return found.select(*columns, F.coalesce("_own", "_shared").alias("_found")).select(*columns, "_found.*")


def containment_forward(pairs: DataFrame, taxa: DataFrame) -> DataFrame:
    """Containment features of each class by inheritance, one per key.

    ``x__from_Y`` takes the key ``x``. The most specific class wins a key; within one class the
    redefining feature wins, then the lower association uuid.
    """
    order = [F.col("level").desc(), is_override(F.col("feature_name")).desc(), F.col("association")]
    return _first_inherited(pairs, taxa, redefined_name(F.col("feature_name")), order)


def contested(candidates: DataFrame) -> DataFrame:
    """(metaclass, key, holder) of the keys that several holders give; most keys have one."""
    of_key = Window.partitionBy("metaclass", "key")
    several = F.min("holder").over(of_key) < F.max("holder").over(of_key)
    held = candidates.select("metaclass", "key", "holder")
    return held.withColumn("_several", several).filter("_several").drop("_several")


def minimal_holders(candidates: DataFrame, taxa: DataFrame) -> DataFrame:
    """The rows (metaclass, key, holder, ...) whose holder is most specific: no other holder of the key is below it.

    A holder is dominated if it is a proper supertype of another one. Each holder's supertypes are looked up, so
    the pairs of holders of a key are never listed; a class that gives a key itself dominates all others, which are
    its supertypes. Rows of these three columns only come once each.
    """
    keys = ["metaclass", "key"]
    whole = [*keys, "holder"]
    itself = F.col("holder") == F.col("metaclass")
    held = candidates.select(*whole).withColumn("_own", F.max(itself).over(Window.partitionBy(*keys)))
    proper = taxa.filter("metaclass <> supertype")
    above = used_lookup(
        proper.select(F.col("metaclass").alias("holder"), F.col("supertype").alias("_above")),
        proper.select(F.col("supertype").alias("holder")), ["holder"],
    )
    # Each holder and those above it, grouped where the window left them.
    passed = F.inline(F.array(
        F.struct("holder", (F.col("_own") & ~itself).alias("dominated"), F.lit(True).alias("given")),
        F.struct(F.col("_above").alias("holder"), F.lit(True).alias("dominated"), F.lit(False).alias("given")),
    ))
    found = lookup_join(held, above, ["holder"], "left").select(*keys, passed).groupBy(*whole).agg(
        (F.max("dominated") & F.col("key").isNotNull()).alias("dominated"), F.max("given").alias("given")
    )
    if set(candidates.columns) == set(whole):
        return found.filter("given AND NOT dominated").select(*whole)
    return candidates.join(found.filter("dominated").select(*whole), whole, "left_anti")


def inherited_keys(pairs: DataFrame, taxa: DataFrame, redefining: bool) -> DataFrame:
    """Features of every class and its supertypes with the key they compete for.

    ``redefining`` gives ``x__from_Y`` the key ``x``, as containment does.
    """
    name = F.col("feature_name")
    return _inherited(pairs, taxa).withColumn("key", redefined_name(name) if redefining else name)


def ambiguous_features(pairs: DataFrame, taxa: DataFrame, classes: DataFrame, redefining: bool) -> DataFrame:
    """An error row for each (class, key) that several incomparable classes give: none of them overrides the others.

    The forward lookups still take one of them (level, override, association); this tells that they had to choose.
    """
    pairs = materialize(pairs, "holders")
    competing = minimal_holders(contested(inherited_keys(pairs, taxa, redefining)), taxa)
    found = competing.groupBy("metaclass", "key").agg(
        F.count_distinct("holder").alias("n"), F.min("holder").alias("first")
    ).filter("n > 1")
    homes = classes.select(F.col("uuid").alias("metaclass"), "resource")
    return error_rows(
        lookup_join(found, homes, ["metaclass"]), "ambiguous-feature",
        F.concat(F.col("n").cast("string"), F.lit(" unrelated classes give the feature "), F.col("key"),
                 F.lit(", among them "), F.col("first")),
        element="metaclass",
    )


def redefinition_override(pairs: DataFrame, taxa: DataFrame) -> DataFrame:
    """Forward containment entries that come from a redefining feature."""
    return containment_forward(pairs, taxa).filter(is_override(F.col("feature_name")))


def reference_forward(pairs: DataFrame, taxa: DataFrame) -> DataFrame:
    """Reference features of each class by inheritance; the most specific class wins a name."""
    return _first_inherited(pairs, taxa, F.col("feature_name"), [F.col("level").desc(), F.col("association")])


def _reverse(pairs: DataFrame, taxa: DataFrame) -> DataFrame:
    below = taxa.select("metaclass", "metaclass_name", F.col("supertype").alias("target_class"), "depth", "level")
    kept = [c for c in PAIR if c != "target_class"]
    return inherited(below, pairs.select("target_class", *kept), "target_class").withColumn("key", F.col("feature_name"))


def reverse_lookup(pairs: DataFrame, taxa: DataFrame) -> DataFrame:
    """Pairs keyed by the target class and all its specializations.

    Entries with the same key collapse to the nearest one (lowest depth, then association uuid).
    """
    order = [F.col("depth"), F.col("association")]
    return _first(_reverse(pairs, taxa), ["metaclass", "key"], order).select(
        "metaclass", "metaclass_name", "key", *PAIR, "depth"
    )


def ambiguous_reverse_keys(pairs: DataFrame, taxa: DataFrame) -> DataFrame:
    """Keys of the reverse lookup that several pairs compete for."""
    return _reverse(pairs, taxa).groupBy("metaclass", "key").agg(
        F.count(F.lit(1)).alias("candidates")
    ).filter("candidates > 1")


def association_pair_counts(containment: DataFrame, reference: DataFrame) -> DataFrame:
    """Number of distinct forward pairs over all classes."""
    pair = ("association", "feature", "opposite")
    tagged = [
        df.select(F.lit(kind).alias("kind"), *pair)
        for kind, df in (("composite", containment), ("reference", reference))
    ]
    return union_all(tagged).distinct().groupBy("kind").agg(F.count(F.lit(1)).alias("pairs"))


def forward_features(containment: DataFrame, reference: DataFrame) -> DataFrame:
    """All forward association features of each class, by the feature's own name."""
    return union_all([containment, reference]).select(
        F.col("metaclass_name").alias("metaclass"), "feature_name", "association", "is_ordered"
    )


def attribute_lookups(effective: DataFrame, features: DataFrame, taxa: DataFrame) -> DataFrame:
    """Per class, kind, ordering and name: the effective attribute and the implementation attribute.

    Both are matched by name; among namesakes the most specific one is taken.
    """
    keys = ["metaclass", "kind", "is_ordered", "name"]
    # Divided as the join below needs them; the window takes them so, too.
    placed = effective.repartition("metaclass", "name")
    wanted = _first(placed, keys, [F.col("level").desc(), F.col("attribute")]).select(
        *keys, "metaclass_name", "attribute", "type"
    )
    owned = features.filter(F.col("opposite").isNull()).select(
        F.col("owner").alias("supertype"), "name", F.col("uuid").alias("implementation"),
        F.col("is_ordered").alias("implementation_ordered"), F.col("is_derived").alias("implementation_derived"),
    )
    known = inherited(taxa.select("metaclass", "supertype", "level"), owned, "supertype")
    known = _first(known, ["metaclass", "name"], [F.col("level").desc(), F.col("implementation")])
    return wanted.join(known.drop("level", "supertype"), ["metaclass", "name"])


def attribute_lookup(lookups: DataFrame, kind: str, ordered: bool) -> DataFrame:
    """The lookup of one kind and ordering."""
    flag = F.col("is_ordered") if ordered else ~F.col("is_ordered")
    return lookups.filter((F.col("kind") == kind) & flag).select(
        "metaclass", "metaclass_name", "name", "attribute", "implementation", "implementation_ordered"
    )


# ---------------------------------------------------------------- routes of a property

# Where a (class, property) is looked for, in this order.
ROUTES = ("forward containment", "forward reference", "inverse containment", "inverse reference")


@dataclass(frozen=True)
class AssociationLookups:
    containment_forward: DataFrame
    reference_forward: DataFrame
    containment_reverse: DataFrame
    reference_reverse: DataFrame


def property_routes(lookups: AssociationLookups) -> DataFrame:
    """One association per (class, property), forward before inverse, containment before reference.

    A forward property is the key of its lookup. An inverse property is the opposite's name; when
    several entries carry it, the nearest one is taken.
    """
    columns = ["route", "rank", "depth", "metaclass", "property", "association", "feature_name", "opposite_name",
               "source_class_name", "target_class_name"]

    def tagged(df: DataFrame, rank: int, prop: str, depth: Column) -> DataFrame:
        return df.select(
            F.lit(ROUTES[rank]).alias("route"), F.lit(rank).alias("rank"), depth.alias("depth"),
            F.col("metaclass_name").alias("metaclass"), F.col(prop).alias("property"), *columns[5:],
        )

    zero = F.lit(0)
    found = union_all([
        tagged(lookups.containment_forward, 0, "key", zero),
        tagged(lookups.reference_forward, 1, "key", zero),
        tagged(lookups.containment_reverse, 2, "opposite_name", F.col("depth")),
        tagged(lookups.reference_reverse, 3, "opposite_name", F.col("depth")),
    ])
    best = _first(found, ["metaclass", "property"], [F.col("rank"), F.col("depth"), F.col("association")])
    return best.select(*[c for c in columns if c not in ("rank", "depth")])


def lookup_forward_property(lookups: AssociationLookups) -> DataFrame:
    """Association of every (class, forward property): containment first, then reference.

    Only the two forward lookups are taken, so an object that makes its lookups on demand makes no other.
    """
    found = union_all([
        df.select("metaclass", "metaclass_name", F.col("key").alias("property"), F.lit(rank).alias("rank"),
                  "association", "feature_name", "opposite_name")
        for rank, df in enumerate((lookups.containment_forward, lookups.reference_forward))
    ])
    return _first(found, ["metaclass", "property"], [F.col("rank")]).drop("rank")


def lookup_inverse_property(lookups: AssociationLookups) -> DataFrame:
    """Association of every (class, inverse property), by the opposite's name; nearest entry first.

    Only the two reverse lookups are taken.
    """
    found = union_all([
        df.select("metaclass", "metaclass_name", F.col("opposite_name").alias("property"), F.lit(rank).alias("rank"),
                  "depth", "association", "feature_name")
        for rank, df in enumerate((lookups.containment_reverse, lookups.reference_reverse))
    ])
    order = [F.col("rank"), F.col("depth"), F.col("association")]
    return _first(found, ["metaclass", "property"], order).drop("rank", "depth")
