"""Inheritance closure, its cycles, and effective attributes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelweave.functions.scale import lookup_join, materialize, used_lookup
from modelweave.operators.errors import error_rows


def closure(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Reflexive-transitive (node, ancestor, depth) over ``edges(specific, general)``; depth is minimal.

    Paths double: after a round all pairs up to twice the length are known, since a longer shortest path
    is one of exactly the length known so far and a known one behind it. So a chain of n classes takes
    log n rounds, and a pair is produced only in the round its length falls in. Cycles end because known
    pairs are not found again. Every round is written to the shared folder.

    Only nodes that have one below them are in the middle of a path, so the rounds are for these; the others, mostly
    far more, then take the ancestors of the nodes directly above them.
    """
    edges = edges.select(F.col("specific").alias("ancestor"), F.col("general"))
    # The nodes that have one below them.
    generals = materialize(
        edges.select("general").distinct().join(nodes.select(F.col("uuid").alias("general")), "general", "left_semi"),
        "generals",
    )
    n_generals = generals.count()
    edges = lookup_join(
        edges.join(nodes.select(F.col("uuid").alias("ancestor")), "ancestor", "left_semi"), generals, ["general"],
        "left_semi", lookup_rows=n_generals,
    )
    own = nodes.select(F.col("uuid").alias("node"), F.col("uuid").alias("ancestor"), F.lit(0).alias("depth")).distinct()
    steps = edges.filter("ancestor <> general").select(
        F.col("ancestor").alias("node"), F.col("general").alias("ancestor"), F.lit(1).alias("depth")
    ).distinct()
    inner = generals.select(F.col("general").alias("node"), F.lit(True).alias("_inner"))
    steps = materialize(lookup_join(steps, inner, ["node"], "left", lookup_rows=n_generals), "closure")
    # Pairs of at least one step; the reflexive ones are added at the end.
    known = steps.filter("_inner").drop("_inner")
    length = 1
    while not known.filter(F.col("depth") == length).isEmpty():
        longest = known.filter(F.col("depth") == length).select("node", F.col("ancestor").alias("_middle"))
        rest = known.select(F.col("node").alias("_middle"), "ancestor", "depth")
        paths = lookup_join(longest, rest, ["_middle"]).filter("node <> ancestor")
        found = materialize(
            paths.groupBy("node", "ancestor").agg((F.min("depth") + length).alias("depth"))
            .join(known.select("node", "ancestor"), ["node", "ancestor"], "left_anti"),
            "closure",
        )
        known = known.unionByName(found)
        length *= 2
    above = known.select(F.col("node").alias("_general"), "ancestor", "depth").unionByName(
        generals.select(F.col("general").alias("_general"), F.col("general").alias("ancestor"), F.lit(0).alias("depth"))
    )
    # Divided by node, so that a broadcast of `above` and the grouping leave each row where it is.
    outer = steps.filter("_inner IS NULL").select("node", F.col("ancestor").alias("_general")).repartition("node")
    paths = lookup_join(outer, above, ["_general"])
    ends = materialize(paths.groupBy("node", "ancestor").agg((F.min("depth") + 1).alias("depth")), "closure")
    return own.unionByName(known).unionByName(ends)


def strong_components(pairs: DataFrame) -> DataFrame:
    """(node, component): the nodes of a closure that lie on a cycle, with the smallest node each is on one with.

    Two nodes are on a cycle if each is the other's ancestor. Only pairs on a cycle pass the first grouping.
    """
    both = (
        pairs.filter("node <> ancestor")
        .groupBy(F.least("node", "ancestor").alias("low"), F.greatest("node", "ancestor").alias("high"))
        .agg(F.count(F.lit(1)).alias("n")).filter("n = 2")
    )
    ends = both.select(F.explode(F.array("low", "high")).alias("node"), F.col("low").alias("other"))
    return ends.groupBy("node").agg(F.min("other").alias("component"))


def cyclic_generalizations(classes: DataFrame, pairs: DataFrame, generalizations: DataFrame) -> DataFrame:
    """An error row for each group of classes that generalize each other, and for each class that generalizes itself.

    ``element`` is the smallest class of the group; the message counts its classes.
    """
    groups = strong_components(pairs).groupBy("component").agg(F.count(F.lit(1)).alias("n"))
    own = generalizations.filter("specific = general").select(F.col("specific").alias("component")).distinct()
    own = own.join(classes.select(F.col("uuid").alias("component")), "component", "left_semi")
    alone = own.join(strong_components(pairs).select(F.col("node").alias("component")), "component", "left_anti")
    every = groups.unionByName(alone.withColumn("n", F.lit(1).cast("long")))
    homes = classes.select(F.col("uuid").alias("component"), "resource")
    return error_rows(
        lookup_join(every, homes, ["component"]), "cyclic-generalization",
        F.concat(F.lit("Classes generalize each other: "), F.col("n").cast("string"), F.lit(" from "),
                 F.col("component")),
        element="component", severity="fatal",
    )


def taxonomy(classes: DataFrame, generalizations: DataFrame) -> DataFrame:
    """All supertypes of each class, itself included.

    ``level`` is the number of supertypes of the supertype: a class always has a lower level than
    its specializations, so ascending level lists the general classes first.
    """
    pairs = closure(classes.select("uuid"), generalizations).select(
        F.col("node").alias("metaclass"), F.col("ancestor").alias("supertype"), "depth"
    )
    levels = pairs.groupBy(F.col("metaclass").alias("supertype")).agg(F.count(F.lit(1)).cast("int").alias("level"))
    names = classes.select(F.col("uuid"), F.col("name"))
    described = materialize(levels.join(
        names.select(F.col("uuid").alias("supertype"), F.col("name").alias("supertype_name")), "supertype"
    ), "levels")
    subtypes = names.select(F.col("uuid").alias("metaclass"), F.col("name").alias("metaclass_name"))
    return lookup_join(inherited(pairs, described, "supertype"), subtypes, ["metaclass"])


def inherited(taxa: DataFrame, held: DataFrame, holder: str) -> DataFrame:
    """What the supertypes in column ``holder`` hold, for each (metaclass, holder) of ``taxa``.

    Few classes are supertypes of others: what these hold is looked up apart from what each class holds itself, so
    it may be broadcast, and no supertype's classes meet in one task.
    """
    own, above = taxa.filter(F.col("metaclass") == F.col(holder)), taxa.filter(F.col("metaclass") != F.col(holder))
    general = used_lookup(held, above, [holder])
    return lookup_join(above, general, [holder]).unionByName(lookup_join(own, held, [holder]))


def specializations(taxa: DataFrame) -> DataFrame:
    """Inverse of the taxonomy: all subtypes of each class, itself included."""
    return taxa.select(
        F.col("supertype").alias("metaclass"), F.col("supertype_name").alias("metaclass_name"),
        F.col("metaclass").alias("subtype"), F.col("metaclass_name").alias("subtype_name"), "depth",
    )


def effective_attributes(taxa: DataFrame, attributes: DataFrame) -> DataFrame:
    """Own and inherited datatype attributes of each class."""
    owned = attributes.select(
        F.col("owner").alias("supertype"), F.col("uuid").alias("attribute"), "name", "type", "kind",
        "is_ordered", "is_derived",
    )
    found = inherited(taxa.select("metaclass", "metaclass_name", "supertype", "depth", "level"), owned, "supertype")
    return found.select(
        "metaclass", "metaclass_name", "attribute", "name", "type", "kind", "is_ordered", "is_derived",
        F.col("supertype").alias("owner"), "depth", "level",
    )
