"""Checks over the finished tables."""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from modelweave.functions.scale import lookup_join, materialize
from modelweave.operators.errors import union_all

# kind of feature -> (kind of value it holds, column of the value, name of its tables)
_HELD = {
    "atomic": ("atomic", "value", "AtomicValues"),
    "enumeration": ("literal", "value", "LiteralValues"),
    "structured": ("instance", "ref_instance", "StructuredValues"),
    "link": ("element", "ref", "Links"),
}

# table -> foreign key column -> universe it must resolve in
MODEL_KEYS = {
    "elements": {"metaClass": "metaClasses"},
    "orderedAtomicValues": {"attribute": "attributes"},
    "unorderedAtomicValues": {"attribute": "attributes"},
    "orderedLiteralValues": {"attribute": "attributes", "value": "literals"},
    "unorderedLiteralValues": {"attribute": "attributes", "value": "literals"},
    "orderedStructuredValues": {"attribute": "attributes", "value": "elements"},
    "unorderedStructuredValues": {"attribute": "attributes", "value": "elements"},
    "appliedProfiles": {"appliedProfile": "profiles"},
    "orderedLinks": {"sourceElement": "elements", "targetElement": "elements", "metaAssociation": "associations"},
    "unorderedLinks": {"sourceElement": "elements", "targetElement": "elements", "metaAssociation": "associations"},
    "appliedStereotypes": {"modelElement": "elements", "appliedStereotype": "stereotypes"},
    "orderedStereotypeReferences": {
        "modelElement": "elements", "associationTargetEnd": "features", "referencedElement": "elements"
    },
    "unorderedStereotypeReferences": {
        "modelElement": "elements", "associationTargetEnd": "features", "referencedElement": "elements"
    },
}

# The universe that grows with the model.
ELEMENTS = "elements"
_UNRESOLVED = ("table", "column", "reference", "n_rows")

# What identifies a collection, and the share of the elements that a first comparison takes together.
_COLLECTION = ("table", "resource", "entity", "attribute")
_SHARES = 256
# Longer lists of differing shares filter nothing.
_LISTED = 1000
# Values whose rebuilt collections are compared at once, so many are shuffled before their files are removed;
# spark.modelweave.passRows overrides it.
PASS_ROWS = 300_000_000


def _share() -> Column:
    return F.pmod(F.xxhash64("resource", "entity"), F.lit(_SHARES)).cast("int")


def _pass_rows(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.modelweave.passRows", str(PASS_ROWS)))


def _passes(counts: dict[tuple[str | None, int], int], most: int) -> list[Column]:
    """Conditions that part all rows so that those expected under each are about ``most`` at the most.

    ``counts`` has the rows by table and share. Small tables go together, a large one by ranges of its shares; the last
    condition holds for tables that are not expected at all.
    """
    if sum(counts.values()) <= most:
        return [F.lit(True)]
    table, share = F.col("table"), _share()
    names = sorted({t for t, _ in counts if t is not None})
    out, together, held = [], [], 0
    for name in names:
        own = [counts.get((name, i), 0) for i in range(_SHARES)]
        if sum(own) > most:
            parts = min(_SHARES, math.ceil(sum(own) / most))
            ends = [_SHARES * (i + 1) // parts for i in range(parts)]
            out += [(table == name) & (share >= start) & (share < end) for start, end in zip([0, *ends], ends)]
            continue
        if together and held + sum(own) > most:
            out.append(table.isin(together))
            together, held = [], 0
        together, held = [*together, name], held + sum(own)
    if together:
        out.append(table.isin(together))
    return [*out, ~table.isin(names) | table.isNull()]


def _differing(expected: DataFrame, found: DataFrame) -> DataFrame:
    """(table, attribute, share) in which the sides differ in number or hashes of their values, or a key is null.

    A null key meets nothing in the comparison by collections, so it is left to that one. What is found is summed up
    pass by pass, so that the shuffle files of one pass are gone before the next.
    """
    number = F.xxhash64("resource", "entity", "index", "value")
    no_key = reduce(or_, [F.col(k).isNull() for k in _COLLECTION])
    # Halves, so that the sums are plain longs.
    sums = {"n": F.lit(1), "high": F.shiftright(number, 32), "low": number.bitwiseAND(F.lit(0xFFFFFFFF))}

    def side(rows: DataFrame, sign: int, label: str) -> DataFrame:
        counted = rows.groupBy("table", "attribute", _share().alias("share")).agg(
            *[(F.sum(c.cast("long")) * sign).alias(k) for k, c in sums.items()], F.max(no_key).alias("no_key")
        )
        return materialize(counted, label)

    wanted = side(expected, 1, "expected-shares")
    counts = {(r["table"], r["share"]): r["n"] for r in wanted.groupBy("table", "share").agg(F.sum("n").alias("n")).collect()}
    passes = _passes(counts, _pass_rows(expected.sparkSession))
    sides = union_all([wanted, *[side(found.filter(own), -1, "found-shares") for own in passes]])
    both = sides.groupBy("table", "attribute", "share").agg(*[F.sum(k).alias(k) for k in sums], F.max("no_key").alias("no_key"))
    return both.filter("n <> 0 OR high <> 0 OR low <> 0 OR no_key").select("table", "attribute", "share")


def _within(rows: DataFrame, differing: DataFrame) -> DataFrame:
    """The rows in the tables, attributes and shares that differ, as filters on keys, which reach the scans."""
    columns = {"table": F.col("table"), "attribute": F.col("attribute"), "share": _share()}
    for name, column in columns.items():
        listed = [r[0] for r in differing.select(name).distinct().limit(_LISTED + 1).collect()]
        if len(listed) <= _LISTED:
            known = sorted(v for v in listed if v is not None)
            rows = rows.filter(column.isin(known) | column.isNull() if None in listed else column.isin(known))
    return rows


def _prints(rows: DataFrame, n: str) -> DataFrame:
    """Per (table, resource, entity, attribute): the number of values and the sum of their hashes, in any order."""
    number = F.xxhash64("index", "value").cast("decimal(38,0)")
    return rows.groupBy("table", "resource", "entity", "attribute").agg(
        F.count(F.lit(1)).alias(n), F.sum(number).alias(f"_{n}")
    )


def expected_values(slots: DataFrame, attributes: DataFrame, forward: DataFrame) -> DataFrame:
    """(table, resource, entity, attribute, index, value): what the raw slots say, told by the kinds of values alone.

    ``index`` is null where the order does not count. Values of another kind than their feature's have no table;
    the exports report them.
    """
    lookup = attributes.filter(~F.col("implementation_derived")).select(
        F.col("metaclass_name").alias("metaclass"), F.col("name").alias("feature_name"), "attribute", "is_ordered",
        F.col("kind").alias("_kind"),
    ).unionByName(forward.select(
        "metaclass", "feature_name", F.col("association").alias("attribute"), "is_ordered", F.lit("link").alias("_kind")
    ))
    of = F.create_map(*[F.lit(x) for pair in _HELD.items() for x in (pair[0], pair[1][0])])
    title = F.create_map(*[F.lit(x) for pair in _HELD.items() for x in (pair[0], pair[1][2])])
    value = reduce(
        lambda out, kind: F.when(F.col("_kind") == kind, F.col(_HELD[kind][1])).otherwise(out), _HELD, F.lit(None)
    )
    found = lookup_join(slots.drop("feature"), lookup, ["metaclass", "feature_name"]).withColumn("_value", value)
    right_kind = (F.col("_kind") == "atomic") | (of[F.col("_kind")] == F.col("value_kind"))
    needs_value = F.col("_kind").isin("structured", "link")
    kept = found.filter(
        right_kind & (~needs_value | F.col("_value").isNotNull()) & ((F.col("_kind") != "link") | F.col("is_collection"))
    )
    index = F.when(F.col("is_ordered"), F.when(F.col("is_collection"), F.col("position")).otherwise(F.lit(0)))
    word = F.when(F.col("is_ordered"), F.lit("ordered")).otherwise(F.lit("unordered"))
    return kept.select(
        F.concat(word, title[F.col("_kind")]).alias("table"), "resource", "entity", "attribute",
        index.cast("int").alias("index"), F.col("_value").alias("value"),
    )


def collected_values(collections: DataFrame) -> DataFrame:
    """The values of rebuilt collections, one row each, as `expected_values` gives them."""
    rows = collections.select(
        "table", "resource", "entity", "attribute", F.inline(F.arrays_zip("indexes", "values"))
    ).withColumnsRenamed({"indexes": "index", "values": "value"})
    return rows.withColumn("index", F.when(F.col("table").startswith("ordered"), F.col("index")).cast("int"))


def lost_values(expected: DataFrame, found: DataFrame) -> DataFrame:
    """(table, resource, entity, attribute, n_expected, n_found) wherever the two sides differ in any value.

    Tables, attributes and shares of their elements are compared first, by counts and order-free sums of hashes that
    the tasks reduce; only where these differ are collections compared. There both sides are reduced to the same per
    collection before they meet, so a collection of any size is one row of the join.
    """
    keys = list(_COLLECTION)
    differing = materialize(_differing(expected, found), "differing-shares")
    expected, found = _within(expected, differing), _within(found, differing)
    both = _prints(expected, "n_expected").join(_prints(found, "n_found"), keys, "full")
    differs = ~F.col("_n_expected").eqNullSafe(F.col("_n_found")) | ~F.col("n_expected").eqNullSafe(F.col("n_found"))
    none = F.lit(0).cast("long")
    return both.filter(differs).select(
        *keys, F.coalesce("n_expected", none).alias("n_expected"), F.coalesce("n_found", none).alias("n_found")
    )


def unresolved_references(tables: dict[str, DataFrame], universes: dict[str, DataFrame]) -> DataFrame:
    """Foreign key values found in no known resource, with the number of rows that hold them.

    References are counted before the shuffle, so an element that many rows refer to arrives as one
    row, and each universe is read once. References to elements are shuffled once, by themselves, with a count for
    each table and column. The others, which name parts of metamodels, are counted in one pass and written.
    """
    def references(wanted: Callable[[str], bool]) -> tuple[DataFrame | None, list[tuple[str, str, str]]]:
        """(number of table and column, reference) of the universes wanted, and what the numbers stand for."""
        parts, places = [], []
        for name, keys in MODEL_KEYS.items():
            own = [(name, c, u) for c, u in keys.items() if wanted(u)] if name in tables else []
            if own:
                entries = [F.struct(F.lit(i).alias("at"), F.col(c).alias("reference")) for i, (_, c, _) in enumerate(own, len(places))]
                parts.append(tables[name].select(F.inline(F.array(*entries))))
                places += own
        return (union_all(parts).filter(F.col("reference").isNotNull()) if parts else None), places

    def known(universe: str) -> DataFrame:
        return universes[universe].select(F.col("uuid").alias("reference"))

    found = []
    held, places = references(lambda universe: universe == ELEMENTS)
    if held is not None:
        counted = held.groupBy("reference").agg(*[F.count_if(F.col("at") == i).alias(f"n{i}") for i in range(len(places))])
        entries = [
            F.struct(F.lit(t).alias("table"), F.lit(c).alias("column"), F.col(f"n{i}").alias("n_rows"))
            for i, (t, c, _) in enumerate(places)
        ]
        missing = counted.join(known(ELEMENTS), "reference", "left_anti")
        found.append(missing.select("reference", F.inline(F.array(*entries))).filter("n_rows > 0").select(*_UNRESOLVED))
    held, places = references(lambda universe: universe != ELEMENTS)
    if held is not None:
        counted = materialize(held.groupBy("at", "reference").agg(F.count(F.lit(1)).alias("n")), "named-references")
        table, column = (F.element_at(F.array(*[F.lit(place[i]) for place in places]), F.col("at") + 1) for i in (0, 1))
        for universe in sorted({u for _, _, u in places}):
            own = counted.filter(F.col("at").isin([i for i, place in enumerate(places) if place[2] == universe]))
            missing = own.join(known(universe), "reference", "left_anti")
            found.append(missing.select(table.alias("table"), column.alias("column"), "reference", F.col("n").alias("n_rows")))
    return union_all(found)
