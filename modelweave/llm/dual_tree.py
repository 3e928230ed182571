"""Product codes of vectors, their codebooks trained by Lloyd's rounds over two trees.

Vectors are cut into equal parts; every part position has a codebook of its own. The parts at a position of a
block of ``BLOCK`` vectors stand in a tree: ranges of points, halved along their widest dimension down to at most
``LEAF`` points, each with its box and the sum of its points. These trees are made once and written. A round puts
the entries of a codebook in a tree of boxes too and goes down both: of the pairs of a range of points and a
range of entries, those are left out whose least distance exceeds another pair's largest one; between single
entries, the corner of the box that favours the farther one decides. Where one entry is left, the whole range is
assigned by its cached sum. What is still open in a leaf is decided point by point, in integers.

A round reads the trees and gives only sums by entry, added up per task, so nothing but the trees is written and
a lost executor costs its own part of a round. What reaches the driver has the size of the codebooks.

Defined results: a row counts if its vector has no null or non-finite component, none beyond 2^27 when scaled (its
squared distance would not fit a long), and the commonest length among those that ``parts`` divides (ties: the
shorter). Rows of one id are vectors of their own; a row without id counts but starts no codebook; equal ids at
the start go by vector. With fewer vectors than ``entries`` there are as many entries. Ties go to the lower index,
an unused entry stays. A sum by label that no long holds is null. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modelweave.functions.scale import lookup_join
from modelweave.llm.common import written
from modelweave.llm.vectors import BLOCK, finite, integers, narrow, one_list, summed, wide

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
LEAF = 16


def halvings(n: int, depth: int) -> list[np.ndarray]:
    """The starts (and the end) of the ranges of each level, when every range is cut in its middle."""
    levels = [np.array([0, n])]
    for _ in range(depth):
        edges = levels[-1]
        both = np.empty(2 * len(edges) - 1, np.int64)
        both[::2], both[1::2] = edges, (edges[:-1] + edges[1:]) // 2
        levels.append(both)
    return levels


def _depth(n: int) -> int:
    depth = 0
    while n > LEAF << depth:
        depth += 1
    return depth


def _boxes(points: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.minimum.reduceat(points, edges[:-1]), np.maximum.reduceat(points, edges[:-1])


def halved(points: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """An order of the points in which every range is cut along its widest dimension."""
    order = np.arange(len(points))
    for edges in levels[:-1]:
        low, high = _boxes(points[order], edges)
        node = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
        value = points[order, (high - low).argmax(axis=1)[node]]
        order = order[np.lexsort((value, node))]
    return order


class PointTree:
    """The parts at one position, in the order of their tree, with the box and sum of every range."""

    def __init__(self, points: np.ndarray, low: np.ndarray, high: np.ndarray, sums: np.ndarray):
        self.points, self.low, self.high, self.sums = points, low, high, sums
        self.levels = halvings(len(points), _depth(len(points)))

    @classmethod
    def of(cls, points: np.ndarray) -> tuple[PointTree, np.ndarray]:
        """The tree and the order its points stand in."""
        levels = halvings(len(points), _depth(len(points)))
        order = halved(points, levels)
        points = points[order]
        boxes = [_boxes(points, edges) for edges in levels]
        sums = np.concatenate([np.add.reduceat(points, edges[:-1]) for edges in levels])
        low, high = (np.concatenate(x) for x in zip(*boxes, strict=True))
        return cls(points, low, high, sums), order


class EntryTree:
    """A codebook with the boxes of ever smaller ranges of its entries, single entries last."""

    def __init__(self, codebook: np.ndarray):
        self.entries = codebook
        levels = halvings(len(codebook), len(codebook).bit_length() - 1)
        order = halved(codebook, levels)
        self.levels = []
        for edges in levels:
            low, high = _boxes(codebook[order], edges)
            range_of = np.empty(len(codebook), np.int64)
            range_of[order] = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
            self.levels.append((range_of, low, high))
        self.levels.append((np.arange(len(codebook)), codebook, codebook))


def _open_after(low: np.ndarray, high: np.ndarray, alive: np.ndarray, level) -> np.ndarray:
    """The entries left for each box of points, after comparing it with one level of the entries' ranges."""
    range_of, e_low, e_high = level
    gap = np.maximum(np.maximum(low[:, None] - e_high, e_low - high[:, None]), 0)
    reach = np.maximum(np.abs(high[:, None] - e_low), np.abs(e_high - low[:, None]))
    least, most = (gap * gap).sum(axis=2)[:, range_of], (reach * reach).sum(axis=2)[:, range_of]
    bound = np.where(alive, most, np.iinfo(np.int64).max).min(axis=1)
    return alive & (least <= bound[:, None])


def _not_behind(low: np.ndarray, high: np.ndarray, alive: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """The entries left that are not farther than one chosen entry everywhere in the box."""
    twice = low + high  # twice the middle
    far = ((2 * entries[None] - twice[:, None]) ** 2).sum(axis=2)
    chosen = np.where(alive, far, np.iinfo(np.int64).max).argmin(axis=1)
    one = entries[chosen][:, None]
    # d(x, e) - d(x, one) is linear in x, so it is least in a corner
    towards = entries[None] - one
    corner = np.where(towards > 0, high[:, None], low[:, None])
    least = ((corner - entries[None]) ** 2 - (corner - one) ** 2).sum(axis=2)
    behind = (least > 0) | ((least == 0) & (np.arange(len(entries)) > chosen[:, None]))
    behind[np.arange(len(chosen)), chosen] = False
    return alive & ~behind


def assign(tree: PointTree, codebook: EntryTree) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(sums, counts, entry of every point in the tree's order, points decided one by one) of a position."""
    entries = codebook.entries
    k, dims = entries.shape
    sums, counts = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
    chosen = np.zeros(len(tree.points), np.int64)
    node, alive = np.zeros(1, np.int64), np.ones((1, k), bool)
    first, singles = 0, len(codebook.levels) - 1
    for depth, edges in enumerate(tree.levels):
        low, high = tree.low[first + node], tree.high[first + node]
        bottom = depth == len(tree.levels) - 1
        for step in range(min(depth, singles), singles + 1 if bottom else min(depth, singles) + 1):
            alive = _open_after(low, high, alive, codebook.levels[step])
            if step == singles:
                alive = _not_behind(low, high, alive, entries)
        whole = alive.sum(axis=1) == 1
        at, entry = node[whole], alive[whole].argmax(axis=1)
        np.add.at(sums, entry, tree.sums[first + at])
        sizes = edges[at + 1] - edges[at]
        np.add.at(counts, entry, sizes)
        chosen[_ranges(edges[at], sizes)] = np.repeat(entry, sizes)
        node, alive = node[~whole], alive[~whole]
        if bottom:
            break
        first += len(edges) - 1
        node, alive = np.repeat(2 * node, 2), np.repeat(alive, 2, axis=0)
        node[1::2] += 1
    edges = tree.levels[-1]
    sizes = edges[node + 1] - edges[node]
    at = _ranges(edges[node], sizes)
    if len(at):
        left = np.repeat(alive, sizes, axis=0)
        point, entry = np.nonzero(left)  # by point, then entry
        far = ((tree.points[at[point]] - entries[entry]) ** 2).sum(axis=1)
        starts = np.concatenate(([0], np.cumsum(left.sum(axis=1))[:-1]))
        nearest = far == np.minimum.reduceat(far, starts)[point]
        point, entry = point[nearest], entry[nearest]
        lowest = np.concatenate(([True], point[1:] != point[:-1]))
        entry = entry[lowest]
        chosen[at] = entry
        np.add.at(sums, entry, tree.points[at])
        np.add.at(counts, entry, 1)
    return sums, counts, chosen, len(at)


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after the other."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(sizes.sum())


# ---------------------------------------------------------------- blocks as rows

_BINARY = ["points", "orders", "lows", "highs", "sums"]


def _block_schema(label: T.DataType) -> T.StructType:
    schema = T.StructType().add("ids", T.ArrayType(T.LongType())).add("labels", T.ArrayType(label))
    schema = schema.add("n", "long")
    for name in _BINARY:
        schema = schema.add(name, "binary").add(f"{name}_kind", "string")
    return schema


def _planted(parts: int, scale: int):
    """For mapInArrow: from (id, label, v) to blocks of trees."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                given = batch.slice(at, BLOCK)
                n = given.num_rows
                points = integers(given.column(2), n, scale).reshape(n, parts, -1)
                trees, orders = zip(*(PointTree.of(points[:, p]) for p in range(parts)), strict=True)
                columns = [one_list(given.column(0)), one_list(given.column(1)), pa.array([n], pa.int64())]
                names = ["ids", "labels", "n"]
                values = [
                    np.stack([t.points for t in trees]), np.stack(orders), np.stack([t.low for t in trees]),
                    np.stack([t.high for t in trees]), np.stack([t.sums for t in trees]),
                ]
                for name, value in zip(_BINARY, values, strict=True):
                    raw, kind = narrow(value)
                    columns += [pa.array([raw], pa.binary()), pa.array([kind])]
                    names += [name, f"{name}_kind"]
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _read(batch: pa.RecordBatch, i: int, name: str, *shape: int) -> np.ndarray:
    return wide(batch.column(name)[i].as_py(), batch.column(f"{name}_kind")[i].as_py(), *shape)


def _trees(batch: pa.RecordBatch, i: int, parts: int) -> list[PointTree]:
    n = batch.column("n")[i].as_py()
    dims = len(_read(batch, i, "points", -1)) // (parts * n)
    whole = [_read(batch, i, name, parts, -1, dims) for name in ("points", "lows", "highs", "sums")]
    return [PointTree(*(x[p] for x in whole)) for p in range(parts)]


def _summing(codebooks: np.ndarray):
    """For mapInArrow: from blocks to one row (part, entry, n, s0, s1, ...) per entry and task."""
    parts, k, dims = codebooks.shape

    def run(batches):
        books = [EntryTree(c) for c in codebooks]
        sums, counts = np.zeros((parts, k, dims), np.int64), np.zeros((parts, k), np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                for p, tree in enumerate(_trees(batch, i, parts)):
                    more, n, _, _ = assign(tree, books[p])
                    sums[p] += more
                    counts[p] += n
        part, entry = np.nonzero(counts)
        columns = [part, entry, counts[part, entry], *sums[part, entry].T]
        names = ["part", "entry", "n", *(f"s{d}" for d in range(dims))]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    return run


def _coded(codebooks: np.ndarray):
    """For mapInArrow: from blocks to (id, label, code, error)."""
    parts = len(codebooks)

    def run(batches):
        books = [EntryTree(c) for c in codebooks]
        for batch in batches:
            for i in range(batch.num_rows):
                trees = _trees(batch, i, parts)
                n = len(trees[0].points)
                orders = _read(batch, i, "orders", parts, n)
                codes, error = np.zeros((n, parts), np.uint8), np.zeros(n, np.int64)
                for p, tree in enumerate(trees):
                    _, _, chosen, _ = assign(tree, books[p])
                    codes[orders[p], p] = chosen
                    error[orders[p]] += ((tree.points - codebooks[p][chosen]) ** 2).sum(axis=1)
                digits = codes.tobytes().hex()
                text = [digits[at:at + 2 * parts] for at in range(0, len(digits), 2 * parts)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("ids")[i].values, batch.column("labels")[i].values, pa.array(text, pa.string()),
                     pa.array(error)],
                    ["id", "label", "code", "error"],
                )

    return run


# ---------------------------------------------------------------- the rounds


def first_codebooks(kept: DataFrame, parts: int, entries: int, scale: int) -> np.ndarray:
    """(part, entry, dimension): the parts of the vectors of smallest id."""
    rows = kept.filter("id is not null").orderBy("id", "v").select("v").limit(entries).collect()  # ``entries`` rows
    if not rows:
        return np.zeros((parts, 0, 1), np.int64)
    whole = np.floor(np.array([r["v"] for r in rows], np.float64) * scale).astype(np.int64)
    return np.ascontiguousarray(whole.reshape(len(rows), parts, -1).transpose(1, 0, 2))


def _trained(blocks: DataFrame, codebooks: np.ndarray, rounds: int) -> np.ndarray:
    dims = codebooks.shape[2]
    names = [f"s{d}" for d in range(dims)]
    schema = "part long, entry long, n long, " + ", ".join(f"{s} long" for s in names)
    read = blocks.drop("ids", "labels", "orders", "orders_kind")
    for _ in range(rounds):
        found = summed(read.mapInArrow(_summing(codebooks), schema), ["part", "entry"], ["n", *names])
        codebooks = codebooks.copy()
        for r in found:
            codebooks[r["part"], r["entry"]] = [int(r[s]) // int(r["n"]) for s in names]
    return codebooks


def compress(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """(id, code, error, label_error, codebooks_sha256) of every vector that counts."""
    if entries > 256:
        raise ValueError("a part's code has two hex digits")
    spark = vectors.sparkSession
    given = vectors.select(
        vectors[id_col].cast("long").alias("id"), vectors[label_col].alias("label"),
        vectors[vector_col].cast("array<double>").alias("v"),
    )
    kept = given.filter(finite(F.col("v"), scale) & (F.size("v") > 0) & (F.size("v") % parts == 0))
    lengths = kept.groupBy(F.size("v").alias("length")).agg(F.count(F.lit(1)).alias("n"))
    most = lengths.orderBy(F.desc("n"), "length").first()
    empty = f"`{id_col}` long, code string, error long, label_error long, codebooks_sha256 string"
    if most is None:
        return spark.createDataFrame([], empty)
    kept = kept.filter(F.size("v") == most["length"])
    codebooks = first_codebooks(kept, parts, entries, scale)
    if not codebooks.size:
        return spark.createDataFrame([], empty)
    label = given.schema["label"].dataType
    blocks = written(kept.mapInArrow(_planted(parts, scale), _block_schema(label)), "trees")
    codebooks = _trained(blocks, codebooks, rounds)
    digest = hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()
    schema = T.StructType().add("id", "long").add("label", label).add("code", "string").add("error", "long")
    coded = written(blocks.mapInArrow(_coded(codebooks), schema), "codes")
    key = F.when(F.col("label").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("label").cast("string")))
    coded = coded.withColumn("_label", key)
    total = F.sum(F.col("error").cast("decimal(38,0)")).try_cast("long")
    labels = coded.groupBy("_label").agg(total.alias("label_error"))
    return lookup_join(coded, labels, ["_label"]).select(
        F.col("id").alias(id_col), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )
