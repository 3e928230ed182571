"""Approximate nearest neighbours by inner product, with a permutation index.

``PIVOTS`` vectors, picked by a hash of their content, see every vector: the order of the pivots by nearness
is the vector's permutation. In each block of vectors the permutations are posted in an inverted file, one
list per pivot with the place the pivot takes in each vector's order. A query adds up over its pivots the
difference between its own place for the pivot and the posted ones (Spearman's footrule), and the vectors
with the smallest sums, ``SHARE`` of the block (at least ``LEAST``), are ranked again by the exact inner
product in double precision, summed component by component. The best of all blocks are the result.

So that large norms count, vectors are lifted before they are seen by the pivots: a component makes all of
the largest norm, and a query has 0 there; the nearest lifted vector is the one of largest inner product.
For the pivots all components are divided by the largest of the table, so no square is lost or infinite.

Blocks of queries meet blocks of vectors by an equi-join on the pair of block numbers; a cell holds at most
about ``BLOCK`` of each, however many there are.

Defined results: vectors that are null, zero, hold null or non-finite components, or are of another length
than most, take no part, neither do rows without id. A query's own id is no candidate. Equal scores go to
the smaller id; rows of one id are separate candidates. A vector is zero if all its components are; scores
beyond the largest double are infinite, and those that are no number come last. An empty table gives no rows; with fewer candidates
than ``k``, all are returned.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from modelweave.llm.common import written

PIVOTS = 128
SHARE = 0.05
LEAST = 256
BLOCK = 8192


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v array<double>) of the vectors that take part."""
    v = F.col("v")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(
        vectors[id_col].cast("long").alias("id"), vectors[vector_col].cast("array<double>").alias("v")
    )
    return rows.filter(
        F.col("id").isNotNull() & v.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(v, lambda x: x != 0)
    )


def pick_pivots(rows: DataFrame, pivots: int) -> np.ndarray:
    """At most ``pivots`` distinct vectors, those of lowest hash."""
    lowest = (
        rows.groupBy(F.xxhash64("v").alias("hash")).agg(F.min("id").alias("id")).orderBy("hash").limit(pivots)
    )
    found = rows.join(F.broadcast(lowest), "id").filter(F.xxhash64("v") == F.col("hash"))
    by_hash = {r["hash"]: r["v"] for r in found.dropDuplicates(["hash"]).select("hash", "v").collect()}
    return np.array([by_hash[h] for h in sorted(by_hash)])


def _seen(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The place of every pivot in each vector's order; equal vectors have equal places."""
    near = np.einsum("ij,kj->ik", x, pivots)  # not by a block product, which rounds by place
    order = np.argsort(-near, axis=1, kind="stable")
    places = np.empty_like(order, dtype=np.int16)
    np.put_along_axis(places, order, np.arange(len(pivots), dtype=np.int16)[None, :], axis=1)
    return places


def _matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(values.flatten(), dtype=np.float64).reshape(rows, -1)


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
    pivots: int = PIVOTS, share: float = SHARE, block: int = BLOCK,
) -> DataFrame:
    """(query_id, rank, id, score): for each row where ``is_query`` (of column ``id``) holds, the ``k`` found."""
    rows = usable(vectors, id_col, vector_col)
    out_schema = f"query_id long, `{id_col}` long, score double"
    largest = F.array_max(F.transform("v", F.abs))
    sizes = rows.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n"), F.max(largest).alias("unit"))
    most = sizes.orderBy(F.desc("n"), "dim").first()
    spark = vectors.sparkSession
    if most is None:
        return spark.createDataFrame([], f"query_id long, rank int, `{id_col}` long, score double")
    rows = written(rows.filter(F.size("v") == most["dim"]), "vectors")
    unit = most["unit"]
    pivot = pick_pivots(rows, pivots) / unit
    norm2 = F.aggregate("v", F.lit(0.0), lambda a, x: a + (x / unit) * (x / unit))
    top = rows.agg(F.max(norm2)).first()[0]
    lifted = np.hstack([pivot, np.sqrt(np.maximum(top - (pivot**2).sum(1, keepdims=True), 0))])
    shared = spark.sparkContext.broadcast(lifted)  # at most ``pivots`` vectors
    queries = rows.filter(is_query)
    n_queries = queries.count()
    groups, blocks = -(-int(most["n"]) // block), max(1, -(-n_queries // block))

    def dealt(of: DataFrame, own: int, others: int, own_first: bool) -> DataFrame:
        part = F.pmod(F.xxhash64("id"), F.lit(own)).cast("long")
        other = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(others - 1).cast("long")))
        of = of.select("id", "v", part.alias("own"), other.alias("other"))
        row, column = ("own", "other") if own_first else ("other", "own")
        # Columns of their own for each side: both come from one table, and a cogroup would take them for the same.
        return of.select(
            (F.col(row) * max(blocks, 1) + F.col(column)).alias("cell"), F.col("id").alias("id"), F.col("v").alias("v")
        )

    def cell(data: pa.Table, asked: pa.Table) -> pa.Table:
        out = []
        if data.num_rows and asked.num_rows:
            p = shared.value
            ids = np.asarray(data.column("id"), dtype=np.int64)
            x = _matrix(data.column("v"), len(ids))
            order = np.argsort(ids, kind="stable")
            ids, x = ids[order], x[order]
            scaled = x / unit
            rest = np.sqrt(np.maximum(top - (scaled**2).sum(1, keepdims=True), 0))
            postings = np.ascontiguousarray(_seen(np.hstack([scaled, rest]), p).T)  # one list of places per pivot
            asked_ids = np.asarray(asked.column("id"), dtype=np.int64)
            q = _matrix(asked.column("v"), len(asked_ids))
            places = _seen(np.hstack([q / unit, np.zeros((len(q), 1))]), p)
            many = min(len(ids), max(LEAST, k + 1, int(np.ceil(share * len(ids)))))
            tie = np.arange(len(ids))
            for qid, vector, place in zip(asked_ids, q, places, strict=True):
                footrule = np.zeros(len(ids), np.int32)
                for posted, at in zip(postings, place, strict=True):
                    footrule += np.abs(posted - at)
                key = footrule.astype(np.int64) * len(ids) + tie
                found = np.argpartition(key, many - 1)[:many] if many < len(ids) else tie
                found = found[ids[found] != qid]
                with np.errstate(over="ignore", invalid="ignore"):
                    score = np.cumsum(x[found] * vector, axis=1)[:, -1]  # summed from the first component on
                best = np.lexsort((ids[found], -score))[:k]
                out.append((np.full(len(best), qid), ids[found][best], score[best]))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [[], [], []]
        return pa.table(
            [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64()), strict=True)],
            names=["query_id", id_col, "score"],
        )

    found = (
        dealt(rows, groups, blocks, True).groupBy("cell")
        .cogroup(dealt(queries, blocks, groups, False).groupBy("cell")).applyInArrow(cell, out_schema)
    )
    best = Window.partitionBy("query_id").orderBy(F.isnan("score"), F.desc("score"), F.col(id_col))
    ranked = found.withColumn("rank", F.row_number().over(best).cast("int")).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", id_col, "score")
