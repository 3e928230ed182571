"""Centroid clustering by Lloyd's rounds with heap-ordered bounds.

Vectors stand in blocks of ``BLOCK``, each a row of a table. A block keeps, for every cluster, a heap of its
vectors by gap: how much farther the second nearest centroid is than the own one. When centroids move, a gap
shrinks by at most the drift of the own centroid plus the largest drift of any other; instead of lowering all
gaps, this is added up in one number per cluster, and a gap is pushed with that number's value of the time on
top. A round pops from each heap the vectors whose gap is used up and computes only their distances to all
centroids again; all others cannot have changed. Distances, sums and centroids are integers, bounds are doubles
and expire ``SLACK`` early, which is far more than their rounding.

A round writes the blocks anew to the shared folder, with their sums by cluster, which only moved vectors change.
What reaches the driver is the sum over all blocks, as many numbers as the centroids have.

Defined results: a vector counts if it has exactly ``dims`` components, none null, non-finite or beyond 2^27 when
scaled (its squared distance would not fit a long). Rows of one id are vectors of their own; a row without
id counts, but starts no centroid. Equal hashes at the start go by id, then vector. With fewer vectors than ``k``,
there are as many centroids. Ties go to the centroid of smaller number, a centroid without vectors stays. Sums of
distances that no long holds are null. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelweave.llm.common import discard, written
from modelweave.llm.vectors import BLOCK, as_long, finite, integers, narrow, one_list, squared, summed, wide

K, ROUNDS, SCALE, DIMS = 16, 3, 64, 64
SLACK = 0.01

STATE = (
    "ids array<long>, points binary, kind string, cluster array<int>, gap array<double>, heaped array<int>,"
    " counts array<long>, sums array<long>, distance array<long>, inertia array<long>, rescanned long"
)


class Block:
    """Vectors with their clusters and one heap of (gap, vector) per cluster."""

    def __init__(self, points: np.ndarray, k: int):
        self.points = points
        self.cluster = np.full(len(points), -1)
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in range(k)]
        self.counts, self.sums = np.zeros(k, np.int64), np.zeros((k, points.shape[1]), np.int64)
        self.rescanned = 0

    def expired(self, spent: np.ndarray) -> np.ndarray:
        """The vectors whose gap is used up, taken off their heaps; vectors without cluster too."""
        out = []
        for heap, used in zip(self.heaps, spent.tolist(), strict=True):
            while heap and heap[0][0] <= used + SLACK:
                out.append(heapq.heappop(heap)[1])
        return np.concatenate((np.array(out, np.int64), np.flatnonzero(self.cluster < 0)))

    def assign(self, centroids: np.ndarray, spent: np.ndarray) -> None:
        """Bring every vector to its nearest centroid."""
        at = self.expired(spent)
        self.rescanned = len(at)
        if not len(at):
            return
        far = squared(self.points[at], centroids)
        best = far.argmin(axis=1)
        if far.shape[1] > 1:
            near = np.sqrt(np.partition(far, 1, axis=1)[:, :2].astype(np.float64))
            gap = near[:, 1] - near[:, 0]
        else:
            gap = np.full(len(at), np.inf)
        old = self.cluster[at]
        moved = old != best
        for of, sign in ((old, -1), (best, 1)):
            changed = moved & (of >= 0)
            np.add.at(self.sums, of[changed], sign * self.points[at[changed]])
            np.add.at(self.counts, of[changed], sign)
        self.cluster[at] = best
        key = gap + spent[best]
        for c in np.unique(best):
            heap, mine = self.heaps[c], best == c
            entries = list(zip(key[mine].tolist(), at[mine].tolist(), strict=True))
            if len(entries) > len(heap) // 4:
                heap += entries
                heapq.heapify(heap)
            else:
                for entry in entries:
                    heapq.heappush(heap, entry)

    def row(self, ids: pa.Array, centroids: np.ndarray, last: bool) -> pa.RecordBatch:
        """As a row of the state table; the distances are filled in at the end only."""
        k = len(self.heaps)
        raw, kind = narrow(self.points)
        entries = [e for heap in self.heaps for e in heap]
        distance, inertia = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if last:
            distance = ((self.points - centroids[self.cluster]) ** 2).sum(axis=1)
            inertia = np.zeros(k, np.int64)
            np.add.at(inertia, self.cluster, distance)
        columns = [
            one_list(ids), pa.array([raw], pa.binary()), pa.array([kind]),
            one_list(pa.array(self.cluster, pa.int32())),
            one_list(pa.array([e[0] for e in entries], pa.float64())),
            one_list(pa.array([e[1] for e in entries], pa.int32())),
            one_list(pa.array(self.counts)), one_list(pa.array(self.sums.ravel())),
            one_list(pa.array(distance)), one_list(pa.array(inertia)), pa.array([self.rescanned], pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(columns, _NAMES)

    @classmethod
    def read(cls, row: dict, k: int) -> Block:
        cluster = np.asarray(row["cluster"].values, dtype=np.int64)
        block = cls(wide(row["points"].as_py(), row["kind"].as_py(), len(cluster), -1), k)
        block.cluster = cluster
        block.counts = np.array(row["counts"].values, dtype=np.int64)
        block.sums = np.array(row["sums"].values, dtype=np.int64).reshape(k, -1)
        gap, heaped = row["gap"].values.to_pylist(), row["heaped"].values.to_pylist()
        at = 0
        for c, n in enumerate(block.counts.tolist()):  # the order of a heap is kept as it is
            block.heaps[c] = list(zip(gap[at:at + n], heaped[at:at + n], strict=True))
            at += n
        return block


_NAMES = [c.strip().split(" ")[0] for c in STATE.split(",")]


def _started(centroids: np.ndarray, scale: int, last: bool):
    """For mapInArrow: from (id, v) to blocks with their first clusters."""
    spent = np.zeros(len(centroids))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                block = Block(integers(part.column(1), part.num_rows, scale), len(centroids))
                block.assign(centroids, spent)
                yield block.row(part.column(0), centroids, last)

    return run


def _continued(centroids: np.ndarray, spent: np.ndarray, last: bool):
    """For mapInArrow: one more round over the blocks."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i] for name in _NAMES}
                block = Block.read(row, len(centroids))
                block.assign(centroids, spent)
                yield block.row(row["ids"].values, centroids, last)

    return run


def first_centroids(kept: DataFrame, k: int, seed: str, scale: int) -> np.ndarray:
    """The ``k`` vectors of smallest hash of their id, scaled."""
    hashed = kept.filter("id is not null").withColumn(
        "hash", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    )
    rows = hashed.orderBy("hash", "id", "v").limit(k).collect()  # ``k`` rows
    return np.floor(np.array([r["v"] for r in rows], np.float64) * scale).astype(np.int64)


def _moved(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The next centroids, from the sums of all blocks."""
    k, dims = centroids.shape
    n, total = [0] * k, [[0] * dims for _ in range(k)]
    for r in summed(state.select(F.posexplode("counts").alias("c", "n")), ["c"], ["n"]):
        n[r["c"]] = int(r["n"])
    for r in summed(state.select(F.posexplode("sums").alias("at", "x")), ["at"], ["x"]):
        total[r["at"] // dims][r["at"] % dims] = int(r["x"])
    return np.array([[x // n[c] for x in total[c]] if n[c] else centroids[c] for c in range(k)], np.int64)


def _drift(old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """How much the gaps of each cluster may have shrunk."""
    drift = np.sqrt(((new - old).astype(np.float64) ** 2).sum(axis=1))
    others = [np.delete(drift, c).max(initial=0) for c in range(len(drift))]
    return drift + np.array(others)


def cluster(
    vectors: DataFrame, k: int = K, rounds: int = ROUNDS, scale: int = SCALE, dims: int = DIMS, seed: str = "1",
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector that counts."""
    spark = vectors.sparkSession
    v = vectors[vector_col].cast("array<double>")
    kept = vectors.select(vectors[id_col].cast("long").alias("id"), v.alias("v")).filter(
        (F.size("v") == dims) & finite(F.col("v"), scale)
    )
    centroids = first_centroids(kept, k, seed, scale)
    if not len(centroids):
        return spark.createDataFrame(
            [], f"`{id_col}` long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        )
    state = written(kept.mapInArrow(_started(centroids, scale, rounds == 0), STATE), "clusters")
    spent = np.zeros(len(centroids))
    for done in range(1, rounds + 1):
        moved = _moved(state, centroids)
        spent = spent + _drift(centroids, moved)
        centroids, before = moved, state
        state = written(before.mapInArrow(_continued(centroids, spent, done == rounds), STATE), "clusters")
        discard(before)
    inertia = [0] * len(centroids)
    for r in summed(state.select(F.posexplode("inertia").alias("c", "x")), ["c"], ["x"]):
        inertia[r["c"]] = int(r["x"])
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    own = F.col("_v.cluster") + 1
    return state.select(F.explode(F.arrays_zip("ids", "cluster", "distance")).alias("_v")).select(
        F.col("_v.ids").alias(id_col), F.col("_v.cluster").alias("cluster"), F.col("_v.distance").alias("distance"),
        F.element_at(F.array(*map(as_long, inertia)), own).alias("cluster_inertia"),
        as_long(sum(inertia)).alias("inertia"),
        F.element_at(F.array(*map(F.lit, digests)), own).alias("centroid_sha256"),
    )
