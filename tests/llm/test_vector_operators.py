"""Centroid clustering and product codes against plain loops."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from modelweave.llm import dual_tree, heap_clusters, vectors

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, embedding array<double>, label int, id long, v int, cluster int, code string, n long"


def table(spark, rows):
    return spark.createDataFrame([(*r, 0, 0, 0, "x", 0) for r in rows], SCHEMA).coalesce(2)


def made(n, dims, seed, spread=1.0):
    random = np.random.default_rng(seed)
    centres = random.normal(size=(6, dims))
    x = centres[random.integers(0, 6, n)] + spread * random.normal(size=(n, dims))
    return [(i, v.tolist(), None if i % 5 == 0 else i % 3) for i, v in enumerate(x)]


def usable(rows, dims):
    return [r for r in rows if r[1] is not None and len(r[1]) in dims
            and all(x is not None and np.isfinite(x) and abs(x) <= 2**27 for x in r[1])]


def floors(points, scale):
    return np.floor(np.array(points, float) * scale).astype(np.int64)


def lloyd(points, centres, rounds):
    """Plain rounds in integers; the last assignment and the centres."""
    for _ in range(rounds):
        near = [int(((centres - p) ** 2).sum(1).argmin()) for p in points]
        for c in range(len(centres)):
            mine = points[[n == c for n in near]]
            if len(mine):
                centres[c] = [int(s) // len(mine) for s in mine.sum(0)]
    far = np.stack([((centres - p) ** 2).sum(1) for p in points])
    return far.argmin(1), far.min(1), centres


def brute_clusters(rows, k, rounds, scale, dims):
    kept = usable(rows, [dims])
    starts = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), i, v) for i, v, _ in kept if i is not None)[:k]
    points = floors([v for _, v, _ in kept], scale)
    near, far, centres = lloyd(points, floors([v for _, _, v in starts], scale), rounds)
    inertia = np.bincount(near, far, k).astype(int)
    names = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centres]
    return Counter((i, int(c), int(d), int(inertia[c]), int(far.sum()), names[c])
                   for (i, _, _), c, d in zip(kept, near, far, strict=True))


def brute_codes(rows, parts, entries, rounds, scale, dims):
    kept = usable(rows, [dims])
    starts = sorted((i, v) for i, v, _ in kept if i is not None)[:entries]
    points, first = floors([v for _, v, _ in kept], scale), floors([v for _, v in starts], scale)
    codes, error, books = [""] * len(kept), np.zeros(len(kept), int), []
    for p in range(parts):
        cut = slice(p * dims // parts, (p + 1) * dims // parts)
        near, far, book = lloyd(points[:, cut], first[:, cut].copy(), rounds)
        codes = [c + f"{n:02x}" for c, n in zip(codes, near, strict=True)]
        error += far
        books += book.ravel().tolist()
    by_label = defaultdict(int)
    for (_, _, label), e in zip(kept, error, strict=True):
        by_label[label] += int(e)
    digest = hashlib.sha256(",".join(map(str, books)).encode()).hexdigest()
    return Counter((i, c, int(e), by_label[label], digest)
                   for (i, _, label), c, e in zip(kept, codes, error, strict=True))


def awkward(dims):
    one, two = [1.0] * dims, [-0.51] * dims
    return [
        (1, one, 1), (1, one, 1), (1, two, None), (None, two, 2), (2, None, 1), (3, [], 1), (4, [None] + one[1:], 1),
        (5, [NAN] + one[1:], 1), (6, [INF] + one[1:], 1), (7, one[1:], 1), (8, [0.0] * dims, None), (9, [-0.0] * dims, 2),
        (10, [1e30] + one[1:], 1), (11, [2.0**14] * dims, 3), (12, [-(2.0**14)] * dims, 3), (13, [2.0**14 - 1] * dims, 3),
        *[(20 + i, one, 1) for i in range(300)], *[(400 + i, [i / 7 - 3.0] * dims, i % 2) for i in range(50)],
    ]


@pytest.mark.parametrize("block", [4096, 64])
def test_clusters_equal_plain_rounds(spark, monkeypatch, block):
    monkeypatch.setattr(heap_clusters, "BLOCK", block)
    for rows, k, rounds in ((made(700, 8, 1), 16, 6), (awkward(8), 5, 3), (made(40, 8, 2), 3, 0), (made(9, 8, 3), 16, 2)):
        got = heap_clusters.cluster(table(spark, rows), k, rounds, 64, 8).collect()
        assert Counter(map(tuple, got)) == brute_clusters(rows, k, rounds, 64, 8)


@pytest.mark.parametrize("block", [4096, 64])
def test_codes_equal_plain_rounds(spark, monkeypatch, block):
    monkeypatch.setattr(dual_tree, "BLOCK", block)
    for rows, parts, entries, rounds in (
        (made(700, 8, 1, 0.1), 4, 16, 6), (awkward(8), 2, 5, 3), (made(40, 8, 2), 8, 16, 0), (made(9, 8, 3), 1, 16, 2),
    ):
        rows = [r for r in rows if r[1] is None or None in r[1] or all(abs(x) <= 2**15 or not np.isfinite(x) for x in r[1])]
        got = dual_tree.compress(table(spark, rows), parts, entries, rounds, 4096).collect()
        assert Counter(map(tuple, got)) == brute_codes(rows, parts, entries, rounds, 4096, 8)


def test_no_vectors(spark):
    for rows in ([(1, None, 1)], [(None, [1.0] * 64, 1)]):
        given = table(spark, rows)
        for df in (given, given.filter("false")):
            assert heap_clusters.cluster(df).collect() == []
            assert dual_tree.compress(df).collect() == []


def test_only_expired_vectors_are_rescanned():
    points = vectors.wide(*vectors.narrow(floors([v for _, v, _ in made(3000, 16, 5, 0.2)], 64)), 3000, 16)
    centres = points[:6].copy()
    block, spent = heap_clusters.Block(points, 6), np.zeros(6)
    block.assign(centres, spent)
    assert block.rescanned == 3000
    rescans = []
    for _ in range(8):
        far = vectors.squared(points, centres)
        assert (block.cluster == far.argmin(1)).all()
        assert (block.counts == np.bincount(block.cluster, minlength=6)).all()
        moved = np.array([block.sums[c] // max(n, 1) if n else centres[c] for c, n in enumerate(block.counts)])
        spent = spent + heap_clusters._drift(centres, moved)
        centres = moved
        block.assign(centres, spent)
        rescans.append(block.rescanned)
    assert rescans[-1] < 300 and sum(rescans) < 0.5 * 8 * 3000
    for heap, n in zip(block.heaps, block.counts, strict=True):
        assert len(heap) == n
        assert all(heap[(i - 1) // 2] <= heap[i] for i in range(1, len(heap)))


def test_whole_ranges_are_assigned_by_their_sums():
    points = floors([v for _, v, _ in made(4000, 4, 7, 0.02)], 4096)
    tree, order = dual_tree.PointTree.of(points)
    book = points[[int(np.flatnonzero((points == p).all(1))[0]) for p in points[:16]]]
    sums, counts, chosen, single = dual_tree.assign(tree, dual_tree.EntryTree(book))
    far = np.stack([((book - p) ** 2).sum(1) for p in tree.points])
    assert (chosen == far.argmin(1)).all()
    assert (counts == np.bincount(chosen, minlength=16)).all()
    for c in range(16):
        assert (sums[c] == tree.points[chosen == c].sum(0)).all()
    assert single < 4000  # some ranges were taken whole
    assert sorted(order.tolist()) == list(range(4000))


def test_ties_go_to_the_lower_entry():
    tree, _ = dual_tree.PointTree.of(np.array([[0], [5], [10], [5], [5]] * 30))
    _, counts, _, _ = dual_tree.assign(tree, dual_tree.EntryTree(np.array([[10], [0], [0], [10]])))
    assert counts.tolist() == [120, 30, 0, 0]


def test_distances_are_exact_for_large_components():
    points = np.array([[2**27, -(2**27)], [2**27 - 1, 3], [0, 0]])
    assert vectors.squared(points, points).tolist() == [
        [sum((int(a) - int(b)) ** 2 for a, b in zip(p, q, strict=True)) for q in points] for p in points
    ]
