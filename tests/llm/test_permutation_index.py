import numpy as np

from modelweave.llm.permutation_index import nearest
from pyspark.sql import functions as F


def brute(rows, is_query, k):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], float)
    out = {}
    for q in sorted({int(i) for i in ids if is_query(i)}):
        score = np.cumsum(x * x[ids == q][0], axis=1)[:, -1]
        keep = ids != q
        order = np.lexsort((ids[keep], -score[keep]))[:k]
        out[q] = list(zip(ids[keep][order].tolist(), score[keep][order].tolist(), strict=True))
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_recall_and_exact_scores(spark, small):
    table = spark.read.parquet(f"{small}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    expected = brute(rows, lambda i: i % 20 == 0, 20)
    for block in (8192, 100):  # one cell, and several blocks of queries and vectors
        got = found(nearest(table, F.col("id") % 20 == 0, block=block))
        assert set(got) == set(expected)
        hits = sum(len({i for i, _ in got[q]} & {i for i, _ in expected[q]}) for q in got)
        assert hits >= 0.95 * sum(map(len, expected.values()))
        scores = {(q, i): s for q in expected for i, s in brute(rows, lambda i, q=q: i == q, 10**6)[q]}
        assert all(scores[q, i] == s for q in got for i, s in got[q])


def test_large_norms_are_found(spark):
    random = np.random.default_rng(3)
    x = random.normal(size=(600, 8)) * random.exponential(1.0, size=(600, 1))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got, expected = found(nearest(table, F.col("id") % 60 == 0, k=10)), brute(rows, lambda i: i % 60 == 0, 10)
    hits = sum(len(dict(got[q]).keys() & dict(expected[q]).keys()) for q in expected)
    assert hits >= 0.9 * sum(map(len, expected.values()))


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [float(i % 7), 1.0, float(i % 3)]) for i in range(1, 40)]
    rows = [*good, (100, None), (101, []), (102, [0.0, 0.0, 0.0]), (103, [1.0, None, 2.0]), (104, [nan, 1.0, 1.0]),
            (105, [inf, 1.0, 1.0]), (106, [1.0, 2.0]), (None, [9.0, 9.0, 9.0]), (0, [1.0, 1.0, 1.0])]
    table = spark.createDataFrame([(*r, 1, 1) for r in rows], "vec_id long, embedding array<double>, id int, v int")
    whole = [*good, (0, [1.0, 1.0, 1.0])]
    got = found(nearest(table, F.col("id") % 20 == 0, k=50))
    assert got == brute(whole, lambda i: i % 20 == 0, 50)  # few rows: all are ranked, ties by id
    assert nearest(table.filter("false"), F.col("id") >= 0).count() == 0
    assert nearest(table.filter("vec_id = 100"), F.col("id") >= 0).count() == 0
    assert nearest(table, F.col("id") < 0).count() == 0


def test_many_equal_vectors(spark):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(700)] + [(700 + i, [float(i), 1.0, 0.0]) for i in range(30)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = found(nearest(table, F.col("id") % 350 == 0, k=5, block=200))
    assert [i for i, _ in got[350]] == [i for i, _ in brute(rows, lambda i: i == 350, 5)[350]]


def test_magnitudes_do_not_change_the_neighbours(spark):
    random = np.random.default_rng(5)
    x = random.normal(size=(900, 8)) * random.exponential(1.0, size=(900, 1))

    def near(power):
        rows = [(i, v.tolist()) for i, v in enumerate(x * 2.0**power)]
        table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        return found(nearest(table, F.col("id") % 90 == 0, k=7, share=0.1, block=500))

    plain = near(0)
    for power in (500, -500):  # squares of the norms are far beyond, or below, what the pivots could tell
        assert near(power) == {q: [(i, s * 2.0 ** (2 * power)) for i, s in of] for q, of in plain.items()}


def test_tiny_vectors_count_and_endless_scores_have_an_order(spark):
    rows = [(0, [1e-200, 0.0]), (1, [1e200, 1e200]), (2, [3e-200, 1.0]), (3, [1e300, -1e300]), (4, [0.0, -0.0]),
            (5, [2.0, 5e-324]), (20, [1e300, 1e300])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = found(nearest(table, F.col("id") % 20 == 0, k=10))
    assert set(got) == {0, 20}
    assert got[0] == [(3, 1e300 * 1e-200), (20, 1e300 * 1e-200), (1, 1e200 * 1e-200), (5, 2e-200), (2, 0.0)]
    infinite = float("inf")
    assert got[20][:4] == [(1, infinite), (5, 2e300), (2, 1e300), (0, 1e100)]
    assert got[20][4][0] == 3 and np.isnan(got[20][4][1]) and len(got[20]) == 5
