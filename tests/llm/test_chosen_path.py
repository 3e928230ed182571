import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from corpus_pipeline import near_deduplication
from modelweave.llm import chosen_path
from tests.llm.cases import documents, edge_documents, no_documents


def sets_of(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[k:k + 5]) for k in range(len(words) - 4)}


def brute(rows, per_cent=85):
    sets = {i: sets_of(t) for i, t in rows if i is not None}
    holders = defaultdict(set)
    for i, s in sets.items():
        for x in s:
            holders[x].add(i)
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, s in sets.items():
        for j, common in Counter(j for x in s for j in holders[x] if j < i).items():
            if 100 * common >= per_cent * (len(s) + len(sets[j]) - common):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return Counter((i, len(sets_of(t)), None if i is None else find(i)) for i, t in rows)


def found(docs, **given):
    rows = chosen_path.components(docs, **given).collect()
    assert all(r.kept == (r.component_id in (None, r.doc_id)) for r in rows)
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in rows)


def test_documents(spark, small):
    docs = documents(spark, small)
    assert found(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_awkward_rows(spark):
    docs = edge_documents(spark)
    assert found(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])
    assert found(no_documents(spark)) == Counter()


def test_large_groups_and_shared_passages(spark, monkeypatch):
    """Groups larger than a small node: near copies of one text, chains, and texts that share much but not enough."""
    monkeypatch.setattr(chosen_path, "SMALL", 4)
    random.seed(7)
    words = [f"w{i}" for i in range(500)]
    base = random.choices(words, k=120)
    rows = []
    for i in range(60):  # near copies of one text
        text = list(base)
        text[random.randrange(120)] = f"edit{i}"
        rows.append((i, " ".join(text)))
    chain = random.choices(words, k=300)
    for i in range(25):  # each close to the next, the ends far apart
        chain[i * 5] = f"chain{i}"
        rows.append((100 + i, " ".join(chain)))
    loose = random.choices(words, k=150)
    for i in range(50):  # copies of one text that are links of some others only
        text = list(loose)
        for _ in range(random.randint(1, 4)):
            text[random.randrange(150)] = f"loose{i}"
        rows.append((300 + i, " ".join(text)))
    passage = random.choices(words, k=60)
    rows += [(200 + i, " ".join(passage + random.choices(words, k=40))) for i in range(40)]  # one passage, else apart
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(docs) == brute(rows)
    kept = {r.doc_id for r in chosen_path.dedup(docs).collect()}
    assert {i for i in kept if i < 60} == {0} and {i for i in kept if 100 <= i < 200} == {100}


@pytest.mark.parametrize("few", [0, 6, 200_000])
def test_merging_components(spark, monkeypatch, few):
    monkeypatch.setattr(chosen_path, "FEW_LINKS", few)
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 20)] + [(50, 40), (60, 61)], "a long, b long")
    parts = chosen_path.merge_components(None, links)
    more = spark.createDataFrame([(20, 40), (70, 61), (5, 6)], "a long, b long")
    parts = {r.node: r.part for r in chosen_path.merge_components(parts, more).collect()}
    assert parts == {**{i: 1 for i in range(1, 21)}, 40: 1, 50: 1, 60: 60, 61: 60, 70: 60}


def test_other_similarities(spark, small):
    members = spark.range(4000).select(F.xxhash64("id").alias("path"), F.col("id").alias("node"), F.lit(bytes(256)).alias("sketch"))
    for per_cent in (80, 50):  # 1 / similarity slots on average
        assert abs(chosen_path._children(members, per_cent).count() / 4000 - 100 / per_cent) < 0.03
    docs = documents(spark, small)
    given = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute(given, 80)
    assert found(docs, similarity=80) == want != brute(given)
    kept = {r.doc_id for r in near_deduplication(spark, docs, small, similarity=80).collect()}
    assert kept == {i for i, _, part in want if i == part}


def test_settling_compares_in_all_nodes(spark):
    """A copy that shares only the smallest of a document's five nodes, beside others that are unrelated."""
    random.seed(11)
    text = random.choices([f"w{i}" for i in range(500)], k=100)
    rows = [(i, " ".join(random.choices([f"u{i}" for i in range(500)], k=100))) for i in range(2, 40)]
    rows += [(1, " ".join(text)), (50, " ".join([*text, "edit"]))]
    members = [
        (path, node, part, 1 + len(others), others[0], 1)
        for path, others in ((1, range(2, 12)), (2, range(12, 20)), (3, range(20, 27)), (4, range(27, 33)))
        for node, part in [(1, 1), *((n, others[0]) for n in others)]
    ]
    members += [(5, 1, 1, 2, 50, 1), (5, 50, 50, 2, 50, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    join = chosen_path.Join(docs, None, "doc_id", "text", 85)
    join.settle(spark.createDataFrame(members, "path long, node long, part long, size long, main long, outside long"))
    assert {(r.node, r.part) for r in join.parts.collect()} == {(1, 1), (50, 1)}


def test_candidates_are_confirmed_whatever_their_sketches(spark):
    text = " ".join(f"w{i}" for i in range(100))
    docs = spark.createDataFrame([(1, text), (2, text + " edit"), (3, "short text")], "doc_id long, text string")
    nodes = spark.createDataFrame(
        [(1, 96, bytes(256)), (2, 97, bytes([1]) * 256), (3, 1, bytes(256))], "node long, n long, sketch binary"
    )
    join = chosen_path.Join(docs, nodes, "doc_id", "text", 85)
    join.compare(spark.createDataFrame([(1, 2), (1, 3)], "a long, b long"))
    assert [(r.a, r.b) for r in join.tried.collect()] == [(1, 2)]
    assert {(r.node, r.part) for r in join.parts.collect()} == {(1, 1), (2, 1)}


def test_a_row_is_dropped_by_its_own_text(spark):
    """An id with two texts: a copy of a smaller document goes, the text that nothing stands for stays."""
    texts = ["one text that stands twice in the table", "another text that stands in it once only"]
    rows = [(1, texts[0]), (2, texts[0]), (2, texts[1])]
    kept = chosen_path.dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(1, texts[0]), (2, texts[1])]


def test_texts_of_one_id_are_nodes_of_their_own(spark):
    """A near copy beside an unrelated text of the same id: the copy goes, the other stays, whichever is longer."""
    random.seed(5)
    a = " ".join(random.choices([f"a{i}" for i in range(300)], k=80))
    for size in (30, 200):
        b = " ".join(random.choices([f"b{i}" for i in range(300)], k=size))
        rows = [(1, a), (2, a + " more"), (2, b), (3, "something else that stands alone"), (0, " ".join(random.choices([f"c{i}" for i in range(300)], k=90)))]
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        kept = {(r.doc_id, r.text) for r in chosen_path.dedup(docs).collect()}
        assert kept == {rows[0], rows[2], rows[3], rows[4]}
        parts = Counter((r.doc_id, r.component_id) for r in chosen_path.components(docs).collect())
        assert parts == Counter([(1, 1), (2, 1), (2, 2), (3, 3), (0, 0)])
