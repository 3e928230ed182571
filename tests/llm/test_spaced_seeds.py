import random
import re

import pytest

from modelweave.llm.spaced_seeds import LEAST, SHARE, WINDOW, decontaminate, leaks
from tests.llm.cases import documents, edge_documents, no_documents


def words_of(text):
    return [w for w in re.split("[\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower()) if w]


def brute(docs, items):
    """All alignments of all pairs that share a word, compared in place."""
    out = set()
    split = {i: words_of(t) for i, t in items}
    for d, text in docs:
        if d is None:
            continue
        words = words_of(text)
        places = {}
        for p, w in enumerate(words):
            places.setdefault(w, []).append(p)
        for i, item in split.items():
            if len(item) < LEAST:
                continue
            for shift in {p - k for k, w in enumerate(item) for p in places.get(w, ())}:
                equal = [0 <= shift + k < len(words) and words[shift + k] == w for k, w in enumerate(item)]
                width = min(WINDOW, len(item))
                best = max(sum(equal[k:k + width]) for k in range(len(item) - width + 1))
                if sum(equal) >= SHARE * len(item) or best >= SHARE * width:
                    out.add((d, i))
    return out


def found(docs, items, **given):
    return {(r.doc_id, r.item_id) for r in leaks(docs, items, **given).collect()}


def test_documents(spark, small):
    docs, items = documents(spark, small), spark.read.parquet(f"{small}/benchmark.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()]
    assert found(docs, items) == brute(*rows)
    # the way without broadcasts finds the same
    assert found(docs, items, broadcast_seeds=0) == found(docs, items)


@pytest.fixture(scope="module")
def planted():
    random.seed(8)
    vocabulary = [f"v{i}" for i in range(3000)]
    items = [(i, " ".join(random.choices(vocabulary, k=random.randint(16, 50)))) for i in range(40)]
    docs = []
    for i, text in items:
        words = text.split()
        for k, word in enumerate(words):  # an eighth of the words is substituted
            if k % 8 == i % 8:
                words[k] = f"other{i}{k}"
        docs.append((i, " ".join([*random.choices(vocabulary, k=60), *words, *random.choices(vocabulary, k=60)])))
        docs.append((100 + i, " ".join([*random.choices(vocabulary, k=80), *text.split()[3:9]])))  # a short phrase
    return docs, items


def test_substituted_words_are_found_and_short_phrases_are_not(spark, planted):
    docs, items = planted
    frames = (spark.createDataFrame(docs, "doc_id long, text string"),
              spark.createDataFrame(items, "item_id long, text string"))
    assert found(*frames) == brute(docs, items) == {(i, i) for i, _ in items}
    assert {r.doc_id for r in decontaminate(*frames).collect()} == {d for d, _ in docs if d >= 100}


def test_awkward_rows(spark):
    docs = edge_documents(spark)
    items = spark.createDataFrame(
        [(1, "this LINE of more-than forty characters; stands in many documents"), (2, None), (3, ""), (4, "a b c"),
         (1, "this line of more than forty characters stands in many documents"), (None, "word " * 20)],
        "item_id long, text string",
    )
    got = found(docs, items)
    assert {d for d, i in got if i == 1} == {9, 10, 20, 21, 22, 23, 24, 25}
    assert {d for d, i in got if i is None} <= {4, 5}
    kept = decontaminate(docs, items)
    assert kept.columns == docs.columns
    assert None in {r.doc_id for r in kept.collect()}
    assert found(no_documents(spark), items) == set()
    assert decontaminate(docs, items.filter("false")).count() == docs.count()


def test_no_python_in_the_plan(spark, small):
    plan = leaks(documents(spark, small), spark.read.parquet(f"{small}/benchmark.parquet"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert not [bad for bad in ("Python", "Pandas", "InArrow", "CartesianProduct") if bad in text]


def test_short_items_are_found_word_for_word(spark):
    items = [(1, "What is a seed?"), (2, "yes"), (3, "one two three four five six"), (4, "one two three four five")]
    docs = [(1, "he asked: what IS a seed"), (2, "what is the seed, yes"), (3, "one two three four five other six"),
            (4, "zero one two three four five six seven"), (5, "yesterday")]
    frames = (spark.createDataFrame(docs, "doc_id long, text string"),
              spark.createDataFrame(items, "item_id long, text string"))
    want = {(1, 1), (2, 2), (3, 4), (4, 3), (4, 4)}
    assert found(*frames) == found(*frames, broadcast_seeds=0) == want
    assert {r.doc_id for r in decontaminate(*frames).collect()} == {5}
