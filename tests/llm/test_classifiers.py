"""Quality and toxicity: held-out accuracy, learning rules, awkward rows."""

import random
import zlib

import numpy as np
import pytest

from modelweave.llm import quality, toxicity
from tests.llm.cases import edge_documents, no_documents


def auc(score, label):
    rank = np.empty(len(score))
    rank[np.argsort(score)] = np.arange(len(score))
    good = label == 1
    return (rank[good].mean() - (good.sum() - 1) / 2) / (~good).sum()


@pytest.mark.parametrize("module,label,folder,least", [
    (quality, "quality", "/root/testdata/sf0.01", 0.95), (toxicity, "toxic", "/root/testdata/sf0.1", 0.98),
])
def test_held_out_accuracy(spark, module, label, folder, least):
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = module.classify(docs, labels).join(labels, "doc_id").collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % module.FOLDS == module.HELD_OUT)
    unseen = [(r.score, r[label]) for r in rows if r.held_out]
    assert auc(*(np.array(c) for c in zip(*unseen, strict=True))) >= least


@pytest.mark.parametrize("module,label", [(quality, "quality"), (toxicity, "toxic")])
def test_held_out_labels_are_not_learnt(spark, module, label):
    """Turning the labels of the held-out fold round changes no score."""
    random.seed(2)
    ids = range(60)
    docs = spark.createDataFrame([(i, " ".join(random.choices("abcdefgh", k=30)), "s") for i in ids],
                                 "doc_id long, text string, source string")
    scores = []
    for turned in (False, True):
        rows = []
        for i in ids:
            held = zlib.crc32(str(i).encode()) % module.FOLDS == module.HELD_OUT
            rows.append((i, (i % 2) ^ int(held and turned)))
        labels = spark.createDataFrame(rows, f"doc_id long, {label} int")
        scores.append({r.doc_id: r.score for r in module.classify(docs, labels).collect()})
    assert scores[0] == scores[1]


@pytest.mark.parametrize("module,label", [(quality, "quality"), (toxicity, "toxic")])
def test_awkward_rows(spark, module, label):
    docs = edge_documents(spark)
    labels = spark.createDataFrame([(1, 0), (1, None), (2, 1), (4, 1), (4, 0), (None, 1), (20, 0), (999, 1)],
                                   f"doc_id long, {label} int")
    rows = module.classify(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    same = {r.score for r in rows if r.doc_id in (2, 3, 8)}  # no words: the bias alone
    assert len(same) == 1
    assert len({r.score for r in rows if r.doc_id == 5}) == 1
    assert all(r.held_out is False for r in rows if r.doc_id is None)
    assert module.classify(no_documents(spark), labels).count() == 0
    unlabelled = module.classify(docs, labels.filter("false")).collect()
    assert {r.score for r in unlabelled} == {0.5}
    model = module.train(docs, labels)
    assert module.score_documents(docs.drop("score"), model).columns == [*docs.drop("score").columns, "score"]


def test_pair_that_is_toxic_only_together():
    """The machine learns a pair of words that no sum of single weights can tell."""
    random.seed(4)
    filler = [f"w{i}" for i in range(30)]
    texts, labels = [], []
    for i in range(1200):
        insult, group = random.random() < 0.5, random.random() < 0.5
        words = random.choices(filler, k=8) + ["insultx"] * insult + ["groupy"] * group
        random.shuffle(words)
        texts.append(" ".join(words).encode())
        labels.append(int(insult and group))
    model = np.frombuffer(toxicity.fit(texts, np.array(labels, float)), np.float32)
    model = model.reshape(toxicity.BUCKETS + 1, -1).astype(float)
    both, one, other = toxicity.margins(model, [b"w1 insultx groupy", b"w1 insultx", b"w1 groupy"])
    additive = model.copy()
    additive[:, 1:] = 0
    base = toxicity.margins(model, [b"w1"])[0]
    assert both > 2 > max(one, other)
    assert both - base > (one - base) + (other - base) + 0.5  # more than the sum of the parts
    assert toxicity.margins(additive, [b"w1 insultx groupy"])[0] < both


def test_training_step_is_the_published_rule():
    """One text, one pass: weights follow the closed form of the proximal rule."""
    texts = [b"alpha beta"]
    got = np.frombuffer(quality.fit(texts, np.array([1.0])), np.float32)
    z, n = np.zeros(quality.BUCKETS + 1), np.zeros(quality.BUCKETS + 1)
    (index, value), = quality._rows(texts)
    index, value = np.append(index, quality.BUCKETS), np.append(value, 1.0)
    for _ in range(quality.EPOCHS):
        w = np.zeros(len(index))
        for k, i in enumerate(index):
            if abs(z[i]) > quality.L1:
                w[k] = -(z[i] - np.sign(z[i]) * quality.L1) / (
                    (quality.BETA + n[i] ** 0.5) / quality.ALPHA + quality.L2
                )
        p = 1 / (1 + np.exp(-(w @ value)))
        for k, i in enumerate(index):
            g = (p - 1) * value[k]
            sigma = ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / quality.ALPHA
            z[i] += g - sigma * w[k]
            n[i] += g * g
    expected = np.where(
        np.abs(z) <= quality.L1, 0,
        -(z - np.sign(z) * quality.L1) / ((quality.BETA + np.sqrt(n)) / quality.ALPHA + quality.L2),
    )
    assert np.allclose(got, expected, atol=1e-5)
