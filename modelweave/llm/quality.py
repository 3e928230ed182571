"""Quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader.

The words of a text are its white-space words. Each has a spelling (A-Z lower-cased) and a shape: its bytes
as classes (capital, letter, digit, the mark itself), runs of a class once, and whether it repeats the word
before. Terms are the 1- and 2-grams of spellings and the 1- to 3-grams of shapes, hashed to ``BUCKETS``
weights; a term's value is its share of the text's n-grams of that kind, times ``SCALE``. The weights are
trained per coordinate by the proximal follow-the-regularised-leader rule (L1 and L2), one pass over each of
``SHARDS`` shards ``EPOCHS`` times, and averaged. A score is the logistic function of a sparse dot product.

Labels are learnt from at most ``SAMPLE`` labelled rows of the folds that are not held out, chosen by a hash
of their id. Labels, language, source and id are no inputs of a score.

Defined results: a null or empty text has the score of the bias alone. Without a labelled row every
score is 0.5. Repeated rows get equal scores; a null id is held out of training. Other columns are passed
through. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelweave.llm.common import SPACE, Words, mix, span_hashes
from modelweave.llm.training import fold, labelled_sample, scored, trained

BUCKETS = 1 << 18
SAMPLE = 16_000
SHARDS = 4
EPOCHS = 2
SCALE = 10.0
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.02, 0.1
FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3

_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[ord("A"):ord("Z") + 1] = ord("A")
_CLASS[ord("a"):ord("z") + 1] = ord("a")
_CLASS[0x80:] = ord("a")
_CLASS[ord("0"):ord("9") + 1] = ord("0")


def held_out(id_col: Column) -> Column:
    return F.coalesce(fold(id_col, FOLDS) == HELD_OUT, F.lit(False))


def _grams(h: np.ndarray, words: Words, n: int, kind: int) -> tuple[np.ndarray, np.ndarray]:
    """(text index, bucket) of the n-grams of hashes."""
    if len(h) < n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    m = len(h) - n + 1
    out = h[:m] + np.uint64(kind)
    for k in range(1, n):
        out = mix(out) + h[k:k + m]
    inside = words.doc[:m] == words.doc[n - 1:]
    buckets = (mix(out) >> np.uint64(64 - 18)).astype(np.int64)
    return words.doc[:m][inside], buckets[inside]


def terms(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each kind of n-gram, the text index and bucket of every place."""
    words = Words(texts)
    if not len(words.hashes):
        return []
    raw = words.raw
    kinds = _CLASS[raw]
    change = np.ones(len(kinds), bool)
    change[1:] = kinds[1:] != kinds[:-1]
    change &= ~SPACE[raw]
    change[words.starts] = True
    at = np.cumsum(change)
    shapes = span_hashes(kinds[change], at[words.starts] - 1, at[words.ends - 1])
    again = np.zeros(len(shapes), bool)
    again[1:] = (words.hashes[1:] == words.hashes[:-1]) & (words.doc[1:] == words.doc[:-1])
    shapes = np.where(again, mix(shapes + np.uint64(1)), shapes)
    return [
        _grams(words.hashes, words, 1, 1), _grams(words.hashes, words, 2, 2), _grams(shapes, words, 1, 3),
        _grams(shapes, words, 2, 4), _grams(shapes, words, 3, 5),
    ]


def dots(weights: np.ndarray, texts: list[bytes]) -> np.ndarray:
    """Sparse dot products of all texts."""
    out = np.zeros(len(texts))
    for doc, bucket in terms(texts):
        total = np.bincount(doc, weights[bucket], len(texts))
        out += SCALE * total / np.maximum(np.bincount(doc, minlength=len(texts)), 1)
    return out


def logistic(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _rows(texts: list[bytes]):
    """Each text's distinct buckets and their values."""
    kinds = terms(texts)
    sizes = [np.bincount(doc, minlength=len(texts)) for doc, _ in kinds]
    starts = [np.concatenate(([0], np.cumsum(s))) for s in sizes]
    for i in range(len(texts)):
        parts = [b[s[i]:s[i + 1]] for (_, b), s in zip(kinds, starts, strict=True)]
        value = [np.full(len(p), SCALE / max(len(p), 1)) for p in parts]
        if not kinds or not sum(map(len, parts)):
            yield np.zeros(0, np.int64), np.zeros(0)
            continue
        index, back = np.unique(np.concatenate(parts), return_inverse=True)
        yield index, np.bincount(back, np.concatenate(value))


def fit(texts: list[bytes], labels: np.ndarray) -> bytes:
    """Weights of one shard (the last is the bias)."""
    z, n = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)

    def rows():
        for start in range(0, len(texts), 100):  # made again in every pass, so that no more than these are held
            yield from _rows(texts[start:start + 100])

    def weights(index):
        zi = z[index]
        w = -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(n[index])) / ALPHA + L2)
        return np.where(np.abs(zi) <= L1, 0.0, w)

    bias = np.array([BUCKETS])
    for _ in range(EPOCHS):
        for (index, value), label in zip(rows(), labels, strict=True):
            index, value = np.concatenate((index, bias)), np.append(value, 1.0)
            w = weights(index)
            g = (logistic(w @ value) - label) * value
            step = (np.sqrt(n[index] + g * g) - np.sqrt(n[index])) / ALPHA
            z[index] += g - step * w
            n[index] += g * g
    return weights(np.arange(BUCKETS + 1)).astype(np.float32).tobytes()


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE, id_col: str = "doc_id",
          text_col: str = "text") -> np.ndarray:
    """The averaged weights, ``BUCKETS`` + 1 of them."""
    rows = labelled_sample(docs, labels, label, held_out, sample, id_col, text_col)
    models = [np.frombuffer(m, np.float32) for m in trained(rows, SHARDS, fit)]
    return np.mean(models, axis=0, dtype=np.float64) if models else np.zeros(BUCKETS + 1)


def score_documents(
    docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text", score_col: str = "score"
) -> DataFrame:
    """The documents with one more column, the score (0 to 1, higher: good quality likelier)."""
    shared = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))  # 1 MB, whatever the data

    def score(texts: list[bytes]) -> np.ndarray:
        w = shared.value.astype(np.float64)
        return logistic(dots(w[:-1], texts) + w[-1])

    return scored(docs, score, id_col, text_col, score_col)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, score, predicted) of every document."""
    rows = score_documents(docs.select(id_col, text_col), train(docs, labels, id_col=id_col, text_col=text_col),
                           id_col, text_col)
    return rows.select(
        F.col(id_col), held_out(F.col(id_col)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
