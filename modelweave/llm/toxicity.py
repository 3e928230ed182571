"""Toxicity: a factorization machine over hashed terms.

Terms of a text are its distinct words (runs of letters and digits, A-Z lower-cased) and the first four and
five bytes of its longer words, hashed to ``BUCKETS``. The score is the logistic function of
bias + sum of term weights + sum over pairs of terms of the inner product of their factor vectors, so two
terms that are harmless alone count together (an insult and a mention of a group). Pairs are summed in
linear time. Weights are trained per coordinate by the proximal follow-the-regularised-leader rule, whose L1
part keeps rare and harmless terms at zero; the factors of terms that have a weight by Adagrad steps. The
terms at zero cost nothing when texts are scored.

Labels are learnt from at most ``SAMPLE`` labelled rows of the folds that are not held out, chosen by a hash
of their id. Labels, language, source and id are no inputs of a score.

Defined results: a null or empty text has the score of the bias alone. Without a labelled row every score
is 0.5. Repeated rows get equal scores; a null id is held out of training. Other columns are passed through.
An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelweave.llm.common import mix, sets_of, span_hashes
from modelweave.llm.quality import logistic
from modelweave.llm.training import fold, labelled_sample, scored, trained

BITS = 17
BUCKETS = 1 << BITS
FACTORS = 4
SAMPLE = 16_000
SHARDS = 4
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.2, 1.0, 3.0, 0.1  # weights
RATE = 0.05  # factors
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3
PREFIXES = (4, 5)
LEAST_TEXTS = 3  # a bucket in fewer texts of a shard is not learnt

_LETTER = np.zeros(256, bool)
_LETTER[[*range(ord("0"), ord("9") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = True


def held_out(id_col: Column) -> Column:
    return F.coalesce(fold(id_col, FOLDS) == HELD_OUT, F.lit(False))


def terms(texts: list[bytes], active: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text index, bucket), distinct and sorted; only buckets marked in ``active`` if that is given."""
    joined = b" ".join(texts).lower() + b" "
    data = np.frombuffer(joined, np.uint8)
    edge = np.diff(np.concatenate(([False], _LETTER[data])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    doc = np.searchsorted(np.cumsum(sizes), starts, side="right")
    docs, buckets = [], []
    for kind, most in enumerate((None, *PREFIXES)):
        at = slice(None) if most is None else np.flatnonzero(ends - starts > most)
        s, d = starts[at], doc[at]
        h = span_hashes(data, s, ends[at] if most is None else s + most)
        b = (mix(h + np.uint64(kind)) >> np.uint64(64 - BITS)).astype(np.int64)
        if active is not None:
            keep = active[b]
            d, b = d[keep], b[keep]
        docs.append(d)
        buckets.append(b)
    return sets_of(np.concatenate(docs), np.concatenate(buckets))


def margins(model: np.ndarray, texts: list[bytes]) -> np.ndarray:
    """Bias, weights and pair terms of all texts; ``model`` has a row (weight, factors) per bucket, the bias last."""
    doc, bucket = terms(texts, model[:-1].any(axis=1))
    n, rows = len(texts), model[bucket]
    out = np.full(n, model[-1, 0]) + np.bincount(doc, rows[:, 0], n)
    for f in range(1, 1 + FACTORS):
        v = rows[:, f]
        out += 0.5 * (np.bincount(doc, v, n) ** 2 - np.bincount(doc, v * v, n))
    return out


def fit(texts: list[bytes], labels: np.ndarray) -> bytes:
    """The model of one shard, by gradient steps over its texts in turn."""
    rows = []
    for start in range(0, len(texts), 200):
        part = texts[start:start + 200]
        doc, bucket = terms(part)
        rows += np.split(bucket, np.searchsorted(doc, np.arange(1, len(part))))
    texts_with = np.bincount(np.concatenate(rows), minlength=BUCKETS)
    rows = [r[texts_with[r] >= LEAST_TEXTS] for r in rows]
    start = np.random.default_rng(11).normal(0, 0.01, (BUCKETS, FACTORS))  # the same in every shard
    factors, seen = start.copy(), np.full((BUCKETS, FACTORS), 1.0)
    z, n = np.zeros(BUCKETS), np.zeros(BUCKETS)
    share = min(max(labels.mean(), 1e-3), 1 - 1e-3)
    bias, bias_n = np.log(share / (1 - share)), 1.0

    def weights(b):
        w = -(z[b] - np.sign(z[b]) * L1) / ((BETA + np.sqrt(n[b])) / ALPHA + L2)
        return np.where(np.abs(z[b]) <= L1, 0.0, w)

    order = np.random.default_rng(5)
    for _ in range(EPOCHS):
        for i in order.permutation(len(rows)):
            b = rows[i]
            w = weights(b)
            on = b[w != 0]  # a term has factors once it has a weight
            v = factors[on]
            sums = v.sum(axis=0)
            margin = bias + w.sum() + 0.5 * ((sums * sums).sum() - (v * v).sum())
            error = logistic(margin) - labels[i]
            step = (np.sqrt(n[b] + error * error) - np.sqrt(n[b])) / ALPHA
            z[b] += error - step * w
            n[b] += error * error
            g = error * (sums - v) + L2 * v
            seen[on] += g * g
            factors[on] = v - RATE / np.sqrt(seen[on]) * g
            bias_n += error * error
            bias -= RATE / np.sqrt(bias_n) * error
    model = np.zeros((BUCKETS + 1, 1 + FACTORS))
    model[:-1, 0] = weights(np.arange(BUCKETS))
    model[:-1, 1:] = np.where(model[:-1, :1] != 0, factors, 0)
    model[-1, 0] = bias
    return model.astype(np.float32).tobytes()


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE, id_col: str = "doc_id",
          text_col: str = "text") -> np.ndarray:
    """The averaged model: a row (weight, factors) per bucket and the bias."""
    rows = labelled_sample(docs, labels, label, held_out, sample, id_col, text_col)
    models = [np.frombuffer(m, np.float32).reshape(BUCKETS + 1, -1) for m in trained(rows, SHARDS, fit)]
    return np.mean(models, axis=0, dtype=np.float64) if models else np.zeros((BUCKETS + 1, 1 + FACTORS))


def score_documents(docs: DataFrame, model: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with a column ``score`` (0 to 1, higher: toxic likelier)."""
    shared = docs.sparkSession.sparkContext.broadcast(model.astype(np.float32))  # 3 MB, whatever the data

    def score(texts: list[bytes]) -> np.ndarray:
        return logistic(margins(shared.value.astype(np.float64), texts))

    return scored(docs, score, id_col, text_col)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, score, predicted) of every document."""
    rows = score_documents(docs.select(id_col, text_col), train(docs, labels, id_col=id_col, text_col=text_col),
                           id_col, text_col)
    return rows.select(
        F.col(id_col), held_out(F.col(id_col)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
