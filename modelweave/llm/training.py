"""Labelled samples and shard-wise training, shared by the two text classifiers.

A classifier is fitted on a bounded sample of labelled rows: the ``bound`` rows whose ids hash lowest, dealt
over ``shards`` by a hash of the id. Every shard trains in a task of its own, and the weights are averaged;
what reaches the driver is ``shards`` models (fewer where shards would have under ``SHARD_ROWS`` rows) of a
size the classifier fixes, never a row of data.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelweave.llm.common import by_slices, texts_of, written

SHARD_ROWS = 3_000


def fold(id_col: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(folds))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, held_out: Callable[[Column], Column], bound: int,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(dealt, label, text) of at most ``bound`` labelled ids that are not held out (all rows of these ids).

    Null ids and null labels are left out; an id with several labels has the largest.
    """
    # bound: so many (id, label) pairs are picked and broadcast at most
    picked = (
        labels.filter(labels[id_col].isNotNull() & labels[label].isNotNull() & ~held_out(labels[id_col]))
        .groupBy(labels[id_col].cast("long").alias("_id")).agg(F.max(labels[label]).cast("int").alias("label"))
        .orderBy(F.xxhash64("_id"), "_id").limit(bound)
    )
    rows = docs.select(docs[id_col].cast("long").alias("_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    rows = rows.join(F.broadcast(picked), "_id")
    return written(rows.select(F.xxhash64("_id", F.lit(1)).alias("dealt"), "label", "text"), "sample")


def trained(sample: DataFrame, shards: int, fit: Callable[[list[bytes], np.ndarray], bytes]) -> list[bytes]:
    """The models that ``fit(texts, labels)`` makes of each of at most ``shards`` shards."""
    shards = max(1, min(shards, sample.count() // SHARD_ROWS))

    def one(table: pa.Table) -> pa.Table:
        labels, dealt = (np.asarray(table.column(c)) for c in ("label", "dealt"))
        texts = texts_of(table)
        order = sorted(range(len(texts)), key=lambda i: (dealt[i], texts[i], labels[i]))
        model = fit([texts[i] for i in order], labels[order].astype(float))
        return pa.table([pa.array([int(np.asarray(table.column("shard"))[0])], pa.int64()), pa.array([model], pa.binary())],
                        names=["shard", "model"])

    rows = sample.withColumn("shard", F.pmod("dealt", F.lit(shards)).cast("long"))
    models = rows.groupBy("shard").applyInArrow(one, "shard long, model binary").collect()  # ``shards`` rows
    return [bytes(r["model"]) for r in sorted(models, key=lambda r: r["shard"])]


def scored(
    docs: DataFrame, score: Callable[[list[bytes]], np.ndarray], id_col: str, text_col: str, score_col: str = "score"
) -> DataFrame:
    """The documents' rows (all columns, as given) with one more column, the score."""
    from pyspark.sql import types as T

    names = docs.columns
    at = names.index(text_col)
    inner = docs.toDF(*[f"c{i}" for i in range(len(names))])

    def batch(part: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t or b"" for t in texts_of(part, f"c{at}")]
        return pa.RecordBatch.from_arrays(
            [*part.columns, pa.array(score(texts), pa.float64())], [*part.schema.names, "score"]
        )

    schema = T.StructType([*inner.schema.fields, T.StructField("score", T.DoubleType())])
    return inner.mapInArrow(by_slices(batch, f"c{at}"), schema).toDF(*names, score_col)
