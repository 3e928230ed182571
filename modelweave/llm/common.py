"""What the operators share: reading a table, cutting lineage, slicing Arrow batches, hashing words."""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modelweave.functions.scale import new_folder, remove_folder

FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextlib.contextmanager
def freeing_shuffles(spark: SparkSession):
    """Within, Spark removes an execution's shuffle files as soon as it has ended."""
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SHUFFLES, before)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write a table once to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    with freeing_shuffles(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove the folder of a table that `written` made, once every reader of it has been written itself."""
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        remove_folder(df.sparkSession, folder)


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns an operator reads, named ``id`` and ``text``; a null text is empty."""
    return docs.select(
        docs[id_col].cast("long").alias("id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text")
    )


def slices(batches: Iterable[pa.RecordBatch], size_col: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``most_bytes`` of a text or binary column (one row at least)."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(size_col))
        ends, start = np.cumsum(np.asarray(pc.binary_length(column).fill_null(0)).astype(np.int64)), 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most_bytes, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def by_slices(
    fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch] | pa.RecordBatch], size_col: str = "text",
    most_bytes: int = 1 << 20,
):
    """For mapInArrow: hand ``fn`` the `slices` of the batches."""

    def run(batches):
        for part in slices(batches, size_col, most_bytes):
            made = fn(part)
            yield from [made] if isinstance(made, pa.RecordBatch) else made

    return run


# ---------------------------------------------------------------- words as 64-bit hashes

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BYTE = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64)  # a fixed hash function
_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 2**64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = (x ^ (x >> np.uint64(32))) * _MIX
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    out[:1] = 1
    return np.multiply.accumulate(out)


KEPT_POWERS = 1 << 21
_POWERS: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64; up to ``KEPT_POWERS`` of each are kept for the next batch."""
    if n > KEPT_POWERS:
        return _powers(_BASE, n), _powers(_INVERSE, n)
    if not _POWERS or len(_POWERS[0]) < n:
        size = min(max(n, 1 << 16, 2 * len(_POWERS[0]) if _POWERS else 0), KEPT_POWERS)
        _POWERS[:] = [_powers(_BASE, size), _powers(_INVERSE, size)]
    return _POWERS[0][:n], _POWERS[1][:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start:end] for each span; equal bytes, equal hashes."""
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


class Words:
    """White-space words of some texts, A-Z lower-cased: their hashes and where each text's words begin."""

    def __init__(self, texts: list[bytes], lower: bool = True):
        joined = b" ".join(texts) + b" "
        raw = np.frombuffer(joined, np.uint8)
        data = np.frombuffer(joined.lower(), np.uint8) if lower else raw
        gap = SPACE[data]
        edge = np.diff(np.concatenate(([True], gap)).astype(np.int8))
        self.starts, self.ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        self.data, self.raw = data, raw
        self.hashes = span_hashes(data, self.starts, self.ends)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        self.firsts = np.searchsorted(self.starts, np.concatenate(([0], np.cumsum(sizes))))
        self.counts = np.diff(self.firsts)
        self.doc = np.repeat(np.arange(len(texts)), self.counts)


def shingles(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(text index, hash) of all n-word shingles, in order; a text of fewer words gives its whole sequence as one."""
    h, doc = words.hashes, words.doc
    count = len(h)
    if not count:
        return doc, h
    out = h.copy()
    whole = np.minimum(words.counts, n)[doc]  # shingle length in the word's text
    for k in range(1, n):
        nxt = np.zeros(count, np.uint64)
        nxt[: max(count - k, 0)] = h[k:]
        out = np.where(k < whole, mix(out + np.uint64(k)) + nxt, out)
    at = np.arange(count) - words.firsts[:-1][doc]
    keep = at + whole <= words.counts[doc]
    return doc[keep], mix(out[keep])


def sets_of(doc: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text index, value), sorted by both."""
    order = np.lexsort((values, doc))
    doc, values = doc[order], values[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (values[1:] != values[:-1])
    return doc[new], values[new]


def texts_of(batch: pa.RecordBatch | pa.Table, name: str = "text") -> list[bytes]:
    """The bytes of a text column."""
    column = batch.column(batch.schema.get_field_index(name))
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()
