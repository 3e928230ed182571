"""Token ids in binary files: Simple-8b words in blocks, with the documents' places.

Every text is encoded by the tokenizers library, an end id follows, and the ids of all documents are written in
ascending order of the documents' ids. Where white space ends every piece (this is read from the tokenizer; others
are given whole texts), the library encodes each distinct run without white space once, many in one call, and a
text's ids are put together from them. Runs are told apart by 64-bit hashes.

A file is (numbers little-endian, 64 bits each): a magic number, the number of documents, ids, blocks and ids of a
full block; the documents' ids, whether they have one, and where each starts in the file; the offset, packed
words and numbers in full of every block; the words. Blocks are cut by number of ids only, so any range of ids is
found by its block. Tasks write files under names of their own and return a row for each; the table of these
rows, the manifest, is committed by Spark, and readers open only the files it names. So a task that ran twice
leaves a file that nobody reads, and a lost executor costs what it was writing.

Order: documents are range-partitioned by (id, checksum of the text, place in the table), so those of one id may
stand in several files. Each file's first id has a number, the sum of all files before it, added up in two steps
(groups of files, then files of a group).

Defined results: a null or empty text has the end id only. Documents without id stand before all others. Rows of
one id are documents of their own, ordered by the MD5 of their texts. An empty table gives no file and no rows.
"""

from __future__ import annotations

import json
import math
import re
import unicodedata
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modelweave.functions.scale import new_folder
from modelweave.llm.common import SPACE, by_slices, keyed, slices, texts_of, written
from modelweave.llm.runs import RunTable
from modelweave.llm.simple8b import pack, unpack

END_ID = 1
BLOCK_IDS = 4096
FILE_IDS = 1 << 23  # a file is closed when it has so many ids, or FILE_DOCS documents
FILE_DOCS = 1 << 20
RANGE_BYTES = 16 << 20  # of text that one task encodes and writes, more or less
GROUP = 1024  # files whose first numbers are added up together
RUNS_PER_CALL = 500
SLICE_BYTES = 1 << 20  # of text encoded at a time
MAGIC = int.from_bytes(b"mwtok8b1", "little")
HEADER = 5

# ---------------------------------------------------------------- text to ids

# What the pattern of a pre-tokenizer must be, for white space to end every piece.
_WORDS_ONLY = re.compile(r"('s\|'t\|'re\|'ve\|'m\|'ll\|'d\|)?\[\\p\{L\}\]\+\|\[\\p\{N\}\]\+?\|\[\^\\s\\p\{L\}\\p\{N\}\]\+")
# Characters that two libraries may not agree on as white space.
_DOUBTFUL = re.compile("[^\x00-\x1b!-\x84\x86-\x9f¡-ᙿᚁ-᠍᠏-῿‐-‧‪-‮‰-⁞⁡-⿿、-\ufefe\uff00-\U0010ffff]")
_LETTER, _MARK = np.zeros(256, bool), np.zeros(256, bool)
_LETTER[ord("a"):ord("z") + 1] = True
_MARK[0x21:0x7F] = True
_MARK[[*range(ord("0"), ord("9") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), ord("'")]] = False


def _ends_at_space(config: dict) -> bool:
    """Whether white space ends every piece, whatever stands around it."""
    steps = (config.get("normalizer") or {}).get("normalizers", [])
    cut = (config.get("pre_tokenizer") or {}).get("pretokenizers", [])
    return (
        [s.get("type") for s in steps] == ["NFC", "Replace", "Lowercase"]
        and steps[1].get("pattern") == {"Regex": "\\s+"} and steps[1].get("content") == " "
        and [c.get("type") for c in cut] == ["Split", "ByteLevel"]
        and cut[0].get("behavior") == "Removed" and cut[0].get("invert") is True
        and bool(_WORDS_ONLY.fullmatch(cut[0].get("pattern", {}).get("Regex", "")))
        and cut[1].get("add_prefix_space") is False and cut[1].get("use_regex") is False
        and bool(config["model"].get("end_of_word_suffix"))
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in config["added_tokens"])
    )


def _runs(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, ends, first run of each text): what stands between white space, A-Z lower-cased.

    It is also cut where an ASCII letter meets an ASCII mark other than the apostrophe: a piece never has both.
    """
    joined = (b" ".join(texts) + b" ").lower()
    data = np.frombuffer(joined, np.uint8)
    inside = np.concatenate(([False], ~SPACE[data]))
    letter, mark = _LETTER[data], _MARK[data]
    meet = np.zeros(len(data), bool)
    meet[1:] = (letter[1:] & mark[:-1]) | (mark[1:] & letter[:-1])
    starts = np.flatnonzero(inside[1:] & (~inside[:-1] | meet))
    ends = np.flatnonzero(inside[:-1] & (~inside[1:] | meet))
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    return data, starts, ends, np.searchsorted(starts, np.cumsum(sizes) - sizes)


class Encoder:
    """A tokenizer and the ids of the runs it has met."""

    def __init__(self, config: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(config)
        parsed = json.loads(config)
        size = self.library.get_vocab_size(with_added_tokens=True)
        self.kind = np.dtype("<u2" if max(size, END_ID) < 1 << 16 else "<u4")
        self.by_run = _ends_at_space(parsed)
        if self.by_run:
            self.special = [t["content"].encode() for t in parsed["added_tokens"]]
            self.pieces = regex.compile(parsed["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
            self.ends = np.zeros(size, bool)
            for token, i in parsed["model"]["vocab"].items():
                self.ends[i] = token.endswith(parsed["model"]["end_of_word_suffix"])
            self.runs = RunTable(self.kind, self._encoded)

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, self.kind)

    def _n_pieces(self, run: str) -> int:
        """The pieces of a run, each of which ends with a token that ends a word."""
        if run.isascii() and run.isalpha():
            return 1
        return len(self.pieces.findall(unicodedata.normalize("NFC", run).lower()))

    def _encoded(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids of each run) of runs, many in one call; they are told apart by the words that end in each."""
        runs = [r.decode() for r in raw]
        parts, counts = [], []
        for at in range(0, len(runs), RUNS_PER_CALL):
            some = runs[at:at + RUNS_PER_CALL]
            text = " ".join(some)
            if not _DOUBTFUL.search(text.replace(" ", "")):
                ids = self.whole(text)
                ends = np.flatnonzero(self.ends[ids]) + 1
                words = np.cumsum([self._n_pieces(r) for r in some])
                if words[-1] == len(ends) and (not len(ends) or ends[-1] == len(ids)):
                    parts.append(ids)
                    counts.append(np.diff(np.concatenate(([0], ends))[np.concatenate(([0], words))]))
                    continue
            single = [self.whole(r) for r in some]  # the pieces may be others here
            parts += single
            counts.append(np.array([len(x) for x in single]))
        return np.concatenate(parts), np.concatenate(counts)

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        if not self.by_run:
            found = self.library.encode_batch([t.decode() for t in texts], add_special_tokens=False)
            return [np.array(e.ids, self.kind) for e in found]
        whole = {i for i, t in enumerate(texts) if any(s in t for s in self.special)}  # holds an added token
        data, starts, ends, firsts = _runs([b"" if i in whole else t for i, t in enumerate(texts)])
        ids, before = self.runs.ids(data, starts, ends)
        edges = np.append(before[firsts], before[-1]).tolist()
        return [
            self.whole(t.decode()) if i in whole else ids[a:b]
            for i, (t, a, b) in enumerate(zip(texts, edges[:-1], edges[1:], strict=True))
        ]


_LOADED: dict[str, Encoder] = {}


def _loaded(config: str) -> Encoder:
    if config not in _LOADED:
        _LOADED.clear()
        _LOADED[config] = Encoder(config)
    return _LOADED[config]


def in_order(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text) in ascending order of (id, checksum of the text), range-partitioned by both and the row's place."""
    rows = keyed(docs, id_col, text_col)
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    placed = rows.withColumn("_sum", F.md5(F.col("text").cast("binary")))
    placed = placed.withColumn("_row", F.monotonically_increasing_id())  # so that equal rows are spread too
    ranges = max(1, math.ceil(total / RANGE_BYTES))
    return placed.repartitionByRange(ranges, "id", "_sum", "_row").sortWithinPartitions("id", "_sum").select("id", "text")


def _broadcast(spark: SparkSession, tokenizer_path: str):
    with open(tokenizer_path, encoding="utf-8") as f:  # a few MB, whatever the data
        return spark.sparkContext.broadcast(f.read())


def _encoded_texts(config: str, part: pa.RecordBatch, end_id: int | None) -> list[np.ndarray]:
    encoder = _loaded(config)
    end = np.array([] if end_id is None else [end_id], encoder.kind)
    return [np.concatenate((ids, end)) for ids in encoder.encode(texts_of(part))]


def token_ids(
    docs: DataFrame, tokenizer_path: str, end_id: int | None = END_ID, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, ids array<int>) of every whole text."""
    config = _broadcast(docs.sparkSession, tokenizer_path)

    def batch(part: pa.RecordBatch) -> pa.RecordBatch:
        found = _encoded_texts(config.value, part, end_id)
        return pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.list_(pa.int32()))], ["id", "ids"])

    rows = keyed(docs, id_col, text_col).mapInArrow(by_slices(batch), "id long, ids array<int>")
    return rows.withColumnRenamed("id", id_col)


# ---------------------------------------------------------------- files


def _opened(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The store of a path of any kind, and the path in it."""
    return pyarrow.fs.FileSystem.from_uri(uri if ":" in uri else f"file://{uri}")


class _File:
    """One file being made: documents are added, full blocks are packed at once."""

    def __init__(self):
        self.ids: list[int | None] = []
        self.starts: list[np.ndarray] = []
        self.n = 0
        self.blocks: list[tuple[np.ndarray, np.ndarray]] = []
        self.rest = np.zeros(0, np.uint32)

    def add(self, docs: list[int | None], sizes: np.ndarray, ids: np.ndarray) -> None:
        """Documents, the number of ids of each, and the ids of all."""
        self.ids += docs
        self.starts.append(self.n + np.cumsum(sizes) - sizes)
        self.n += len(ids)
        ids = np.concatenate((self.rest, ids)) if len(self.rest) else ids
        whole = len(ids) - len(ids) % BLOCK_IDS
        self.blocks += [pack(ids[at:at + BLOCK_IDS]) for at in range(0, whole, BLOCK_IDS)]
        self.rest = ids[whole:].copy()

    def content(self) -> list[bytes]:
        if len(self.rest):
            self.blocks.append(pack(self.rest))
        head = HEADER + 3 * len(self.ids) + 3 * len(self.blocks)
        sizes = np.array([(len(w), len(f)) for w, f in self.blocks], np.int64).reshape(-1, 2)
        offsets = head + np.cumsum(sizes.sum(axis=1)) - sizes.sum(axis=1)
        parts = [
            [MAGIC, len(self.ids), self.n, len(self.blocks), BLOCK_IDS], [i or 0 for i in self.ids],
            [i is not None for i in self.ids], np.concatenate(self.starts), offsets, sizes[:, 0], sizes[:, 1],
        ]
        words = [x.astype("<u8").tobytes() for block in self.blocks for x in block]
        return [np.asarray(p, "<i8").tobytes() for p in parts] + words


MANIFEST = "part long, seq long, file string, n_docs long, n_ids long, n_bytes long"


def _writing(folder: str, config, end_id: int | None):
    """For mapInArrow over (id, text) in order: encode, write files, return their manifest rows."""

    def finish(store, base: str, part: int, seq: int, made: _File) -> pa.RecordBatch:
        name = f"part-{part:06d}-{seq:04d}-{uuid.uuid4().hex}.tok"
        content = made.content()
        with store.open_output_stream(f"{base}/{name}") as out:
            for piece in content:
                out.write(piece)
        values = [part, seq, name, len(made.ids), made.n, sum(map(len, content))]
        return pa.RecordBatch.from_arrays(
            [pa.array([v]) for v in values], [c.strip().split(" ")[0] for c in MANIFEST.split(",")]
        )

    def run(batches: Iterator[pa.RecordBatch]):
        store, base = _opened(folder)
        store.create_dir(base, recursive=True)
        made, seq, part = _File(), 0, TaskContext.get().partitionId()
        for some in slices(batches, "text", SLICE_BYTES):
            found = _encoded_texts(config.value, some, end_id)
            sizes = np.array([len(x) for x in found], np.int64)
            made.add(some.column("id").to_pylist(), sizes, np.concatenate(found))
            if made.n >= FILE_IDS or len(made.ids) >= FILE_DOCS:
                yield finish(store, base, part, seq, made)
                made, seq = _File(), seq + 1
        if made.ids:
            yield finish(store, base, part, seq, made)

    return run


def write_files(
    docs: DataFrame, tokenizer_path: str, folder: str | None = None, end_id: int | None = END_ID,
    id_col: str = "doc_id", text_col: str = "text",
) -> tuple[str, DataFrame]:
    """(folder, manifest) of the files with the ids of all documents, in ascending order of their ids.

    The manifest has a row for every file, with the number of its first id in ``start``.
    """
    folder = folder or new_folder(docs.sparkSession, "token-files")
    rows = in_order(docs, id_col, text_col)
    config = _broadcast(docs.sparkSession, tokenizer_path)
    return folder, with_starts(written(rows.mapInArrow(_writing(folder, config, end_id), MANIFEST), "token-manifest"))


def with_starts(manifest: DataFrame) -> DataFrame:
    """The manifest with ``start``, the ids of all files before each."""
    rows = manifest.withColumn("_group", F.floor(F.col("part") / GROUP))
    before = (Window.unboundedPreceding, -1)
    groups = rows.groupBy("_group").agg(F.sum("n_ids").alias("_ids"))  # one row for GROUP partitions
    all_groups = Window.orderBy("_group").rowsBetween(*before)
    groups = groups.select("_group", F.coalesce(F.sum("_ids").over(all_groups), F.lit(0)).alias("_first"))
    in_group = Window.partitionBy("_group").orderBy("part", "seq").rowsBetween(*before)
    inside = F.coalesce(F.sum("n_ids").over(in_group), F.lit(0))
    return rows.withColumn("_inside", inside).join(groups, "_group").select(
        *manifest.columns, (F.col("_first") + F.col("_inside")).cast("long").alias("start")
    )


class Reader:
    """A file's documents and ids, read block by block."""

    def __init__(self, source):
        self.source = source
        magic, self.n_docs, self.n_ids, self.n_blocks, self.block_ids = self._words(0, HEADER).tolist()
        if magic != MAGIC:
            raise ValueError("no token file")
        heads = self._words(HEADER, 3 * self.n_docs + 3 * self.n_blocks)
        self.ids, self.has_id, self.starts = heads[:3 * self.n_docs].reshape(3, -1)
        self.offsets, self.sizes, self.full = heads[3 * self.n_docs:].reshape(3, -1)

    def _words(self, at: int, n: int, kind: str = "<i8") -> np.ndarray:
        self.source.seek(8 * at)
        raw = self.source.read(8 * n)
        if len(raw) != 8 * n:
            raise ValueError("a token file is cut off")
        return np.frombuffer(raw, kind)

    def block(self, i: int) -> np.ndarray:
        words = self._words(int(self.offsets[i]), int(self.sizes[i] + self.full[i]), "<u8")
        n = min(self.block_ids, self.n_ids - i * self.block_ids)
        return unpack(words[:self.sizes[i]], words[self.sizes[i]:], n)

    def between(self, start: int, stop: int) -> np.ndarray:
        """The ids from one number of the file to another."""
        first = start // self.block_ids
        blocks = [self.block(i) for i in range(first, -(-stop // self.block_ids))]
        whole = np.concatenate(blocks) if blocks else np.zeros(0, np.uint64)
        return whole[start - first * self.block_ids:stop - first * self.block_ids]

    def documents(self, most: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray]]:
        """(first document, document behind the last, ids) of ranges of about ``most`` ids (one document at least)."""
        edges = np.append(self.starts, self.n_ids)
        at = 0
        while at < self.n_docs:
            stop = max(at + 1, int(np.searchsorted(edges, edges[at] + most, side="right")) - 1)
            yield at, stop, self.between(int(edges[at]), int(edges[stop]))
            at = stop


def read_files(spark: SparkSession, folder: str, manifest: DataFrame, row=None, schema: str | None = None) -> DataFrame:
    """(id, start, n, ids array<long>) of all documents of the files a manifest names.

    ``row``, with ``schema``, makes something else of (id, start, ids as an array) of a document.
    """
    files = manifest.count()
    schema = schema or "id long, start long, n long, ids array<long>"
    row = row or (lambda doc, start, ids: (doc, start, len(ids), ids.astype(np.int64)))
    names = [f.strip().split(" ")[0] for f in schema.split(",")]
    kinds = {"long": pa.int64(), "string": pa.string(), "array<long>": pa.list_(pa.int64())}
    types = [kinds[f.strip().split(" ")[1]] for f in schema.split(",")]

    def run(batches):
        store, base = _opened(folder)
        for batch in batches:
            for i in range(batch.num_rows):
                first = batch.column("start")[i].as_py()
                with store.open_input_file(f"{base}/{batch.column('file')[i].as_py()}") as source:
                    reader = Reader(source)
                    for at, stop, ids in reader.documents():
                        edges = np.append(reader.starts, reader.n_ids)[at:stop + 1]
                        made = [
                            row(
                                int(reader.ids[d]) if reader.has_id[d] else None, first + int(reader.starts[d]),
                                ids[edges[d - at] - edges[0]:edges[d - at + 1] - edges[0]],
                            )
                            for d in range(at, stop)
                        ]
                        columns = zip(*made, strict=True)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names
                        )

    named = manifest.select("file", "start").repartition(max(1, files))
    return named.mapInArrow(run, _typed(schema))


def _typed(schema: str) -> T.StructType:
    return T.StructType.fromDDL(schema)


def digests(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document, read back from the files."""
    folder, manifest = write_files(docs, tokenizer_path, id_col=id_col, text_col=text_col)
    manifest = written(manifest, "token-starts")

    def row(doc, start, ids):
        return doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())

    read = read_files(
        docs.sparkSession, folder, manifest, row, "id long, start long, n_tokens long, ids_crc32 long"
    )
    return read.withColumnRenamed("id", id_col)
