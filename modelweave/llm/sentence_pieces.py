"""Encoding and decoding with merge-type piece vocabularies.

A text's symbols (characters, blanks as U+2581, one such mark put before) stand in a chain. Every
adjacent pair whose concatenation is a piece lies on an agenda ordered by score, then by place; the best
pair is merged and its new neighbours are laid on the agenda, until that is empty (module ``agenda`` does this for
many runs at a time). Symbols that are no
piece become their UTF-8 bytes' pieces. Two neighbours that stand side by side in no piece are never merged, so
texts are cut there (a table of byte pairs tells where; the place before a blank is one), every distinct run
between cuts goes through the agenda once, and one result serves all its occurrences; runs are told apart by
64-bit hashes. A text in ``check_every`` (each one, unless asked otherwise) is encoded and decoded by the
sentencepiece library as well, a slice of its Arrow batch in one call; a difference stops the job.

Defined results: a null or empty text has only the begin and end ids and decodes to the empty text.
U+2581 in a text encodes like a blank and decodes to one. Rows are independent, so repeated rows get equal
results; a null id stays null. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from modelweave.llm.agenda import Agenda
from modelweave.llm.common import by_slices, keyed, texts_of
from modelweave.llm.runs import RunTable

MARK = "▁"
CACHED = 400_000  # runs kept per worker
CHECK_EVERY = 1


class Pieces:
    """A merge-type vocabulary, its encoder and decoder."""

    def __init__(self, model: bytes):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        self.library = SentencePieceProcessor(model_proto=model)
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        rules, trained = proto.normalizer_spec, proto.trainer_spec
        kinds = {p.type for p in proto.pieces}
        if (
            trained.model_type != 2 or not trained.byte_fallback or trained.treat_whitespace_as_suffix
            or rules.precompiled_charsmap or not rules.add_dummy_prefix or rules.remove_extra_whitespaces
            or not rules.escape_whitespaces or not kinds <= {1, 2, 3, 6}
        ):
            raise ValueError("only merge vocabularies with byte fallback, a dummy prefix and plain text are supported")
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == 1}
        self.scores = {p.piece: -p.score for p in proto.pieces if p.type == 1 and len(p.piece) > 1}
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece goes on behind a blank")
        self.pairs = {p[i:i + 2] for p in self.scores for i in range(len(p) - 1)}
        byte = {int(p.piece[1:-1], 16): i for i, p in enumerate(proto.pieces) if p.type == 6}
        self.bytes = [byte[b] for b in range(256)]
        self.begin, self.end = self.library.bos_id(), self.library.eos_id()
        self.surface = [
            bytes([int(p.piece[1:-1], 16)]) if p.type == 6 else p.piece.replace(MARK, " ").encode() if p.type == 1
            else " ⁇ ".encode() if p.type == 2 else b""
            for p in proto.pieces
        ]
        self.cuts = self._cuts()
        sizes = np.array([len(x) for x in self.surface])
        self.surface_size, self.surface_at = sizes, np.cumsum(sizes) - sizes
        self.surface_bytes = np.frombuffer(b"".join(self.surface), np.uint8)
        self.is_byte = np.zeros(len(sizes), bool)
        self.is_byte[self.bytes] = True
        self.agenda = Agenda(self.ids, self.scores)
        self.runs = RunTable("<u4", self._merged)

    def _cuts(self) -> np.ndarray:
        """For every pair of bytes, whether no merge can reach over the place between them."""
        out = np.zeros((256, 256), bool)
        plain = [MARK if b == 0x20 else chr(b) for b in range(128)]
        for b, left in enumerate(plain):
            out[b, :128] = [left + right not in self.pairs for right in plain]
        out[128:, 0x20] = True  # no piece goes on behind a blank
        if not any("\n" in p for p in self.scores):
            out[0x0A, :], out[:, 0x0A] = True, True
        return out

    def merged(self, segment: str) -> list[int]:
        """Ids of a segment, by the agenda of adjacent pairs."""
        scores = self.scores
        symbols = list(segment)
        n = len(symbols)
        right, left = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = []
        for i in range(n - 1):
            pair = symbols[i] + symbols[i + 1]
            if (score := scores.get(pair)) is not None:
                agenda.append((score, i, pair))
        heapq.heapify(agenda)
        while agenda:
            _, i, pair = heapq.heappop(agenda)
            j = right[i]
            if symbols[i] is None or j >= n or symbols[i] + symbols[j] != pair:
                continue  # one of the two has been merged otherwise
            symbols[i], symbols[j] = pair, None
            k = right[i] = right[j]
            if k < n:
                left[k] = i
                if (score := scores.get(new := pair + symbols[k])) is not None:
                    heapq.heappush(agenda, (score, i, new))
            if (h := left[i]) >= 0 and (score := scores.get(new := symbols[h] + pair)) is not None:
                heapq.heappush(agenda, (score, h, new))
        out: list[int] = []
        for symbol in symbols:
            if symbol is not None:
                if (known := self.ids.get(symbol)) is not None:
                    out.append(known)
                else:
                    out += [self.bytes[b] for b in symbol.encode()]
        return out

    def _merged(self, runs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all runs, number of ids of each): many runs at a time, long and rare ones by themselves."""
        groups, left = self.agenda.ids(runs, MARK)
        single = [(i, np.array(self.merged(runs[i].decode().replace(" ", MARK)), np.int64)) for i in left.tolist()]
        counts = np.zeros(len(runs), np.int64)
        for which, ids in groups:
            counts[which] = ids.shape[1]
        for i, ids in single:
            counts[i] = len(ids)
        at = np.cumsum(counts) - counts
        out = np.empty(int(counts.sum()), "<u4")
        for which, ids in groups:
            out[at[which][:, None] + np.arange(ids.shape[1])] = ids
        for i, ids in single:
            out[at[i]:at[i] + len(ids)] = ids
        return out, counts

    def encoded(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts with begin and end ids, where each text's ids start, and the end of the last)."""
        marked = [b" " + t.replace(MARK.encode(), b" ") if t else b"" for t in texts]
        data = np.frombuffer(b"".join(marked), np.uint8)
        sizes = np.fromiter(map(len, marked), np.int64, len(marked))
        firsts = np.cumsum(sizes) - sizes
        cut = np.zeros(len(data) + 1, bool)
        cut[1:-1] = self.cuts[data[:-1], data[1:]] if len(data) else False
        cut[firsts], cut[-1] = True, True
        edges = np.flatnonzero(cut) if len(data) else np.zeros(1, np.int64)
        self.runs.most = CACHED
        ids, before = self.runs.ids(data, edges[:-1], edges[1:])
        bounds = before[np.searchsorted(edges[:-1], np.append(firsts, len(data)))]
        ids = np.insert(ids, np.repeat(bounds, 2)[1:-1], np.tile(np.array([self.begin, self.end], "<u4"), len(texts)))
        return ids, bounds + 2 * np.arange(len(bounds))

    def packed(self, text: str) -> bytes:
        """Ids of a text with begin and end, as little-endian unsigned 32-bit integers."""
        return self.encoded([text.encode()])[0].tobytes()

    def decoded(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """The texts, in UTF-8, of what `encoded` gave."""
        size = self.surface_size[ids]
        before = np.concatenate(([0], np.cumsum(size)))
        raw = self.surface_bytes[np.repeat(self.surface_at[ids] - before[:-1], size) + np.arange(before[-1])].tobytes()
        at = before[bounds]
        # the first piece of a text loses the blank put before it, but not the byte piece of a blank
        piece = ~self.is_byte[ids[np.minimum(bounds[:-1] + 1, len(ids) - 1)]] if len(ids) else np.zeros(0, bool)
        return [
            raw[a + (raw[a:a + 1] == b" " and bool(p) and b > a):b]
            for a, b, p in zip(at[:-1].tolist(), at[1:].tolist(), piece.tolist(), strict=True)
        ]

    def decode(self, ids) -> str:
        """The text of ids: control ids are nothing, the first piece loses the blank put before the text."""
        raw = b"".join(map(self.surface.__getitem__, ids))
        if raw[:1] == b" " and next((i for i in ids if self.surface[i]), None) not in self.bytes:
            raw = raw[1:]
        try:
            return raw.decode()
        except UnicodeDecodeError:  # ids that no encoder made
            return self.library.decode(list(ids))


def checked(pieces: Pieces, of, text: str, ids: list[int], decoded: str) -> None:
    """Stop if the library encodes a text or decodes its ids otherwise."""
    if ids != pieces.library.encode(text, add_bos=True, add_eos=True):
        raise RuntimeError(f"the library encodes the text of id {of} otherwise")
    if decoded != pieces.library.decode(ids):
        raise RuntimeError(f"the library decodes the ids of id {of} otherwise")


_LOADED: dict[bytes, Pieces] = {}


def loaded(model: bytes) -> Pieces:
    """The vocabulary, kept with its cache for the next task of the worker."""
    key = hashlib.sha256(model).digest()
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Pieces(model)
    return _LOADED[key]


def _check(pieces: Pieces, of: pa.Array, texts: list[bytes], ids: np.ndarray, bounds: np.ndarray, decoded: list[bytes],
           every: int) -> None:
    """Stop if the library encodes or decodes one of every ``every`` texts otherwise; one call for all of them."""
    asked = range(0, len(texts), every)
    given = pieces.library.encode([texts[i].decode() for i in asked], add_bos=True, add_eos=True, num_threads=1)
    back = pieces.library.decode(given, num_threads=1) if given else []
    for i, theirs, text in zip(asked, given, back, strict=True):
        own = ids[bounds[i]:bounds[i + 1]]
        if len(theirs) != len(own) or (np.array(theirs, "<u4") != own).any() or text.encode() != decoded[i]:
            checked(pieces, of[i], texts[i].decode(), own.tolist(), decoded[i].decode())


def _per_text(docs: DataFrame, model_path: str, schema: T.StructType, columns, id_col: str, text_col: str, check_every: int):
    """Rows of ``schema``: the id and the ``columns(ids, bounds, decoded texts)`` of a slice."""
    with open(model_path, "rb") as f:  # a few hundred kB, whatever the data
        model = docs.sparkSession.sparkContext.broadcast(f.read())
    names = schema.fieldNames()

    def batch(part: pa.RecordBatch) -> pa.RecordBatch:
        pieces, texts = loaded(model.value), texts_of(part)
        ids, bounds = pieces.encoded(texts)
        decoded = pieces.decoded(ids, bounds)
        _check(pieces, part.column(0), texts, ids, bounds, decoded, check_every)
        return pa.RecordBatch.from_arrays([part.column(0), *columns(ids, bounds, decoded)], names)

    return keyed(docs, id_col, text_col).mapInArrow(by_slices(batch), schema)


def encode(
    docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", check_every: int = CHECK_EVERY
) -> DataFrame:
    """(id, ids array<int>, decoded): every whole text encoded, and its ids decoded again."""
    schema = T.StructType().add(id_col, "long").add("ids", T.ArrayType(T.IntegerType())).add("decoded", "string")

    def columns(ids: np.ndarray, bounds: np.ndarray, decoded: list[bytes]):
        lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids.astype(np.int32)))
        return lists, pa.array(decoded, pa.binary()).cast(pa.string())

    return _per_text(docs, model_path, schema, columns, id_col, text_col, check_every)


def digests(
    docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", check_every: int = CHECK_EVERY
) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of the same, without sending ids and texts on."""
    schema = (
        T.StructType().add(id_col, "long").add("n_tokens", "long").add("ids_sha256", "string")
        .add("decoded_sha256", "string")
    )

    def columns(ids: np.ndarray, bounds: np.ndarray, decoded: list[bytes]):
        packed = [ids[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        return (
            pa.array(np.diff(bounds), pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in packed], pa.string()),
            pa.array([hashlib.sha256(x).hexdigest() for x in decoded], pa.string()),
        )

    return _per_text(docs, model_path, schema, columns, id_col, text_col, check_every)
