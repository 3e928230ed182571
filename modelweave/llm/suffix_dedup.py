"""Exact dedup of repeated byte strings, by prefix doubling over distributed positions.

A byte is removed if it is covered by a string of ``LENGTH`` bytes that also starts in a document with a
smaller id. Positions are ranked by growing prefixes, and a rank that is unique drops out:

1. Within a task, the rank of every position doubles from 1 to 16 bytes and on to ``FIRST`` = 24: the rank of
   two halves is a 64-bit hash of their ranks. Of every 27 neighbouring positions, the one of smallest rank
   is kept, so that each string of 50 bytes holds a kept position, at the same place wherever the string
   stands.
2. Spark sorts (rank, document) pairs of the kept positions over the cluster. Ranks of one document drop out.
   Per slice and rank, one pair is sorted; the slice's other documents of that rank are known to share it. A task
   holds one row of the rank it is at, however many documents have it.
3. The positions left get the bytes around them, and the rank is taken on to the 27 strings of 50 bytes that
   hold their first 24. Spark sorts them by the first rank, and equal strings meet: a string of which a
   smaller document has another is marked. Positions with the same bytes around them are compared as one, so only
   ranks of several surroundings have their strings sorted. The marks of a document make its removed runs.

Before each sort a task reduces its own slice: a rank is sent once per slice, and strings for which the slice
itself has a smaller document are settled there. So a passage that a third of all documents hold is sent once
per slice. Ranks that still have more than their part of the positions go another way, with one row per
string, reduced before the shuffle (`_by_string`).

Defined results: a null or empty text has no bytes. A row without id loses nothing and no other row loses
anything for it. Rows of one id never count against each other, and repeated rows lose alike. Other columns
are passed through. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modelweave.llm.common import _BYTE, by_slices, mix, texts_of, written

LENGTH = 50
FIRST = 24
SIDE = LENGTH - FIRST  # so many bytes of a string may stand before its kept position
NEAR = SIDE + 1
PIECE = 1 << 18  # bytes hashed at a time
SLICE = 2 << 20  # bytes of text a task reduces at a time; more takes memory and hardly sends fewer ranks
OPEN_ROWS = 100_000  # rows of a sorted partition compared at a time, unless one rank has more
LEAST_HOT = 2_000

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def _join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rank of the concatenation of two strings, from theirs."""
    out = a * _A
    out += b
    out ^= out >> np.uint64(32)
    out *= _B
    return out


def _ranks(data: np.ndarray) -> np.ndarray:
    """Rank of the ``FIRST`` bytes from each position on, by doubling.

    Up to 8 bytes the rank is the bytes themselves, in an integer of twice the width at each doubling.
    """
    rank = data
    for reach, wide in ((1, np.uint16), (2, np.uint32), (4, np.uint64)):
        both = rank[reach:].astype(wide)
        both <<= wide(8 * reach)
        both |= rank[:-reach]
        rank = both
    sixteen = _join(rank[:-8], rank[8:])
    return _join(sixteen[:len(sixteen) - 8], rank[16:])


def _of_neighbours(pick, x: np.ndarray, width: int) -> np.ndarray:
    """``pick`` (np.minimum or np.maximum) over ``width`` neighbours from each place on."""
    reach = 1
    while 2 * reach <= width:
        x = pick(x[:-reach], x[reach:])
        reach *= 2
    return pick(x[:len(x) - (width - reach)], x[width - reach:]) if reach < width else x


def _pieces(texts: list[bytes]):
    """(text indices, offsets of the pieces' bytes in their texts, the bytes) of about ``PIECE`` bytes in all.

    Long texts are cut so that every string of ``LENGTH`` bytes lies in a piece.
    """
    group, size = [], 0
    for i, text in enumerate(texts):
        for at in range(0, len(text) - LENGTH + 1, PIECE):
            part = text[at:at + PIECE + LENGTH - 1] if len(text) > PIECE else text
            group.append((i, at, part))
            size += len(part)
            if size >= PIECE:
                yield group
                group, size = [], 0
    if group:
        yield group


def kept_positions(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text index, position, rank) of the kept positions, sorted by the first two."""
    found = []
    for group in _pieces(texts):
        sizes = np.array([len(p) for _, _, p in group])
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        data = np.frombuffer(b"".join(p for _, _, p in group), np.uint8)
        ranks = _ranks(data)  # of len(data) - 23 positions
        order = (ranks >> np.uint64(32)).astype(np.uint32)  # half a rank tells the smallest; equal halves are all kept
        least = _of_neighbours(np.minimum, order, NEAR)  # for every string that starts in data: len(data) - 49
        over = (starts + sizes)[:-1, None] - np.arange(1, LENGTH)
        least[over.ravel()] = 0  # strings over a border do not count
        pad = np.zeros(SIDE, np.uint32)
        # A position is kept if it has the smallest rank of some string: the largest of the least ones around it.
        around = _of_neighbours(np.maximum, np.concatenate((pad, least, pad)), NEAR)
        at = np.flatnonzero(order == around)
        piece = np.searchsorted(starts, at, side="right") - 1
        text = np.array([i for i, _, _ in group])[piece]
        offset = np.array([a for _, a, _ in group])[piece]
        found.append((text, at - starts[piece] + offset, ranks[at]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    text, at, rank = (np.concatenate(c) for c in zip(*found, strict=True))
    same = text[1:] == text[:-1]
    if not (same & (at[1:] <= at[:-1])).any():  # pieces come in order and differ, unless a text was cut
        return text, at, rank
    order = np.lexsort((at, text))
    text, at, rank = text[order], at[order], rank[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (at[1:] != at[:-1])  # a border position may stand in two pieces
    return text[new], at[new], rank[new]


def _starts(sorted_values: np.ndarray) -> np.ndarray:
    new = np.ones(len(sorted_values), bool)
    new[1:] = sorted_values[1:] != sorted_values[:-1]
    return np.flatnonzero(new)


def _blobs(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """One binary value per group of consecutive values."""
    width = values.dtype.itemsize
    offsets = np.append(starts, len(values)) * width
    return pa.Array.from_buffers(
        pa.binary(), len(starts), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(values.tobytes())]
    )


# ---------------------------------------------------------------- the first rank: which are shared


def _slice_ranks(batch: pa.RecordBatch):
    """(rank, id, ids) of a slice: for every rank its smallest id, ``ids`` being empty where the slice has others.

    Those others, for which nothing is open, come as rows of their own: ``ids`` holds them, and ``id`` is null.
    """
    ids = np.asarray(batch.column(0), dtype=np.int64)
    text, _, rank = kept_positions(texts_of(batch))
    of = ids[text]
    order = np.lexsort((of, rank))
    rank, of = rank[order], of[order]
    new = np.ones(len(rank), bool)
    new[1:] = (rank[1:] != rank[:-1]) | (of[1:] != of[:-1])
    rank, of = rank[new].view(np.int64), of[new]
    starts = _starts(rank)
    several = np.diff(np.append(starts, len(rank))) > 1
    empty = pc.if_else(pa.array(several), pa.scalar(b"", pa.binary()), pa.scalar(None, pa.binary()))
    yield pa.RecordBatch.from_arrays([pa.array(rank[starts]), pa.array(of[starts]), empty], _RANK_NAMES)
    other = np.ones(len(rank), bool)
    other[starts] = False
    if other.any():
        rank, of = rank[other], of[other]
        starts = _starts(rank)
        yield pa.RecordBatch.from_arrays(
            [pa.array(rank[starts]), pa.nulls(len(starts), pa.int64()), _blobs(of, starts)], _RANK_NAMES
        )


_RANK_NAMES = ["rank", "id", "ids"]


def _shared_ranks(batches):
    """From rows sorted by rank: (id, rank) of the ranks that stand in several documents.

    Of the rank at a batch's end only one row is held: either all its ids so far are equal, or it is known to be
    shared and its rows are given out as they come.
    """
    held = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))
    for batch in batches:
        rank, ids = np.asarray(batch.column("rank")), batch.column("ids")
        passed = np.asarray(batch.column("id").is_null())
        if passed.any():
            blobs = ids.filter(pa.array(passed)).to_pylist()
            yield from _pairs(
                np.frombuffer(b"".join(blobs), np.int64), np.repeat(rank[passed], [len(x) // 8 for x in blobs])
            )
        new = (rank, np.asarray(batch.column("id").fill_null(0)), np.asarray(ids.is_valid()))
        rank, of, several = (np.concatenate((h, n[~passed])) for h, n in zip(held, new, strict=True))
        if not len(rank):
            continue
        starts = _starts(rank)
        shared = np.minimum.reduceat(of, starts) != np.maximum.reduceat(of, starts)
        shared |= np.logical_or.reduceat(several, starts)
        keep = np.repeat(shared, np.diff(np.append(starts, len(rank))))
        yield from _pairs(of[keep], rank[keep])
        held = (rank[-1:], of[-1:], shared[-1:])


def _pairs(ids: np.ndarray, ranks: np.ndarray):
    for at in range(0, len(ids), 1 << 16):
        part = slice(at, at + (1 << 16))
        yield pa.RecordBatch.from_arrays([pa.array(ids[part]), pa.array(ranks[part])], ["id", "rank"])


# ---------------------------------------------------------------- on to the strings of LENGTH bytes


def _strings(rank: np.ndarray, left: np.ndarray, right: np.ndarray):
    """For each number of bytes before the position, the rank of that string of all rows."""
    ahead = [np.zeros(len(rank), np.uint64)]
    for i in range(SIDE):
        ahead.append(_join(ahead[-1], _BYTE[right[:, i]]))
    before = rank
    for j in range(NEAR):
        yield j, mix(before + ahead[SIDE - j] * _C + np.uint64(j))
        if j < SIDE:
            before = _join(before, _BYTE[left[:, SIDE - 1 - j]])


def _whole(rank: np.ndarray, around: np.ndarray, possible: np.ndarray) -> np.ndarray:
    """One rank for the rank, the bytes around it and the possible strings, taken on by eight bytes at a time."""
    words = np.zeros((len(rank), 2 * SIDE + 4), np.uint8)
    words[:, :2 * SIDE] = around
    words[:, 2 * SIDE:] = possible.astype(np.uint32)[:, None].view(np.uint8)
    whole = rank
    for word in words.view(np.uint64).T:
        whole = _join(whole, word)
    return whole


def _marks(rank, ids, around, possible, whole) -> np.ndarray:
    """Bits of the strings (by bytes before the position) of which a smaller id has another.

    Of rows with the same surroundings, all strings of those without the smallest id are marked. Those that have it
    stand for one row, whose strings are compared if its rank has other surroundings, too.
    """
    order = np.argsort(whole)
    new = np.ones(len(order), bool)
    new[1:] = (whole[order][1:] != whole[order][:-1]) | (rank[order][1:] != rank[order][:-1])
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, len(order)))
    least = np.minimum.reduceat(ids[order], starts)
    one = order[starts]
    by_rank = np.argsort(rank[one])
    alike = np.diff(np.append(_starts(rank[one][by_rank]), len(one)))
    several = by_rank[np.repeat(alike > 1, alike)]
    row = one[several]
    one_marks = np.zeros(len(one), np.uint32)
    one_marks[several] = _string_marks(rank[row], least[several], around[row], possible[row])
    marks = np.empty(len(rank), np.uint32)
    marks[order] = np.where(ids[order] > np.repeat(least, sizes), possible[order], np.repeat(one_marks, sizes))
    return marks


def _string_marks(rank, ids, around, possible) -> np.ndarray:
    """The same marks, by sorting the strings of all rows for each number of bytes before the position."""
    marks = np.zeros(len(rank), np.uint32)
    for j, string in _strings(rank, around[:, :SIDE], around[:, SIDE:]):
        bit = np.uint32(1 << j)
        at = np.flatnonzero(possible & bit)
        if not len(at):
            continue
        string = string[at]
        order = np.argsort(string)
        starts = _starts(string[order])
        of = ids[at][order]
        least = np.repeat(np.minimum.reduceat(of, starts), np.diff(np.append(starts, len(order))))
        marks[at[order[of > least]]] |= bit
    return marks


OPEN = T.StructType([
    T.StructField("rank", T.LongType()), T.StructField("id", T.LongType()), T.StructField("doc", T.LongType()),
    T.StructField("places", T.BinaryType()), T.StructField("around", T.BinaryType()),
    T.StructField("possible", T.LongType()), T.StructField("marked", T.LongType()),
])
_OPEN_NAMES = OPEN.fieldNames()


def _slice_strings(batch: pa.RecordBatch):
    """Rows (rank, id, doc, places, bytes around, possible and marked strings) of the shared positions of a slice.

    ``around`` is null where the slice has settled all strings.
    """
    ids, docs = np.asarray(batch.column("id"), dtype=np.int64), np.asarray(batch.column("doc"), dtype=np.int64)
    texts = texts_of(batch)
    text, at, rank = kept_positions(texts)
    ranks = batch.column("ranks")
    shared = np.asarray(ranks.flatten(), dtype=np.int64).view(np.uint64)
    shared_of = np.repeat(np.arange(len(texts)), np.asarray(ranks.value_lengths()))
    # (text, rank) is looked up by a hash: one taken for another keeps a position that is not shared, to no effect
    keep = np.asarray(pc.is_in(
        pa.array(_join(rank, text.astype(np.uint64))), value_set=pa.array(_join(shared, shared_of.astype(np.uint64)))
    ))
    text, at, rank = text[keep], at[keep], rank[keep]
    if not len(text):
        return
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    offsets = np.concatenate(([0], np.cumsum(sizes + 2 * SIDE)))[:-1] + SIDE
    edge = bytes(SIDE)
    data = np.frombuffer(b"".join(edge + t + edge for t in texts), np.uint8)
    near = np.lib.stride_tricks.sliding_window_view(data, LENGTH + SIDE)[offsets[text] + at - SIDE]
    around = np.concatenate((near[:, :SIDE], near[:, LENGTH:]), axis=1)
    before = np.minimum(at, SIDE)
    behind = np.minimum(sizes[text] - at - FIRST, SIDE)
    # strings with j bytes before: j <= before and SIDE - j <= behind
    full = (1 << (before + 1)) - 1
    possible = (full & ~((1 << (SIDE - behind)) - 1)).astype(np.uint32)
    # equal surroundings in one document are one row with several places
    whole = _whole(rank, around, possible)
    order = np.argsort(_join(whole, text.astype(np.uint64)), kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = (text[order][1:] != text[order][:-1]) | (whole[order][1:] != whole[order][:-1])
    starts = np.flatnonzero(new)
    # in the order of the texts: neighbours share most of their bytes, which keeps the table small
    first_of = np.empty(len(order), np.int64)
    first_of[order] = np.repeat(order[starts], np.diff(np.append(starts, len(order))))
    order = np.argsort(first_of, kind="stable")
    starts = _starts(first_of[order])
    first = order[starts]
    places = _blobs(at[order].astype("<i4"), starts)  # a text has less than 2 GB
    around = around[first]
    marked = _marks(rank[first], ids[text[first]], around, possible[first], whole[first])
    done = marked == possible[first]
    blobs = pa.Array.from_buffers(pa.binary(2 * SIDE), len(first), [None, pa.py_buffer(around)]).cast(pa.binary())
    blobs = pc.if_else(pa.array(done), pa.scalar(None, pa.binary()), blobs)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(rank[first].view(np.int64)), pa.array(ids[text[first]]), pa.array(docs[text[first]]), places, blobs,
            pa.array(possible[first].astype(np.int64)), pa.array(marked.astype(np.int64)),
        ],
        _OPEN_NAMES,
    )


def _bytes_of(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """The bytes of a binary column, one value after the other."""
    column = column.cast(pa.binary())
    parts = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    found = [np.zeros(0, np.uint8)]
    for part in parts:
        if len(part):
            ends = np.frombuffer(part.buffers()[1], np.int32)[part.offset:part.offset + len(part) + 1]
            found.append(np.frombuffer(part.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]])
    return np.concatenate(found)


def _around(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return _bytes_of(column).reshape(len(column), 2 * SIDE)


def _compare(table: pa.Table):
    """The rows (doc, places, marked) of whole ranks, with all marks."""
    around = _around(table.column("around"))
    possible = np.asarray(table.column("possible")).astype(np.uint32)
    marked = np.asarray(table.column("marked")).astype(np.uint32)
    rank = np.asarray(table.column("rank")).view(np.uint64)
    marked = marked | _marks(
        rank, np.asarray(table.column("id")), around, possible, _whole(rank, around, possible)
    )
    out = pa.table([table.column("doc"), table.column("places"), pa.array(marked.astype(np.int64))],
                   names=["doc", "places", "marked"])
    return out.filter(pa.array(marked != 0)).to_batches()


def _compare_sorted(batches):
    """The same for a stream of rows sorted by rank."""
    held, rows = [], 0
    for batch in batches:
        held.append(pa.Table.from_batches([batch]))
        rows += batch.num_rows
        if rows < OPEN_ROWS:
            continue
        table = pa.concat_tables(held)
        rank = np.asarray(table.column("rank"))
        cut = int(np.searchsorted(rank, rank[-1], side="left"))
        if cut:
            yield from _compare(table.slice(0, cut))
        held = [table.slice(cut)]
        rows = table.num_rows - cut
    if rows:
        yield from _compare(pa.concat_tables(held))


def _by_string(hot: DataFrame) -> DataFrame:
    """(doc, places, marked) of rows whose rank has too many: one row per string, least ids before the shuffle."""
    schema = "string long, row long, id long, doc long, bit long"

    def strings(batches):
        for batch in batches:
            around = _around(batch.column("around"))
            rank = np.asarray(batch.column("rank")).view(np.uint64)
            todo = np.asarray(batch.column("possible")) & ~np.asarray(batch.column("marked"))
            for j, string in _strings(rank, around[:, :SIDE], around[:, SIDE:]):
                at = np.flatnonzero(todo & (1 << j))
                if len(at):
                    pick = pa.array(at)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(string[at].view(np.int64)), batch.column("row").take(pick),
                         batch.column("id").take(pick), batch.column("doc").take(pick),
                         pa.array(np.full(len(at), 1 << j))],
                        ["string", "row", "id", "doc", "bit"],
                    )

    hot = written(hot.withColumn("row", F.xxhash64("doc", "places")), "hot-ranks")
    each = hot.select("rank", "row", "id", "doc", "around", "possible", "marked").mapInArrow(strings, schema)
    each = written(each, "hot-strings")
    several = each.groupBy("string").agg(F.min("id").alias("least"), F.max("id").alias("most"))
    several = written(several.filter("least < most").select("string", "least"), "hot-shared")
    found = each.join(several, "string").filter("id > least").groupBy("doc", "row").agg(
        F.bit_or("bit").alias("found")
    )
    both = hot.select("doc", "row", "places", "marked").join(written(found, "hot-found"), ["doc", "row"], "left")
    marked = F.col("marked").bitwiseOR(F.coalesce("found", F.lit(0)))
    return both.select("doc", "places", marked.alias("marked")).filter("marked <> 0")


# ---------------------------------------------------------------- the operator


def _marked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, places, marked): marks of the kept positions, ``doc`` being a hash of id and text."""
    rows = docs.filter(docs[id_col].isNotNull() & (F.octet_length(docs[text_col]) >= LENGTH)).select(
        docs[id_col].cast("long").alias("id"), docs[text_col].alias("text")
    )
    ranks = rows.mapInArrow(by_slices(_slice_ranks, most_bytes=SLICE), "rank long, id long, ids binary")
    # a rank's rows meet, but for those that are only passed on: of one rank, they go to many tasks
    meeting = F.when(F.col("id").isNull(), F.xxhash64("rank", "ids")).otherwise(F.col("rank"))
    shared = ranks.repartition(meeting).sortWithinPartitions("rank").mapInArrow(_shared_ranks, "id long, rank long")
    shared = written(shared, "shared-ranks")
    of_id = shared.groupBy("id").agg(F.collect_set("rank").alias("ranks"))
    strings = rows.join(of_id, "id").select("id", F.xxhash64("id", "text").alias("doc"), "text", "ranks")
    strings = written(strings.mapInArrow(by_slices(_slice_strings, most_bytes=SLICE), OPEN), "strings")
    settled = strings.filter("around is null and marked <> 0").select("doc", "places", "marked")
    todo = strings.filter("around is not null")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    limit = max(LEAST_HOT, todo.count() // (2 * parts))
    hot = written(todo.groupBy("rank").count().filter(F.col("count") > limit).select("rank"), "hot")
    # a hot rank has more than half a partition's rows, so there are fewer than two per partition
    hot = F.broadcast(hot)
    cold = todo.join(hot, "rank", "left_anti").repartition("rank").sortWithinPartitions("rank")
    cold = cold.select(_OPEN_NAMES).mapInArrow(_compare_sorted, "doc long, places binary, marked long")
    marks = settled.unionByName(cold)
    if not hot.isEmpty():
        marks = marks.unionByName(_by_string(todo.join(hot, "rank", "left_semi").select(_OPEN_NAMES)))
    return written(marks, "marks")


def _removed(text: bytes, places: list[bytes], marked: list[int]) -> tuple[bytes, int, int]:
    """(kept bytes, removed bytes, runs) of a text."""
    n = len(text)
    at = np.frombuffer(b"".join(places), "<i4").astype(np.int64)
    bits = np.repeat(np.array(marked, np.int64), [len(p) // 4 for p in places])
    row, before = np.nonzero(bits[:, None] >> np.arange(NEAR) & 1)
    starts = at[row] - before
    change = np.bincount(starts, minlength=n + 1) - np.bincount(starts + LENGTH, minlength=n + 1)
    gone = np.cumsum(change[:n]) > 0
    runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
    return np.frombuffer(text, np.uint8)[~gone].tobytes(), int(gone.sum()), runs


def dedup_strings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept binary): every document's bytes without the repeated ones.

    ``kept`` may end or begin in the midst of a character, as strings are of bytes.
    """
    marks = _marked(docs, id_col, text_col).groupBy("doc").agg(
        F.collect_list("places").alias("places"), F.collect_list("marked").alias("marked")
    )
    rows = docs.select(
        docs[id_col].cast("long").alias("id"), F.coalesce(docs[text_col], F.lit("")).alias("text")
    ).withColumn("doc", F.xxhash64("id", "text"))
    joined = rows.join(marks, "doc", "left").select("id", "text", "places", "marked")

    def batch(part: pa.RecordBatch) -> pa.RecordBatch:
        made = []
        for text, places, marked in zip(
            texts_of(part), part.column("places").to_pylist(), part.column("marked").to_pylist(), strict=True
        ):
            kept, removed, runs = _removed(text, places, marked) if places else (text, 0, 0)
            made.append((len(text), removed, runs, kept))
        columns = list(zip(*made, strict=True))
        types = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays(
            [part.column(0), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))],
            [id_col, "n_bytes", "n_removed", "n_spans", "kept"],
        )

    return joined.mapInArrow(
        by_slices(batch), f"`{id_col}` long, n_bytes long, n_removed long, n_spans long, kept binary"
    )
