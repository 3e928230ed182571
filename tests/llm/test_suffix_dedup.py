import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from modelweave.llm import suffix_dedup
from tests.llm.cases import documents, edge_documents, no_documents


def brute(rows):
    first, out = {}, []
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for at in range(len(data) - 49 if i is not None else 0):
            earliest = first.setdefault(data[at:at + 50], i)
            if earliest < i:
                gone[at:at + 50] = True
        runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out.append((i, len(data), int(gone.sum()), runs, np.frombuffer(data, np.uint8)[~gone].tobytes()))
    return Counter(out)


def found(docs):
    return Counter(
        (r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.dedup_strings(docs).collect()
    )


def periodic(spark):
    random.seed(1)
    parts = ["abcde", "fghij", " xy z", "qrst\n"]
    rows = [(i, "".join(random.choice(parts) for _ in range(random.randint(0, 60)))) for i in range(200)]
    rows += [(500 + i, "a" * (45 + i)) for i in range(12)] + [(600 + i, "ab" * random.randint(10, 80)) for i in range(40)]
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.mark.parametrize("least_hot", [2, 10**9])
def test_periodic_and_frequent_strings(spark, monkeypatch, least_hot):
    monkeypatch.setattr(suffix_dedup, "LEAST_HOT", least_hot)
    docs = periodic(spark).repartition(3)
    if least_hot == 2:
        monkeypatch.setattr(suffix_dedup, "SLICE", 2000)  # strings meet in the cluster, not in one slice
    assert found(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_awkward_rows(spark):
    docs = edge_documents(spark)
    assert found(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])
    assert found(no_documents(spark)) == Counter()


def test_long_texts_are_cut_without_loss(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 300)
    texts = [t.encode() for t in ("x" * 1000, "abc" * 700, "some words " * 90, "q" * 50, "q" * 49)]
    for text in texts:
        _, at, _ = suffix_dedup.kept_positions([text])
        # every string of 50 bytes holds a kept position with its first 24 bytes
        for start in range(len(text) - 49):
            assert ((at >= start) & (at <= start + 26)).any()


def test_documents(spark, small):
    docs = documents(spark, small)
    assert found(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_shared_ranks_hold_one_row_of_a_rank():
    """Ranks over the borders of batches, with ids passed on, against plain sets."""
    random.seed(5)
    given = sorted((random.randint(0, 30), random.randint(0, 3)) for _ in range(300))
    given += [(50, 7)] * 40 + [(60, 8)] * 25 + [(60, 9)]  # one id only; a second one at the very end
    ids_of = {}
    for rank, i in given:
        ids_of.setdefault(rank, set()).add(i)
    rows = [(rank, i, None) for rank, i in given] + [(70, 1, b""), (70, None, np.array([2, 3]).tobytes())]
    schema = pa.schema([("rank", pa.int64()), ("id", pa.int64()), ("ids", pa.binary())])
    for size in (1, 2, 7, 1000):
        batches = [
            pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows[at:at + size]), schema)], schema=schema)
            for at in range(0, len(rows), size)
        ]
        got = {(i, r) for b in suffix_dedup._shared_ranks(iter(batches)) for i, r in zip(*b.to_pydict().values())}
        want = {(i, r) for r, ids in ids_of.items() if len(ids) > 1 for i in ids}
        assert got == want | {(1, 70), (2, 70), (3, 70)}


@pytest.mark.parametrize("slice_bytes", [400, 1 << 20])
def test_a_passage_of_a_third_of_all_documents(spark, monkeypatch, slice_bytes):
    monkeypatch.setattr(suffix_dedup, "SLICE", slice_bytes)
    passage = "this passage of more than fifty bytes stands in a third of all documents; "
    rows = [(i, (passage if i % 3 == 0 else "") + f"own words of document {i} " * 4) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found(docs) == brute(rows)


def slice_rows(rows, monkeypatch):
    """(rows of `_slice_strings` with all ranks wanted, number of rows compared string by string)."""
    compared = []

    def strings(rank, *columns, plain=suffix_dedup._strings):
        compared.append(len(rank))
        return plain(rank, *columns)

    monkeypatch.setattr(suffix_dedup, "_strings", strings)
    _, _, rank = suffix_dedup.kept_positions([t.encode() for _, t in rows])
    ranks = [np.unique(rank).view(np.int64).tolist()] * len(rows)
    columns = [[i for i, _ in rows], list(range(len(rows))), [t for _, t in rows], ranks]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["id", "doc", "text", "ranks"])
    return [r for b in suffix_dedup._slice_strings(batch) for r in b.to_pylist()], sum(compared)


def check_marks(rows, found):
    """The strings that are marked, by their first bytes, are those of which a smaller id has another."""
    strings_of = [[t.encode()[at:at + 50] for at in range(len(t) - 49)] for _, t in rows]
    least = {}
    for (i, _), strings in zip(rows, strings_of):
        for x in strings:
            least[x] = min(least.get(x, i), i)
    want = {(doc, at) for doc, (i, _) in enumerate(rows) for at, x in enumerate(strings_of[doc]) if least[x] < i}
    got = set()
    for r in found:
        assert not r["marked"] & ~r["possible"]
        for at in np.frombuffer(r["places"], "<i4").tolist():
            got |= {(r["doc"], at - j) for j in range(suffix_dedup.NEAR) if r["marked"] >> j & 1}
    assert got == want and want


def test_copies_are_not_compared_string_by_string(monkeypatch):
    random.seed(11)
    passage = "".join(random.choice("abcdefghijklmnop ") for _ in range(1500))
    rows = [(i, f"own words of {i} " * 4 + passage + f" and the end of {i}" * 3) for i in range(30)]
    found, compared = slice_rows(rows, monkeypatch)
    check_marks(rows, found)
    assert len(found) > 30 * 80
    assert [r["doc"] for r in found] == sorted(r["doc"] for r in found)  # text order takes less disk
    assert compared < len(found) / 4  # only those at the passage's ends have other bytes around them


def test_marks_where_surroundings_differ(monkeypatch):
    random.seed(12)
    parts = ["abcde", "fghij", " xy z", "qrst\n"]
    rows = [(i // 2, "".join(random.choice(parts) for _ in range(random.randint(8, 40)))) for i in range(120)]
    rows += [(i, rows[i][1]) for i in range(0, 40, 3)] + [(200, "a" * 90), (200, "a" * 70), (3, "a" * 60)]
    random.shuffle(rows)
    found, compared = slice_rows(rows, monkeypatch)
    check_marks(rows, found)
    assert compared


def test_bytes_of_sliced_and_chunked_columns():
    values = [b"ab", b"cd", b"", b"ef", b"gh"]
    for kind in (pa.binary(), pa.large_binary()):
        column = pa.array(values, kind)
        assert suffix_dedup._bytes_of(column.slice(1, 3)).tobytes() == b"cdef"
        assert suffix_dedup._bytes_of(pa.chunked_array([column.slice(1), column.slice(5), column])).tobytes() == b"cdefghabcdefgh"
        assert not len(suffix_dedup._bytes_of(column.slice(2, 1))) and not len(suffix_dedup._bytes_of(column.slice(0, 0)))
