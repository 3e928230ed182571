"""Simple-8b words and token files: exact round trips, ids as the library gives them."""

import hashlib
import io
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from modelweave.llm import runs as run_table
from modelweave.llm import simple8b, token_files
from tests.llm.cases import SCHEMA, documents, edge_documents, no_documents

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    with open(PATH, encoding="utf-8") as f:
        return token_files.Encoder(f.read())


def test_numbers_come_back():
    random_ = np.random.default_rng(1)
    cases = [np.zeros(0), np.zeros(1), np.zeros(1000), np.arange(300), np.full(7, 2**60 - 1), np.full(3, 2**60)]
    for bits in range(65):
        cases.append(random_.integers(0, 2**bits, 500, dtype=np.uint64, endpoint=False) if bits < 64
                     else random_.integers(0, 2**64 - 1, 500, dtype=np.uint64, endpoint=True))
    for _ in range(200):
        widths = random_.choice([0, 1, 3, 8, 15, 16, 40, 63], random_.integers(1, 400))
        cases.append(np.array([random_.integers(0, 2**int(w), dtype=np.uint64) for w in widths], np.uint64))
    for case in cases:
        case = np.asarray(case, np.uint64)
        words, full = simple8b.pack(case)
        assert (simple8b.unpack(words, full, len(case)) == case).all()


def test_small_numbers_take_little_room():
    assert len(simple8b.pack(np.zeros(4800))[0]) == 20
    assert len(simple8b.pack(np.ones(600))[0]) == 10
    assert len(simple8b.pack(np.full(400, 30_000))[0]) == 100
    words, full = simple8b.pack(np.array([1, 2**60, 1], np.uint64))
    assert len(full) == 1 and len(words) == 3


def test_runs_are_encoded_as_the_whole_text_is(library, encoder):
    assert encoder.by_run
    generator = random.Random(2)
    letters = "abAB  \t\n\x0b\x1c\x1f\x85 ᠎​́̀éßΣσİ가ᄀ1²'.,-<|>季😀　ﬁ"
    words = ["don't", "<|endoftext|>", "<|startoftext|>x", "I'LL", "a<|b", "ΣΑΣ", "́", "’s", "'", "''s"]
    texts = ["".join(generator.choices(letters, k=generator.randint(0, 60))) for _ in range(3000)]
    texts += [" ".join(generator.choices(words, k=5)) for _ in range(500)] + ["", " ", "\n", "word " * 3000]
    texts += ["".join(generator.choices("aB1,.'$é€́ <", k=12)) for _ in range(3000)]
    got = encoder.encode([t.encode() for t in texts])
    for text, ids in zip(texts, got, strict=True):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize(("places", "runs"), [(4, 1000), (1 << 21, 3)])
def test_a_full_table_changes_nothing(library, monkeypatch, places, runs):
    monkeypatch.setattr(run_table, "PLACES", places)
    monkeypatch.setattr(run_table, "MOST_RUNS", runs)
    with open(PATH, encoding="utf-8") as f:
        encoder = token_files.Encoder(f.read())
    for text in ("many different words", "again many other words", "many", "a b c d e f g h i j k l", "many a b") * 2:
        assert encoder.encode([text.encode()])[0].tolist() == library.encode(text, add_special_tokens=False).ids


def test_other_tokenizers_are_given_whole_texts():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        other = token_files.Encoder(f.read())
    assert not other.by_run
    text = "two  words\n"
    assert other.encode([text.encode()])[0].tolist() == other.library.encode(text).ids


def brute(library, rows):
    out, start = [], 0
    coded = []
    for i, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        digest = hashlib.md5((text or "").encode()).hexdigest()
        coded.append((i is not None, i or 0, digest, zlib.crc32(np.array(ids, "<u4").tobytes()), len(ids)))
    for has, i, _, crc, n in sorted(coded):
        out.append((i if has else None, start, n, crc))
        start += n
    return out


def test_tables(spark, small, library, monkeypatch):
    for docs in (documents(spark, small), edge_documents(spark), no_documents(spark)):
        got = token_files.digests(docs, PATH)
        assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
        expected = brute(library, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
        assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == expected


def test_many_files_in_order(spark, library, monkeypatch):
    monkeypatch.setattr(token_files, "RANGE_BYTES", 400)
    monkeypatch.setattr(token_files, "GROUP", 3)
    generator = random.Random(4)
    rows = [(generator.randrange(60), " ".join(generator.choices(["one", "two", "x1"], k=generator.randint(0, 30))))
            for _ in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    folder, manifest = token_files.write_files(docs, PATH)
    named = sorted(manifest.collect(), key=lambda r: (r.part, r.seq))
    assert len(named) > 5
    assert [r.start for r in named] == np.cumsum([0, *[r.n_ids for r in named[:-1]]]).tolist()
    read = sorted(token_files.read_files(spark, folder, manifest).collect(), key=lambda r: r.start)
    got = [(r.id, r.start, r.n, zlib.crc32(np.array(r.ids, "<u4").tobytes())) for r in read]
    assert got == brute(library, rows)


def test_ids_as_a_table(spark, library):
    docs = spark.createDataFrame([(1, "one text"), (2, None)], "doc_id long, text string")
    assert sorted(map(tuple, token_files.token_ids(docs, PATH).collect())) == [
        (1, [*library.encode("one text", add_special_tokens=False).ids, 1]), (2, [1])]


def test_extra_columns_with_clashing_names(spark, library):
    rows = [(1, "a", "x", 5, 6, 0.5, 1, 2), (None, "b", "x", 5, 6, 0.5, 1, 2)]
    got = token_files.digests(spark.createDataFrame(rows, SCHEMA), PATH).collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == brute(library, [(1, "a"), (None, "b")])


def test_a_file_is_read_by_ranges():
    made, given = token_files._File(), []
    generator = np.random.default_rng(3)
    for i in range(40):
        ids = generator.integers(0, 2**int(generator.integers(1, 33)), int(generator.integers(0, 900)))
        made.add([None if i == 3 else i], np.array([len(ids)]), ids)
        given.append(ids)
    raw = b"".join(made.content())
    reader = token_files.Reader(io.BytesIO(raw))
    whole = np.concatenate(given)
    assert reader.n_blocks == -(-len(whole) // token_files.BLOCK_IDS) > 2
    for start, stop in ((0, 0), (0, len(whole)), (4095, 4097), (5000, 5001), (len(whole) - 1, len(whole))):
        assert (reader.between(start, stop) == whole[start:stop]).all()
    parts = [ids for _, _, ids in reader.documents(most=1000)]
    assert len(parts) > 5 and (np.concatenate(parts) == whole).all()
    assert reader.has_id.tolist() == [int(i != 3) for i in range(40)]
    with pytest.raises(ValueError, match="no token file"):
        token_files.Reader(io.BytesIO(b"x" * 100))
    with pytest.raises(ValueError, match="cut off"):
        token_files.Reader(io.BytesIO(raw[:-8])).between(0, len(whole))


def test_files_no_manifest_names_are_not_read(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    folder, manifest = token_files.write_files(docs, PATH)
    store, base = token_files._opened(folder)
    with store.open_output_stream(f"{base}/part-000000-0000-left.tok") as out:
        out.write(b"cut")
    assert [(r.id, r.start) for r in token_files.read_files(spark, folder, manifest).orderBy("start").collect()] == [
        (1, 0), (2, 3)]
