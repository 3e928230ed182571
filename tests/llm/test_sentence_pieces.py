import hashlib
import random
from array import array

import public_tokenizers
import pytest

from modelweave.llm import sentence_pieces
from tests.llm.cases import documents, edge_documents, no_documents

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def pieces():
    with open(PATH, "rb") as f:
        return sentence_pieces.Pieces(f.read())


def library(pieces, text):
    return pieces.library.encode(text, add_bos=True, add_eos=True)


def test_random_texts_equal_the_library(pieces):
    random.seed(3)
    letters = " ▁\nabcdethiéß季😀.,0123 \t<>sunk/"
    texts = ["".join(random.choices(letters, k=random.randint(0, 80))) for _ in range(2000)]
    texts += ["", " ", "  ", "▁", "▁▁ a", "\n", "\n\n a  b\n  c \n", "<s> hi </s>", "\x00a", "😀x 😀", " " * 100 + "x",
              "aaaa" * 50, "<0x41> <unk>", "﻿x", "季节 北京 大学", "é", "\U0010ffff"]
    for text in texts:
        ids = array("I", pieces.packed(text)).tolist()
        assert ids == library(pieces, text), text
        assert pieces.decode(ids) == pieces.library.decode(ids), text


def test_ids_no_encoder_made_decode_like_the_library(pieces):
    random.seed(5)
    for _ in range(300):
        ids = random.choices([0, 1, 2, *range(3, 300), 28705, 16230], k=random.randint(0, 12))
        if b"\xe2\x81\x87" not in b"".join(pieces.surface[i] for i in ids):  # without the unknown piece
            assert pieces.decode(ids) == pieces.library.decode(ids), ids


def test_a_full_cache_changes_nothing(pieces, monkeypatch):
    monkeypatch.setattr(sentence_pieces, "CACHED", 3)
    text = "many different words in one text, again many words"
    assert array("I", pieces.packed(text)).tolist() == library(pieces, text)


def test_tables(spark, small, pieces):
    for docs in (documents(spark, small), edge_documents(spark), no_documents(spark)):
        rows = sentence_pieces.digests(docs, PATH, check_every=1).collect()
        given = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in docs.select("doc_id", "text").collect())
        expected = []
        for null, i, text in given:
            ids = library(pieces, text)
            expected.append((
                None if null else i, len(ids), hashlib.sha256(array("I", ids).tobytes()).hexdigest(),
                hashlib.sha256(pieces.library.decode(ids).encode()).hexdigest(),
            ))
        assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, expected))


def test_encode_returns_ids_and_text(spark, pieces):
    docs = spark.createDataFrame([(1, "one text"), (2, None)], "doc_id long, text string")
    rows = {r.doc_id: (r.ids, r.decoded) for r in sentence_pieces.encode(docs, PATH).collect()}
    assert rows == {1: (library(pieces, "one text"), "one text"), 2: ([1, 2], "")}


def test_every_text_is_checked_both_ways(pieces):
    assert sentence_pieces.CHECK_EVERY == 1
    text = "one text"
    ids = library(pieces, text)
    sentence_pieces.checked(pieces, 1, text, ids, text)
    with pytest.raises(RuntimeError, match="encodes the text of id 1 "):
        sentence_pieces.checked(pieces, 1, text, ids[:-1], text)
    with pytest.raises(RuntimeError, match="decodes the ids of id 1 "):
        sentence_pieces.checked(pieces, 1, text, ids, "one  text")
