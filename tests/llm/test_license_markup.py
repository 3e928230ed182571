import re

import pytest

from modelweave.llm.license_markup import BASE, Scanner, TEMPLATES, WORD, compile_template, scan
from modelweave.llm.license_texts import WHOLE
from tests.llm.cases import documents, edge_documents, no_documents


def words_of(text):
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def base_of(text):
    words = words_of(text)
    places, labels = [], set()
    for phrase, label in BASE.items():
        p = phrase.split()
        for i in range(len(words)):
            if words[i:i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_base_columns_equal_brute_force(spark, small):
    for docs in (documents(spark, small), edge_documents(spark), no_documents(spark)):
        rows = scan(docs).collect()
        got = sorted(repr((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)) for r in rows)
        expected = sorted(repr((r.doc_id, *base_of(r.text))) for r in docs.select("doc_id", "text").collect())
        assert got == expected
        for r in rows:
            assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) | {""}
            assert 0 <= r.score <= 1 and r.labels == ",".join(sorted(set(filter(None, r.labels.split(",")))))


@pytest.mark.parametrize("text,labels,score", [
    ("Licensed under the Apache License, Version 2.0.", "apache-2.0", 1),
    ("Licensed under the Apache License 2.0", "apache-2.0", 1),
    ("Released under the MIT License.", "mit", 1),
    ("under the terms of the MIT\n * license", "mit", 1),
    ("under the MIT permissive license", "", 0.75),
    ("GNU General Public License as published by the Free Software Foundation; either version 3 of the License, or"
     " at your option any later version", "gpl,gpl-3.0", 1),
    ("GNU General Public License, version 4", "gpl", 5 / 6),
    ("GNU Lesser General Public License", "gpl,lgpl", 1),
    ("CC BY-NC 4.0", "cc-by,cc-by-nc-4.0", 1),
    ("Copyright (c) 2020 Some Person. All rights reserved.", "copyright,reserved", 1),
    ("Copyright 1999, 2001 by one two three four five six seven. All rights reserved.", "reserved", 0.25),
    ("all rights were reserved", "", 0),
    ("", "", 0), (None, "", 0),
])
def test_templates(text, labels, score):
    found = Scanner(BASE, TEMPLATES).scan((text or "").encode())
    assert found[5] == labels and found[6] == pytest.approx(score)


def accepts(template, text):
    words = WORD.findall(text.encode().lower())
    return compile_template("x", template).share(words, 0) == 1.0


@pytest.mark.parametrize("template,text,accepted", [
    ("a [[b]] c", "a c", True), ("a [[b]] c", "a b c", True), ("a [[b]] c", "a x c", False),
    ("a [[b|d e]] c", "a d e c", True), ("a [[b|d e]] c", "a b e c", False), ("a [[b [[x]] y]] c", "a b y c", True),
    (r"a {{2: \d+}} c", "a 1 2 c", True), (r"a {{2: \d+}} c", "a 1 2 3 c", False), (r"a {{2: \d+}} c", "a x c", False),
    ("a {{3: c|d}} c", "a c d c", True), ("a b", "a b and more", True), ("a b", "a", False),
])
def test_markup(template, text, accepted):
    assert accepts(template, text) is accepted


@pytest.mark.parametrize("template", ["[[a]]", "a [[b", "a b]]", "a | b"])
def test_malformed_templates(template):
    with pytest.raises(ValueError):
        compile_template("x", template)


def _plain(template, optional):
    """A text a template accepts: each region left out, or with its first alternative and a replacement."""
    text = re.sub(r"\{\{16: .+?\}\}", " some author and others ", template)
    text = re.sub(r"\{\{1: .+?\}\}", " 1. " if optional else " ", text)
    return re.sub(r"\[\[([^|\]]*).*?\]\]", r"\1" if optional else "", text)


@pytest.mark.parametrize("label,template", WHOLE)
@pytest.mark.parametrize("optional", [False, True])
def test_whole_licences(label, template, optional):
    text = _plain(template, optional)
    scanner = Scanner(BASE, TEMPLATES + WHOLE)
    found = scanner.scan(("Some file.\n# " + text.replace("\n", "\n# ") + "# The end.").encode())
    assert [x for x in found[5].split(",") if x in dict(WHOLE)] == [label] and found[6] == 1
    words = words_of(_plain(template, False))
    automaton = compile_template(label, template)
    assert automaton.share([w.encode() for w in words], 0) == 1
    for i, word in enumerate(words):  # one mandatory word changed or left out is not accepted
        if word in ("some", "author", "and", "others"):
            continue
        for instead in ([word + "x"], []):
            changed = [w.encode() for w in words[:i] + instead + words[i + 1:]]
            assert automaton.share(changed, 0) < 1, (i, word, instead)


def test_whole_licence_in_a_table(spark):
    mit = _plain(dict(WHOLE)["mit-whole"], True)
    rows = [(1, mit), (2, mit.replace("merge", "blend")), (3, "x " * 50_000 + mit), (4, None), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.labels) for r in scan(docs).collect())
    assert got == [(1, "mit,mit-whole"), (2, "mit"), (3, "mit,mit-whole"), (4, ""), (4, "")]
