"""License scans with marked-up templates, compiled to automata over words.

A template is plain wording with two kinds of markup: ``[[ ... ]]`` is a region a text may leave out, and
``{{most: pattern}}`` a region it may replace by up to ``most`` words that each match the pattern. The
automaton of a template reads words only, so case, punctuation and line breaks never matter; it accepts a
run of consecutive words if all mandatory words stand there exactly, in order. A text is scanned from every
place of a template's first mandatory word, and gets the label of each template that accepts a run there. Short
templates (``TEMPLATES``) tell that a licence is named, those of ``license_texts`` that its whole text stands there.

Besides, base phrases are counted at all places where their words stand consecutively.

``score`` is the largest share of a template's mandatory words that one run of words matched in order from
the first on: 1 for an accepted template, 0 where no template begins.

Defined results: a null or empty text has no words, no labels and score 0. Rows are independent; a null id
stays null; repeated rows get equal results. An empty table gives no rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from modelweave.llm.common import by_slices, keyed, texts_of
from modelweave.llm.license_texts import WHOLE

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")  # of the lower-cased UTF-8 bytes: all but [\x00-\x2F\x3A-\x60\x7B-\x7F]

# Base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Label, template. Several templates may give one label.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("apache-2.0", r"licensed under the apache license [[version]] 2 0"),
    ("apache-2.0", r"apache license version 2 0 [[{{1: january|\d{4}}} {{1: \d{4}}}]]"),
    ("mit", r"under [[the terms of]] the mit license"),
    ("mit", r"permission is hereby granted free of charge to any person obtaining a copy of this software and"
            r" associated documentation files [[the software]] to deal in the software without restriction"),
    ("bsd", r"redistribution and use in source and binary forms with or without modification are permitted"
            r" provided that the following conditions are met"),
    ("gpl-3.0", r"gnu general public license [[as published by the free software foundation]] [[either]] version 3"
                r" [[0]] [[of the license or at your option any later version]]"),
    ("gpl-2.0", r"gnu general public license [[as published by the free software foundation]] [[either]] version 2"
                r" [[0]] [[of the license or at your option any later version]]"),
    ("lgpl", r"gnu lesser general public license"),
    ("lgpl", r"gnu library general public license"),
    ("mpl-2.0", r"mozilla public license [[version|v]] 2 0"),
    ("cc-by-4.0", r"cc by 4 0 [[international|unported]]"),
    ("cc-by-sa-4.0", r"cc by sa 4 0 [[international]]"),
    ("cc-by-nc-4.0", r"cc by nc 4 0 [[international]]"),
    ("cc-by-nd-4.0", r"cc by nd 4 0 [[international]]"),
    ("cc-by-nc-sa-4.0", r"cc by nc sa 4 0 [[international]]"),
    ("cc-by-nc-nd-4.0", r"cc by nc nd 4 0 [[international]]"),
    ("cc-by-4.0", r"creative commons attribution 4 0 international [[public]] license"),
    ("cc0-1.0", r"cc0 [[1 0]] [[universal]] [[public domain dedication]]"),
    ("copyright", r"copyright [[c]] {{6: \d{4}|[a-z\x80-\xff]+}} all rights reserved"),
)

_MARKUP = re.compile(rb"\[\[|\]\]|\||\{\{(\d+):\s*(.*?)\}\}(?!\})|[^\s\[\]|{}]+", re.S)


@dataclass
class Automaton:
    """States are numbers; ``steps[s]`` are (word or pattern, next state, mandatory) and ``free[s]`` the
    states reached without a word."""

    label: str
    steps: list[list[tuple[bytes | re.Pattern, int, bool]]] = field(default_factory=lambda: [[]])
    free: list[set[int]] = field(default_factory=lambda: [set()])
    final: int = 0
    mandatory: int = 0
    first: bytes = b""  # the first mandatory word: what may stand before it adds nothing

    def state(self) -> int:
        self.steps.append([])
        self.free.append(set())
        return len(self.steps) - 1

    def reached(self, states: dict[int, int]) -> dict[int, int]:
        """With all states reached without a word; a state's value is the most mandatory words behind it."""
        todo = list(states.items())
        while todo:
            s, done = todo.pop()
            for nxt in self.free[s]:
                if states.get(nxt, -1) < done:
                    states[nxt] = done
                    todo.append((nxt, done))
        return states

    def share(self, words: list[bytes], at: int) -> float:
        """Share of the mandatory words matched by the run that begins at ``at``; 1 if it is accepted."""
        now, best = self.reached({0: 0}), 0
        while True:
            if self.final in now:
                return 1.0
            if at >= len(words):
                break
            word, nxt = words[at], {}
            for s, done in now.items():
                for want, to, counts in self.steps[s]:
                    if want == word if isinstance(want, bytes) else want.fullmatch(word):
                        nxt[to] = max(nxt.get(to, -1), done + counts)
            if not nxt:
                break
            now = self.reached(nxt)
            best = max(best, *now.values())
            at += 1
        return min(best / self.mandatory, 1.0)


def compile_template(label: str, text: str) -> Automaton:
    """The automaton of a template. Optional regions may hold alternatives (``a|b``) and replaceable regions."""
    a = Automaton(label)
    here = 0
    regions: list[tuple[int, int, int]] = []  # (state before, state behind, start of the alternative)
    for m in _MARKUP.finditer(text.encode()):
        token = m[0]
        if token == b"[[":
            behind = a.state()
            a.free[here].add(behind)
            regions.append((here, behind, here))
        elif token == b"|":
            if not regions:
                raise ValueError(f"an alternative outside an optional region of {label}")
            a.free[here].add(regions[-1][1])
            here = regions[-1][0]
        elif token == b"]]":
            if not regions:
                raise ValueError(f"an optional region of {label} ends before it begins")
            _, behind, _ = regions.pop()
            a.free[here].add(behind)
            here = behind
        elif m[1] is not None:
            pattern, behind = re.compile(m[2].strip()), a.state()
            a.free[here].add(behind)
            for _ in range(int(m[1])):
                nxt = a.state()
                a.steps[here].append((pattern, nxt, False))
                a.free[nxt].add(behind)
                here = nxt
            here = behind
        else:
            for word in WORD.findall(token.lower()):
                nxt = a.state()
                a.steps[here].append((word, nxt, not regions))
                if not regions:
                    a.first = a.first or word
                    a.mandatory += 1
                here = nxt
    if regions or not a.mandatory:
        raise ValueError(f"the template of {label} is not closed, or has no mandatory word")
    a.final = here
    return a


class Scanner:
    """Base phrases and templates, ready to scan the words of a text."""

    def __init__(self, base: dict[str, str], templates):
        self.base = [(tuple(p.encode().split()), label) for p, label in base.items()]
        self.by_first: dict[bytes, list[Automaton]] = {}
        for label, text in templates:
            a = compile_template(label, text)
            self.by_first.setdefault(a.first, []).append(a)
        self.rare = frozenset(self.by_first) | {p[0] for p, _ in self.base}

    def scan(self, text: bytes):
        """(n_words, n_base, first_word, last_word, base_labels, labels, score) of a text."""
        words = WORD.findall(text.lower())
        places = [i for i, w in enumerate(words) if w in self.rare] if not self.rare.isdisjoint(words) else []
        hits, base, labels, score = [], set(), set(), 0.0
        for i in places:
            for phrase, label in self.base:
                if phrase[0] == words[i] and tuple(words[i:i + len(phrase)]) == phrase:
                    hits.append(i)
                    base.add(label)
            for a in self.by_first.get(words[i], ()):
                share = a.share(words, i)
                score = max(score, share)
                if share == 1.0:
                    labels.add(a.label)
        return (
            len(words), len(hits), min(hits, default=None), max(hits, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | labels)), score,
        )


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", base: dict[str, str] = BASE,
    templates=TEMPLATES + WHOLE,
) -> DataFrame:
    """One row per document: counts, places of base phrases, labels and score."""
    kept: list[Scanner] = []

    def batch(part: pa.RecordBatch) -> pa.RecordBatch:
        if not kept:
            kept.append(Scanner(base, templates))
        rows = [kept[0].scan(t) for t in texts_of(part)]
        columns = list(zip(*rows, strict=True))
        types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
        return pa.RecordBatch.from_arrays(
            [part.column(0), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names
        )

    names = [id_col, "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    schema = (
        f"`{id_col}` long, n_words long, n_base long, first_word long, last_word long, base_labels string,"
        " labels string, score double"
    )
    return keyed(docs, id_col, text_col).mapInArrow(by_slices(batch), schema)
