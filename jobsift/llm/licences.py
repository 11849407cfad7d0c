"""License scans by template-markup matching.

A template is license wording with markup: ``<<optional>>...<<end>>`` may be
left out, ``<<any a-b>>`` stands for ``a`` to ``b`` words of any kind (names,
years, versions); all other words are mandatory and must match exactly, in
order, with nothing between.  Templates are compiled to one token automaton:
a nondeterministic one whose sets of states are made deterministic as texts
need them.  A text gets a template's label if the automaton accepts a stretch
of its words.

Words are runs of letters and digits after lower-casing A to Z; every character
past ASCII belongs to a word.

Defined cases: a null or empty text has no word, no label and score 0; repeated
rows get the same answer each; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import id_text, rebatched, texts_of

#: A to Z to lower case, other ASCII that is no letter or digit to a space.
WORDS = bytes(x + 32 if 65 <= x <= 90 else x if 48 <= x <= 57 or 97 <= x <= 122 or x >= 128 else 32 for x in range(256))

#: The contract's phrases and labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: Public license wordings; labels after the public list of license identifiers.
TEMPLATES = {
    "Apache-2.0": "licensed under the apache license <<optional>>version<<end>> 2 <<optional>>0<<end>>",
    "Apache-2.0-header": "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at <<any 0-8>> unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "GPL-3.0": "<<optional>>released<<end>> <<optional>>licensed<<end>> under the <<optional>>terms of the<<end>> gnu general public license <<optional>>as published by the free software foundation either<<end>> version 3",
    "GPL-2.0": "<<optional>>released<<end>> <<optional>>licensed<<end>> under the <<optional>>terms of the<<end>> gnu general public license <<optional>>as published by the free software foundation either<<end>> version 2",
    "MIT": "under the <<optional>>terms of the<<end>> mit license",
    "MIT-text": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice <<optional>>including the next paragraph<<end>> shall be included in all copies or substantial portions of the software",
    "ISC": "permission to use copy modify and <<optional>>or<<end>> distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "BSD": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "CC-BY": "under <<optional>>a<<end>> <<optional>>the<<end>> <<optional>>creative commons<<end>> cc by <<optional>>license<<end>> <<any 1-1>> 0",
    "CC-BY-NC": "under <<optional>>a<<end>> <<optional>>the<<end>> <<optional>>creative commons<<end>> cc by nc <<optional>>license<<end>> <<any 1-1>> 0",
    "CC-BY-NC-SA": "under <<optional>>a<<end>> <<optional>>the<<end>> <<optional>>creative commons<<end>> cc by nc sa <<optional>>license<<end>> <<any 1-1>> 0",
    "CC-BY-SA": "under <<optional>>a<<end>> <<optional>>the<<end>> <<optional>>creative commons<<end>> cc by sa <<optional>>license<<end>> <<any 1-1>> 0",
    "CC0-1.0": "<<any 0-1>> cc0 <<optional>>universal<<end>> 1 0",
    "MPL-2.0": "subject to the terms of the mozilla public license v 2 0",
    "SPDX": "spdx license identifier <<any 1-4>>",
}

_MARK = re.compile(r"<<optional>>|<<end>>|<<any (\d+)-(\d+)>>|[^\s<>]+")


def parsed(template: str) -> list[tuple]:
    """Parts in order: ("word", w), ("any", least, most) or ("optional", parts)."""
    open_: list[list[tuple]] = [[]]
    for m in _MARK.finditer(template.lower()):
        if m[0] == "<<optional>>":
            open_.append([])
        elif m[0] == "<<end>>":
            inner = open_.pop()
            open_[-1].append(("optional", inner))
        elif m[1] is not None:
            open_[-1].append(("any", int(m[1]), int(m[2])))
        else:
            open_[-1].append(("word", m[0].encode()))
    if len(open_) != 1:
        raise ValueError(f"an optional part is not closed: {template}")
    return open_[0]


def expression(parts: list[tuple]) -> str:
    """The same template as a regular expression over words that each end in a space."""
    out = ""
    for part in parts:
        if part[0] == "word":
            out += re.escape(part[1].decode()) + " "
        elif part[0] == "any":
            out += "(?:[^ ]+ ){%d,%d}" % part[1:]
        else:
            out += f"(?:{expression(part[1])})?"
    return out


class Automaton:
    """All templates as one automaton over words."""

    def __init__(self, templates: dict[str, str]):
        self.words: dict[bytes, int] = {}
        self.steps: list[list[tuple[int | None, int]]] = []  # of a state: (word or None for any, next)
        self.free: list[list[int]] = []  # steps that take no word
        self.label: dict[int, str] = {}
        starts = []
        for label, template in templates.items():
            at = self._state()
            starts.append(at)
            self.label[self._build(parsed(template), at)] = label
        self.start = self._closed(starts)
        self.sets: dict[frozenset, int] = {}
        self.members: list[frozenset] = []
        self.found: list[frozenset] = []
        self.next: list[dict[int, int]] = []
        self.begin = self._set(frozenset(self.start))

    def _state(self) -> int:
        self.steps.append([])
        self.free.append([])
        return len(self.steps) - 1

    def _build(self, parts: list[tuple], at: int) -> int:
        for part in parts:
            if part[0] == "optional":
                end = self._build(part[1], at)
                done = self._state()
                self.free[end].append(done)
                self.free[at].append(done)
                at = done
                continue
            for k in range(1 if part[0] == "word" else part[2]):
                to = self._state()
                self.steps[at].append((self.words.setdefault(part[1], len(self.words)) if part[0] == "word" else None, to))
                if part[0] == "any" and k >= part[1]:
                    self.free[at].append(to)
                at = to
        return at

    def _closed(self, states: list[int]) -> set[int]:
        out, todo = set(), list(states)
        while todo:
            if (s := todo.pop()) not in out:
                out.add(s)
                todo += self.free[s]
        return out

    def _set(self, members: frozenset) -> int:
        if members not in self.sets:
            self.sets[members] = len(self.members)
            self.members.append(members)
            self.found.append(frozenset(self.label[s] for s in members if s in self.label))
            self.next.append({})
        return self.sets[members]

    def labels(self, words: list[bytes]) -> set[str]:
        """Labels of the templates that accept some stretch of ``words``."""
        out: set[str] = set()
        state, known, most = self.begin, self.words, 20_000
        for word in words:
            w = known.get(word, -1)
            to = self.next[state].get(w)
            if to is None:
                moved = [t for s in self.members[state] for need, t in self.steps[s] if need is None or need == w]
                to = self.next[state][w] = self._set(frozenset(self._closed(moved) | self.start))
            state = to
            if self.found[state]:
                out |= self.found[state]
        if len(self.members) > most:  # sets are remade when needed
            self.sets, self.members, self.found, self.next = {}, [], [], []
            self.begin = self._set(frozenset(self.start))
        return out


def places(joined: bytes, phrase: bytes) -> list[int]:
    """Word places of ``phrase`` in words that each have a space on both sides."""
    out, at, words, seen = [], -1, 0, 0
    while (at := joined.find(b" " + phrase + b" ", at + 1)) >= 0:
        words += joined.count(b" ", seen, at)
        seen = at
        out.append(words)
    return out


SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def _needed(parts: list[tuple]) -> list[bytes]:
    return [p[1] for p in parts if p[0] == "word"]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] | None = None) -> DataFrame:
    """One row for each row of ``docs``; score: 1 if a template is accepted,
    0.5 if only a base phrase stands there, else 0."""
    templates = TEMPLATES if templates is None else templates
    phrases = {k.encode(): v for k, v in PHRASES.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(templates)
        # A text without the longest mandatory word of any template needs no automaton.
        keys = {max(_needed(parsed(t)), key=len) for t in templates.values()}
        pattern = re.compile(b"|".join(map(re.escape, sorted(keys))))
        rough = re.compile(b"|".join(re.escape(max(p.split(), key=len)) for p in phrases))
        for batch in rebatched(batches, 2 << 20):
            rows = []
            for text in texts_of(batch):
                text = text.translate(WORDS)
                words = text.split()
                at: list[int] = []
                base: set[str] = set()
                if rough.search(text):
                    joined = b" " + b" ".join(words) + b" "
                    for phrase, label in phrases.items():
                        if here := places(joined, phrase):
                            at += here
                            base.add(label)
                more = automaton.labels(words) if pattern.search(text) else set()
                rows.append((len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(base)), ",".join(sorted(base | more)), 1.0 if more else 0.5 if base else 0.0))
            if rows:
                kinds = [*[pa.int64()] * 4, *[pa.string()] * 2, pa.float64()]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True))], ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])

    return id_text(docs, id_col, text_col).mapInArrow(run, SCHEMA)


def oracle(templates: dict[str, str] | None = None) -> str:
    """The same result in DuckDB's SQL: templates as regular expressions over the words."""
    templates = TEMPLATES if templates is None else templates
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    hits = [f"list_transform(list_filter(range(1, len(words) + 1), lambda i: {' AND '.join(f'words[i + {k}] = {w!r}' for k, w in enumerate(p.split()))}), lambda i: i - 1)" for p in PHRASES]
    base = [f"CASE WHEN len(p{k}) > 0 THEN '{label}' END" for k, label in enumerate(PHRASES.values())]
    more = [f"CASE WHEN regexp_matches(joined, '(?:^| )(?:{expression(parsed(t))})') THEN '{label}' END" for label, t in templates.items()]
    named = lambda x: f"array_to_string(list_sort(list_distinct(list_filter({x}, lambda y: y IS NOT NULL))), ',')"
    return f"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
p AS (SELECT doc_id, words, array_to_string(words, ' ') || ' ' AS joined, {', '.join(f'{h} AS p{k}' for k, h in enumerate(hits))} FROM w),
l AS (SELECT doc_id, words, list_concat(list_concat(p0, p1), list_concat(p2, p3)) AS spots, [{', '.join(base)}] AS base, [{', '.join(more)}] AS more FROM p)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(spots) AS BIGINT) AS n_base,
  CAST(list_min(spots) AS BIGINT) AS first_word, CAST(list_max(spots) AS BIGINT) AS last_word,
  coalesce({named('base')}, '') AS base_labels, coalesce({named('list_concat(base, more)')}, '') AS labels,
  CASE WHEN len(list_filter(more, lambda y: y IS NOT NULL)) > 0 THEN 1.0 WHEN len(spots) > 0 THEN 0.5 ELSE 0.0 END::DOUBLE AS score
FROM l"""
