"""License scan: matching statistics against a generalised suffix automaton of licence words, chained into template spans.

All templates and base phrases are put into one suffix automaton over words. A text is streamed
through it once: after every word the automaton knows the longest run of words ending there that any
template holds. Runs that cannot be extended and have at least `LEAST` words are matches, at every
place of every template that holds them. The matches of a template whose places rise in the text and
in the template, with at most `GAP` words between them in either, are chained so that the words
covered are most; a chain that covers `COVERAGE` of a template is a span and gives its label. A base
phrase is found where the current run ends in it, which the automaton's suffix links tell.

`score` is the largest share of a template or base phrase that the text covers in one chain.

* Null and empty texts have no words, no labels and score 0.
* A long text is one pass; words that no template holds are skipped by array arithmetic. Chaining looks
  back no further than `GAP` words before a match.
* Rows are never joined or grouped, so repeated rows and repeated or null ids are rows of their own.
* Equally good chains: the one that begins earlier in the text, then in the template.
* Other columns, whatever they are called, are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.words import PLAIN_TABLE, find_words, slices

# Base phrases and their labels.
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Published licence notices, one or more per label.
TEMPLATES = [
    (
        "apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the"
        " License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by"
        " applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS,"
        " WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language"
        " governing permissions and limitations under the License.",
    ),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the Software), to deal in the Software without restriction, including without limitation the"
        " rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit"
        " persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice"
        " and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    (
        "gpl-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public"
        " License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later"
        " version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the"
        " implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more"
        " details.",
    ),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    (
        "gpl-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public"
        " License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later"
        " version.",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
        " following conditions are met: Redistributions of source code must retain the above copyright notice, this list of"
        " conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice,"
        " this list of conditions and the following disclaimer in the documentation and/or other materials provided with the"
        " distribution.",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,"
        " provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "mpl-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not"
        " distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    (
        "unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use,"
        " compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose,"
        " commercial or non-commercial, and by any means.",
    ),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-4.0", "Licensed under CC BY 4.0"),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution ShareAlike 4.0 International License"),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    ("cc-by-nc-4.0", "This work is licensed under a Creative Commons Attribution NonCommercial 4.0 International License"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
]

# Words of the shortest match, words between two matches of a chain, and the share of a template that makes a span.
LEAST = 3
GAP = 8
COVERAGE = 0.85

SPAN_TYPE = "array<struct<label:string,first_word:long,last_word:long,covered:long,share:double>>"
SCAN_TYPE = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, "
    f"score double, spans {SPAN_TYPE}"
)


def words_of(text: str) -> list[str]:
    """Words of a template or phrase; they are ASCII."""
    return re.findall("[0-9a-z]+", text.lower())


class SuffixAutomaton:
    """All runs of words of several sequences. State 0 is the empty run."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        # Places (sequence, end) of the longest run of a state; after `spread`, of all states that it is a suffix of.
        self.ends: list[set[tuple[int, int]]] = [set()]

    def _state(self, length: int, following: dict[int, int], link: int) -> int:
        self.next.append(dict(following))
        self.length.append(length)
        self.link.append(link)
        self.ends.append(set())
        return len(self.next) - 1

    def _split(self, state: int, word: int, to: int) -> int:
        """A state for the runs of `to` that are one word longer than those of `state`."""
        clone = self._state(self.length[state] + 1, self.next[to], self.link[to])
        self.link[to] = clone
        while state >= 0 and self.next[state].get(word) == to:
            self.next[state][word] = clone
            state = self.link[state]
        return clone

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:
            to = self.next[last][word]
            return to if self.length[to] == self.length[last] + 1 else self._split(last, word, to)
        new = self._state(self.length[last] + 1, {}, 0)
        while last >= 0 and word not in self.next[last]:
            self.next[last][word] = new
            last = self.link[last]
        if last >= 0:
            to = self.next[last][word]
            self.link[new] = to if self.length[to] == self.length[last] + 1 else self._split(last, word, to)
        return new

    def add(self, sequence: int, words: list[int]) -> None:
        state = 0
        for end, word in enumerate(words, 1):
            state = self._extend(state, word)
            self.ends[state].add((sequence, end))

    def spread(self) -> None:
        """Hands places down the suffix links, longest runs first."""
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            if self.link[state] > 0:
                self.ends[self.link[state]] |= self.ends[state]

    def step(self, state: int, length: int, word: int) -> tuple[int, int]:
        """State and length of the longest run that ends with `word`, from that before it."""
        while state and word not in self.next[state]:
            state = self.link[state]
            length = self.length[state]
        if word in self.next[state]:
            return self.next[state][word], length + 1
        return 0, 0


@dataclass(frozen=True)
class Compiled:
    """The automaton, the hashes of its words in order, the length of every template, and the phrases that end each state."""

    automaton: SuffixAutomaton
    hashes: np.ndarray
    lengths: list[int]
    phrases: list[list[int]]
    phrase_words: list[int]


@cache
def compiled() -> Compiled:
    texts = [words_of(t) for _, t in TEMPLATES]
    phrases = [words_of(p) for p in BASE_PHRASES]
    listed = sorted({w for words in texts + phrases for w in words})
    hashes = find_words(pa.array([" ".join(listed)]), PLAIN_TABLE).hash
    hashes, number = np.unique(hashes, return_inverse=True)
    ids = dict(zip(listed, number.tolist()))
    automaton = SuffixAutomaton()
    for i, words in enumerate(texts + phrases):
        automaton.add(i, [ids[w] for w in words])
    ends_in = _phrases_of_states(automaton, [[ids[w] for w in p] for p in phrases])
    automaton.spread()
    # Phrases take part in the automaton, not as templates.
    automaton.ends = [{e for e in ends if e[0] < len(texts)} for ends in automaton.ends]
    return Compiled(automaton, hashes, [len(t) for t in texts], ends_in, [len(p) for p in phrases])


def _phrases_of_states(automaton: SuffixAutomaton, phrases: list[list[int]]) -> list[list[int]]:
    """Phrases that are suffixes of a state's runs, provided that the run is as long: those of its state and of its links."""
    own: list[list[int]] = [[] for _ in automaton.next]
    for i, words in enumerate(phrases):
        state = 0
        for word in words:
            state = automaton.next[state][word]
        own[state].append(i)
    out: list[list[int]] = [[] for _ in own]
    for state in sorted(range(1, len(own)), key=automaton.length.__getitem__):
        out[state] = own[state] + out[automaton.link[state]]
    return out


# (end in the text, length, state) of a run that cannot be extended
Run = tuple[int, int, int]


def stream(scan: Compiled, ids: list[int], base: int) -> tuple[list[Run], list[tuple[int, int]]]:
    """Unextendable runs, and (start, phrase) of the base phrases, of neighbouring words that begin at word `base`."""
    automaton, phrases, phrase_words = scan.automaton, scan.phrases, scan.phrase_words
    runs, found = [], []
    state = length = 0
    for at, word in enumerate(ids, base):
        before, held = state, length
        state, length = automaton.step(state, length, word)
        if length != held + 1 and held >= LEAST:
            runs.append((at, held, before))
        for phrase in phrases[state]:
            if length >= phrase_words[phrase]:
                found.append((at + 1 - phrase_words[phrase], phrase))
    if length >= LEAST:
        runs.append((base + len(ids), length, state))
    return runs, found


@dataclass
class Match:
    """Words `start` to `end` of the text equal those that end at `to` of a template."""

    start: int
    end: int
    to: int
    covered: int = 0
    first: int = 0
    before: int = -1


@dataclass(frozen=True)
class Span:
    template: int
    first: int
    last: int
    covered: int


def chains(matches: list[Match]) -> list[tuple[Match, int]]:
    """The best chains of one template's matches, no match in two of them, with the words that each covers."""
    matches.sort(key=lambda m: (m.end, m.to, m.start))
    for i, m in enumerate(matches):
        m.covered, m.first, m.before = m.end - m.start, m.start, -1
        begin = m.to - (m.end - m.start)
        for j in range(i - 1, -1, -1):
            p = matches[j]
            if p.end < m.start - GAP:
                break
            if p.to < begin - GAP:
                continue
            # Where two matches overlap, the later one counts from the end of the earlier.
            gain = min(m.end - m.start, m.end - p.end, m.to - p.to)
            if gain > 0 and (p.covered + gain, -p.first) > (m.covered, -m.first):
                m.covered, m.first, m.before = p.covered + gain, p.first, j
    used, out = set(), []
    for i in sorted(range(len(matches)), key=lambda i: (-matches[i].covered, matches[i].first, matches[i].to)):
        at, path = i, []
        while at >= 0 and at not in used:
            path.append(at)
            at = matches[at].before
        if at < 0:
            used.update(path)
            out.append((matches[i], matches[i].covered))
    return out


def spans_of(scan: Compiled, runs: list[Run]) -> tuple[list[Span], float]:
    """Spans of covered templates by place, and the largest share of a template that a chain covers."""
    by_template: dict[int, list[Match]] = {}
    for end, length, state in runs:
        for template, to in scan.automaton.ends[state]:
            by_template.setdefault(template, []).append(Match(end - length, end, to))
    spans, best = [], 0.0
    for template, matches in by_template.items():
        for last, covered in chains(matches):
            share = covered / scan.lengths[template]
            best = max(best, share)
            if share >= COVERAGE:
                spans.append(Span(template, last.first, last.end - 1, covered))
    return sorted(spans, key=lambda s: (s.first, s.last, s.template)), best


def scan_words(scan: Compiled, ids: np.ndarray) -> tuple[list[Span], float, list[tuple[int, int]]]:
    """Spans, score of the templates and base places of one text, from the numbers of its words; -1 for unknown ones."""
    known = np.flatnonzero(ids >= 0)
    runs, found = [], []
    for part in np.split(known, np.flatnonzero(np.diff(known) > 1) + 1):
        # No phrase and no match is shorter than two words.
        if len(part) > 1:
            some, places = stream(scan, ids[part].tolist(), int(part[0]))
            runs += some
            found += places
    spans, best = spans_of(scan, runs)
    return spans, best, found


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    scan = compiled()
    labels = list(BASE_PHRASES.values())
    for batch in batches:
        for part in slices(batch, 1):
            words = find_words(part.column(1), PLAIN_TABLE, lower=True)
            at = np.minimum(np.searchsorted(scan.hashes, words.hash), len(scan.hashes) - 1)
            numbers = np.where(scan.hashes[at] == words.hash, at, -1)
            rows: list[tuple] = []
            for row in range(part.num_rows):
                spans, best, found = scan_words(scan, numbers[words.of(row)])
                starts = [s for s, _ in found]
                listed = [
                    {
                        "label": TEMPLATES[s.template][0],
                        "first_word": s.first,
                        "last_word": s.last,
                        "covered": s.covered,
                        "share": s.covered / scan.lengths[s.template],
                    }
                    for s in spans
                ]
                base = sorted({labels[p] for _, p in found})
                rows.append(
                    (len(found), min(starts, default=None), max(starts, default=None), base, 1.0 if found else best, listed)
                )
            n_base, first, last, base, score, spans = zip(*rows) if rows else ((),) * 6
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array(np.diff(words.first).astype(np.int64)),
                    *[pa.array(c, pa.int64()) for c in (n_base, first, last)],
                    pa.array(base, pa.list_(pa.string())),
                    pa.array(score, pa.float64()),
                    pa.array(spans, SPAN_ARROW),
                ],
                ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "score", "spans"],
            )


SPAN_ARROW = pa.list_(
    pa.struct(
        [
            ("label", pa.string()),
            ("first_word", pa.int64()),
            ("last_word", pa.int64()),
            ("covered", pa.int64()),
            ("share", pa.float64()),
        ]
    )
)


def scan_licenses(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per document: words, places and labels of the base phrases, score, and all spans of covered templates."""
    slim = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"))
    return slim.mapInArrow(_scan, SCAN_TYPE)


def license_labels(scanned: DataFrame) -> DataFrame:
    """The scan with its labels as sorted, comma-joined strings."""
    both = F.array_sort(F.array_union("base_labels", F.transform("spans", lambda s: s["label"])))
    return scanned.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join(both, ",").alias("labels"),
        "score",
    )
