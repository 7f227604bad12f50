import random
import re

import pytest

from tokenloom.llm import licenses, queries

SF = "/root/testdata/sf0.001"
TYPE = "doc_id long, text string, score string, spans int"


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def base_places(w):
    """(start, label) of every base phrase, by comparing at every word."""
    out = []
    for phrase, label in licenses.BASE_PHRASES.items():
        p = phrase.split()
        out += [(i, label) for i in range(len(w)) if w[i : i + len(p)] == p]
    return out


def brute_runs(w, template):
    """(start, end, to) of all unextendable equal runs of a text and a template, as the longest match of any template sees them."""
    texts = [licenses.words_of(t) for _, t in licenses.TEMPLATES] + [p.split() for p in licenses.BASE_PHRASES]
    longest = []
    for end in range(len(w) + 1):
        length = 0
        while length < end and any(has(t, w[end - length - 1 : end]) for t in texts):
            length += 1
        longest.append(length)
    found = []
    for end in range(1, len(w) + 1):
        if longest[end] >= licenses.LEAST and (end == len(w) or longest[end + 1] != longest[end] + 1):
            run = w[end - longest[end] : end]
            found += [(end - len(run), end, i + len(run)) for i in range(len(template)) if template[i : i + len(run)] == run]
    return found


def has(text, run):
    return any(text[i : i + len(run)] == run for i in range(len(text) - len(run) + 1))


def best_chain(runs):
    """Most words that a chain covers, by trying all predecessors."""
    runs = sorted(runs, key=lambda r: (r[1], r[2]))
    best = []
    for s, e, to in runs:
        options = [e - s]
        for (ps, pe, pto), covered in zip(runs, best):
            if pe >= s - licenses.GAP and pto >= to - (e - s) - licenses.GAP:
                gain = min(e - s, e - pe, to - pto)
                if gain > 0:
                    options.append(covered + gain)
        best.append(max(options))
    return max(best, default=0)


def scan(spark, *texts):
    frame = spark.createDataFrame([(i, t, "s", 1) for i, t in enumerate(texts)], TYPE)
    return licenses.scan_licenses(frame).orderBy("doc_id").collect()


def expect(row, text):
    w = words(text)
    places = base_places(w)
    starts = [s for s, _ in places]
    assert row.n_words == len(w) and row.n_base == len(places)
    assert (row.first_word, row.last_word) == (min(starts, default=None), max(starts, default=None))
    assert row.base_labels == sorted({label for _, label in places})
    labels, score = set(), 1.0 if places else 0.0
    for label, template in licenses.TEMPLATES:
        t = licenses.words_of(template)
        share = best_chain(brute_runs(w, t)) / len(t)
        score = max(score, share)
        labels |= {label} if share >= licenses.COVERAGE else set()
    assert {s.label for s in row.spans} == labels
    assert row.score == pytest.approx(score)


def test_notices_and_their_edits(spark):
    apache, mit = licenses.TEMPLATES[0][1], licenses.TEMPLATES[2][1]
    edited = mit.split()
    edited[10:12], edited[40:41] = ["other", "words"], []
    texts = [
        apache,
        f"Intro words. {' '.join(edited)} And the rest.",
        mit[: len(mit) // 2],
        "prose " * 30 + "Released under the MIT License. " + "prose " * 30 + "Released under the MIT License.",
        "Licensed under CC BY-NC 4.0. All rights reserved, ALL RIGHTS RESERVED",
        "This work is licensed under the GNU General Public License, version 3.",
        "cc cc by by cc-by ccby all rights all rights reserved",
        "the license of the software and the rights",
    ]
    rows = scan(spark, *texts)
    for row, text in zip(rows, texts):
        expect(row, text)
    assert [sorted({s.label for s in r.spans}) for r in rows[:6]] == [["apache-2.0"], ["mit"], [], ["mit"], ["cc-by-nc-4.0"], ["gpl-3.0"]]
    assert [(s.first_word, s.last_word) for s in rows[3].spans] == [(30, 34), (65, 69)]
    span = rows[1].spans[0]
    assert span.first_word == 2 and span.share < 1 and span.last_word == span.first_word + len(words(" ".join(edited))) - 1


@pytest.mark.parametrize("seed", range(3))
def test_shuffled_pieces_of_notices(spark, seed):
    rng = random.Random(seed)
    texts = []
    for _ in range(40):
        pieces = []
        for _ in range(rng.randint(1, 6)):
            source = words(rng.choice(licenses.TEMPLATES)[1])
            at = rng.randrange(len(source))
            pieces.append(" ".join(source[at : at + rng.randint(1, 25)]) + " x" * rng.randint(0, 3))
        texts.append(" ".join(pieces))
    for row, text in zip(scan(spark, *texts), texts):
        expect(row, text)


def test_registered_query_equals_direct_search(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.QUERIES["op11_license_scan"](spark, SF).collect()
    assert {r.doc_id for r in rows} == set(texts) and len(rows) == len(texts)
    found = 0
    for row in rows:
        w = words(texts[row.doc_id])
        places = base_places(w)
        found += len(places)
        starts = [s for s, _ in places]
        assert (row.n_words, row.n_base) == (len(w), len(places))
        assert (row.first_word, row.last_word) == (min(starts, default=None), max(starts, default=None))
        assert row.base_labels == ",".join(sorted({label for _, label in places}))
        assert set(filter(None, row.base_labels.split(","))) <= set(row.labels.split(","))
        assert row.labels == ",".join(sorted(set(filter(None, row.labels.split(","))))) and 0 <= row.score <= 1
    assert found


def test_odd_rows(spark):
    texts = [None, "", " .,- ", "é" * 5, "All Rights Reserved " * 3, "wörd " * 50_000 + "cc by", "CC\x00BY"]
    rows = scan(spark, *texts)
    assert [r.n_words for r in rows] == [0, 0, 0, 1, 9, 50_002, 2]
    assert [r.n_base for r in rows] == [0, 0, 0, 0, 3, 1, 1]
    assert (rows[4].first_word, rows[4].last_word, rows[5].first_word) == (0, 6, 50_000)
    assert rows[0].score == 0 and rows[0].spans == [] and rows[4].score == 1
    twice = spark.createDataFrame([(None, "cc by", "", 0)] * 2, TYPE)
    assert [r.n_base for r in licenses.license_labels(licenses.scan_licenses(twice)).collect()] == [1, 1]
    assert licenses.license_labels(licenses.scan_licenses(twice.where("false"))).collect() == []


def test_automaton_holds_all_runs_and_places():
    rng = random.Random(2)
    sequences = [[rng.randrange(3) for _ in range(rng.randint(1, 14))] for _ in range(6)]
    automaton = licenses.SuffixAutomaton()
    for i, s in enumerate(sequences):
        automaton.add(i, s)
    automaton.spread()
    runs = {tuple(s[i:j]) for s in sequences for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
    for run in runs:
        state = 0
        for word in run:
            state = automaton.next[state][word]
        places = {(n, i + len(run)) for n, s in enumerate(sequences) for i in range(len(s)) if tuple(s[i : i + len(run)]) == run}
        assert automaton.ends[state] == places
    text = [rng.randrange(4) for _ in range(200)]
    state = length = 0
    for end, word in enumerate(text, 1):
        state, length = automaton.step(state, length, word)
        assert length == max((k for k in range(end + 1) if tuple(text[end - k : end]) in runs), default=0)
