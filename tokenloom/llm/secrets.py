"""Secret scan: all rules in one byte pass of a combined, minimised automaton.

Per document the spans of every rule are its leftmost, longest, non-overlapping matches; spans
of different rules may overlap. Positions are code points, ends exclusive.

* Null and empty text have no spans; their digest is the one of the empty string.
* Rows are never joined or grouped, so repeated rows, repeated or null ids and any row order are fine.
* A long text costs its length once; batches are bounded by Arrow's byte limit and single texts.
* Other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.automaton import Automaton, Rule, compile_rules, matches

# The three base rules, in the order of their kinds.
BASE_RULES = [
    Rule("assign", "(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?", "[A-Za-z0-9+/_.=-]", 6, any_case=True),
    Rule("access", "AKIA", "[A-Z0-9]", 16),
    Rule("hex", "", "[0-9a-f]", 24),
]
# Published formats of tokens, added to the base spans.
MORE_RULES = [
    Rule("github", "gh[pousr]_", "[A-Za-z0-9]", 36),
    Rule("slack", "xox[abprs]-", "[A-Za-z0-9-]", 20),
    Rule("google", "AIza", "[A-Za-z0-9_-]", 35),
]
RULES = BASE_RULES + MORE_RULES

SCAN_TYPE = "doc_id long, n_assign long, n_access long, n_hex long, n_more long, base_sha256 string, spans string"


@cache
def automaton() -> Automaton:
    return compile_rules(RULES)


def find_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(start, rule, end) in code points, by start and rule."""
    if not text:
        return []
    data = text.encode()
    found = matches(automaton(), RULES, data)
    if not found or len(data) == len(text):
        return found
    # Code points up to each border, counted once along the text.
    borders, at, points, place = sorted({b for s, _, e in found for b in (s, e)}), 0, 0, {}
    for border in borders:
        points += len(data[at:border].decode())
        at, place[border] = border, points
    return sorted((place[s], r, place[e]) for s, r, e in found)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{RULES[r].kind}:{s}:{e}" for s, r, e in spans)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.columns
        counts, digests, listed = [[], [], [], []], [], []
        for text in texts:
            spans = find_spans(text.as_py())
            base = [s for s in spans if s[1] < len(BASE_RULES)]
            for rule in range(len(BASE_RULES)):
                counts[rule].append(sum(s[1] == rule for s in base))
            counts[-1].append(len(spans) - len(base))
            digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
            listed.append(joined(spans))
        numbers = [pa.array(c, pa.int64()) for c in counts]
        strings = [pa.array(c, pa.string()) for c in (digests, listed)]
        names = ["doc_id", "n_assign", "n_access", "n_hex", "n_more", "base_sha256", "spans"]
        yield pa.RecordBatch.from_arrays([ids, *numbers, *strings], names)


def scan_secrets(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: counts per base kind, a digest of the base spans, and all spans as `kind:start:end`."""
    slim = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    return slim.mapInArrow(_scan, SCAN_TYPE)


def masked(docs: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """`docs` with every span of `text` replaced by `mark`; the other columns stay as they are."""

    @F.pandas_udf("string")
    def mask(texts):
        return texts.map(lambda t: t if not t else _replaced(t, mark))

    return docs.withColumn(text, mask(docs[text]))


def _replaced(text: str, mark: str) -> str:
    out, at = [], 0
    for start, _, end in find_spans(text):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])
