"""Common table expressions of the oracle queries, written apart from the Spark jobs."""

from __future__ import annotations

from tokenloom.functions.text import WHITESPACE_CODE_POINTS

BLANKS = "||".join(f"chr({c})" for c in WHITESPACE_CODE_POINTS)
BLANK_CLASS = "[" + "".join(f"\\x{{{c:X}}}" for c in [*WHITESPACE_CODE_POINTS, 0x2581]) + "]+"

CLEAN = f"clean AS (SELECT doc_id, lang, trim(coalesce(text, ''), {BLANKS}) AS t FROM documents)"

VOCAB = """vocab AS (
    SELECT c, row_number() OVER (ORDER BY c) - 1 AS id
    FROM (SELECT DISTINCT unnest(string_split(t, '')) AS c FROM clean WHERE t <> ''))"""

CHARS = """chars AS (
    SELECT doc_id, unnest(string_split(t, '')) AS c, generate_subscripts(string_split(t, ''), 1) AS pos
    FROM clean WHERE t <> '')"""

ENCODED = """enc AS (
    SELECT doc_id, pos, id FROM chars JOIN vocab USING (c)
    UNION ALL
    SELECT doc_id, length(t) + 1, (SELECT count(*) FROM vocab) FROM clean WHERE t <> '')"""

SPLITS = """splits AS (
    SELECT doc_id, k, CASE WHEN r <= ceil(0.005::DOUBLE * n) THEN 'val' ELSE 'train' END AS split
    FROM (SELECT doc_id, md5('2357:' || doc_id) AS k,
                 row_number() OVER (ORDER BY md5('2357:' || doc_id), doc_id) AS r, count(*) OVER () AS n
          FROM documents))"""

STREAM = """stream AS (
    SELECT split, doc_id, id, row_number() OVER (PARTITION BY split ORDER BY k, doc_id, pos) - 1 AS g
    FROM enc JOIN splits USING (doc_id))"""

LINES = f"""lines AS (
    SELECT * FROM (
        SELECT doc_id, unnest(string_split(t, chr(10))) AS line,
               generate_subscripts(string_split(t, chr(10)), 1) - 1 AS line_no
        FROM clean)
    WHERE line <> '' AND strlen(line) <= 16384)"""


def folded(text: str) -> str:
    """A text expression with runs of white space as one space, none at the ends."""
    return f"trim(regexp_replace({text}, '{BLANK_CLASS}', ' ', 'g'))"


def units_of(text: str) -> str:
    """Space-separated units of a text expression."""
    marked = f"chr(9601) || replace({folded(text)}, ' ', ' ' || chr(9601))"
    return f"trim(regexp_replace(regexp_replace({marked}, '([0-9])', ' \\1 ', 'g'), ' +', ' ', 'g'))"


WORDS = f"""words AS (
    SELECT word, count(*) AS cnt
    FROM (SELECT unnest(string_split({units_of("line")}, ' ')) AS word FROM lines)
    WHERE word <> '' GROUP BY word)"""

TOKENS = ",\n".join([CLEAN, VOCAB, CHARS, ENCODED])
TOKEN_STREAM = ",\n".join([TOKENS, SPLITS, STREAM])
EOS = "(SELECT count(*) FROM vocab)"
