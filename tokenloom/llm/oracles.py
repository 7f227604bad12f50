"""SQL of the operators that DuckDB can express, written apart from the Spark jobs: every pair, window and match in full."""

from __future__ import annotations

from tokenloom.llm.secrets import RULES

BLANKS = "[^\\x20\\x09-\\x0D]+"
WORDS = f"""words AS (
    SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos
    FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{BLANKS}') AS w FROM documents))"""

# The patterns of the scan, in the order of its rules; a match counts with so many characters of its last group.
PATTERNS = {
    "assign": ("(?:(?i:password|passwd|secret|token|api_?key))[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)", 6),
    "access": ("AKIA([A-Z0-9]+)", 16),
    "hex": ("([0-9a-f]+)", 24),
    "github": ("gh[pousr]_([A-Za-z0-9]+)", 36),
    "slack": ("xox[abprs]-([A-Za-z0-9-]+)", 20),
    "google": ("AIza([A-Za-z0-9_-]+)", 35),
}
assert list(PATTERNS) == [r.kind for r in RULES]


def found_sql(number: int, kind: str, pattern: str, least: int) -> str:
    """Kept matches of one kind: a match begins after all text between and within the matches before it."""
    return f"""SELECT doc_id, {number} AS rule, '{kind}' AS kind, stop - length(m) AS start, stop
        FROM (SELECT doc_id, m, body, sum(length(gap) + length(m)) OVER (PARTITION BY doc_id ORDER BY n) AS stop
              FROM (SELECT doc_id, unnest(regexp_split_to_array(t, '{pattern}')) AS gap,
                           unnest(regexp_extract_all(t, '{pattern}')) AS m,
                           unnest(regexp_extract_all(t, '{pattern}', 1)) AS body,
                           unnest(range(length(t) + 1)[:len(regexp_extract_all(t, '{pattern}')) + 1]) AS n
                    FROM texts)
              WHERE m IS NOT NULL)
        WHERE length(body) >= {least}"""


OP3_SQL = f"""WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS ({" UNION ALL ".join(found_sql(i, k, *p) for i, (k, p) in enumerate(PATTERNS.items()))}),
per_doc AS (
    SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
           count(*) FILTER (kind = 'hex') AS n_hex, count(*) FILTER (rule > 2) AS n_more,
           string_agg(kind || ':' || start::BIGINT || ':' || stop::BIGINT, ',' ORDER BY start, rule) FILTER (rule < 3) AS base,
           string_agg(kind || ':' || start::BIGINT || ':' || stop::BIGINT, ',' ORDER BY start, rule) AS spans
    FROM found GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       coalesce(n_more, 0) AS n_more, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN per_doc USING (doc_id)"""

OP4_SQL = f"""WITH {WORDS},
lists AS (SELECT doc_id, list(word ORDER BY pos) AS w FROM words GROUP BY doc_id),
windows AS (
    SELECT doc_id, i AS pos, md5(array_to_string(w[i:i + 34], ' ')) AS h
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM lists)),
repeated AS (SELECT h FROM windows GROUP BY h HAVING count(*) > 1),
marked AS (
    SELECT words.*, h IS NOT NULL AS starts FROM words
    LEFT JOIN (SELECT doc_id, pos, h FROM windows JOIN repeated USING (h)) USING (doc_id, pos)),
covered AS (
    SELECT *, bool_or(starts) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone FROM marked),
kept AS (
    SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed,
           string_agg(word, ' ' ORDER BY pos) FILTER (NOT gone) AS kept FROM covered GROUP BY doc_id)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents LEFT JOIN kept USING (doc_id)"""


def closure_sql(links: str) -> str:
    """Smallest vertex that each vertex of `links` reaches, itself included."""
    return f"""reach(a, b) AS (
    SELECT a, a FROM {links} UNION SELECT r.a, l.b FROM reach r JOIN {links} l ON l.a = r.b),
smallest AS (SELECT a, min(b) AS root FROM reach GROUP BY a)"""


OP6_SQL = f"""WITH RECURSIVE usable AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
    WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
    SELECT p.vec_id AS a, q.vec_id AS b FROM usable p JOIN usable q USING (label)
    WHERE p.vec_id <> q.vec_id AND len(p.e) = len(q.e) AND list_cosine_similarity(p.e, q.e) >= 0.98::DOUBLE),
{closure_sql("links")}
SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links, coalesce(root, vec_id) AS component_id,
       coalesce(root, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN smallest ON a = vec_id"""

OP8_SQL = f"""WITH RECURSIVE {WORDS},
lists AS (SELECT doc_id, list(word ORDER BY pos) AS w FROM words GROUP BY doc_id),
shingles AS (
    SELECT DISTINCT doc_id, md5(array_to_string(w[i:i + 4], ' ')) AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM lists)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
    SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS n FROM shingles p JOIN shingles q USING (s)
    WHERE p.doc_id <> q.doc_id GROUP BY 1, 2),
links AS (
    SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 5 * shared.n >= 4 * (x.n + y.n - shared.n)),
{closure_sql("links")}
SELECT doc_id, coalesce(root, doc_id) AS class_id, (SELECT count(*) FROM links WHERE a = doc_id) AS n_links
FROM documents LEFT JOIN smallest ON a = doc_id"""


def plain_words_sql(text: str) -> str:
    """Runs of letters, digits and everything beyond ASCII, A to Z in lower case."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    lowered = f"translate(coalesce({text}, ''), '{upper}', '{upper.lower()}')"
    return f"regexp_extract_all({lowered}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"


OP13_SQL = f"""WITH cut AS (SELECT doc_id, row_number() OVER () AS r, {plain_words_sql("text")} AS t FROM documents),
sizes AS (SELECT r, doc_id, len(t)::BIGINT AS n FROM cut WHERE len(t) > 0),
totals AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS length FROM sizes),
counts AS (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(t) AS term FROM cut) GROUP BY r, term),
spread AS (SELECT term, count(*)::BIGINT AS df FROM counts GROUP BY term),
wanted AS (SELECT DISTINCT item_id, unnest({plain_words_sql("text")}) AS term FROM benchmark),
scored AS (
    SELECT item_id, doc_id, r,
           sum(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT
               * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // length))))::BIGINT AS score
    FROM wanted JOIN spread USING (term) JOIN counts USING (term) JOIN sizes USING (r), totals GROUP BY item_id, doc_id, r)
SELECT item_id, rank, doc_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank FROM scored WHERE score > 0)
WHERE rank <= 50"""
