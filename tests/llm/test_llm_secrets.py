import hashlib
import random
import re

from tokenloom.llm import automaton, secrets

ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base_spans(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def test_one_pass_finds_what_the_regexes_find():
    rng = random.Random(3)
    pieces = ["password", "passwd", "secret", "token", "api_key", "APIKEY", "tok", "=", ":", " ", "'", '"', "abc", "abcdef", "AKIA", "A" * 16]
    pieces += ["0123456789abcdef", "deadbeef", "é", "😀", "\n", "=ab", "Z9", "secretoken=abcdef"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 22)))
        assert [s for s in secrets.find_spans(text) if s[1] < 3] == base_spans(text), text


def test_a_dropped_match_is_consumed():
    assert secrets.find_spans("token=token: abcdef") == []
    assert secrets.find_spans("token=token:  token=abcdef") == [(14, 0, 26)]


def test_more_rules_add_spans():
    text = "é ghp_" + "a1" * 20 + " xoxb-" + "1" * 24
    assert [(secrets.RULES[r].kind, s, e) for s, r, e in secrets.find_spans(text)] == [
        ("github", 2, 46), ("hex", 6, 46), ("slack", 47, 76), ("hex", 52, 76)
    ]


def test_minimisation_merges_equal_states():
    one = automaton.Rule("x", "(ab|cb)", "[0-9]", 1)
    small = automaton.compile_rules([one])
    # Start, after a or c, after b, inside a match.
    assert len(small.moves) == 4
    assert automaton.matches(small, [one], b"ab1 cb22") == [(0, 0, 3), (4, 0, 8)]


def test_cases(spark):
    long = "x " * 100_000 + "password=abcdef1"
    rows = [(1, "password: hunter22", "a"), (1, "password: hunter22", "a"), (2, None, "b"), (3, "", "c"), (None, "AKIA" + "B" * 16, "d"), (4, long, "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = {(r.doc_id, r.spans): r for r in secrets.scan_secrets(docs).collect()}
    assert secrets.scan_secrets(docs).count() == len(rows)
    assert got[1, "assign:0:18"].n_assign == 1
    assert got[None, "access:0:20"].n_access == 1
    assert got[2, ""].base_sha256 == got[3, ""].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert got[4, "assign:200000:200016"].n_hex == 0
    assert secrets.scan_secrets(docs.limit(0)).count() == 0
    masked = {r.doc_id: r for r in secrets.masked(docs, mark="*").collect()}
    assert masked[1].text == "*" and masked[1].spans == "a" and masked[2].text is None and masked[3].text == ""
