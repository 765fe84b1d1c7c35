import hashlib
import re

import pytest
from tests.llm.conftest import prose

from tidemark.llm.secret_scan import BASE_RULES, RULES, masked, redact_secrets, scan_secrets, secret_digest
from tidemark.llm.trigrams import trigram_query, trigrams_of

SECRETS = [
    (20, 'API_KEY = "abcdefghijkl"  Password:short token=sixteen_chars.x=/+'),
    (21, "é AKIAABCDEFGHIJKLMN AKIAshort deadbeefdeadbeef deadbeef"),
    (22, "secret='0123456789abcdef0123' passwd : \"aaaaaaaaaaaa"),
    (23, "-----BEGIN RSA PRIVATE KEY----- ghp_" + "a1B2" * 9 + " https://me:hunter22@host/"),
    (24, "to\nken=abcdefghijklmnop apikeyapikey:abcdefghijklmnop ſecret=abcdefghijklmnop"),
    (25, "token=" * 50 + "abcdefghijklmnop"),
    (26, "f" * 5000 + "g" + prose(3, 4000) + " PASSWD=Zz09+/_.=-Zz09"),
]


def brute(text, rules):
    found = []
    for order, rule in enumerate(rules):
        for m in re.compile(rule.pattern, rule.flags).finditer(text or ""):
            if m.end(rule.group) - m.start(rule.group) >= rule.least:
                found.append((m.start(), order, m.end()))
    return [f"{rules[o].kind}:{s}:{e}" for s, o, e in sorted(found)]


def test_equal_to_scanning_everything(documents, odd_rows):
    rows = [*odd_rows, *SECRETS]
    got = secret_digest(scan_secrets(documents(rows))).collect()
    kinds = [rule.kind for rule in BASE_RULES]
    want = []
    for doc_id, text in rows:
        base = brute(text, BASE_RULES)
        counts = [sum(s.startswith(f"{kind}:") for s in base) for kind in kinds]
        digest = hashlib.sha256(",".join(base).encode()).hexdigest()
        want.append((doc_id, *counts, digest, ",".join(brute(text, RULES))))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert sum(row.n_assign for row in got) >= 6


def test_redaction_keeps_rows_and_columns(spark, documents, odd_rows):
    docs = documents([*odd_rows, *SECRETS]).withColumnRenamed("size", "n_chars")
    clean = redact_secrets(docs)
    assert clean.schema == docs.schema and clean.count() == docs.count()
    left = {r.doc_id: (r.text, r.n_chars) for r in clean.collect() if (r.doc_id or 0) >= 20}
    for doc_id, _ in SECRETS:
        text, length = left[doc_id]
        assert "[SECRET]" in text and length == len(text) and not brute(text, BASE_RULES)
    plain = {r.doc_id: r.text for r in clean.collect() if (r.doc_id or 0) < 20}
    assert plain[4] == prose(4, 30)


@pytest.mark.parametrize(
    ("spans", "want"),
    [([(1, 3), (2, 5)], "a*fg"), ([(0, 2), (2, 3)], "*defg"), ([(1, 2), (4, 5)], "a*cd*fg"), ([], "abcdefg")],
)
def test_masks(spans, want):
    found = [{"start_at": a, "end_at": b} for a, b in spans]
    assert masked("abcdefg", found, "*") == want


@pytest.mark.parametrize(
    ("pattern", "want"),
    [
        ("abcd", ("and", (b"abc", b"bcd"))),
        ("ab", True),
        ("[0-9a-f]+", True),
        ("(?:abc|xyz)+[0-9]*", ("or", (b"abc", b"xyz"))),
        ("abc?", True),
        ("a.*bcd", b"bcd"),
        ("ABC", b"abc"),
        ("abc|d", True),
    ],
)
def test_queries(pattern, want):
    assert trigram_query(pattern) == want


def test_rules_without_trigrams_scan_everything():
    none = [rule.kind for rule in RULES if not trigrams_of(trigram_query(rule.pattern, rule.flags))]
    assert none == ["hex"]


def test_empty(documents):
    assert scan_secrets(documents([])).count() == 0
