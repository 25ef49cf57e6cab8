import hashlib
import random
import re

import pytest
from newslake.llm import pii, queries

PARTS = list("0123456789") * 3 + list("@.+- a(x)%é") + [
    "b@c.d", "4111111111111111", "1.2.3.4", "+1 (555) 123-4567", "://", "token=",
]


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def brute(text):
    """Base spans by the patterns themselves."""
    rules = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(d := re.sub("[^0-9]", "", m)) <= 19 and luhn(d)),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(re.sub("[^0-9]", "", m)) <= 15),
    )
    found = [
        (kind, m.start(), m.end()) for kind, rule, valid in rules for m in re.finditer(rule, text) if valid(m[0])
    ]
    return sorted(found, key=lambda s: (s[1], pii.KINDS.index(s[0])))


@pytest.fixture(scope="module")
def automaton():
    return pii._automaton()


def test_base_against_patterns(automaton):
    rng = random.Random(2)
    for _ in range(20_000):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randrange(50)))
        assert [s for s in pii.find(text, automaton) if s[0] in pii.BASE] == brute(text)


@pytest.mark.parametrize(
    "text, masked",
    [
        ('password=45bb0d53635bf1 token = "1beb58b8af68854f" ok', 'password=[SECRET] token = "[SECRET]" ok'),
        ("IBAN: DE89 3704 0044 0532 0130 00 now", "IBAN: [IBAN] now"),
        ("IBAN: DE88 3704 0044 0532 0130 00 now", "IBAN: DE88 3704 0044 0532 0130 00 now"),
        ("see https://bob:pw@host.com/x, a.b@c.de.", "see [URL], [EMAIL]."),
        ("https://host.com/x?y=1", "https://host.com/x?y=1"),
        ("ssn 123-45-6789, Account no: 12345678", "ssn [SSN], Account no: [ACCOUNT]"),
        ("ssn 000-45-6789; a password is needed", "ssn 000-45-6789; a password is needed"),
        ("", ""),
    ],
)
def test_further_kinds(automaton, text, masked):
    assert pii.masked_text(text, pii.find(text, automaton)) == masked


@pytest.mark.parametrize(
    "text, masked",
    [
        ("IBAN: DE89 3704 0044 0532 0130 00 BIC: COBADEFFXXX", "IBAN: [IBAN] BIC: COBADEFFXXX"),
        ("IBAN DE89 3704 0044 0532 0130 00 EUR 100", "IBAN [IBAN] EUR 100"),
        ("IBAN DE89370400440532013000 7 days", "IBAN [IBAN] 7 days"),
        ("iban GB82 WEST 1234 5698 7654 32 BIC X", "iban [IBAN] BIC X"),
        ("IBAN: NO93 8601 1117 947 OSLO 1", "IBAN: [IBAN] OSLO 1"),
        ("IBAN: DE88 3704 0044 0532 0130 00 BIC", "IBAN: DE88 3704 0044 0532 0130 00 BIC"),
        ("IBAN: ZZ22 3704 0044 0532 0130 00 EUR 100", "IBAN: [IBAN] EUR 100"),
        ("IBAN: DE89 3704 0044 0532 0130 00 BIC X; IBAN: GB82 WEST 1234 5698 7654 32", "IBAN: [IBAN] BIC X; IBAN: [IBAN]"),
    ],
)
def test_iban_before_capitals_and_digits(automaton, text, masked):
    assert pii.masked_text(text, pii.find(text, automaton)) == masked


@pytest.mark.parametrize(
    "cue", ["API key", "apiKey", "API_key", "ApiKey", "passWord", "PASSWORD", "ToKen", "é API Key", "\u0130 API key"]
)
def test_cues_in_mixed_case(automaton, cue):
    text = f"{cue}: 45bb0d53635bf1 ok"
    assert pii.masked_text(text, pii.find(text, automaton)) == f"{cue}: [SECRET] ok"


def test_number_cues_in_mixed_case(automaton):
    text = "Social Security number: 123-45-6789, aCCount No: 12345678, Iban: DE89370400440532013000"
    masked = "Social Security number: [SSN], aCCount No: [ACCOUNT], Iban: [IBAN]"
    assert pii.masked_text(text, pii.find(text, automaton)) == masked


def test_tables(spark):
    rows = [(1, "é a@b.cd", "x"), (1, "é a@b.cd", "x"), (2, None, "x"), (3, "", None), (None, "9" * 40_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kind string")
    found = pii.with_spans(docs)
    assert found.columns == ["doc_id", "text", "kind", "spans"]
    digests = pii.digests(found).collect()
    assert sorted(r.spans for r in digests) == ["", "", "", "email:2:8", "email:2:8"]
    empty = hashlib.sha256(b"").hexdigest()
    assert sorted(r.base_sha256 == empty for r in digests) == [False, False, True, True, True]
    texts = pii.masked(docs).selectExpr("text as t").collect()
    assert sorted(t.t or "" for t in texts)[-2:] == ["é [EMAIL]"] * 2
    assert [t.t for t in texts].count(None) == 1
    assert pii.digests(pii.with_spans(docs.limit(0))).count() == 0


def test_query_over_the_whole_table(spark, sf):
    found = {r.doc_id: r for r in queries.op8_pii_anchors(spark, sf).collect()}
    for row in spark.read.parquet(f"{sf}/documents.parquet").collect():
        spans = brute(row.text)
        digest = hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()
        assert found[row.doc_id].base_sha256 == digest
        assert found[row.doc_id].n_email == sum(s[0] == "email" for s in spans)


def test_a_column_of_the_same_name_stays(spark):
    docs = spark.createDataFrame([(1, "a@b.c", "own"), (2, None, None)], "doc_id long, text string, spans string")
    found = pii.with_spans(docs)
    assert found.columns == ["doc_id", "text", "spans", "spans_"]
    assert {r.doc_id: r.spans for r in found.collect()} == {1: "own", 2: None}
    assert {r.doc_id: r.spans for r in pii.digests(found).collect()} == {1: "email:0:5", 2: ""}
