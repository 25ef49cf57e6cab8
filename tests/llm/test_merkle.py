import hashlib

import pytest
from newslake.llm import merkle
from pyspark.sql import functions as F


def prints(spark, *texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return [r.f for r in rows.select("i", merkle.fingerprint(F.col("t")).alias("f")).orderBy("i").collect()]


def test_root_is_a_tree_of_digests(spark):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    (found,) = prints(spark, "One. Two!\nthree\n\nfour")
    sections = [sha(sha("One. Two!") + sha("three")), sha(sha("four"))]
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()[:8]
    assert found == f"{sha(''.join(sections))}:{md5('One.')},{md5(' Two!')}|{md5('three')};{md5('four')}"


def test_equality_and_likeness(spark):
    text = "\n".join(f"Paragraph {i} has some words. And a few more." for i in range(20))
    same, changed, other = text, text.replace("Paragraph 7 ", "Paragraph x "), "Nothing alike!"
    rows = [(text, same, 1.0), (text, changed, 0.9), (text, other, 0.0), ("", "", 1.0), ("", "\n", 0.0), ("", "a", 0.0)]
    found = spark.createDataFrame(rows, "a string, b string, least double").select(
        "least", merkle.likeness(merkle.fingerprint(F.col("a")), merkle.fingerprint(F.col("b"))).alias("l")
    ).collect()
    for r in found:
        assert r.least <= r.l <= (1.0 if r.least in (0.9, 1.0) else 0.0)
    assert [r.l for r in found][1] < 1


def test_edited_places(spark):
    a, b = prints(spark, "x\ny\n\nz\nw", "x\ny\n\nz!\nw")
    rows = spark.createDataFrame([(a, b), (a, a)], "a string, b string")
    found = rows.select(merkle.edited_places(F.col("a"), F.col("b")).alias("p")).collect()
    assert [[tuple(p) for p in r.p] for r in found] == [[(1, 0)], []]


def test_differing_places(spark):
    cases = [
        ("x\ny\n\nz\nw", "x\ny\n\nz!\nw", [(1, 0)], [(1, 0)]),
        ("x\ny\nz", "x\nz", [(0, 1)], []),
        ("x\ny\nz", "x\nz\ny", [(0, 1), (0, 2)], [(0, 1), (0, 2)]),
        ("x\ny", "x\ny\ny", [], [(0, 2)]),
        ("x\nx\nx", "x\nx", [(0, 2)], []),
        ("x\ny", "x\n\ny", [(0, 1)], [(1, 0)]),
        ("a\nb\nc\nd", "A\nb\nc\nD", [(0, 0), (0, 3)], [(0, 0), (0, 3)]),
        ("x\n\ny", "x\n\ny", [], []),
        ("", "x", [(0, 0)], [(0, 0)]),
    ]
    pairs = [tuple(prints(spark, old, new)) for old, new, *_ in cases] + [(None, "x")]
    rows = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string")
    found = rows.select("i", merkle.differing_places(F.col("a"), F.col("b")).alias("p")).orderBy("i").collect()
    for (old, new, *expected), r in zip(cases, found):
        assert [[tuple(x) for x in r.p.old], [tuple(x) for x in r.p.new]] == expected, (old, new)
    assert found[-1].p is None


SCHEMA = "doc_id long, text string, next string"


def brute(rows):
    known = sorted({d for d, _ in rows}, reverse=True)
    texts = dict(rows)
    out = {}
    for i, d in enumerate(known):
        text, following = texts[d] or "", texts[known[(i + 1) % len(known)]] or ""
        k = len(text) // 3
        edited = text[: len(text) - k] + following[:k]
        out[d] = (len(text), hashlib.sha256(edited.encode()).hexdigest())
    return out


@pytest.mark.parametrize("n", [1, 2, 25])
def test_next_document(spark, n):
    rows = [(i * i * 7 - 40, f"é😀 text {i}. " * (i % 5)) for i in range(n)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(4)
    found = {r.doc_id: (r.n_chars, r.edited_sha256) for r in merkle.compared(docs).collect()}
    assert found == brute(rows)


def test_nulls_and_repeated_rows(spark):
    rows = [(1, "one two three", "x"), (1, "one two three", "x"), (2, None, None), (None, "abcdef", "x"), (3, "w. " * 40_000, "x")]
    found = merkle.compared(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id or 0, r.n_chars) for r in found) == [(0, 6), (1, 13), (1, 13), (2, 0), (3, 120_000)]
    lone = next(r for r in found if r.doc_id is None)
    assert lone.edited_sha256 == hashlib.sha256(b"abcd").hexdigest() and lone.near_next is None
    one = [r for r in found if r.doc_id == 1]
    assert one[0] == one[1]
    # After document 1 comes the first, 3.
    assert one[0].edited_sha256 == hashlib.sha256(b"one two tw. w").hexdigest()
    assert merkle.compared(spark.createDataFrame([], SCHEMA)).count() == 0
