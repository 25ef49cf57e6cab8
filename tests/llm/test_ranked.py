import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from newslake.llm import ranked

DOCS = "doc_id long, text string, lang string"
ITEMS = "item_id long, text string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    """All documents scored for all items, from the formula."""
    counts = [(i, Counter(words(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, n_all = len(counts), sum(c.total() for _, c in counts)
    df = Counter(w for _, c in counts for w in c)
    asked = {}
    for i, t in items:
        if i is not None:
            asked.setdefault(i, set()).update(words(t))
    out = []
    for item, own in asked.items():
        scores = []
        for doc, c in counts:
            m = 100 - 90 + (90 * c.total() * n_docs) // n_all
            score = 0
            for w in own & c.keys():
                weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
                score += weight * ((10**9 * c[w]) // (1000 * c[w] + 8 * m))
            if score > 0 and doc is not None:
                scores.append((-score, doc))
        out += [(item, r, d, -s) for r, (s, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def found(spark, docs, items, **more):
    rows = ranked.ranked(
        spark.createDataFrame([(*d, "en") for d in docs], DOCS).repartition(3), spark.createDataFrame(items, ITEMS), **more
    ).collect()
    return sorted(tuple(r) for r in rows)


def corpus(rng, n, vocabulary=300):
    pool = [f"w{i}" for i in range(vocabulary)]
    often = [1 / (i + 1) for i in range(vocabulary)]
    docs = []
    for i in range(n):
        size = int(rng.paretovariate(1.1) * 6) % 900
        docs.append((i, " ".join(rng.choices(pool, often, k=size))))
    docs += [(n + i, docs[i][1]) for i in range(40)] * 2
    items = [(i, " ".join(rng.choices(pool, often, k=rng.randrange(1, 25)))) for i in range(25)]
    items += [(100 + i, " ".join(docs[i][1].split()[:30])) for i in range(10)]
    return docs, items


def test_terms():
    rng = random.Random(1)
    alphabet = "aZ09éÉßİ日本🎉_-/'[]`{}~:;@ \t\n\x00\x7f\x80\xa0 "
    for _ in range(300):
        text = "".join(rng.choices(alphabet, k=rng.randrange(40)))
        assert [t.decode() for t in ranked.terms(text)] == words(text)


@pytest.mark.parametrize("bucket", [1024, 16])
def test_same_as_scoring_all(spark, monkeypatch, bucket):
    monkeypatch.setattr(ranked, "BUCKET", bucket)
    monkeypatch.setattr(ranked, "LEAST_BUCKET", 4)
    docs, items = corpus(random.Random(2), 1500)
    assert found(spark, docs, items) == brute(docs, items)


def test_blocks_of_items(spark):
    docs, items = corpus(random.Random(3), 300)
    assert found(spark, docs, items, block=40) == brute(docs, items)
    assert found(spark, docs, items, k=3) == brute(docs, items, 3)


def test_bounds_let_all_good_rows_through():
    """What the coordinate bounds leave out is below the floor, and they leave out much."""
    rng = np.random.default_rng(4)
    weight = rng.integers(0, 9000, 200)
    left_out = 0
    for _ in range(60):
        sizes = rng.integers(1, 60, 300)
        terms = np.concatenate([rng.choice(200, s, replace=False) for s in sizes])
        impacts = rng.integers(1, 900_000, len(terms))
        owner = np.repeat(np.arange(300), sizes)
        lengths = np.sqrt(np.bincount(owner, weight[terms] * impacts.astype(float) ** 2))
        bucket = ranked.Bucket(lengths, np.arange(300), sizes, terms, impacts)
        asked = rng.choice(220, 12, replace=False)
        asked = asked[asked < 200]
        own = np.zeros(200, np.int64)
        own[asked] = weight[asked]
        scores = bucket.score(np.arange(300), own)
        plain = np.bincount(owner, own[terms] * impacts.astype(float))
        assert (scores == plain).all()
        assert (scores <= np.sqrt(weight[asked].sum()) * lengths * (1 + 1e-9)).all()
        floor = int(np.sort(scores)[-5])
        rows = ranked.candidates(bucket, asked, weight, floor)
        assert set(np.flatnonzero((scores >= floor) & (scores > 0))) <= set(rows)
        left_out += 300 - len(rows)
    assert left_out > 60 * 100


def test_short_buckets_are_pruned():
    items = ranked.Items([1], [np.array([0, 1])], {b"a": 0, b"b": 1})
    search = ranked.Search(items, np.array([1000, 1000]), 1, np.zeros(1, np.int64))

    def bucket(impact, ids):
        n = len(ids)
        lengths = np.full(n, math.sqrt(1000.0) * impact)
        return ranked.Bucket(lengths, np.array(ids), np.ones(n, np.int64), np.zeros(n, np.int64), np.full(n, impact))

    assert search.add(bucket(900, [5, 6]))
    assert search.add(bucket(899, [4])) and search.scored == 2
    assert not search.add(bucket(400, [1, 2, 3])) and search.met == 3
    assert search.best == [[(-900_000, 5)]]


def test_tables(spark):
    no_items = ranked.ranked(spark.createDataFrame([(1, "a", "en")], DOCS), spark.createDataFrame([], ITEMS))
    assert no_items.columns == ["item_id", "rank", "doc_id", "score"] and no_items.collect() == []
    assert found(spark, [], [(1, "a")]) == []
    long = "a " * 60_000 + "b"
    docs = [(1, long), (1, long), (None, "a rare"), (2, None), (3, ""), (4, "B, b!"), (5, "rare"), (6, "rare"), (7, "x y z")]
    items = [(1, "a"), (1, "B b"), (None, "a"), (2, None), (3, "rare ?"), (4, "none")]
    assert found(spark, docs, items) == brute(docs, items)
    clashing = spark.createDataFrame([(1, "one two", 5, 6, "x")], "doc_id long, text string, n long, terms long, Length string")
    asked = spark.createDataFrame([(1, "two", 3)], "item_id long, text string, doc_id long")
    assert [tuple(r)[:3] for r in ranked.ranked(clashing, asked).collect()] == [(1, 1, 1)]
