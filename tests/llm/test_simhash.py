import random

import numpy as np
import pytest
import xxhash
from newslake.llm import components, queries, simhash


def brute_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n = min(4, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + n]), 42) for i in range(len(words) - n + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints):
    """Smallest id reachable, per id, by comparing all pairs."""
    group = {i: i for i in prints}

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    ids = sorted(prints)
    for i in ids:
        for j in ids:
            if i < j and (prints[i] ^ prints[j]).bit_count() <= 4:
                a, b = sorted((find(i), find(j)))
                group[b] = a
    return {i: find(i) for i in ids}


def test_fingerprint():
    rng = random.Random(1)
    texts = ["", " \t\n", "a", "A b", "a B c", "a b c d", "É é \x0b x\x1cy  z Q\x85r s"]
    texts += [" ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(40))) for _ in range(50)]
    for text in texts:
        assert simhash.fingerprint(text, 4) % 2**64 == brute_print(text)


def test_any_close_pair_shares_a_block():
    rng = random.Random(2)
    masks = simhash.block_masks(4)
    for _ in range(5000):
        difference = sum(1 << b for b in rng.sample(range(64), rng.randrange(5)))
        assert any(difference & m == 0 for m in masks)


def chains(rng, n):
    """Fingerprints in chains of close neighbours and in dense crowds."""
    prints, now = [], 0
    for i in range(n):
        flips = rng.sample(range(64), rng.randrange(1, 7))
        now = rng.getrandbits(64) if i % 40 == 0 else now
        now ^= sum(1 << b for b in flips)
        prints.append(now)
    crowd = rng.getrandbits(64)
    return prints + [crowd ^ (1 << a) ^ (1 << b) for a in range(30) for b in range(a)]


@pytest.mark.parametrize("bucket", [2048, 40])
def test_links_against_all_pairs(spark, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    prints = dict(enumerate(chains(random.Random(bucket), 300), 10))
    rows = [(p - (1 << 64) if p >> 63 else p, i) for i, p in prints.items()]
    table = spark.createDataFrame(rows, "fingerprint long, node long").repartition(4)
    found = components.components(simhash.links(table)).collect()
    expected = {i: g for i, g in brute_groups(prints).items() if i != g}
    assert {r.node: r.component for r in found} == expected


def test_linked_within_batches():
    rng = np.random.default_rng(3)
    prints = rng.integers(0, 1 << 12, 500).astype(np.uint64)
    buckets = np.sort(rng.integers(0, 20, 500))
    found = simhash.linked(buckets, prints, 1)
    for b in range(20):
        rows = np.flatnonzero(buckets == b)
        own = {int(r): int(prints[r]) for r in rows}
        for i in own:
            for j in own:
                if (own[i] ^ own[j]).bit_count() <= 1:
                    assert found[i] == found[j]
    assert (buckets[found] == buckets).all()


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(0, 200)] + [(1000 + i, 500) for i in range(300)] + [(7, 7), (None, 3)]
    found = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    expected = {i: 0 for i in range(1, 201)} | {1000 + i: 500 for i in range(300)}
    assert {r.node: r.component for r in found} == expected
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_tables(spark):
    rows = [
        (5, "one two three four five", "x"), (3, "ONE  two three\nfour five", "x"), (3, "other words", "y"),
        (3, "other words", "y"), (9, None, "x"), (8, "", "x"), (None, "other words", "z"), (None, "z", "z"),
        (11, "w " * 50_000, "x"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    found = {(r.doc_id, r.fingerprint): r.component_id for r in simhash.near_duplicates(docs).collect()}
    signed = lambda t: simhash.fingerprint(t, 4)
    five = signed("one two three four five")
    assert found[5, five] == found[3, five] == 3
    assert found[9, 0] == found[8, 0] == 8
    assert found[None, signed("other words")] == 3
    assert found[None, signed("z")] is None
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    # Unrelated rows of id 3 both stay; the copies, with an id or without, go.
    assert sorted((r.doc_id or 0, (r.text or "")[:5]) for r in kept.collect()) == [
        (0, "z"), (3, "ONE  "), (3, "other"), (8, ""), (11, "w w w")
    ]
    twice = spark.createDataFrame([(None, "a b"), (None, "a b"), (1, "c d"), (1, "e f")], "doc_id long, text string")
    assert sorted(r.text for r in simhash.one_of_each(twice).collect()) == ["a b", "c d", "e f"]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    assert simhash.one_of_each(docs.limit(0)).count() == 0


def test_query_over_the_whole_table(spark, sf):
    texts = spark.read.parquet(f"{sf}/documents.parquet").collect()
    prints = {r.doc_id: brute_print(r.text) for r in texts}
    groups = brute_groups(prints)
    found = queries.op7_simhash(spark, sf).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in found} == {
        i: (f"{p:016x}", groups[i]) for i, p in prints.items()
    }
