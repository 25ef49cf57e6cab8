import itertools
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from newslake.llm import packing, queries
from tokenizers import Tokenizer

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN


def test_fullest_against_all_combinations():
    rng = random.Random(1)
    for _ in range(500):
        left = {rng.randrange(1, 15): rng.randrange(1, 4) for _ in range(rng.randrange(6))}
        room = rng.randrange(25)
        found = packing.fullest(left, room)
        sums = (
            sum(n * k for n, k in zip(left, uses))
            for uses in itertools.product(*(range(c + 1) for c in left.values()))
        )
        assert all(0 < k <= left[n] for n, k in found.items())
        assert sum(n * k for n, k in found.items()) == max(s for s in sums if s <= room)


def test_plan_is_that_of_one_bin_at_a_time():
    rng = random.Random(2)
    for _ in range(50):
        counts = {rng.randrange(1, 40): rng.randrange(1, 30) for _ in range(12)}
        left, bins = dict(counts), []
        while left:
            longest = max(left)
            left[longest] -= 1
            uses = packing.fullest(left, 64 - longest)
            uses[longest] = uses.get(longest, 0) + 1
            left[longest] += 1
            left = {n: c - uses.get(n, 0) for n, c in left.items() if c > uses.get(n, 0)}
            bins.append(uses)
        made = packing.plan(counts, 64)
        assert [uses for times, uses in made for _ in range(times)] == bins


def test_cut():
    assert packing.cut(1, 8) == [(0, 1)]
    assert packing.cut(8, 8) == [(0, 8)]
    assert packing.cut(19, 8) == [(0, 3), (3, 8), (11, 8)]


def test_ids_are_those_of_the_library():
    library = Tokenizer.from_file(PATH)
    library.encode_special_tokens = True
    encode = packing.read_tokenizer(PATH, PATTERN)
    rng = random.Random(4)
    parts = ["ab", "the", " ", "\n", "\r\n", "\xa0", "  é", "ß", "12", "..", "'s", "日本", "😀", "　", "<|endoftext|>"]
    for _ in range(1000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(20)))
        assert list(encode(text)) == library.encode(text, add_special_tokens=False).ids


def test_words_by_another_tokenizer():
    path = public_tokenizers.path("word_bpe_49k.json")
    encode = packing.read_tokenizer(path, PATTERN)
    assert list(encode("Hello there")) == Tokenizer.from_file(path).encode("Hello there", add_special_tokens=False).ids


def check(rows, texts, most=1024):
    """Every id of every document is in its place, and sequences are gapless."""
    library = Tokenizer.from_file(PATH)
    library.encode_special_tokens = True
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(texts)
    for doc_id, text in texts.items():
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        own = sorted(pieces[doc_id], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own)))
        assert [(r.start, r.length) for r in own] == packing.cut(len(ids), most)
        for r in own:
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= most
    return len(sequences)


def test_tables(spark):
    texts = {1: "a b c", 2: "", 3: None, 4: "word " * 30_000, 5: "x" * 4_000}
    docs = spark.createDataFrame([(*r, 0) for r in texts.items()], "doc_id long, text string, offset int")
    check(packing.packed(docs, PATH, PATTERN).collect(), texts)
    again = docs.union(docs.where("doc_id = 1")).union(docs.selectExpr("null", "text", "offset"))
    rows = packing.packed(again, PATH, PATTERN).collect()
    assert sum(r.doc_id == 1 for r in rows) == 2
    places = sorted((r.sequence_id, r.offset, r.length) for r in rows)
    assert all(a[0] != b[0] or a[1] + a[2] == b[1] for a, b in zip(places, places[1:]))
    assert packing.packed(docs.limit(0), PATH, PATTERN).count() == 0


def test_query_over_the_whole_table(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op3_min_bin_slack(spark, sf).collect()
    used = check(rows, texts)
    assert used <= -(-sum(r.length for r in rows) // 1024) * 1.01 + 1
