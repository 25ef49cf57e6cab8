import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from newslake.llm import bpe, queries

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
PARTS = ["ab", "a", "the", " ", "\n", "  é", "ßung", "1", "23", "...", "'s", "日本", "😀", "aaaa", "\x00", "\t"]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding(
        "own", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={}
    )


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.read_ranks(PATH), PATTERN)


def test_same_ids_as_the_library(encoder, library):
    rng = random.Random(1)
    for _ in range(2000):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randrange(30)))
        assert encoder.encode(text) == library.encode_ordinary(text)


@pytest.mark.parametrize("text", ["", "a" * 20_000, "ab" * 9_999 + "a", "é" * 5_000, "\x00" * 300])
def test_long_pieces(encoder, library, text):
    assert encoder.encode(text) == library.encode_ordinary(text)


def test_any_vocabulary():
    """Against merges by rank, over a small vocabulary with awkward overlaps."""
    tokens = [bytes([i]) for i in range(256)] + [b"aa", b"ab", b"aab", b"ba", b"aabba", b"bb"]
    encoder = bpe.Encoder({t: i for i, t in enumerate(tokens)}, r"[^ ]+| +")
    rng = random.Random(3)
    for _ in range(3000):
        piece = bytes(rng.choice(b"ab") for _ in range(rng.randrange(1, 16)))
        whole = encoder.rank.get(piece.decode())
        expected = [whole] if whole is not None else encoder.merged(piece.decode())
        assert encoder.encode_piece(piece) == expected


def test_round_trip_and_digests(spark, library):
    rows = [(1, "the  cat's\n"), (1, "the  cat's\n"), (2, ""), (3, None), (None, "日本 😀"), (4, "x " * 50_000)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, ids string")
    found = bpe.decoded(bpe.encoded(docs, PATH, PATTERN), PATH, PATTERN)
    assert sorted((r.doc_id or 0, bytes(r.bytes).decode()) for r in found.collect()) == sorted(
        (d or 0, t or "") for d, t in rows
    )
    for r in bpe.digests(found).collect():
        text = next(t or "" for d, t in rows if d == r.doc_id)
        ids = library.encode_ordinary(text)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.digests(bpe.decoded(bpe.encoded(docs, PATH, PATTERN), PATH, PATTERN)).count() == 0


def test_query_over_the_whole_table(spark, sf, library):
    found = {r.doc_id: r for r in queries.op10_byte_bpe(spark, sf).collect()}
    texts = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(found) == len(texts)
    for t in texts:
        ids = library.encode_ordinary(t.text)
        assert found[t.doc_id].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert found[t.doc_id].decoded_sha256 == hashlib.sha256(t.text.encode()).hexdigest()
