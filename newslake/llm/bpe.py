"""Byte-level BPE by backtracking over longest matches.

A piece of text (one match of the splitting pattern) becomes a string with one
Latin-1 character per byte, so that an Aho-Corasick automaton over the
vocabulary finds every token in it in one pass. The encoder takes the longest
token at each place, provided that it is compatible with the token before it:
two tokens may stand side by side if merging their joint bytes by rank gives
back just these two. Answers are remembered per pair. If no token fits, the one
before it is taken back and shortened; a place that failed once is never
entered again, so the time is linear in the piece. The result is what merging
by rank would give.

Unicode classes are those of the ``regex`` library; for letters that were added
to Unicode in the last versions they may differ from another library's.
"""

from __future__ import annotations

import base64
import sys
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslake.llm.common import once_per_worker, to_python

cloudpickle.register_pickle_by_value(sys.modules[__name__])

KNOWN_PIECES = 300_000
KNOWN_PAIRS = 2_000_000
LONGEST_KEPT = 64
_TEXT_AT_ONCE = 4_000_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Vocabulary file with one base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(t): int(r) for t, r in (x.split() for x in lines if x.strip())}


class _Pieces(dict):
    """Piece to token ids; the common ones are kept, up to a bound."""

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = tuple(self.encoder.encode_piece(piece.encode()))
        if len(piece) <= LONGEST_KEPT:
            if len(self) >= KNOWN_PIECES:
                self.clear()
            self[piece] = ids
        return ids


class Encoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.rank = {token.decode("latin-1"): rank for token, rank in ranks.items()}
        self.token = {rank: token for token, rank in self.rank.items()}
        self.length = {rank: len(token) for token, rank in self.rank.items()}
        self.automaton = ahocorasick.Automaton()
        for token, rank in self.rank.items():
            self.automaton.add_word(token, rank)
        self.automaton.make_automaton()
        self.split = regex.compile(pattern).findall
        self.shorter: dict[int, int] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.pieces = _Pieces(self)
        size = max(self.token) + 1
        self.lengths = np.zeros(size, np.int64)
        self.lengths[list(self.length)] = list(self.length.values())
        self.starts = np.cumsum(self.lengths) - self.lengths
        joined = "".join(self.token.get(i, "") for i in range(size))
        self.bytes = np.frombuffer(joined.encode("latin-1"), np.uint8)

    def merged(self, piece: str) -> list[int]:
        """Tokens by repeated merges of the lowest rank, leftmost first."""
        parts = list(piece)
        while len(parts) > 1:
            found = [self.rank.get(a + b, len(self.lengths)) for a, b in zip(parts, parts[1:])]
            best = min(found)
            if best == len(self.lengths):
                break
            at = found.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.rank[p] for p in parts]

    def compatible(self, left: int, right: int) -> bool:
        known = self.pairs.get((left, right))
        if known is None:
            known = self.merged(self.token[left] + self.token[right]) == [left, right]
            if len(self.pairs) >= KNOWN_PAIRS:
                self.pairs.clear()
            self.pairs[left, right] = known
        return known

    def next_shorter(self, token: int) -> int:
        """The longest shorter token that the token begins with, or -1."""
        known = self.shorter.get(token)
        if known is None:
            text = self.token[token]
            heads = (text[:n] for n in range(len(text) - 1, 0, -1))
            known = next((self.rank[h] for h in heads if h in self.rank), -1)
            self.shorter[token] = known
        return known

    def encode_piece(self, piece: bytes) -> list[int]:
        text = piece.decode("latin-1")
        whole = self.rank.get(text)
        if whole is not None:
            return [whole]
        longest = [-1] * len(text)
        for end, token in self.automaton.iter(text):  # ends ascend: the last one is the longest
            longest[end + 1 - self.length[token]] = token
        passable = bytearray(b"\1") * (len(text) + 1)
        taken: list[int] = []
        place, token = 0, longest[0] if text else -1
        while place < len(text):
            while token >= 0:
                end = place + self.length[token]
                if passable[end] and (not taken or self.compatible(taken[-1], token)):
                    break
                token = self.next_shorter(token)
            if token >= 0:
                taken.append(token)
                place = end
                token = longest[place] if place < len(text) else -1
            else:
                passable[place] = 0
                token = taken.pop()
                place -= self.length[token]
        return taken

    def encode(self, text: str) -> list[int]:
        ids: list[int] = []
        for piece in map(self.pieces.__getitem__, self.split(text)):
            ids += piece
        return ids

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of many tokens, gathered at once."""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        from_start = np.repeat(self.starts[ids] - ends + lengths, lengths)
        return self.bytes[from_start + np.arange(len(from_start))].tobytes()


def _encoder(path: str, pattern: str) -> Encoder:
    return once_per_worker(("bpe", path, pattern), lambda: Encoder(read_ranks(path), pattern))


def _slices(batch: pa.RecordBatch, sizes: np.ndarray, most: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose sizes add up to about ``most``."""
    if not len(sizes):
        return
    run = np.cumsum(sizes) // most
    cuts = [0, *(np.flatnonzero(np.diff(run)) + 1), len(sizes)]
    for start, end in zip(cuts, cuts[1:]):
        yield batch.slice(start, end - start)


def encoded(texts: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, ids`` for every row of ``doc_id, text``; a null text counts as
    empty and an empty text has no ids. Repeated rows are encoded as they are."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, pattern)
        for whole in batches:
            sizes = np.array([len(t) for t in whole.column(1).to_pylist()])
            for batch in _slices(whole, sizes, _TEXT_AT_ONCE):
                ids = [np.array(encoder.encode(t), np.int32) for t in batch.column(1).to_pylist()]
                ends = np.cumsum([0, *map(len, ids)])
                values = pa.array(np.concatenate(ids), pa.int32())
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
                yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["doc_id", "ids"])

    rows = texts.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return to_python(rows).mapInArrow(encode, "doc_id long, ids array<int>")


def decoded(tokens: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, ids, bytes`` for every row of ``doc_id, ids``; null ids count
    as none. The bytes of whole texts are their UTF-8."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, pattern)
        for whole in batches:
            sizes = np.asarray(whole.column(1).value_lengths())
            for batch in _slices(whole, sizes, _TEXT_AT_ONCE // 4):
                texts = [
                    encoder.decode(np.asarray(ids.values, np.int64)) for ids in batch.column(1)
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(texts, pa.binary())],
                    ["doc_id", "ids", "bytes"],
                )

    rows = tokens.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    return rows.mapInArrow(decode, "doc_id long, ids array<int>, bytes binary")


def digests(decoded: DataFrame) -> DataFrame:
    """One row per document: number of tokens, digest of ids and of bytes."""
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )
