"""Packing documents into sequences by minimum bin slack.

Only the number of pieces of each length decides what is packed with what, and
there are at most as many lengths as a sequence has tokens. So the jobs count
the pieces per length; the driver plans on these few numbers, and every task
looks up its own pieces' places in the plan.

The plan fills one sequence at a time. The longest piece left is set; a
subset-sum table over the lengths left, held as a bitset, then gives the
fullest combination that fits beside it, with longer pieces preferred. That
combination is taken as often as its pieces last, since the next search would
find it again, so the number of searches follows the number of lengths.
"""

from __future__ import annotations

import json
import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
import tokenizers
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newslake.llm.common import checkpointed, once_per_worker, to_python

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _byte_letters() -> dict[str, int]:
    """The letter that a byte-level vocabulary file writes for each byte:
    printable Latin-1 bytes stand for themselves, others for 256 and up."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = (b for b in range(256) if b not in plain)
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


def read_tokenizer(path: str, pattern: str):
    """A function from text to ids, without special tokens. A plain byte-level
    vocabulary is run by the faster of two libraries with the same result."""
    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    model, before = told["model"], told.get("pre_tokenizer") or {}
    special = {t["content"] for t in told.get("added_tokens", ()) if t.get("special")}
    byte_level = (
        model.get("type") == "BPE"
        and not told.get("normalizer")
        and before.get("type") == "ByteLevel"
        and not before.get("add_prefix_space")
        and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix"))
    )
    if byte_level:
        letter = _byte_letters()
        ranks = {
            bytes(letter[c] for c in token): rank
            for token, rank in model["vocab"].items()
            if token not in special
        }
        own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        return own.encode_ordinary
    own = tokenizers.Tokenizer.from_file(path)
    own.encode_special_tokens = True
    return lambda text: own.encode(text, add_special_tokens=False).ids


def cut(n: int, most: int) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of ``n`` tokens; only the first may be short."""
    first = n % most or min(n, most)
    return [(0, first), *((start, most) for start in range(first, n, most))]


def pieces(docs: DataFrame, path: str, pattern: str, most: int, end_id: int) -> DataFrame:
    """Pieces of each document's ids, ``end_id`` at their end, with the task
    that made each piece and its number among that task's pieces of its length.
    Null texts count as empty and have one piece, ``end_id`` alone."""

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = once_per_worker(("packing", path), lambda: read_tokenizer(path, pattern))
        task, seen = TaskContext.get().partitionId(), [0] * (most + 1)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.array([*encode(text.as_py()), end_id], "<u4")
                for number, (start, length) in enumerate(cut(len(ids), most)):
                    crc = zlib.crc32(ids[start : start + length].tobytes())
                    rows.append((doc_id, number, start, length, crc, task, seen[length]))
                    seen[length] += 1
            yield pa.RecordBatch.from_pylist(
                [dict(zip(schema.names, row)) for row in rows], schema=schema
            )

    schema = pa.schema(
        [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
         ("length", pa.int64()), ("ids_crc32", pa.int64()), ("task", pa.int32()),
         ("number", pa.int64())]
    )
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return to_python(rows).mapInArrow(tokenize, f"{PIECES}, task int, number long")


def fullest(left: dict[int, int], room: int) -> dict[int, int]:
    """The combination of lengths, at most ``left`` of each, that comes nearest
    to ``room``; longer ones are preferred."""
    sums, steps = 1, []
    mask = (1 << room + 1) - 1
    for length in sorted((n for n, count in left.items() if count and n <= room), reverse=True):
        before, uses, take = sums, min(left[length], room // length), 1
        while uses:
            take = min(take, uses)
            sums |= sums << length * take & mask
            uses -= take
            take *= 2
        if sums != before:
            steps.append((length, before))
        if sums >> room:
            break
    total, found = sums.bit_length() - 1, {}
    for length, before in reversed(steps):
        uses = 0
        while not before >> total - uses * length & 1:
            uses += 1
        if uses:
            found[length] = uses
            total -= uses * length
    return found


def plan(counts: dict[int, int], most: int) -> list[tuple[int, dict[int, int]]]:
    """How often to make a sequence of which pieces: ``(times, {length: uses})``."""
    left, made = {n: c for n, c in sorted(counts.items()) if c}, []
    while left:
        longest = max(left)
        left[longest] -= 1
        uses = fullest(left, most - longest)
        left[longest] += 1
        uses[longest] = uses.get(longest, 0) + 1
        times = min(left[n] // u for n, u in uses.items())
        for n, u in uses.items():
            left[n] -= times * u
            if not left[n]:
                del left[n]
        made.append((times, uses))
    return made


class Places:
    """Looks up where the k-th piece of a length goes."""

    def __init__(self, made: list[tuple[int, dict[int, int]]]):
        taken: dict[int, int] = {}
        self.rows: dict[int, list] = {}
        sequence = 0
        for times, uses in made:
            offset = 0
            for length in sorted(uses, reverse=True):
                first = taken.get(length, 0)
                self.rows.setdefault(length, []).append((first, sequence, uses[length], offset))
                taken[length] = first + times * uses[length]
                offset += length * uses[length]
            sequence += times
        self.sequences = sequence
        self.rows = {n: np.array(rows, np.int64).T for n, rows in self.rows.items()}

    def find(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequences, offsets = np.empty_like(ranks), np.empty_like(ranks)
        for length in np.unique(lengths):
            own = lengths == length
            first, sequence, uses, offset = self.rows[int(length)]
            row = np.searchsorted(first, ranks[own], "right") - 1
            turn, slot = np.divmod(ranks[own] - first[row], uses[row])
            sequences[own] = sequence[row] + turn
            offsets[own] = offset[row] + slot * length
        return sequences, offsets


def packed(
    docs: DataFrame, path: str, pattern: str, most: int = 1024, end_id: int = 2
) -> DataFrame:
    """All documents packed into sequences of at most ``most`` tokens.

    One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id,
    offset``. Rows that repeat a ``doc_id`` are documents of their own; an
    empty table gives no rows; other columns are ignored. The rows per task and
    length are numbered from a stored table, so a lost task changes nothing.
    """
    cut_up = checkpointed(pieces(docs, path, pattern, most, end_id))
    per_task = cut_up.groupBy("length", "task").agg(F.count("*").alias("own"))
    counts = {r.length: r.n for r in per_task.groupBy("length").agg(F.sum("own").alias("n")).collect()}
    places = Places(plan(counts, most))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = per_task.select(
        "length", "task", F.coalesce(F.sum("own").over(earlier), F.lit(0)).alias("earlier")
    )
    ranked = cut_up.join(offsets, ["length", "task"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("number") + F.col("earlier")).alias("rank"),
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = places.find(batch.column("length").to_numpy(), batch.column("rank").to_numpy())
            columns = [*batch.columns[:5], *map(pa.array, found)]
            yield pa.RecordBatch.from_arrays(
                columns, [*batch.schema.names[:5], "sequence_id", "offset"]
            )

    return ranked.mapInArrow(place, f"{PIECES}, sequence_id long, offset long")
