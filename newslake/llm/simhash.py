"""SimHash near-duplicates, found by pigeonhole blocks.

A fingerprint is cut into blocks. Two fingerprints that differ in at most
``distance`` bits leave at least ``BLOCKS - distance`` blocks untouched, so they
agree on some choice of that many blocks. Each distinct fingerprint is sent to
one bucket per choice; fingerprints that meet in a bucket are compared bit by
bit. Within a batch of buckets only one link per fingerprint is sent on, to the
smallest member of its batch that it hangs together with, which keeps all
connections. A bucket of over ``BUCKET`` fingerprints is cut into parts, and
every pair of parts is a bucket of its own, in a task of its own.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newslake.llm.common import checkpointed, to_python, unused
from newslake.llm.components import components

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BITS = 64
BLOCKS = 7
BUCKET = 2048
SEED = 42
_PAIRS_AT_ONCE = 1 << 19


def fingerprint(text: str, shingle: int) -> int:
    """Bits that are set in over half of the hashes of all shingles of words."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = [*accumulate(map(len, words))]
    ends = [end + i for i, end in enumerate(ends)]
    starts = [0, *(end + 1 for end in ends[:-1])]
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[s:e], SEED) for s, e in zip(starts, ends[min(shingle, len(words)) - 1 :])]
    bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    majority = 2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)
    return int(np.packbits(majority, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """``doc_id, row, fingerprint`` (signed longs) for every row; ``row`` is a
    hash of id and text, and a text without words, empty or null, has
    fingerprint zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(text.as_py(), shingle) for text in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.int64())], ["doc_id", "row", "fingerprint"]
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        _row().alias("row"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return to_python(rows).mapInArrow(run, "doc_id long, row long, fingerprint long")


def _row() -> Column:
    """The same for rows of one id and one text."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")))


def block_masks(distance: int) -> list[int]:
    """Masks of all choices of blocks on which a close pair may agree."""
    cuts = [BITS * i // BLOCKS for i in range(BLOCKS + 1)]
    blocks = [(1 << high) - (1 << low) for low, high in zip(cuts, cuts[1:])]
    masks = [sum(choice) for choice in combinations(blocks, BLOCKS - distance)]
    return [m - (1 << BITS) if m >> BITS - 1 else m for m in masks]


def _tie(labels: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
    """Gives the rows of all pairs, and what hangs on them, the least label."""
    while True:
        a, b = labels[left], labels[right]
        differ = a != b
        if not differ.any():
            return
        left, right, a, b = left[differ], right[differ], a[differ], b[differ]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while (labels != (shorter := labels[labels])).any():
            labels[:] = shorter


def linked(buckets: np.ndarray, prints: np.ndarray, distance: int) -> np.ndarray:
    """For rows in order of bucket numbers: the first row of the batch that
    each hangs together with by close pairs within buckets."""
    labels = np.arange(len(prints))
    lag, rows = 1, np.flatnonzero(buckets[:-1] == buckets[1:])
    held, number = [], 0
    while len(rows):
        close = rows[np.bitwise_count(prints[rows] ^ prints[rows + lag]) <= distance]
        held.append((close, close + lag))
        number += len(close)
        lag += 1
        rows = rows[rows + lag < len(prints)]
        rows = rows[buckets[rows] == buckets[rows + lag]]
        if number > _PAIRS_AT_ONCE or not len(rows):
            _tie(labels, *map(np.concatenate, zip(*held)))
            held, number = [], 0
    return labels


def links(prints: DataFrame, distance: int = 4) -> DataFrame:
    """Edges ``a, b`` between the nodes of distinct fingerprints, given as
    ``fingerprint, node``: they hold together what pairs of fingerprints within
    the distance hold together."""
    if not 0 <= distance < BLOCKS:
        raise ValueError(f"distance must be from 0 to {BLOCKS - 1}")
    masks = F.array(*map(F.lit, block_masks(distance)))
    keyed = prints.select("fingerprint", "node", F.explode(masks).alias("mask")).select(
        "fingerprint", "node", "mask", F.col("fingerprint").bitwiseAND(F.col("mask")).alias("key")
    )
    shared = keyed.groupBy("mask", "key").agg(F.count("*").alias("members")).where("members > 1")
    parts = F.ceil(F.col("members") / BUCKET).cast("int")
    part = F.pmod(F.xxhash64("fingerprint"), parts).cast("int")
    order = ["mask", "key", "low", "high"]
    met = (
        keyed.join(shared, ["mask", "key"])
        .select("fingerprint", "node", "mask", "key", parts.alias("parts"), part.alias("part"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select(
            "fingerprint", "node", "mask", "key",
            F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"),
        )
        .repartition(*order)
        .sortWithinPartitions(*order, "node")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None

        def edges(rows: np.ndarray, new: np.ndarray) -> pa.RecordBatch:
            found = linked(np.cumsum(new), rows[0].view(np.uint64), distance)
            tied = np.flatnonzero(found != np.arange(len(found)))
            return pa.RecordBatch.from_arrays(
                [pa.array(rows[1][tied]), pa.array(rows[1][found[tied]])], ["a", "b"]
            )

        for batch in batches:
            rows = np.stack([c.to_numpy().astype(np.int64) for c in batch.columns])
            rows = rows if kept is None else np.concatenate([kept, rows], axis=1)
            new = np.ones(rows.shape[1], bool)
            new[1:] = (rows[2:, 1:] != rows[2:, :-1]).any(axis=0)
            last = np.flatnonzero(new)[-1] if len(new) else 0  # its bucket may go on
            kept = rows[:, last:]
            if last:
                yield edges(rows[:, :last], new[:last])
        if kept is not None and kept.shape[1]:
            new = np.zeros(kept.shape[1], bool)
            yield edges(kept, new)

    return met.mapInArrow(compare, "a long, b long")


def _grouped(stored: DataFrame, distance: int) -> DataFrame:
    """``fingerprint, component_id`` of every fingerprint; nodes are the
    fingerprints themselves, so that rows of one id tie nothing together."""
    prints = checkpointed(stored.groupBy("fingerprint").agg(F.min("doc_id").alias("least")))
    found = components(links(prints.withColumn("node", F.col("fingerprint")), distance))
    named = prints.join(found, prints.fingerprint == found.node, "left").select(
        "fingerprint", "least", F.coalesce("component", "fingerprint").alias("component")
    )
    first = named.groupBy("component").agg(F.min("least").alias("component_id"))
    return named.join(first, "component").select("fingerprint", "component", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``doc_id, text``.

    Documents whose fingerprints differ in at most ``distance`` bits are
    linked, and the component's id is its smallest ``doc_id``. Exact copies,
    and repeated rows, have one fingerprint and count as one from then on.
    Texts without words have fingerprint zero and are linked like any other.
    Rows without a ``doc_id`` are linked too; a component of such rows alone
    has no id. Other columns are ignored.
    """
    stored = checkpointed(fingerprints(docs, shingle))
    return stored.join(_grouped(stored, distance), "fingerprint", "left").select(
        "doc_id", "fingerprint", "component_id"
    )


def one_of_each(docs: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """The documents without near-duplicates: of each component one row stays,
    that with the smallest ``doc_id``; of several such the one with the smallest
    hash, and rows without an id come last. Rows that share an id and nothing
    else are documents of their own. The columns are those of the input."""
    stored = checkpointed(fingerprints(docs, shingle))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    chosen = (
        stored.join(_grouped(stored, distance), "fingerprint").groupBy("component")
        .agg(F.min(order).alias("first")).select(F.col("first.row").alias("chosen"))
    )
    row, turn = unused(docs, "_row"), unused(docs, "_turn")
    marked = docs.withColumn(row, _row())
    once = Window.partitionBy(row).orderBy(F.lit(0))
    return (
        marked.join(chosen, marked[row] == chosen.chosen, "left_semi")
        .withColumn(turn, F.row_number().over(once))
        .where(F.col(turn) == 1)
        .select(docs.columns)
    )


def digests(found: DataFrame) -> DataFrame:
    """The fingerprint written as 16 hexadecimal digits."""
    written = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return found.select("doc_id", written.alias("fingerprint"), "component_id")
