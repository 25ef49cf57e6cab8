"""Approximate nearest neighbours by a permutation index.

A bounded sample of vectors serves as pivots. Every vector is represented by
its ``POSTED`` nearest pivots in order, and posted in the inverted file of each
of these, with the place that the pivot has in its order. A query opens the
files of its own ``OPENED`` nearest pivots only, and so meets a small part of
the postings. What two orders share there tells how much nearer they are than
orders that share nothing, by the footrule distance of lists that are cut off.
The candidates with the least distance are ranked anew by the inner product of
the original vectors: ``SHARE`` of a block, and all with less than ``NEAR`` of
the distance of strangers, so that a crowd of near copies is ranked whole.

Vectors are dealt to blocks by a hash, and each task builds the files of one
block and runs a group of queries through them, one at a time. So memory is
bounded by the block; queries, which come in numbers far below the vectors, are
what is sent to every block. Each block hands on ``k`` rows per query.

Large inner products prefer long vectors. So vectors are lengthened, by one
more component, to the length of the longest one; then the order by distance is
the order by inner product.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PIVOTS = 1024
SAMPLED = 4_096
POSTED = 48
OPENED = 48
SHARE = 0.15
NEAR = 0.5
BLOCK = 16_384
BLOCK_NUMBERS = 4 * 1024 * 1024
QUERIES = 32_768
_ORDERED_AT_ONCE = 2048
#: Beyond these powers of two, squares of components leave the range of doubles.
_LARGE, _SMALL = 2.0**480, 2.0**-480


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, vector`` (doubles) of the rows that take part: with an id, no
    null or non-finite component, some component other than zero, and the
    commonest length (of equally common ones the largest). Of rows that repeat
    an id, the smallest vector counts."""
    vector = F.col("embedding").cast("array<double>")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector"))
        .where("vec_id is not null and vector is not null")
        .where(F.forall("vector", finite) & F.exists("vector", lambda x: x != 0))
    )
    sizes = rows.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n"))
    common = sizes.orderBy(F.desc("n"), F.desc("size")).first()
    rows = rows.where(F.size("vector") == (common.size if common else 0))
    return rows.groupBy("vec_id").agg(F.min("vector").alias("vector"))


def pivots(vectors: DataFrame, most: int = PIVOTS) -> np.ndarray:
    """Distinct vectors, at most ``most``, from a sample of ``SAMPLED`` that is
    chosen by a hash of the ids. Each one is the one farthest from those before
    it, so that a crowd of near copies has one pivot."""
    chosen = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLED).collect()
    rows = np.array([r.vector for r in chosen], np.float64)
    taken: list[int] = []
    far = np.full(len(rows), np.inf)
    while len(taken) < min(most, len(rows)) and (far > 0).any():
        taken.append(int(far.argmax()))
        far = np.minimum(far, ((rows - rows[taken[-1]]) ** 2).sum(axis=1))
    return rows[taken]


def lengthened(vectors: np.ndarray, longest: float) -> np.ndarray:
    rest = np.maximum(longest - np.einsum("ij,ij->i", vectors, vectors), 0)
    return np.column_stack([vectors, np.sqrt(rest)])


def orders(vectors: np.ndarray, pivots: np.ndarray, most: int) -> np.ndarray:
    """The nearest pivots of each vector, nearest first, for vectors of equal length."""
    most = min(most, len(pivots))
    found = np.empty((len(vectors), most), np.int64)
    for at in range(0, len(vectors), _ORDERED_AT_ONCE):
        part = slice(at, at + _ORDERED_AT_ONCE)
        far = -(vectors[part] @ pivots.T)
        first = np.argpartition(far, most - 1, axis=1)[:, :most] if most < len(pivots) else None
        if first is None:
            found[part] = np.argsort(far, axis=1, kind="stable")
        else:
            first.sort(axis=1)
            order = np.argsort(np.take_along_axis(far, first, axis=1), axis=1, kind="stable")
            found[part] = np.take_along_axis(first, order, axis=1)
    return found


class Block:
    """The inverted files of one block; rows are in order of their ids."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, pivots: np.ndarray, longest: float):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        self.pivots = lengthened(pivots, longest)
        seen = orders(lengthened(self.vectors, longest), self.pivots, POSTED)
        posted = np.argsort(seen.ravel(), kind="stable")
        self.rows = (posted // seen.shape[1]).astype(np.int32)
        self.places = (posted % seen.shape[1]).astype(np.int32)
        self.starts = np.searchsorted(seen.ravel()[posted], np.arange(len(self.pivots) + 1))
        self.opened = 0

    def nearness(self, query: np.ndarray) -> tuple[np.ndarray, int]:
        """How much less the footrule distance of each row is than that of a row
        that shares no pivot with the query, and that of the query to itself."""
        seen = orders(np.append(query, 0.0)[None], self.pivots, OPENED)[0]
        most = max(POSTED, OPENED)
        total = np.zeros(len(self.ids), np.int64)
        for own, pivot in enumerate(seen):
            # A row is at most once in a file. What it shares, it doesn't miss in either list.
            file = slice(self.starts[pivot], self.starts[pivot + 1])
            total[self.rows[file]] += 2 * (most - np.maximum(self.places[file], own))
            self.opened += file.stop - file.start
        return total, 2 * sum(most - own for own in range(len(seen)))

    def search(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the best candidates, best first."""
        near, whole = self.nearness(query)
        wanted = max(int(SHARE * len(near)), 2 * k)
        if wanted < len(near):
            # Rows come in order of nearness, then id; a crowd around the query is taken whole.
            rows = np.arange(len(near))
            first = np.argpartition(rows - near * len(near), wanted)[:wanted]
            rows = np.union1d(first, np.flatnonzero(near > (1 - NEAR) * whole))
        else:
            rows = np.arange(len(near))
        rows = rows[self.ids[rows] != query_id]
        # Row by row, so that equal vectors have equal scores.
        scores = (self.vectors[rows] * query).sum(axis=1)
        best = np.lexsort((self.ids[rows], -scores))[:k]
        return self.ids[rows[best]], scores[best]


def nearest(vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """``query_id, rank, vec_id, score``: for every vector for which
    ``is_query``, an expression over ``vec_id``, holds, its ``k`` nearest other
    vectors found, by inner product, ties to the smaller id; all of them if
    there are fewer. Vectors as in ``usable``; ``left_out`` lists the others.
    Components so large or small that their squares leave the range of doubles
    are scaled by a power of two for the order; only the scores shown may then be
    infinite or zero. Other columns are ignored; an empty table gives no rows.
    """
    found = usable(vectors)
    most = found.agg(F.max(F.array_max(F.transform("vector", F.abs)))).first()[0] or 1.0
    scale = 2.0 ** -math.frexp(most)[1] if most > _LARGE or most < _SMALL else 1.0
    if scale != 1.0:
        found = found.withColumn("vector", F.transform("vector", lambda x: x * scale))
    squares = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    counted = found.agg(
        F.count("*").alias("n"), F.count(F.when(is_query, 1)).alias("q"), F.max(squares).alias("longest"),
        F.max(F.size("vector")).alias("dims"),
    ).first()
    chosen, longest = pivots(found), counted.longest or 0.0
    block = max(1, min(BLOCK, BLOCK_NUMBERS // (counted.dims or 1)))
    blocks, groups = -(-counted.n // block), -(-counted.q // QUERIES)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(max(1, n) - 1)))
    dealt = lambda n, salt: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(max(1, n))).cast("int")
    entries = found.select(
        dealt(blocks, 1).alias("block"), every(groups).alias("group"),
        F.lit(False).alias("asks"), "vec_id", "vector",
    )
    asked = found.where(is_query).select(
        every(blocks).alias("block"), dealt(groups, 2).alias("group"),
        F.lit(True).alias("asks"), "vec_id", "vector",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held, files = None, [], None
        for batch in batches:
            cells = np.stack([batch.column(c).to_numpy() for c in ("block", "group")], axis=1)
            asks = batch.column("asks").to_numpy(zero_copy_only=False)
            ids = batch.column("vec_id").to_numpy()
            rows = batch.column("vector").flatten().to_numpy().reshape(len(ids), -1)
            turns = np.flatnonzero((cells[1:] != cells[:-1]).any(axis=1) | (asks[1:] != asks[:-1])) + 1
            out = []
            for start, end in zip([0, *turns], [*turns, len(ids)]):
                if cell != (now := tuple(cells[start])):
                    cell, held, files = now, [], None
                if not asks[start]:
                    held.append((ids[start:end], rows[start:end]))
                elif held or files:
                    files = files or Block(*map(np.concatenate, zip(*held)), chosen, longest)
                    held = []
                    for i in range(start, end):
                        near, scores = files.search(ids[i], rows[i], k)
                        out.append((np.full(len(near), ids[i]), near, scores))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c)) for c in zip(*out)], ["query_id", "vec_id", "score"]
                )

    near = (
        entries.union(asked).repartition("block", "group")
        .sortWithinPartitions("block", "group", "asks", "vec_id")
        .mapInArrow(run, "query_id long, vec_id long, score double")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", (F.col("score") / scale / scale).alias("score"))
    )


def left_out(vectors: DataFrame) -> DataFrame:
    """``vec_id`` of the rows that take no part: without an id first."""
    part = usable(vectors).select("vec_id")
    ids = vectors.select(F.col("vec_id").cast("long").alias("vec_id"))
    return ids.join(part, "vec_id", "left_anti")
