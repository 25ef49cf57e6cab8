"""Exact nearest articles by cosine similarity, for batches of questions.

No join ever pairs questions with vectors row by row. Each task scores Arrow
batches of vectors against a matrix of questions and sends on its best few per
question; a final ranking picks the best of those. A question set of at most
``BROADCAST_NUMBERS`` vector elements, which is measured, is sent to every task
of a single scan. A larger one is cut, like the vectors, into blocks of bounded
size that meet in a grouped job; the result is the same.

Scores that are equal to ``RANK_DIGITS`` digits, the noise of summing in another
order, rank by id; what is shown is rounded to ``SCORE_DIGITS``. Vectors and
questions that hold a null or a number that is not finite take no part, see
``unusable``; vectors of several lengths are an error.
"""

from __future__ import annotations

import heapq
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Sent along with the jobs: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOP_K = 5
RANK_DIGITS = 12
SCORE_DIGITS = 6
BROADCAST_NUMBERS = 4 * 1024 * 1024
NUMBERS_PER_BLOCK = 16 * 1024 * 1024
BROADCAST_HITS = 100_000
_SCORED_AT_ONCE = 256


def unit_rows(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """List column as a matrix of unit rows; an all-zero row stays zero, and
    one with a number that is not finite is NaN throughout."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = pc.min_max(pc.list_value_length(column)).as_py()
    if sizes["min"] != sizes["max"]:
        raise ValueError(f"vectors of {sizes['min']} and of {sizes['max']} numbers")
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    matrix = flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)
    matrix[~np.isfinite(matrix).all(axis=1)] = np.nan
    norms = np.sqrt(np.einsum("ij,ij->i", matrix, matrix))
    return matrix / np.where(norms == 0, 1.0, norms)[:, None]


class _Best:
    """The best ``k`` (score, id) pairs per question so far."""

    def __init__(self, questions: np.ndarray, k: int):
        self.questions, self.k = questions, k
        self.pairs: list[list] = [[] for _ in range(len(questions))]
        self.floor = np.full(len(questions), -np.inf)

    def add(self, vectors: np.ndarray, ids: pa.Array) -> None:
        usable = np.isfinite(vectors).all(axis=1)
        vectors, ids = vectors[usable], ids.filter(pa.array(usable))
        n, k = len(vectors), self.k
        if not n or not len(self.questions):
            return
        if vectors.shape[1] != self.questions.shape[1]:
            raise ValueError(
                f"vectors of {vectors.shape[1]} numbers, questions of {self.questions.shape[1]}"
            )
        # In id order the first of equal scores are the ones to keep, so a
        # question takes at most k rows of a batch, whatever the copies in it.
        order = pc.sort_indices(ids)
        vectors, ids = vectors[order.to_numpy()], ids.take(order)
        for at in range(0, len(self.questions), _SCORED_AT_ONCE):
            part = slice(at, at + _SCORED_AT_ONCE)
            # Adding zero turns -0.0 into 0.0.
            scores = np.round(self.questions[part] @ vectors.T, RANK_DIGITS) + 0.0
            if n > k:
                kth = np.partition(scores, n - k, axis=1)[:, n - k]
            else:
                kth = scores.min(axis=1)
            for q in np.nonzero(scores.max(axis=1) >= self.floor[part])[0]:
                row = scores[q]
                above = np.nonzero(row > kth[q])[0]
                level = np.nonzero(row == kth[q])[0][: k - len(above)]
                self._merge(at + q, row, np.concatenate([above, level]), ids)

    def _merge(self, q: int, scores: np.ndarray, found: np.ndarray, ids: pa.Array) -> None:
        found = found[scores[found] >= self.floor[q]]
        new = zip((-scores[found]).tolist(), ids.take(pa.array(found)).to_pylist())
        best = self.pairs[q] = heapq.nsmallest(self.k, {*self.pairs[q], *new})
        if len(best) == self.k:
            self.floor[q] = -best[-1][0]

    def table(self, q_ids: pa.Array, id_type: pa.DataType) -> dict[str, pa.Array]:
        places = [q for q, pairs in enumerate(self.pairs) for _ in pairs]
        flat = [pair for pairs in self.pairs for pair in pairs]
        return {
            "q_id": q_ids.take(pa.array(places, pa.int64())),
            "id": pa.array([i for _, i in flat], id_type),
            "score": pa.array([-s for s, _ in flat], pa.float64()),
        }


def ranked(candidates: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("q_id").orderBy(F.desc("score"), "id")
    once = candidates.groupBy("q_id", "id").agg(F.max("score").alias("score"))
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def candidate_schema(vectors: DataFrame, questions: DataFrame) -> T.StructType:
    return T.StructType(
        [
            T.StructField("q_id", questions.schema["q_id"].dataType),
            T.StructField("id", vectors.schema["id"].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )


def _scan_with_all(vectors: DataFrame, table: pa.Table, k: int, schema: T.StructType) -> DataFrame:
    q_ids, matrix = table["q_id"].combine_chunks(), unit_rows(table["values"])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, id_type = _Best(matrix, k), None
        for batch in batches:
            id_type = batch.column("id").type
            best.add(unit_rows(batch.column("values")), batch.column("id"))
        if id_type is not None:
            yield pa.RecordBatch.from_pydict(best.table(q_ids, id_type))

    return vectors.mapInArrow(score, schema)


def best_of_block(k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """What scores the vectors of a group against its questions."""

    def score(some: pa.Table, asked: pa.Table) -> pa.Table:
        best = _Best(unit_rows(asked["values"]) if len(asked) else np.zeros((0, 0)), k)
        if len(some):
            best.add(unit_rows(some["values"]), some["id"].combine_chunks())
        id_type = some.schema.field("id").type
        return pa.table(best.table(asked["q_id"].combine_chunks(), id_type))

    return score


def _scan_in_blocks(
    vectors: DataFrame, questions: DataFrame, k: int, schema: T.StructType, q_blocks: int
) -> DataFrame:
    stored = vectors.agg(F.count("*").alias("rows"), F.max(F.size("values")).alias("dims")).first()
    v_blocks = max(1, -(-stored.rows * max(1, stored.dims or 1) // NUMBERS_PER_BLOCK))

    def spread(df: DataFrame, key: str, own: str, n_own: int, other: str, n_other: int):
        return df.withColumn(own, F.pmod(F.xxhash64(key), F.lit(n_own))).withColumn(
            other, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_other - 1).cast("long")))
        )

    left = spread(vectors, "id", "v_block", v_blocks, "q_block", q_blocks)
    right = spread(questions, "q_id", "q_block", q_blocks, "v_block", v_blocks)

    on = ["q_block", "v_block"]
    return left.groupBy(*on).cogroup(right.groupBy(*on)).applyInArrow(best_of_block(k), schema)


def nearest(
    vectors: DataFrame,
    questions: DataFrame,
    k: int = TOP_K,
    broadcast_numbers: int = BROADCAST_NUMBERS,
) -> DataFrame:
    """``q_id, rank, id, score`` of the best ``k`` vectors per question.

    ``vectors`` has one row per ``id``, ``questions`` one per ``q_id``; both
    have ``values`` of one length; those without a vector are passed over.
    """
    v = vectors.select("id", "values").where(F.col("values").isNotNull())
    q = questions.select("q_id", "values").where(F.col("values").isNotNull())
    schema = candidate_schema(v, q)
    q = q.persist()  # embedding them may be dear, and they are read twice
    asked = q.agg(F.count("*").alias("rows"), F.max(F.size("values")).alias("dims")).first()
    per_block = max(1, broadcast_numbers // max(1, asked.dims or 1))
    if asked.rows <= per_block:
        sent = q.toArrow()
        q.unpersist()
        candidates = _scan_with_all(v, sent, k, schema)
    else:
        candidates = _scan_in_blocks(v, q, k, schema, -(-asked.rows // per_block))
    return shown(ranked(candidates, k))


def shown(found: DataFrame) -> DataFrame:
    score = F.round("score", SCORE_DIGITS).alias("score")
    return found.select("q_id", "rank", "id", score)


def unusable(vectors: DataFrame) -> DataFrame:
    """Ids of the vectors that no search finds: null, or with a number in them
    that is null or not finite."""
    finite = F.forall(
        "values", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    return vectors.where(F.col("values").isNull() | ~finite).select("id")


def with_metadata(hits: DataFrame, vectors: DataFrame, broadcast_hits: int = BROADCAST_HITS) -> DataFrame:
    """Hits with the stored metadata of their articles, one row per hit.

    The hits are counted; up to ``broadcast_hits`` they are sent to every task
    of one scan of the vector table, which then isn't shuffled.
    """
    few = hits.persist()
    sent = F.broadcast(few) if few.count() <= broadcast_hits else few
    found = vectors.select("id", "metadata").join(sent, "id")
    return found.dropDuplicates(["q_id", "rank"]).select(*hits.columns, "metadata")
