"""Nearest articles over large vector tables, by hash tables.

The sides of some fixed planes on which a vector lies are bits; ``bits`` of them
make a key, and there is a key per hash table. Vectors at a small angle share a
key in some table with high probability: with the default of 32 tables of 8 bits
those of a cosine of 0.7 in 96 of 100 cases, of 0.8 in 99. Keys are stored with
the vectors. A question is compared, exactly, only with vectors that share a
bucket (table and key) with it. Buckets that no question asks for are left out
before anything is shuffled; a bucket with many vectors or many questions is
cut into parts, each of bounded size, that meet in tasks of their own. A task
sends on the best few per question, so no pair leaves it for nothing.

A question that finds fewer than it asked for is searched exactly, and so are
all questions over a table of at most ``EXACT_ROWS`` rows, which are counted.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslake.operators import search
from newslake.session import shared_dir

# Sent along with the jobs: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

EXACT_ROWS = 100_000
QUESTIONS_PER_PART = 1024


@dataclass(frozen=True)
class HashTables:
    """More bits make smaller buckets, more tables find more."""

    tables: int = 32
    bits: int = 8

    def planes(self, dims: int) -> np.ndarray:
        """One row of signs per bit; the same everywhere, from checksums."""
        signs = [
            1.0 if hashlib.md5(f"{plane}:{place}".encode()).digest()[0] & 1 else -1.0
            for plane in range(self.tables * self.bits)
            for place in range(dims)
        ]
        return np.array(signs).reshape(self.tables * self.bits, dims)

    def keys(self, rows: np.ndarray, planes: np.ndarray) -> np.ndarray:
        sides = (rows @ planes.T >= 0).reshape(len(rows), self.tables, self.bits)
        return (sides * (1 << np.arange(self.bits))).sum(axis=2)


def with_keys(vectors: DataFrame, by: HashTables = HashTables()) -> DataFrame:
    """The table, with ``values``, and the ``keys`` of each vector, to be stored
    together. Vectors that no search finds (see ``search.unusable``) have none."""
    schema = vectors.drop("keys").schema.add("keys", T.ArrayType(T.IntegerType()))
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = None
        for batch in batches:
            values = batch.column("values")
            there = values.is_valid().to_numpy(zero_copy_only=False)
            found: list[list[int] | None] = [None] * len(batch)
            if there.any():
                rows = search.unit_rows(values.filter(pa.array(there)))
                if planes is None or planes.shape[1] != rows.shape[1]:
                    planes = by.planes(rows.shape[1])
                finite = np.isfinite(rows).all(axis=1)
                keys = by.keys(np.where(finite[:, None], rows, 0.0), planes).tolist()
                for i, good, own in zip(np.flatnonzero(there), finite, keys):
                    found[i] = own if good else None
            columns = [batch.column(c) for c in names[:-1]]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.list_(pa.int32()))], names)

    return vectors.drop("keys").mapInArrow(run, schema)


def _postings(keyed: DataFrame, own: str) -> DataFrame:
    return keyed.select(own, "values", F.posexplode("keys").alias("table", "key"))


def _buckets(posted: DataFrame, asked: DataFrame, rows: int) -> DataFrame:
    """Buckets that hold vectors and are asked for, and into how many parts
    their vectors and their questions are cut."""
    bucket = ["table", "key"]
    wanted = asked.groupBy(*bucket).agg(F.count("*").alias("questions"))
    held = posted.select(*bucket).join(wanted.select(*bucket), bucket, "left_semi")
    parts = lambda n, most: F.ceil(F.col(n) / most).cast("long")
    return (
        held.groupBy(*bucket).agg(F.count("*").alias("rows")).join(wanted, bucket)
        .select(
            *bucket, parts("rows", rows).alias("v_parts"),
            parts("questions", QUESTIONS_PER_PART).alias("q_parts"),
        )
    )


def candidates(keyed: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """``q_id, id, score`` of the best of each part of each shared bucket."""
    dims = asked.agg(F.max(F.size("values"))).first()[0] or 1
    posted, wanted = _postings(keyed, "id"), _postings(asked, "q_id")
    buckets = _buckets(posted, wanted, max(1, search.NUMBERS_PER_BLOCK // dims))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    some = lambda key, n: F.pmod(F.xxhash64(key), F.col(n))
    meet = ["table", "key", "v_part", "q_part"]
    left = posted.join(buckets, ["table", "key"]).select(
        "table", "key", some("id", "v_parts").alias("v_part"), every("q_parts").alias("q_part"), "id", "values"
    )
    right = wanted.join(buckets, ["table", "key"]).select(
        "table", "key", every("v_parts").alias("v_part"), some("q_id", "q_parts").alias("q_part"), "q_id", "values"
    )
    return left.groupBy(*meet).cogroup(right.groupBy(*meet)).applyInArrow(
        search.best_of_block(k), search.candidate_schema(keyed, asked)
    )


def nearest(
    keyed: DataFrame,
    questions: DataFrame,
    k: int = search.TOP_K,
    by: HashTables = HashTables(),
    exact_rows: int = EXACT_ROWS,
) -> DataFrame:
    """``q_id, rank, id, score`` of the best ``k`` vectors found per question.

    ``keyed`` has one row per ``id`` with ``values`` and the ``keys`` that
    ``with_keys`` gave it by the same hash tables, ``questions`` one row per
    ``q_id`` with ``values``. Scores and ties are those of ``search.nearest``.
    """
    usable = keyed.where(F.col("keys").isNotNull())
    stored = usable.count()
    if stored <= exact_rows:
        return search.nearest(usable, questions, k)
    spark = keyed.sparkSession
    asked = with_keys(questions.select("q_id", "values"), by).where(F.col("keys").isNotNull())
    asked = _written(asked, shared_dir(spark, "asked"))
    found = _written(search.ranked(candidates(usable, asked, k), k), shared_dir(spark, "found"))
    full = found.where(F.col("rank") == min(k, stored)).select(F.col("q_id").alias("full"))
    short = asked.join(full, asked.q_id == full.full, "left_anti").select("q_id", "values")
    if not short.limit(1).count():
        return search.shown(found)
    kept = search.shown(found).join(short.select("q_id"), "q_id", "left_anti")
    return kept.unionByName(search.nearest(usable, short, k))


def _written(df: DataFrame, path: str) -> DataFrame:
    """Computed once: the embedder may be dear, and the rows are read twice."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
