"""Keyed merges as joins.

Keys are compared null-safe unless said otherwise: a null key is a key like
any other, so repeated runs never pile up rows with a null date. Plain equality
is for keys that are never null; Spark then joins on the partitioning that the
duplicate removal by that key left behind.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_KEY_BYTES = 64 * 1024 * 1024
ROW_BYTES = 32


def _keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(k).alias(f"_{k}") for k in keys])


def _same_key(df: DataFrame, other: DataFrame, keys: Sequence[str], null_safe: bool) -> Column:
    pairs = [(df[k], other[f"_{k}"]) for k in keys]
    return reduce(and_, [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs])


def require_unique(src: DataFrame, keys: Sequence[str]) -> None:
    """Fails if a key occurs twice. Only the keys are read and counted, with
    partial counts before the shuffle."""
    counted = src.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1")
    if counted.limit(1).count():
        raise ValueError(f"several rows in the merge source for one key of {list(keys)}")


def unmatched(
    src: DataFrame, target: DataFrame, keys: Sequence[str], null_safe: bool = True
) -> DataFrame:
    """Rows of ``src`` whose key is not in ``target``.

    Of ``target`` only the key columns are read. Both should hold one row per
    key, so that no join partition is hot.
    """
    known = _keys(target, keys)
    return src.join(known, _same_key(src, known, keys, null_safe), "left_anti")


def _key_bytes(keys: DataFrame) -> int:
    """What the keys take on the wire: their text and some bytes per row."""
    text = [F.coalesce(F.octet_length(keys[c].cast("string")), F.lit(0)) for c in keys.columns]
    return keys.agg(F.sum(reduce(add, text) + F.lit(ROW_BYTES)).alias("n")).first()["n"] or 0


def unmatched_in_large(
    src: DataFrame, target: DataFrame, keys: Sequence[str], null_safe: bool = True
) -> DataFrame:
    """As ``unmatched``, for a ``src`` much smaller than ``target``.

    The keys of ``src`` are measured. Up to ``BROADCAST_KEY_BYTES`` they go to
    every task of one scan of the target's keys, which is not shuffled, and
    what the scan finds, each key once and so no more than was sent, goes back
    to ``src``. Beyond
    that Spark chooses the join. ``src`` is used three times, so the caller
    caches it.
    """
    wanted = _keys(src, keys)
    if _key_bytes(wanted) > BROADCAST_KEY_BYTES:
        return unmatched(src, target, keys, null_safe)
    sent = F.broadcast(wanted)
    found = _keys(target.join(sent, _same_key(target, sent, keys, null_safe), "left_semi"), keys)
    back = F.broadcast(found.distinct())
    return src.join(back, _same_key(src, back, keys, null_safe), "left_anti")
