"""The same two merges on Delta tables, where the ``delta`` package is there.

Use these with a session that has the Delta extensions; the Parquet layouts
in ``newslake.sources.tables`` need nothing beyond Spark.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

try:
    from delta.tables import DeltaTable
except ImportError:
    DeltaTable = None


def _match(keys: Sequence[str]) -> str:
    return " and ".join(f"t.`{k}` <=> s.`{k}`" for k in keys)


def _merge(src: DataFrame, path: str, keys: Sequence[str], update: bool) -> None:
    if DeltaTable is None:
        raise RuntimeError("Delta tables need the delta-spark package")
    if not DeltaTable.isDeltaTable(src.sparkSession, path):
        src.write.format("delta").mode("overwrite").save(path)
        return
    merge = DeltaTable.forPath(src.sparkSession, path).alias("t").merge(src.alias("s"), _match(keys))
    if update:
        merge = merge.whenMatchedUpdateAll()
    merge.whenNotMatchedInsertAll().execute()


def insert_new(src: DataFrame, path: str, keys: Sequence[str]) -> None:
    _merge(src, path, keys, update=False)


def upsert(src: DataFrame, path: str, keys: Sequence[str]) -> None:
    _merge(src, path, keys, update=True)
