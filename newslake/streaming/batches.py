"""Names for micro-batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession


def batch_tags(checkpoint: str) -> Callable[[SparkSession, int], str]:
    """Tags of a stream's micro-batches: the same when one is replayed, and
    never used by another stream, because each checkpoint has its own id."""
    streams: list[str] = []

    def tag(spark: SparkSession, batch_id: int) -> str:
        if not streams:
            found = spark.read.schema("id string").json(f"{checkpoint}/metadata").first()
            streams.append(found["id"])
        return f"stream-{streams[0]}-{batch_id:08d}"

    return tag
